"""Audit queries and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contract as K
from ..functions.linalg import norm, vec
from ..operators import audit as A, manifest as MF, poses as P, spacing as S
from ..session import materialize, stage_path
from ..sources import bridges as B
from ..sources.tables import table
from . import manifest_plans as MP
from .catalog import cte, query
from .pose_plans import all_poses, frames


# --- case rows -----------------------------------------------------------------------
def cases(spark, sf):
    """Registry rows, one per customer, with known faults."""
    k = F.col("c_custkey")
    models = F.array(*[F.lit(m) for m in K.REQUIRED_MODELS])
    limits = F.create_map(*[F.lit(x) for n in K.POINT_LIMITS for x in (n, 500)])
    base_keys = F.array(*[F.lit(n) for n in ("case_id", "ct_path", "sampling")])
    return table(spark, sf, "customer").select(
        k.alias("case_key"), F.when(k % 13 == 0, "").otherwise(F.concat(F.lit("case-"), k.cast("string"))).alias("case_id"),
        F.when(k % 11 == 0, F.array_append(base_keys, "registration")).otherwise(base_keys).alias("keys"),
        F.when(k % 17 == 0, F.slice(models, 2, 13)).when(k % 17 == 1, F.array_append(models, "lung")).otherwise(models).alias("organ_models"),
        F.when(k % 19 == 0, F.array(F.lit("vein"), F.lit("vein"))).otherwise(F.array(F.lit("vein"), F.lit("artery"))).alias("vessel_labels"),
        F.when(k % 23 == 0, F.lit(float("nan"))).otherwise(F.lit(100.0)).alias("ray_length_mm"), F.lit(300).alias("output_resolution"),
        F.when(k % 29 == 0, 256).otherwise(50).alias("black_threshold"), F.when(k % 31 == 0, 1.5).otherwise(0.6).alias("black_ratio_limit"),
        F.when(k % 37 == 0, "tpu").otherwise("auto").alias("backend"), F.when(k % 41 == 0, "XYZ").otherwise("LPS").alias("input_coordinate_system"),
        F.when(k % 47 == 0, F.map_filter(limits, lambda n, _: n != "liver")).when(k % 53 == 0, F.transform_values(limits, lambda _, v: v - 500))
        .otherwise(limits).alias("point_counts"))


_CASE = {"case_id": "c_custkey % 13 = 0", "unexpected_key": "c_custkey % 11 = 0", "missing_model": "c_custkey % 17 = 0", "unexpected_model": "c_custkey % 17 = 1",
         "vessel_labels": "c_custkey % 19 = 0", "ray_length_mm": "c_custkey % 23 = 0", "black_threshold": "c_custkey % 29 = 0",
         "black_ratio_limit": "c_custkey % 31 = 0", "point_counts": "c_custkey % 47 = 0 OR c_custkey % 53 = 0", "backend": "c_custkey % 37 = 0", "input_coordinate_system": "c_custkey % 41 = 0"}


@query("flt17_case_validation", "SELECT kind, count(*) AS n FROM (SELECT unnest([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for n, c in _CASE.items()) + "]) AS kind FROM customer) WHERE kind IS NOT NULL GROUP BY kind")
def flt17(spark, sf):
    return MF.count_kinds(cases(spark, sf).withColumn("bad", MF.violations(*A.case_checks())), "bad", [])


def settings(spark, sf):
    k = F.col("c_custkey")
    items = list(K.LOCKED_SETTINGS.items())
    pairs = [c for i, (n, v) in enumerate(items) for c in (F.lit(n), F.lit(v) + F.when(k % 40 == i, 1.0).otherwise(0.0))]
    return table(spark, sf, "customer").select(k.alias("case_id"), F.when(k % 43 == 0, F.map_filter(
        F.create_map(*pairs), lambda n, _: n != "runtime.seed")).otherwise(F.create_map(*pairs)).alias("settings"))


_LOCK = ", ".join(f"({i}, '{n}', {v}::DOUBLE)" for i, (n, v) in enumerate(K.LOCKED_SETTINGS.items()))


@query("flt18_locked_settings", f"""
SELECT c_custkey AS case_id, setting, CASE WHEN c_custkey % 43 = 0 AND setting = 'runtime.seed' THEN NULL ELSE required + CASE WHEN c_custkey % 40 = i THEN 1.0 ELSE 0.0 END END AS actual, required
FROM customer, (VALUES {_LOCK}) t(i, setting, required) WHERE c_custkey % 40 = i OR (c_custkey % 43 = 0 AND setting = 'runtime.seed')""")
def flt18(spark, sf):
    return A.setting_mismatches(settings(spark, sf), ["case_id"], "settings")


_NAMES = (*K.CATALOG_IDS, "bile_duct", "gallbladder", "stomach", "esophagus", "colon", "jejunum", "ileum", "omentum", "ureter")


def catalogs(spark, sf):
    """Catalogue versions of twenty entries, built from parts."""
    p = table(spark, sf, "part")
    k = F.col("p_partkey")
    name = B.pick(_NAMES, k % 20)
    ids = F.array(F.col("p_size"), F.col("p_size") + 100)
    dual = name.isin(*K.DUAL_ROLES) & ((F.expr("p_partkey div 20") % 4) != 0)
    return p.select(
        F.expr("p_partkey div 20").alias("catalog"), name.alias("organ_label"), F.when(k % 9 == 0, F.reverse(ids)).otherwise(ids).alias("eus_label_ids"),
        F.when(dual, "organ_and_vessel").otherwise("organ").alias("role"),
        F.when(dual, F.when(name == "aorta", "artery").otherwise("vein")).alias("vessel_type"))


@query("flt22_catalog_validity", f"""
WITH e AS (SELECT p_partkey // 20 AS catalog, p_partkey, p_size FROM part),
 s AS (SELECT catalog, p_size FROM e GROUP BY ALL HAVING count(*) > 1),
 f AS (SELECT catalog, 'banned_label' AS kind FROM e WHERE p_partkey % 20 = {_NAMES.index("bile_duct")} UNION ALL SELECT catalog, 'ids_not_sorted_unique' FROM e WHERE p_partkey % 9 = 0
  UNION ALL SELECT catalog, 'shared_id' FROM s, (VALUES (0), (1)) UNION ALL SELECT DISTINCT catalog, 'dual_roles' FROM e WHERE catalog % 4 = 0)
SELECT catalog, kind, count(*) AS n FROM f GROUP BY ALL""")
def flt22(spark, sf):
    return A.catalog_findings(catalogs(spark, sf), "catalog")


@query("flt23_label_value_owners", """
WITH v AS (SELECT p_partkey // 20 AS case_id, p_partkey % 10 AS organ, p_size * 6 AS value FROM part),
 g AS (SELECT case_id, value, count(*) AS n, count(DISTINCT organ) AS o FROM v GROUP BY ALL)
SELECT case_id, CASE WHEN value > 255 THEN 'out_of_range' WHEN o > 1 THEN 'several_owners' ELSE 'repeated' END AS kind, count(*) AS n FROM g WHERE value > 255 OR o > 1 OR n > 1 GROUP BY ALL""")
def flt23(spark, sf):
    v = table(spark, sf, "part").select(F.expr("p_partkey div 20").alias("case_id"), (F.col("p_partkey") % 10).alias("organ"), (F.col("p_size") * 6).alias("value"))
    return A.shared_values(v, ["case_id"])


# --- audits --------------------------------------------------------------------------------
def run_documents(spark, sf):
    c = MF.status_counts(B.manifest(spark, sf), ["case_id"])
    k = F.col("case_id")
    return c.withColumns({
        "run_state": F.when(k == 2, "interrupted").otherwise("complete"), "total_squares": F.col("completed") + F.when(k == 1, 5).otherwise(0),
        "gallery": F.col("gallery") + F.when(k == 1, 1).otherwise(0)})


_AUD1 = "SELECT case_id, kind FROM (VALUES (1, 'status_counts'), (1, 'total_squares'), (2, 'run_state')) t(case_id, kind) WHERE case_id IN (SELECT case_id FROM b_manifest)"


@query("aud01_totals", _AUD1)
def aud01(spark, sf):
    return A.totals_findings(MF.status_counts(B.manifest(spark, sf), ["case_id"]), run_documents(spark, sf))


@query("aud02_design_identity", f"""
SELECT kind, count(*) AS n FROM (SELECT unnest([CASE WHEN c_custkey % 97 = 0 THEN 'core_design_sha256' END, CASE WHEN c_custkey % 89 = 0 THEN 'pose_angles' END,
 CASE WHEN c_custkey % 83 = 0 THEN 'pose_convention' END]) AS kind FROM customer) WHERE kind IS NOT NULL GROUP BY kind
UNION ALL SELECT 'setting:' || setting, count(*) FROM customer, (VALUES {_LOCK}) t(i, setting, required) WHERE c_custkey % 40 = i OR (c_custkey % 43 = 0 AND setting = 'runtime.seed') GROUP BY setting""")
def aud02(spark, sf):
    """Design hash, angle sets, conventions and locked settings of all cases."""
    from ..functions.angles import angle_grid

    k = F.col("c_custkey")
    convention = "B @ Rz(yaw) @ Ry(pitch) @ Rx(roll)"
    yaws = angle_grid(spark).groupBy("yaw_policy").agg(F.array_sort(F.collect_set("yaw")).alias("yaws")).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("yaw_policy", "yaws")))).alias("angles"))
    docs = table(spark, sf, "customer").crossJoin(F.broadcast(yaws)).select(
        k.alias("case_id"), F.when(k % 97 == 0, "x").otherwise(K.DESIGN_SHA256).alias("design"), F.col("angles").alias("want"),
        F.when(k % 89 == 0, F.map_filter("angles", lambda n, _: n != "standard")).otherwise(F.col("angles")).alias("angles"),
        F.when(k % 83 == 0, "B @ Rx @ Ry @ Rz").otherwise(convention).alias("matrix_order"))
    same = F.array_sort(F.map_entries("angles")) == F.array_sort(F.map_entries("want"))
    bad = MF.violations(("core_design_sha256", F.col("design") != K.DESIGN_SHA256), ("pose_angles", ~same), ("pose_convention", F.col("matrix_order") != convention))
    a = MF.count_kinds(docs.withColumn("bad", bad), "bad", [])
    b = A.setting_mismatches(settings(spark, sf), ["case_id"], "settings").groupBy(F.concat(F.lit("setting:"), "setting").alias("kind")).agg(F.count(F.lit(1)).alias("n"))
    return a.unionByName(b)


@query("aud03_sampling_arithmetic", """
WITH s AS (SELECT case_id, organ, source_region, count(*) AS c FROM b_point GROUP BY ALL),
 t AS (SELECT *, 60 AS r, least(c, 60) AS a FROM s)
SELECT kind, count(*) AS n FROM (SELECT unnest([CASE WHEN hash_ = 0 THEN 'shortfall' END, CASE WHEN hash_ = 1 THEN 'faces' END, CASE WHEN hash_ = 2 THEN 'volume' END]) AS kind FROM (
 SELECT *, (c + case_id) % 4 AS hash_ FROM t)) WHERE kind IS NOT NULL GROUP BY kind""")
def aud03(spark, sf):
    g = B.points(spark, sf).groupBy("case_id", "organ", "source_region").agg(F.count(F.lit(1)).alias("candidate_count"))
    h = (F.col("candidate_count") + F.col("case_id")) % 4
    g = g.withColumns({"requested_count": F.lit(60).cast("long"), "actual_count": F.least("candidate_count", F.lit(60))}).withColumns({
        "shortfall_count": F.col("requested_count") - F.col("actual_count") + F.when(h == 0, 1).otherwise(0),
        "input_faces": F.col("candidate_count") * 2, "kept_faces": F.col("candidate_count"), "discarded_faces": F.col("candidate_count") + F.when(h == 1, 1).otherwise(0),
        "volume_mm3": F.when(h == 2, 0.0).otherwise(10.0)})
    return MF.count_kinds(g.withColumn("bad", MF.violations(*A.sampling_findings(g))), "bad", [])


@query("aud04_exported_points", """
SELECT organ, count(*) FILTER (point_index % 17 = 0) AS n_not_unit, min(d) >= 10.0 - 5e-6 AS spacing_kept FROM b_point p JOIN (
 SELECT a.organ, min(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2)) AS d FROM b_point a JOIN b_point b ON a.organ = b.organ AND a.point_index < b.point_index GROUP BY 1) q USING (organ) GROUP BY organ""")
def aud04(spark, sf):
    """Exported text of all points: unit normals within 2e-5, spacing kept."""
    from ..sinks.ply import point_lines

    p = frames(spark, sf)
    bent = p.withColumn("nx", F.col("nx") + F.when(F.col("point_index") % 17 == 0, F.when(F.col("nx") < 0, -0.01).otherwise(0.01)).otherwise(0.0))
    v = F.split("line", " ")
    r = point_lines(bent).select("organ", "point_index", *[v[i].cast("double").alias(c) for i, c in enumerate(("x", "y", "z", "nx", "ny", "nz"))])
    r = materialize(r, "exported")
    unit = r.groupBy("organ").agg(F.count_if(F.abs(norm(vec("nx", "ny", "nz")) - 1.0) > 2e-5).alias("n_not_unit"))
    gap = S.closest_pair(r, ["organ"], "point_index")
    return unit.join(gap, "organ").select("organ", "n_not_unit", (F.col("min_mm") >= K.SPACING_MM - 5e-6).alias("spacing_kept"))


def faulty_plan(spark, sf):
    k = F.col("point_index")
    return P.point_plan(frames(spark, sf)).withColumns({
        "nx": F.col("nx") * F.when(k % 7 == 0, 2.0).otherwise(1.0), "ny": F.col("ny") * F.when(k % 7 == 0, 2.0).otherwise(1.0),
        "nz": F.col("nz") * F.when(k % 7 == 0, 2.0).otherwise(1.0),
        "hx": F.when(k % 11 == 0, -F.col("hx")).otherwise(F.col("hx")), "hy": F.when(k % 11 == 0, -F.col("hy")).otherwise(F.col("hy")),
        "hz": F.when(k % 11 == 0, -F.col("hz")).otherwise(F.col("hz")),
        "candidate_pose_count": F.col("candidate_pose_count") + F.when(k % 13 == 0, 1).otherwise(0),
        "yaw_policy": F.when((k % 19 == 0) & (F.col("organ") == "esophagus"), "pancreas_special").otherwise(F.col("yaw_policy"))})


@query("aud05_point_plan", """
SELECT organ, kind, count(*) AS n FROM (SELECT organ, unnest([CASE WHEN point_index % 7 = 0 THEN 'normal' END, CASE WHEN point_index % 11 = 0 THEN 'axes' END,
 CASE WHEN point_index % 13 = 0 OR (point_index % 19 = 0 AND organ = 'esophagus') THEN 'pose_count' END, CASE WHEN point_index % 19 = 0 AND organ = 'esophagus' THEN 'region_policy' END]) AS kind FROM b_frame)
WHERE kind IS NOT NULL GROUP BY ALL UNION ALL SELECT organ, 'index_gaps', 1 FROM b_frame GROUP BY organ HAVING max(point_index) + 1 <> count(*) OR min(point_index) <> 0""")
def aud05(spark, sf):
    """Plan rows: normals, axes, protocol, pose count, and gap-free numbering.

    Numbering is judged from count, minimum, maximum and distinct count.
    """
    from ..functions.angles import policy_dim

    d = policy_dim(spark).select("yaw_policy", "n_poses")
    p = faulty_plan(spark, sf).join(F.broadcast(d), "yaw_policy", "left")
    region = dict(MF.protocol_checks()[:5])
    bad = MF.violations(
        ("normal", F.abs(norm(vec("nx", "ny", "nz")) - 1.0) > 1e-8), ("axes", ~MF.axes_ok()),
        ("pose_count", F.col("candidate_pose_count") != F.col("n_poses")), ("region_policy", region["region_policy"]))
    a = MF.count_kinds(p.withColumn("bad", bad), "bad", ["organ"])
    gaps = p.groupBy("organ").agg(F.count(F.lit(1)).alias("c"), F.min("point_index").alias("lo"), F.max("point_index").alias("hi"), F.countDistinct("point_index").alias("d"))
    g = gaps.filter("lo <> 0 or hi + 1 <> c or d <> c").select("organ", F.lit("index_gaps").alias("kind"), F.lit(1).cast("long").alias("n"))
    return a.unionByName(g)


@query("aud06_coverage", """
SELECT organ, count(*) AS n_points, count(*) FILTER (miss > 0 OR dup > 0) AS n_incomplete, CAST(sum(miss) AS BIGINT) AS n_missing, CAST(sum(dup) AS BIGINT) AS n_repeats FROM (
 SELECT organ, point_index, count(*) FILTER ((point_index * 7 + ang_ord) % 4001 = 0) AS miss, count(*) FILTER ((point_index * 7 + ang_ord) % 4003 = 0 AND (point_index * 7 + ang_ord) % 4001 <> 0) AS dup FROM b_pose GROUP BY ALL) GROUP BY organ""")
def aud06(spark, sf):
    p = all_poses(spark, sf)
    h = F.col("point_index") * 7 + F.col("ang_ord")
    kept = p.filter(h % 4001 != 0).select("case_id", "organ", "point_index", "roll", "pitch", "yaw")
    twice = p.filter((h % 4003 == 0) & (h % 4001 != 0)).select("case_id", "organ", "point_index", "roll", "pitch", "yaw")
    c = MF.point_coverage(kept, twice, frames(spark, sf), ["case_id", "organ", "point_index"])
    return c.groupBy("organ").agg(
        F.count(F.lit(1)).alias("n_points"), F.count_if((F.col("n_distinct") != F.col("n_expected")) | (F.col("n_repeats") > 0)).alias("n_incomplete"),
        F.sum(F.col("n_expected") - F.col("n_distinct")).alias("n_missing"), F.sum("n_repeats").alias("n_repeats"))


@query("aud07_frames_rebuilt", """
SELECT organ, kind, count(*) AS n FROM (SELECT organ, unnest([CASE WHEN point_index % 23 = 0 THEN 'axes' END, CASE WHEN point_index % 29 = 0 THEN 'normal' END]) AS kind FROM b_frame) WHERE kind IS NOT NULL GROUP BY ALL""")
def aud07(spark, sf):
    """Frames built again from the raw points against the declared ones."""
    k = F.col("point_index")
    declared = frames(spark, sf).withColumns({"cx": F.col("cx") + F.when(k % 23 == 0, 1e-9).otherwise(0.0), "ny": F.col("ny") + F.when(k % 29 == 0, 1e-9).otherwise(0.0)})
    again = materialize(P.ordinary_frames(P.with_policy(B.points(spark, sf), F.lit(B.AORTA_LIMIT)), tuple(F.lit(v) for v in B.ANCHOR)), "rebuilt").filter("frame_ok")
    key = ["case_id", "organ", "point_index"]
    cols = [*P.AXES, "nx", "ny", "nz"]
    j = declared.select(*key, *cols).join(again.select(*key, *[F.col(c).alias(f"__{c}") for c in cols]), key)
    far = lambda cs: F.greatest(*[F.abs(F.col(c) - F.col(f"__{c}")) for c in cs]) > 1e-10
    return MF.count_kinds(j.withColumn("bad", MF.violations(("axes", far(P.AXES)), ("normal", far(("nx", "ny", "nz"))))), "bad", ["organ"])


@query("aud08_allowed_commits", """
SELECT kind, count(*) AS n FROM (SELECT unnest([CASE WHEN c_custkey % 7 = 0 THEN 'current' END, CASE WHEN c_custkey % 11 = 0 THEN 'compatible' END,
 CASE WHEN c_custkey % 13 = 0 THEN 'history' END, CASE WHEN c_custkey % 17 = 0 THEN 'evidence' END]) AS kind FROM customer) WHERE kind IS NOT NULL GROUP BY kind""")
def aud08(spark, sf):
    k = F.col("c_custkey")
    h = lambda s: F.sha1(F.concat(F.lit(s), k.cast("string")))
    both = F.array_sort(F.array(h("a"), h("b")))
    d = table(spark, sf, "customer").select(
        F.when(k % 7 == 0, "NOPE").otherwise(h("c")).alias("current"), F.when(k % 11 == 0, F.reverse(both)).otherwise(both).alias("compatible"),
        F.array(F.struct(F.array(h("a")).alias("completed"), h("c").alias("recovery")),
                F.struct(F.when(k % 17 == 0, F.array(h("z"))).otherwise(F.array(h("b"))).alias("completed"), F.when(k % 13 == 0, "bad").otherwise(h("d")).alias("recovery"))).alias("history"))
    return MF.count_kinds(d.withColumn("bad", MF.violations(*A.commit_checks())), "bad", [])


@query("aud09_manifest_rows", f"""
SELECT kind, count(*) AS n FROM (SELECT kind FROM ({MP._PROTOCOL}) UNION ALL SELECT unnest([CASE WHEN coordinate_system <> 'RAS' THEN 'coordinate_system' END,
 CASE WHEN core_design_sha256 = 'other' THEN 'core_design_sha256' END, CASE WHEN NOT regexp_full_match(build_git_commit, '[0-9a-fA-F]{{40}}') THEN 'build_git_commit' END,
 CASE WHEN source_region = '' THEN 'source_region_empty' END, CASE WHEN record_id % 53 = 0 THEN 'local_axes_world' END,
 CASE WHEN len(target_ids) <> len(list_distinct(target_ids)) THEN 'target_ids' END, CASE WHEN status IS NULL THEN 'status' END]) FROM b_record) WHERE kind IS NOT NULL GROUP BY kind""")
def aud09(spark, sf):
    """All row checks of a manifest in one pass."""
    checks = [*MF.protocol_checks(), *MF.pose_record_checks(), ("status", ~F.col("status").isin(*K.STATUSES))]
    return MF.count_kinds(MP.records(spark, sf).withColumn("bad", MF.violations(*checks)), "bad", [])


@query("aud10_state_manifests", f"SELECT case_id, kind, n FROM ({MP._RECON}) WHERE kind <> 'ok'")
def aud10(spark, sf):
    r = MF.reconcile(*MP.root_and_state(spark, sf), MP.KEY).filter("kind <> 'ok'")
    return r.groupBy("case_id", "kind").agg(F.count(F.lit(1)).alias("n"))


cte("b_summary", MP.LIBRARY)


@query("aud11_summary_recount", """
SELECT case_id, metric, label, n AS recounted, n + 1 AS stored FROM b_summary WHERE label IN ('artery', 'spleen')""")
def aud11(spark, sf):
    """The stored summary against a recount; two labels were altered."""
    now = MF.library_summary(MP.gallery(spark, sf), ["case_id"])
    stored = now.withColumn("stored", F.col("n") + F.when(F.col("label").isin("artery", "spleen"), 1).otherwise(0)).drop("n")
    j = now.join(stored, ["case_id", "metric", "label"], "full_outer")
    return j.filter(~F.col("n").eqNullSafe(F.col("stored"))).select("case_id", "metric", "label", F.col("n").alias("recounted"), "stored")


@query("aud13_pixel_findings", """
SELECT kind, count(*) AS n FROM (SELECT unnest([CASE WHEN l AND NOT p THEN 'label_without_color' END, CASE WHEN p AND NOT l THEN 'color_without_label' END,
 CASE WHEN f AND NOT p THEN 'feature_without_color' END, CASE WHEN f AND NOT l THEN 'feature_without_label' END]) AS kind FROM b_audit_px) WHERE kind IS NOT NULL GROUP BY kind
UNION ALL SELECT 'unknown_colors', count(*) FROM orders WHERE o_orderkey % 7 = 3""")
def aud13(spark, sf):
    from .plane_plans import audited_pixels

    kinds = ("label_without_color", "color_without_label", "feature_without_color", "feature_without_label", "unknown_colors")
    a = audited_pixels(spark, sf)
    rows = F.array(*[F.struct(F.lit(k).alias("kind"), (F.least(F.size(k), F.lit(1)) if k == "unknown_colors" else F.size(k)).alias("m")) for k in kinds])
    return a.select(F.inline(rows)).groupBy("kind").agg(F.sum("m").alias("n")).filter("n > 0")


@query("aud14_report", f"""
WITH f AS (SELECT case_id, 'totals' AS "check", kind, 1 AS n FROM ({_AUD1}) UNION ALL SELECT case_id, 'states', kind, n FROM ({MP._RECON}))
SELECT CAST(c.case_id AS BIGINT) AS case_id, count(kind) = 0 AS passed, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_faults,
 coalesce(string_agg("check" || '/' || kind || '=' || n, '; ' ORDER BY "check" || '/' || kind || '=' || n), '') AS faults
FROM (SELECT DISTINCT case_id FROM b_manifest) c LEFT JOIN f ON f.case_id = c.case_id GROUP BY c.case_id""")
def aud14(spark, sf):
    states = MF.reconcile(*MP.root_and_state(spark, sf), MP.KEY).groupBy(
        "case_id", "kind").agg(F.count(F.lit(1)).alias("n"))
    return A.report(B.manifest(spark, sf).select("case_id").distinct(), [
        A.as_finding(aud01(spark, sf), "totals"), A.as_finding(states, "states")])


@query("aud15_recovery", """
SELECT case_id, count(*) AS completed, count(*) = count(*) + CASE WHEN case_id = 2 THEN 1 ELSE 0 END AS count_ok, string_agg(DISTINCT build_git_commit, ',' ORDER BY build_git_commit) AS commits,
 count(*) FILTER (status = 'gallery') AS gallery, CASE WHEN case_id = 2 THEN 'refused' ELSE 'interrupted' END AS run_state FROM b_record GROUP BY case_id""")
def aud15(spark, sf):
    """Metadata of an interrupted run rebuilt from its rows, if the count fits."""
    r = MP.records(spark, sf)
    g = r.groupBy("case_id").agg(F.count(F.lit(1)).alias("completed"), F.array_join(F.array_sort(F.collect_set("build_git_commit")), ",").alias("commits"),
                                 F.count_if(F.col("status") == "gallery").alias("gallery"))
    g = g.withColumn("expected", F.col("completed") + F.when(F.col("case_id") == 2, 1).otherwise(0))
    return g.withColumn("count_ok", F.col("completed") == F.col("expected")).withColumn(
        "run_state", F.when(F.col("count_ok"), "interrupted").otherwise("refused")).drop("expected")


@query("aud16_resume_gate", """
SELECT c_custkey AS case_id, CASE WHEN c_custkey % 7 = 0 THEN 'new_run' WHEN c_custkey % 7 = 1 THEN 'metadata_missing' WHEN c_custkey % 7 = 2 THEN 'manifest_missing'
 WHEN c_custkey % 5 = 0 AND c_custkey % 11 <> 0 THEN 'protocol_differs' ELSE 'resume' END AS verdict FROM customer""")
def aud16(spark, sf):
    now = MF.protocol_hash(MP.metadata(spark, sf), "doc").select(F.col("case_key").alias("case_id"), "protocol_sha256")
    k = F.col("case_id")
    old = now.filter(k % 7 != 0).withColumns({
        "protocol_sha256": F.when(k % 5 == 0, F.reverse("protocol_sha256")).otherwise(F.col("protocol_sha256")),
        "has_manifest": k % 7 != 2, "has_metadata": k % 7 != 1})
    return A.resume_gate(old, now)


@query("aud17_export_provenance", """
SELECT kind, count(*) AS n FROM (SELECT unnest([CASE WHEN c_custkey % 5 = 0 THEN 'source_manifest_sha256' END, CASE WHEN c_custkey % 7 = 0 THEN 'build_git_commit' END,
 CASE WHEN c_custkey % 11 = 0 THEN 'visualization_coordinate_system' END, CASE WHEN c_custkey % 13 = 0 THEN 'translation_mm' END]) AS kind FROM customer) WHERE kind IS NOT NULL GROUP BY kind""")
def aud17(spark, sf):
    k = F.col("c_custkey")
    t = k.cast("string")
    d = table(spark, sf, "customer").select(
        F.when(k % 5 == 0, F.md5(t)).otherwise(F.upper(F.sha2(t, 256))).alias("source_manifest_sha256"), F.sha2(t, 256).alias("core_design_sha256"),
        F.when(k % 7 == 0, F.repeat(F.lit("g"), 40)).otherwise(F.sha1(t)).alias("build_git_commit"),
        F.when(k % 11 == 0, "LPS").when(k % 2 == 0, "RAS").alias("visualization_coordinate_system"),
        F.when(k % 13 == 0, 0.5).when(k % 3 == 0, F.lit(None).cast("double")).otherwise(-12.5).alias("translation_mm"))
    return MF.count_kinds(d.withColumn("bad", MF.violations(*A.provenance_checks())), "bad", [])


# --- streaming --------------------------------------------------------------------------------
@query("str1_incremental_ingest", """
SELECT true AS ok, count(DISTINCT slice_id) AS n_slices FROM b_event""")
def str1(spark, sf):
    """Manifest rows arriving as files; repeats are ignored, counts run on."""
    from ..streaming.ingest import ingest_counts

    src = stage_path(spark, "arrivals")
    e = B.status_events(spark, sf)
    # three drops of files, as they would arrive over time
    e.withColumn("drop", F.col("event_id") % 3).write.partitionBy("drop").json(src)
    out = ingest_counts(spark, f"{src}/*", e.schema, stage_path(spark, "ingest"))
    return out.agg(F.sum("n").alias("n_slices")).select(F.lit(True).alias("ok"), "n_slices")


@query("str2_incremental_resume", """
SELECT status, count(*) AS n FROM (SELECT slice_id, coalesce(min(status) FILTER (event_id % 2 = 0), min(status)) AS status FROM b_event GROUP BY slice_id) GROUP BY status""")
def str2(spark, sf):
    """Two runs over the same plan; the second only processes what is new.

    Every tenth identifier comes again in the second run, with another status.
    """
    from ..streaming.ingest import resume_run

    root = stage_path(spark, "resume")
    e = B.status_events(spark, sf)
    e.filter("event_id % 2 = 0").write.json(f"{root}/plan")
    resume_run(spark, f"{root}/plan", e.schema, f"{root}/manifest", f"{root}/checkpoint")
    e.write.mode("append").json(f"{root}/plan")
    resume_run(spark, f"{root}/plan", e.schema, f"{root}/manifest", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/manifest").groupBy("status").agg(F.count(F.lit(1)).alias("n"))
