"""Queries on manifest rows, summaries, digests and set comparisons."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contract as K
from ..functions.digest import canonical, multiset_digest
from ..functions.linalg import r6
from ..operators import dedup as D, manifest as MF, poses as P, progress as PR
from ..session import stage
from ..sources import bridges as B
from ..sources.tables import table
from .catalog import cte, query
from .oracle import lst, pose_id_sql, r6 as s6
from .pose_plans import POINTS_PER_TASK, all_poses, frames

KEY = ["case_id", "slice_id"]

cte("b_record", f"""
SELECT *, CASE WHEN record_id % 50 = 0 THEN 'LPS' ELSE 'RAS' END AS coordinate_system,
 CASE WHEN record_id % 97 = 0 THEN 'other' ELSE '{K.DESIGN_SHA256}' END AS core_design_sha256,
 CASE WHEN record_id % 41 = 0 THEN 'xyz' ELSE sha1('c' || CAST(point_index % 3 AS VARCHAR)) END AS build_git_commit,
 CASE WHEN record_id % 37 = 0 THEN '' WHEN organ = 'liver' THEN 'liver_region_one+liver_region_two' WHEN organ = 'duodenum' THEN 'duodenum_bulb' ELSE organ END AS source_region,
 CASE WHEN record_id % 31 = 0 THEN 'none' WHEN organ = 'liver' THEN 'liver_region_two' WHEN organ = 'duodenum' THEN 'duodenum_bulb'
  WHEN organ IN ('pancreas', 'stomach') THEN 'pancreas_special' ELSE 'standard' END AS yaw_policy,
 CASE WHEN record_id % 43 = 0 THEN ['liver', 'liver'] WHEN record_id % 2 = 0 THEN ['liver', 'pancreas'] ELSE ['liver'] END AS target_ids FROM b_manifest
""")


def records(spark, sf):
    """Full pose rows, a few of them faulty in known ways."""
    r = F.col("record_id")
    organ = F.col("organ")
    m = B.manifest(spark, sf)
    a = F.radians(F.col("roll").cast("double"))
    return m.withColumns({
        "coordinate_system": F.when(r % 50 == 0, "LPS").otherwise("RAS"),
        "core_design_sha256": F.when(r % 97 == 0, "other").otherwise(K.DESIGN_SHA256),
        "build_git_commit": F.when(r % 41 == 0, "xyz").otherwise(
            F.sha1(F.concat(F.lit("c"), (F.col("point_index") % 3).cast("string")))),
        "source_region": F.when(r % 37 == 0, "").when(organ == "liver", "liver_region_one+liver_region_two")
        .when(organ == "duodenum", "duodenum_bulb").otherwise(organ),
        "yaw_policy": F.when(r % 31 == 0, "none").when(organ == "liver", "liver_region_two").when(organ == "duodenum", "duodenum_bulb")
        .when(organ.isin("pancreas", "stomach"), "pancreas_special").otherwise("standard"),
        "target_ids": F.when(r % 43 == 0, F.array(F.lit("liver"), F.lit("liver"))).when(
            r % 2 == 0, F.array(F.lit("liver"), F.lit("pancreas"))).otherwise(F.array(F.lit("liver"))),
        "duplicate_source_regions": F.array().cast("array<string>"),
        "duplicate_source_pose_ids": F.array().cast("array<string>"),
        "ax": F.cos(a), "ay": F.sin(a), "az": F.lit(0.0), "hx": -F.sin(a), "hy": F.cos(a), "hz": F.lit(0.0),
        "cx": F.lit(0.0), "cy": F.lit(0.0), "cz": F.when(r % 53 == 0, -1.0).otherwise(1.0),
    })


_PROTOCOL = f"""
SELECT record_id, case_id, unnest([CASE WHEN source_region = '' THEN 'source_region' END, CASE WHEN yaw_policy = 'none' THEN 'yaw_policy' END,
 CASE WHEN CASE organ WHEN 'liver' THEN yaw_policy <> CASE WHEN source_region LIKE '%liver_region_two%' THEN 'liver_region_two' ELSE 'standard' END
  WHEN 'duodenum' THEN yaw_policy <> CASE WHEN source_region = 'duodenum_bulb' THEN 'duodenum_bulb' ELSE 'standard' END
  WHEN 'esophagus' THEN yaw_policy <> 'standard' ELSE yaw_policy NOT IN ('standard', 'pancreas_special') END THEN 'region_policy' END,
 CASE WHEN organ = 'stomach' AND yaw_policy = 'pancreas_special' AND NOT list_contains(target_ids, 'pancreas') THEN 'missing_pancreas_target' END,
 CASE WHEN roll NOT BETWEEN -45 AND 45 OR roll % 5 <> 0 THEN 'roll' END, CASE WHEN pitch NOT BETWEEN -30 AND 30 OR pitch % 5 <> 0 THEN 'pitch' END,
 CASE WHEN NOT CASE yaw_policy WHEN 'standard' THEN yaw BETWEEN -30 AND 30 WHEN 'liver_region_two' THEN yaw BETWEEN -60 AND 60 WHEN 'none' THEN false ELSE yaw BETWEEN -120 AND 30 END THEN 'yaw' END]) AS kind
FROM b_record
"""


@query("flt11_pose_protocol", f"SELECT case_id, kind, count(*) AS n FROM ({_PROTOCOL}) WHERE kind IS NOT NULL GROUP BY ALL")
def flt11(spark, sf):
    r = records(spark, sf).withColumn("bad", MF.violations(*MF.protocol_checks()))
    return MF.count_kinds(r, "bad", ["case_id"])


@query("flt12_axes", """
SELECT case_id, record_id % 53 <> 0 AS axes_ok, count(*) AS n FROM b_record GROUP BY ALL""")
def flt12(spark, sf):
    return records(spark, sf).withColumn("axes_ok", MF.axes_ok()).groupBy("case_id", "axes_ok").agg(F.count(F.lit(1)).alias("n"))


@query("flt13_record_validity", """
SELECT kind, count(*) AS n FROM (SELECT unnest([CASE WHEN coordinate_system <> 'RAS' THEN 'coordinate_system' END,
 CASE WHEN core_design_sha256 = 'other' THEN 'core_design_sha256' END, CASE WHEN NOT regexp_full_match(build_git_commit, '[0-9a-fA-F]{40}') THEN 'build_git_commit' END,
 CASE WHEN source_region = '' THEN 'source_region_empty' END, CASE WHEN record_id % 53 = 0 THEN 'local_axes_world' END,
 CASE WHEN len(target_ids) <> len(list_distinct(target_ids)) THEN 'target_ids' END]) AS kind FROM b_record) WHERE kind IS NOT NULL GROUP BY kind""")
def flt13(spark, sf):
    r = records(spark, sf).withColumn("bad", MF.violations(*MF.pose_record_checks()))
    return MF.count_kinds(r, "bad", [])


# Gallery rows: one per order, features from its line items.
_CAT = lst(K.CATALOG_IDS)
cte("b_gallery", f"""
SELECT m.case_id, m.record_id, m.slice_id, f.features, f.organs AS organ_labels,
 CASE WHEN m.record_id % 61 = 0 THEN [] ELSE list_sort(list_intersect(f.organs, {_CAT})) END AS candidates,
 f.vessels, f.vessel_features FROM b_manifest m JOIN (
 SELECT slice_key, list(struct_pack(label := label, area_mm2 := area_mm2)) AS features, list_sort(list_distinct(list(organ_label))) AS organs,
  list_sort(list_distinct(list({lst(K.VESSEL_IDS)}[CAST(y_mm AS INT) % 3 + 1]))) AS vessels,
  list(struct_pack(label := {lst(K.VESSEL_IDS)}[CAST(y_mm AS INT) % 3 + 1], area_mm2 := CASE WHEN slice_key % 59 = 0 THEN 0.0 ELSE area_mm2 END)) AS vessel_features
 FROM b_feature GROUP BY slice_key) f ON f.slice_key = m.record_id WHERE m.status = 'gallery'
""")


def gallery(spark, sf):
    def build():
        f = B.features(spark, sf)
        vessel = B.pick(K.VESSEL_IDS, F.col("y_mm").cast("int") % 3)
        area = F.when(F.col("slice_key") % 59 == 0, 0.0).otherwise(F.col("area_mm2"))
        # a slice has few features, so its list is small whatever the table size
        g = f.groupBy(F.col("slice_key").alias("record_id")).agg(
            F.collect_list(F.struct("label", "x_mm", "y_mm", "area_mm2")).alias("features"),
            F.array_sort(F.collect_set("organ_label")).alias("organ_labels"),
            F.array_sort(F.collect_set(vessel)).alias("eus_vessel_labels"),
            F.collect_list(F.struct(vessel.alias("label"), "x_mm", "y_mm", area.alias("area_mm2"))).alias("eus_vessel_features"))
        m = B.manifest(spark, sf).filter("status = 'gallery'").select("case_id", "record_id", "slice_id", "status")
        j = m.join(g, "record_id")
        return j.withColumns({
            "eus_candidate_organ_labels": F.when(F.col("record_id") % 61 == 0, F.array().cast("array<string>")).otherwise(
                MF.candidate_organs("organ_labels")),
            "organ_metadata_schema_version": F.when(F.col("record_id") % 67 == 0, "old").otherwise(K.ORGAN_METADATA_VERSION),
            "eus_vessel_metadata_schema_version": F.lit(K.VESSEL_METADATA_VERSION)})

    return stage(spark, "gallery", sf, build)


@query("prj20_candidate_organs", f"""
SELECT record_id, array_to_string(list_sort(list_intersect(organ_labels, {_CAT})), ',') AS candidates FROM b_gallery""")
def prj20(spark, sf):
    return gallery(spark, sf).select("record_id", F.array_join(MF.candidate_organs("organ_labels"), ",").alias("candidates"))


@query("set03_labels_in_catalog", f"""
SELECT label, count(*) AS n FROM (SELECT unnest(list_intersect(organ_labels, {_CAT})) AS label FROM b_gallery) GROUP BY label""")
def set03(spark, sf):
    g = gallery(spark, sf).select(F.explode(F.array_intersect("organ_labels", F.array(*[F.lit(n) for n in K.CATALOG_IDS]))).alias("label"))
    return g.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("flt14_gallery_organ_metadata", f"""
SELECT kind, count(*) AS n FROM (SELECT unnest([CASE WHEN record_id % 67 = 0 THEN 'schema_version' END,
 CASE WHEN candidates <> list_sort(list_intersect(organ_labels, {_CAT})) THEN 'candidates' END]) AS kind FROM b_gallery) WHERE kind IS NOT NULL GROUP BY kind""")
def flt14(spark, sf):
    return MF.count_kinds(gallery(spark, sf).withColumn("bad", MF.violations(*MF.gallery_organ_checks())), "bad", [])


@query("flt15_gallery_vessel_metadata", """
SELECT 'features' AS kind, count(*) AS n FROM b_gallery WHERE record_id % 59 = 0""")
def flt15(spark, sf):
    return MF.count_kinds(gallery(spark, sf).withColumn("bad", MF.violations(*MF.gallery_vessel_checks())), "bad", [])


@query("flt16_feature_validity", """
SELECT label, CASE WHEN l_linenumber % 4 = 0 THEN 'bad_label' WHEN slice_key % 13 = 0 THEN 'area' ELSE 'ok' END AS verdict, count(*) AS n FROM (
 SELECT *, CAST(y_mm AS INT) AS l_linenumber FROM b_feature) GROUP BY ALL""")
def flt16(spark, sf):
    f = B.features(spark, sf)
    four = F.col("y_mm").cast("int") % 4 == 0
    s = F.struct(F.when(four, "bone").otherwise(F.col("label")).alias("label"), "x_mm", "y_mm",
                 F.when(F.col("slice_key") % 13 == 0, -1.0).otherwise(F.col("area_mm2")).alias("area_mm2"))
    f = f.withColumn("f", s).withColumn("bad", MF.feature_bad(F.col("f"), ("artery", "vein")))
    verdict = F.when(~F.col("bad"), "ok").when(F.col("f.label") == "bone", "bad_label").otherwise("area")
    return f.groupBy("label", verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


LIBRARY = """
WITH t AS (SELECT case_id, 'indexed_feature_count' AS metric, '' AS label FROM b_gallery WHERE len(features) > 0
 UNION ALL SELECT case_id, 'feature_label_counts', f.label FROM (SELECT case_id, unnest(features) AS f FROM b_gallery)
 UNION ALL SELECT case_id, 'organ_label_counts', l FROM (SELECT case_id, unnest(organ_labels) AS l FROM b_gallery)
 UNION ALL SELECT case_id, 'eus_candidate_organ_label_counts', l FROM (SELECT case_id, unnest(candidates) AS l FROM b_gallery)
 UNION ALL SELECT case_id, 'eus_vessel_label_counts', l FROM (SELECT case_id, unnest(vessels) AS l FROM b_gallery)
 UNION ALL SELECT case_id, 'eus_vessel_feature_counts', f.label FROM (SELECT case_id, unnest(vessel_features) AS f FROM b_gallery))
SELECT case_id, metric, label, count(*) AS n FROM t GROUP BY ALL"""


@query("agg01_library_summary", LIBRARY)
def agg01(spark, sf):
    return MF.library_summary(gallery(spark, sf), ["case_id"])


_LIMB_SUM = ", ".join(f"sum(CAST(('0x' || substr(h, {8 * i + 1}, 8)) AS UBIGINT)) AS s{i}, bit_xor(CAST(('0x' || substr(h, {8 * i + 1}, 8)) AS UBIGINT)) AS x{i}" for i in range(8))


def digest_sql(src: str, keys: str) -> str:
    """Carry the 32-bit limb sums from the right; ``src`` gives keys and h."""
    q = f"SELECT {keys}, count(*) AS n, {_LIMB_SUM}, CAST(0 AS HUGEINT) AS c FROM ({src}) GROUP BY {keys}"
    for i in reversed(range(8)):
        q = f"SELECT * EXCLUDE (c), (s{i} + c) % 4294967296 AS d{i}, (s{i} + c) // 4294967296 AS c FROM ({q})"
    hx = lambda p: " || ".join(f"printf('%08x', CAST({p}{i} AS BIGINT))" for i in range(8))
    return f"SELECT {keys}, n, {hx('d')} AS sha256_sum, {hx('x')} AS sha256_xor FROM ({q})"


_TEXT = "sha256(concat_ws(chr(1), slice_id, status, CAST(roll AS VARCHAR), CAST(pitch AS VARCHAR), CAST(yaw AS VARCHAR)))"


def row_text():
    return canonical(*(F.col(c) for c in ("slice_id", "status", "roll", "pitch", "yaw")))


@query("agg04_multiset_digest", digest_sql(f"SELECT case_id, status, {_TEXT} AS h FROM b_manifest", "case_id, status"))
def agg04(spark, sf):
    return multiset_digest(B.manifest(spark, sf), ["case_id", "status"], row_text())


@query("agg07_status_counts", """
SELECT case_id, count(*) AS completed, count(*) FILTER (status = 'gallery') AS gallery, count(*) FILTER (status = 'unindexed') AS unindexed,
 count(*) FILTER (status = 'rejected') AS rejected, count(*) FILTER (status = 'excluded_fov') AS excluded_fov,
 CASE WHEN case_id = 1 THEN 'interrupted' ELSE 'complete' END AS run_state FROM b_manifest GROUP BY case_id""")
def agg07(spark, sf):
    c = MF.status_counts(B.manifest(spark, sf), ["case_id"]).withColumn(
        "planned", F.col("completed") + F.when(F.col("case_id") == 1, 1).otherwise(0))
    return MF.run_state(c, "planned").drop("planned")


@query("agg20_distinct_commits", """
SELECT case_id, string_agg(DISTINCT build_git_commit, ',' ORDER BY build_git_commit) AS commits, CASE WHEN count(DISTINCT backend) = 1 THEN min(backend) ELSE 'pending_resume' END AS backend
FROM (SELECT case_id, build_git_commit, CASE WHEN case_id = 0 AND record_id % 2 = 0 THEN 'gpu' ELSE 'cpu' END AS backend FROM b_record) GROUP BY case_id""")
def agg20(spark, sf):
    r = records(spark, sf).withColumn("backend", F.when((F.col("case_id") == 0) & (F.col("record_id") % 2 == 0), "gpu").otherwise("cpu"))
    return r.groupBy("case_id").agg(
        F.array_join(F.array_sort(F.collect_set("build_git_commit")), ",").alias("commits"),
        F.when(F.min("backend") == F.max("backend"), F.min("backend")).otherwise("pending_resume").alias("backend"))


@query("agg21_bounding_cube", f"""
SELECT case_id, {", ".join(s6(f"(min({a}) + max({a})) / 2 - greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z)) / 2", f"lo_{a}") + ", " + s6(f"(min({a}) + max({a})) / 2 + greatest(max(x) - min(x), max(y) - min(y), max(z) - min(z)) / 2", f"hi_{a}") for a in "xyz")}
FROM b_point GROUP BY case_id""")
def agg21(spark, sf):
    g = B.points(spark, sf).groupBy("case_id").agg(*[c for a in "xyz" for c in (F.min(a).alias(f"lo{a}"), F.max(a).alias(f"hi{a}"))])
    half = F.greatest(*[F.col(f"hi{a}") - F.col(f"lo{a}") for a in "xyz"]) / 2
    mid = {a: (F.col(f"lo{a}") + F.col(f"hi{a}")) / 2 for a in "xyz"}
    return g.select("case_id", *[c for a in "xyz" for c in (r6(mid[a] - half).alias(f"lo_{a}"), r6(mid[a] + half).alias(f"hi_{a}"))])


@query("agg22_row_hash", """
SELECT record_id, sha256('{"organ":"' || organ || '","pitch":' || pitch || ',"roll":' || roll || ',"slice_id":"' || slice_id || '","status":"' || status || '","yaw":' || yaw || '}') AS digest FROM b_manifest""")
def agg22(spark, sf):
    cols = sorted(("slice_id", "status", "organ", "roll", "pitch", "yaw"))
    return B.manifest(spark, sf).select("record_id", F.sha2(F.to_json(F.struct(*cols)), 256).alias("digest"))


_FIELDS = sorted(K.PROTOCOL_FIELDS)


def metadata(spark, sf):
    """A protocol document per customer; every eleventh lacks one field."""
    k = F.col("c_custkey")
    pairs = [c for i, f in enumerate(_FIELDS) for c in (F.lit(f), F.concat(F.lit('"'), (k % (i + 2)).cast("string"), F.lit('"')))]
    full = F.create_map(*pairs)
    return table(spark, sf, "customer").select(k.alias("case_key"), F.when(
        k % 11 == 0, F.map_filter(full, lambda n, _: n != "pose_plan")).otherwise(full).alias("doc"))


_DOC = "'{' || " + " || ',' || ".join(f"'\"{f}\":\"' || (c_custkey % {i + 2}) || '\"'" for i, f in enumerate(_FIELDS)) + " || '}'"


@query("agg22_protocol_hash", f"""
SELECT c_custkey AS case_key, CASE WHEN c_custkey % 11 <> 0 THEN sha256({_DOC}) END AS protocol_sha256, CASE WHEN c_custkey % 11 = 0 THEN 'pose_plan' ELSE '' END AS missing FROM customer""")
def agg22_protocol(spark, sf):
    p = MF.protocol_hash(metadata(spark, sf), "doc")
    return p.select("case_key", "protocol_sha256", F.array_join("missing_fields", ",").alias("missing"))


@query("set08_missing_keys", """
SELECT 'pose_plan' AS field, count(*) AS n FROM customer WHERE c_custkey % 11 = 0""")
def set08(spark, sf):
    m = metadata(spark, sf).select(F.explode(F.array_except(F.array(*[F.lit(f) for f in _FIELDS]), F.map_keys("doc"))).alias("field"))
    return m.groupBy("field").agg(F.count(F.lit(1)).alias("n"))


@query("agg23_directory_digest", digest_sql("SELECT source AS directory, sha256(concat_ws(chr(1), CAST(doc_id AS VARCHAR), CAST(strlen(text) AS VARCHAR), sha256(text))) AS h FROM documents", "directory"))
def agg23(spark, sf):
    """Content digest per directory: name, length and content hash of each file."""
    d = table(spark, sf, "documents").select("doc_id", "source", "text").select(
        F.col("source").alias("directory"),
        canonical(F.col("doc_id"), F.octet_length("text"), F.sha2("text", 256)).alias("t"))
    return multiset_digest(d, ["directory"], F.col("t"))


cte("b_expected", "SELECT organ, count(*) AS n_expected FROM (SELECT CASE WHEN point_index % 100 = 7 THEN 'liver' ELSE organ END AS organ FROM b_point) GROUP BY organ")


@query("agg24_expected_counts", """
SELECT organ, coalesce(n, 0) AS n_actual, coalesce(n_expected, 0) AS n_expected FROM (SELECT organ, count(*) AS n FROM b_base GROUP BY organ) a
FULL JOIN b_expected USING (organ) WHERE coalesce(n, 0) <> coalesce(n_expected, 0)""")
def agg24(spark, sf):
    p = B.points(spark, sf)
    want = p.withColumn("organ", F.when(F.col("point_index") % 100 == 7, "liver").otherwise(F.col("organ"))).groupBy("organ").agg(F.count(F.lit(1)).alias("n_expected"))
    got = frames(spark, sf).groupBy("organ").agg(F.count(F.lit(1)).alias("n_actual"))
    j = got.join(want, "organ", "full_outer").fillna(0)
    return j.filter("n_actual <> n_expected")


# --- reconciliation ------------------------------------------------------------------------
cte("b_state", """
SELECT case_id, slice_id, CASE WHEN record_id % 107 = 0 THEN 'rejected' ELSE status END AS status,
 CASE WHEN record_id % 103 = 0 THEN 'changed' ELSE sha256(slice_id || status) END AS digest FROM b_manifest WHERE record_id % 101 <> 0
UNION ALL SELECT case_id, slice_id || '-x', status, sha256(slice_id) FROM b_manifest WHERE record_id % 211 = 0
""")


def root_and_state(spark, sf):
    m = B.manifest(spark, sf)
    r = F.col("record_id")
    root = m.select(*KEY, "status", F.sha2(F.concat("slice_id", "status"), 256).alias("digest"))
    state = m.filter(r % 101 != 0).select(
        *KEY, F.when(r % 107 == 0, "rejected").otherwise(F.col("status")).alias("status"),
        F.when(r % 103 == 0, "changed").otherwise(F.sha2(F.concat("slice_id", "status"), 256)).alias("digest"))
    extra = m.filter(r % 211 == 0).select("case_id", F.concat("slice_id", F.lit("-x")).alias("slice_id"), "status", F.sha2("slice_id", 256).alias("digest"))
    return root, state.unionByName(extra)


_RECON = """
WITH r AS (SELECT case_id, slice_id, count(*) AS n, min(status) AS st, min(sha256(slice_id || status)) AS dg FROM b_manifest GROUP BY ALL),
 s AS (SELECT case_id, slice_id, count(*) AS n2, min(status) AS st2, min(digest) AS dg2 FROM b_state GROUP BY ALL)
SELECT case_id, CASE WHEN n IS NULL THEN 'orphan_in_state' WHEN n2 IS NULL THEN 'missing_in_state' WHEN n > 1 OR n2 > 1 THEN 'repeated_id'
 WHEN st <> st2 THEN 'other_status' WHEN dg <> dg2 THEN 'other_content' ELSE 'ok' END AS kind, count(*) AS n FROM r FULL JOIN s USING (case_id, slice_id) GROUP BY ALL
"""


@query("jn10_root_state_reconcile", _RECON)
def jn10(spark, sf):
    return MF.reconcile(*root_and_state(spark, sf), KEY).groupBy("case_id", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("set04_orphans", """
SELECT side, count(*) AS n FROM (SELECT 'state_only' AS side, case_id, slice_id FROM (SELECT case_id, slice_id FROM b_state EXCEPT SELECT case_id, slice_id FROM b_manifest)
 UNION ALL SELECT 'root_only', case_id, slice_id FROM (SELECT case_id, slice_id FROM b_manifest EXCEPT SELECT case_id, slice_id FROM b_state)) GROUP BY side""")
def set04(spark, sf):
    root, state = (d.select(*KEY) for d in root_and_state(spark, sf))
    a = state.subtract(root).withColumn("side", F.lit("state_only"))
    b = root.subtract(state).withColumn("side", F.lit("root_only"))
    return a.unionByName(b).groupBy("side").agg(F.count(F.lit(1)).alias("n"))


@query("set06_multiset_equality", """
WITH a AS (SELECT case_id, count(*) AS n_left FROM b_manifest GROUP BY 1), b AS (SELECT case_id, count(*) AS n_right FROM b_state GROUP BY 1),
 d AS (SELECT DISTINCT case_id FROM (SELECT case_id, slice_id, status, sha256(slice_id || status) FROM b_manifest EXCEPT ALL SELECT * FROM b_state)
  UNION SELECT DISTINCT case_id FROM (SELECT * FROM b_state EXCEPT ALL SELECT case_id, slice_id, status, sha256(slice_id || status) FROM b_manifest))
SELECT case_id, n_left, n_right, case_id NOT IN (SELECT case_id FROM d) AS same FROM a JOIN b USING (case_id)""")
def set06(spark, sf):
    root, state = root_and_state(spark, sf)
    return MF.same_multiset(root, state, ["case_id"], canonical(F.col("slice_id"), F.col("status"), F.col("digest")))


@query("set07_duplicates", """
SELECT status, o_custkey, count(*) AS n FROM b_manifest m JOIN orders o ON o.o_orderkey = m.record_id GROUP BY ALL HAVING count(*) > 1""")
def set07(spark, sf):
    m = B.manifest(spark, sf).withColumn("o_custkey", F.col("point_index"))
    return MF.duplicates(m, ["status", "o_custkey"])


# --- resume ------------------------------------------------------------------------------------
POSE = ["organ", "point_index", "roll", "pitch", "yaw"]
CASE_POSE = ["case_id", *POSE]  # what one case has finished is open in all others
cte("b_done", "SELECT DISTINCT case_id, organ, point_index, roll, pitch, yaw FROM b_manifest")


def finished(spark, sf):
    return B.manifest(spark, sf).select(*CASE_POSE[:2], F.col("point_index").cast("int").alias("point_index"), *CASE_POSE[3:])


@query("jn11_pending_poses", """
SELECT organ, count(*) AS n FROM b_pose p WHERE NOT EXISTS (SELECT 1 FROM b_done d WHERE d.case_id = p.case_id AND d.organ = p.organ AND d.point_index = p.point_index
 AND d.roll = p.roll AND d.pitch = p.pitch AND d.yaw = p.yaw) GROUP BY organ""")
def jn11(spark, sf):
    return PR.pending(frames(spark, sf), finished(spark, sf), CASE_POSE[:3]).groupBy("organ").agg(F.count(F.lit(1)).alias("n"))


@query("jn12_stale_ids", f"""
SELECT case_id, {pose_id_sql()} AS slice_id FROM b_done d WHERE NOT EXISTS (SELECT 1 FROM b_pose p WHERE d.case_id = p.case_id AND d.organ = p.organ AND d.point_index = p.point_index
 AND d.roll = p.roll AND d.pitch = p.pitch AND d.yaw = p.yaw)""")
def jn12(spark, sf):
    """All finished identifiers that no plan has any more."""
    from ..functions.identity import pose_id

    s = PR.stale(frames(spark, sf), finished(spark, sf), CASE_POSE[:3])
    return s.select("case_id", pose_id(*(F.col(c) for c in POSE)).alias("slice_id"))


@query("top07_control_sample", f"""
SELECT {pose_id_sql()} AS slice_id FROM (SELECT *, CASE organ WHEN 'stomach' THEN 0 WHEN 'duodenum' THEN 1 WHEN 'esophagus' THEN 2 WHEN 'liver' THEN 3 ELSE 4 END AS k FROM b_pose)
ORDER BY k, point_index, ang_ord LIMIT 64""")
def top07(spark, sf):
    return P.with_identity(all_poses(spark, sf)).select("slice_id", "pose_ord").orderBy("pose_ord").limit(64).select("slice_id")


@query("jn13_completed_equals_planned", f"""
SELECT kind, count(*) AS n FROM (SELECT unnest([CASE WHEN (point_index * 7 + ang_ord) % 997 = 0 THEN 'v3x' END, CASE WHEN (point_index * 7 + ang_ord) % 1499 = 0 THEN 'yaw_policy' END,
 CASE WHEN (point_index * 7 + ang_ord) % 2003 = 0 THEN 'build_git_commit' END]) AS kind FROM b_pose) WHERE kind IS NOT NULL GROUP BY kind""")
def jn13(spark, sf):
    f = frames(spark, sf)
    plan = P.expand(f, tasks=-(-f.count() // POINTS_PER_TASK))
    h = F.col("point_index") * 7 + F.col("ang_ord")
    fin = plan.select(*["case_id", *POSE], F.when(h % 1499 == 0, "none").otherwise(F.col("yaw_policy")).alias("yaw_policy"),
                      (F.col("v3x") + F.when(h % 997 == 0, 1e-3).otherwise(0.0)).alias("v3x"), "v1y", "v2z",
                      F.when(h % 2003 == 0, "bad").otherwise("good").alias("build_git_commit"))
    m = MF.field_mismatches(plan.select("case_id", *POSE, "yaw_policy", "v3x", "v1y", "v2z"), fin, ["case_id", *POSE],
                            ["yaw_policy", "v3x", "v1y", "v2z"], allowed_commits=["good", "older"])
    return MF.count_kinds(m, "mismatches", [])


# Faults put into the rows that are audited: one in so many, by point and angle.
_H = "(point_index * 7 + ang_ord)"
_FAULTS = {"vertices": 997, "axes": 1499, "identity": 1801, "region": 1201, "policy": 1301, "targets": 1409, "point": 1103}


@query("jn15_pose_geometry_audit", f"""
SELECT organ, count(*) AS n_rows, {", ".join(f"count(*) FILTER ({_H} % {n} = 0) AS n_{k}" for k, n in _FAULTS.items())} FROM b_pose GROUP BY organ""")
def jn15(spark, sf):
    """Manifest rows against squares, identifiers and fields rebuilt from the point plan."""
    f = frames(spark, sf)
    h = F.col("point_index") * 7 + F.col("ang_ord")
    bad = {k: h % n == 0 for k, n in _FAULTS.items()}
    rows = P.with_identity(P.expand(f, ("source_region", "target_ids")))
    rows = rows.withColumns({
        "v2y": F.col("v2y") + F.when(bad["vertices"], 1e-8).otherwise(0.0), "az": F.col("az") + F.when(bad["axes"], 1e-9).otherwise(0.0),
        "slice_id": F.when(bad["identity"], F.concat("slice_id", F.lit("x"))).otherwise(F.col("slice_id")),
        "source_region": F.when(bad["region"], "elsewhere").otherwise(F.col("source_region")),
        "yaw_policy": F.when(bad["policy"], "none").otherwise(F.col("yaw_policy")),
        "target_ids": F.when(bad["targets"], F.array(F.lit("nothing"))).otherwise(F.col("target_ids")),
        "x": F.col("x") + F.when(bad["point"], 1e-9).otherwise(0.0)})
    a = audit_geometry(rows.select("case_id", *POSE, "slice_id", "source_region", "yaw_policy", "target_ids", *"xyz", *P.VERTICES, *P.AXES), f)
    return a.groupBy("organ").agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(~F.col(f"{k}_ok")).alias(f"n_{k}") for k in _FAULTS])


def audit_geometry(rows, frames_df):
    """Take the point's frame, rotate it by the row's angles, compare; the
    identifier is written anew from the typed fields, and the fields that the
    plan also holds must be equal. The plan has one row per point, thousands
    of times fewer rows than the manifest."""
    from ..functions.angles import ROTATION, angle_grid
    from ..functions.identity import pose_id
    from ..functions.linalg import add, scale, vec

    same = ("source_region", "yaw_policy", "target_ids")
    base = frames_df.select("case_id", "organ", "point_index", *[F.col(c).alias(f"f_{c}") for c in (*P.AXES, *"xyz", *same)])
    grid = angle_grid(rows.sparkSession).drop("ang_ord").withColumnRenamed("yaw_policy", "f_yaw_policy")
    j = rows.join(base, ["case_id", "organ", "point_index"]).join(F.broadcast(grid), ["f_yaw_policy", "roll", "pitch", "yaw"])
    fv = [vec(*(f"f_{c}" for c in P.AXES[3 * i : 3 * i + 3])) for i in range(3)]
    exp = {}
    for jx, stem in enumerate("ahc"):
        col = add(add(scale(fv[0], F.col(f"r0{jx}")), scale(fv[1], F.col(f"r1{jx}"))), scale(fv[2], F.col(f"r2{jx}")))
        exp.update({f"e_{stem}{a}": c for a, c in zip("xyz", col)})
    j = j.withColumns(exp).drop(*ROTATION)
    far = {f"m_{c}": F.abs(F.col(c) - F.col(f"e_{c}")) for c in P.AXES}
    j = j.withColumns(far)
    gap = {}
    for a in "xyz":
        left, right = F.col(f"f_{a}") - F.col(f"e_h{a}") * K.HALF_SIDE_MM, F.col(f"f_{a}") + F.col(f"e_h{a}") * K.HALF_SIDE_MM
        depth = F.col(f"e_a{a}") * K.SIDE_MM
        for i, e in ((1, left), (2, right), (3, right + depth), (4, left + depth)):
            gap[f"g_{i}{a}"] = F.abs(F.col(f"v{i}{a}") - e)
    j = j.withColumns(gap)
    away = F.greatest(*[F.abs(F.col(a) - F.col(f"f_{a}")) for a in "xyz"])
    names = dict(zip(same, ("region", "policy", "targets")))
    return j.select(
        "case_id", *POSE, (F.greatest(*gap) <= 1e-9).alias("vertices_ok"), (F.greatest(*far) <= 1e-10).alias("axes_ok"), (away <= 1e-12).alias("point_ok"),
        (F.col("slice_id") == pose_id(*(F.col(c) for c in POSE))).alias("identity_ok"), *[F.col(c).eqNullSafe(F.col(f"f_{c}")).alias(f"{n}_ok") for c, n in names.items()])


@query("jn14_plan_against_export", """
SELECT case_id, organ, point_index FROM b_point WHERE point_index % 17 = 0""")
def jn14(spark, sf):
    """Plan rows against the exported text of each point, tolerance 2e-6."""
    from ..sinks.ply import point_lines

    p = frames(spark, sf)
    lines = point_lines(p.withColumn("x", F.col("x") + F.when(F.col("point_index") % 17 == 0, 1e-4).otherwise(0.0)))
    v = F.split("line", " ")
    read = lines.select("case_id", "organ", "point_index", *[v[i].cast("double").alias(f"__{c}") for i, c in enumerate(("x", "y", "z", "nx", "ny", "nz"))])
    far = F.lit(False)
    for c in ("x", "y", "z", "nx", "ny", "nz"):
        far = far | (F.abs(F.col(c) - F.col(f"__{c}")) > 2e-6)
    return p.join(read, ["case_id", "organ", "point_index"]).filter(far).select("case_id", "organ", "point_index")


@query("jn20_base_planes_against_points", """
SELECT organ, count(*) AS n, count(*) FILTER (point_index % 19 = 0) AS n_bad FROM b_base GROUP BY organ""")
def jn20(spark, sf):
    from .pose_plans import base

    b = base(spark, sf).select("case_id", "organ", "point_index", "x", "y", "z", "nx")
    e = B.points(spark, sf).select("case_id", "organ", "point_index", F.format_string("%.6f", "x").cast("double").alias("ex"),
                                   F.format_string("%.6f", "y").cast("double").alias("ey"), F.format_string("%.6f", "z").cast("double").alias("ez"),
                                   (F.col("nx") + F.when(F.col("point_index") % 19 == 0, 1e-4).otherwise(0.0)).alias("enx"))
    bad = (F.abs(F.col("x") - F.col("ex")) > 1e-5) | (F.abs(F.col("y") - F.col("ey")) > 1e-5) | (F.abs(F.col("z") - F.col("ez")) > 1e-5) | (
        F.abs(F.col("nx") - F.col("enx")) > 1e-5)
    return b.join(e, ["case_id", "organ", "point_index"]).groupBy("organ").agg(F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("n_bad"))


_KINDS = ", ".join(f"('{k}')" for k in K.IMAGE_FIELDS)


@query("jn21_missing_files", f"""
SELECT kind, count(*) FILTER (record_id % 29 = 0 AND kind <> 'ct_png') AS n_missing, count(*) AS n_rows,
 count(*) FILTER (NOT (record_id % 29 = 0 AND kind <> 'ct_png')) AS n_files FROM b_manifest, (VALUES {_KINDS}) t(kind) WHERE status = 'gallery' GROUP BY kind""")
def jn21(spark, sf):
    m = B.manifest(spark, sf).filter("status = 'gallery'").select("record_id", F.explode(F.array(*[F.lit(k) for k in K.IMAGE_FIELDS])).alias("kind"))
    ref = m.withColumn("path", F.concat(F.regexp_replace("kind", "_png$", ""), F.lit("/"), F.col("record_id").cast("string"), F.lit(".png")))
    files = ref.filter("not (record_id % 29 = 0 and kind <> 'ct_png')").select("path", "kind")
    return dangling(ref, files)


def dangling(ref, files):
    """Referenced paths without a file, and both counts per kind."""
    missing = ref.join(files.select("path"), "path", "left_anti").groupBy("kind").agg(F.count(F.lit(1)).alias("n_missing"))
    rows = ref.groupBy("kind").agg(F.count(F.lit(1)).alias("n_rows"))
    have = files.groupBy("kind").agg(F.count(F.lit(1)).alias("n_files"))
    return rows.join(missing, "kind", "left").join(have, "kind", "left").fillna(0)


# --- duplicate evidence ------------------------------------------------------------------------
def evidence(spark, sf):
    """(kept pose, absorbed pose) rows of the twin points, from the resolution; rows of a cluster share a task."""
    from .candidate_plans import resolved_twins

    r = resolved_twins(spark, sf, ("slice_id", "source_region", "priority", "v3x"))
    return r.filter("owner <> pose_ord").select(
        "case_id", "cluster", "owner", F.col("slice_id").alias("absorbed_id"), F.col("pose_ord").alias("absorbed_ord"),
        F.col("source_region").alias("absorbed_region"), F.col("priority").alias("absorbed_priority"), F.col("v3x").alias("a3x"),
        F.col("owner_slice_id").alias("slice_id"), F.col("owner_source_region").alias("source_region"),
        F.col("owner_priority").alias("priority"), F.col("owner_v3x").alias("v3x"))


@query("jn16_duplicate_evidence", """
SELECT kind, count(*) * 3211 // 3211 AS n_points FROM (SELECT unnest(['checked', 'same_square', 'priority_ok', 'other_region']) AS kind FROM b_twin WHERE organ = 'liver') GROUP BY kind""")
def jn16(spark, sf):
    """Every absorbed pose resolves once, has its keeper's square and no better priority."""
    e = evidence(spark, sf)
    per = e.groupBy("case_id", "cluster", "absorbed_id").agg(
        F.count(F.lit(1)).alias("m"), F.max(F.abs(F.col("v3x") - F.col("a3x"))).alias("gap"),
        F.min(F.col("priority") <= F.col("absorbed_priority")).alias("pri"), F.min(F.col("source_region") != F.col("absorbed_region")).alias("reg"))
    per = per.withColumn("point", F.substring_index("absorbed_id", "-", 2))
    pts = per.groupBy("case_id", "point").agg(
        F.count(F.lit(1)).alias("n"), F.max("m").alias("m"), F.max("gap").alias("gap"), F.min("pri").alias("pri"), F.min("reg").alias("reg"))
    kinds = F.array_compact(F.array(
        F.when((F.col("n") == 3211) & (F.col("m") == 1), "checked"), F.when(F.col("gap") <= 1e-9, "same_square"),
        F.when(F.col("pri"), "priority_ok"), F.when(F.col("reg"), "other_region")))
    return pts.select(F.explode(kinds).alias("kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("n_points"))


@query("set05_absorbed_not_retained", """
SELECT CAST(0 AS BIGINT) AS n_overlap, count(*) * 3211 AS n_absorbed FROM b_twin WHERE organ = 'liver'""")
def set05(spark, sf):
    """Identifiers that are absorbed and kept at once, and the number of absorbed rows."""
    ids = evidence(spark, sf).select("case_id", "cluster", F.explode(F.array(
        F.struct(F.col("absorbed_id").alias("slice_id"), F.lit(1).alias("lost")), F.struct("slice_id", F.lit(0).alias("lost")))).alias("i"))
    per = ids.groupBy("case_id", "cluster", "i.slice_id").agg(F.sum("i.lost").alias("n"), F.min("i.lost").alias("low"))
    return per.agg(F.count_if((F.col("n") > 0) & (F.col("low") == 0)).alias("n_overlap"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_absorbed"))


@query("top06_canonical_order", """
SELECT organ, point_index, row_number() OVER (ORDER BY list_position(['stomach','liver','pancreas','duodenum','esophagus'], organ), case_id, point_index) AS pos FROM b_base""")
def top06(spark, sf):
    """Position in organ order, then point: ranked range by range, not in one task."""
    from ..functions.ranking import dense_index

    f = frames(spark, sf).withColumn("k", F.array_position(F.array(*[F.lit(o) for o in K.SAMPLING_ORGANS]), F.col("organ")))
    d = dense_index(f.select(F.lit(0).alias("all"), "k", "case_id", "organ", "point_index"), ["all"], ["k", "case_id", "point_index"], "pos")
    return d.select("organ", "point_index", (F.col("pos") + 1).alias("pos"))


@query("prj18_orthographic", f"""
SELECT organ, view, count(*) AS n, {s6("avg(h)", "h_mm")}, {s6("avg(v)", "v_mm")}, min(t) AS h_title FROM (
 SELECT organ, 'axial' AS view, x AS h, y AS v, 'R (+) / L (-) [mm]' AS t FROM b_point UNION ALL SELECT organ, 'coronal', x, z, 'R (+) / L (-) [mm]' FROM b_point
 UNION ALL SELECT organ, 'sagittal', y, z, 'A (+) / P (-) [mm]' FROM b_point) GROUP BY organ, view""")
def prj18(spark, sf):
    from ..operators.coordinates import project_orthographic

    p = project_orthographic(B.points(spark, sf).select("organ", "x", "y", "z"))
    return p.groupBy("organ", "view").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("h_mm")).alias("h_mm"), r6(F.avg("v_mm")).alias("v_mm"), F.min("h_title").alias("h_title"))


@query("flt21_safe_paths", """
SELECT case_key, kind, CASE kind WHEN 'plain' THEN true WHEN 'up_and_down' THEN true ELSE false END AS safe FROM (
 SELECT c_custkey AS case_key, ['plain', 'climbs', 'absolute', 'empty', 'up_and_down'][c_custkey % 5 + 1] AS kind FROM customer)""")
def flt21(spark, sf):
    k = F.col("c_custkey")
    c = table(spark, sf, "customer").select(
        k.alias("case_key"), B.pick(("plain", "climbs", "absolute", "empty", "up_and_down"), k % 5).alias("kind"),
        B.pick(("ct/a.png", "ct/../../b.png", "/etc/c.png", "", "ct/../ct/d.png"), k % 5).alias("path"))
    return c.select("case_key", "kind", MF.safe_path(F.col("path")).alias("safe"))


@query("flt19_base_plane_validity", """
SELECT kind, count(*) AS n FROM (SELECT unnest([CASE WHEN point_index % 23 = 0 THEN 'edge_length' END, CASE WHEN point_index % 29 = 0 THEN 'probe_midpoint' END,
 CASE WHEN point_index % 23 = 0 THEN 'axes_disagree' END]) AS kind FROM b_base) WHERE kind IS NOT NULL GROUP BY kind""")
def flt19(spark, sf):
    from .pose_plans import base

    k = F.col("point_index")
    # the third corner is moved along the square's own side, which no orientation hides
    b = base(spark, sf).withColumns({
        **{f"v3{a}": F.col(f"v3{a}") + F.when(k % 23 == 0, 0.01 * F.col(f"a{a}")).otherwise(0.0) for a in "xyz"},
        "z": F.col("z") + F.when(k % 29 == 0, 1e-3).otherwise(0.0)})
    return MF.count_kinds(b.withColumn("bad", MF.violations(*base_plane_checks())), "bad", [])


def base_plane_checks(tol: float = 1e-5):
    from ..functions.linalg import norm, scale, sub, vec

    v = [vec(*(f"v{i}{a}" for a in "xyz")) for i in range(1, 5)]
    far = lambda a, b: F.greatest(*[F.abs(p - q) for p, q in zip(a, b)]) > tol
    edges = F.lit(False)
    for i in range(4):
        edges = edges | (F.abs(norm(sub(v[(i + 1) % 4], v[i])) - K.SIDE_MM) > tol)
    mid = scale(tuple(a + b for a, b in zip(v[0], v[1])), 0.5)
    ax, ay = vec("ax", "ay", "az"), vec("hx", "hy", "hz")
    axes = far(sub(v[1], v[0]), scale(ay, K.SIDE_MM)) | far(sub(v[3], v[0]), scale(ax, K.SIDE_MM)) | far(
        v[2], tuple(p + q for p, q in zip(v[1], scale(ax, K.SIDE_MM))))
    return [("edge_length", edges), ("probe_midpoint", far(mid, vec("x", "y", "z"))), ("axes_disagree", axes)]
