"""Queries on candidate filters, rays, spacing and selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import contract as K
from ..functions.linalg import r6
from ..operators import candidates as C, dedup as D, poses as P, rays as R, spacing as S
from ..session import materialize, stage
from ..sources import bridges as B
from .catalog import cte, query
from .oracle import r6 as s6
from .pose_plans import POINTS_PER_TASK, frames

cte("b_extreme", """
SELECT case_id, min(x) FILTER (model_id = 'liver') AS liver_min_x, max(y) FILTER (model_id = 'liver') AS liver_max_y,
 max(z) FILTER (model_id = 'liver') AS liver_max_z, min(x) FILTER (model_id = 'inferior_vena_cava') AS ivc_min_x,
 max(x) FILTER (model_id = 'inferior_vena_cava') AS ivc_max_x, max(y) FILTER (model_id = 'esophagus') AS eso_max_y,
 min(z) FILTER (model_id = 'esophagus') AS eso_min_z, max(x) FILTER (model_id = 'spleen') AS spleen_max_x,
 max(y) FILTER (model_id = 'pancreas') AS pancreas_max_y, min(z) FILTER (model_id = 'adrenal_gland_right') AS adrenal_min_z,
 max(x) FILTER (model_id = 'aorta') AS aorta_max_x FROM b_vertex GROUP BY case_id
""")
cte("b_cand", """
SELECT v.*, e.* EXCLUDE (case_id, ivc_min_x, eso_max_y, spleen_max_x), ivc_min_x + 160.0 AS ivc_min_x,
 eso_max_y - 130.0 AS eso_max_y, spleen_max_x - 180.0 AS spleen_max_x FROM b_vertex v JOIN b_extreme e USING (case_id)
""")


def extremes(spark, sf):
    return C.model_extremes(B.model_vertices(spark, sf))


def with_extremes(spark, sf, model):
    # The synthetic models are one cloud; three limits are shifted so that the
    # liver regions are not empty.
    v = B.model_vertices(spark, sf).filter(F.col("model_id") == model)
    return v.join(extremes(spark, sf), "case_id").withColumns({
        "ivc_min_x": F.col("ivc_min_x") + 160.0, "esophagus_max_y": F.col("esophagus_max_y") - 130.0,
        "spleen_max_x": F.col("spleen_max_x") - 180.0})


def _ids(df):
    return df.select("case_id", "vertex_id", r6(F.col("x")).alias("x"), r6(F.col("nz")).alias("nz"))


_SEL = f"SELECT case_id, vertex_id, {s6('x', 'x')}, {s6('nz', 'nz')} FROM b_cand WHERE "
_ONE = """model_id = 'liver' AND x BETWEEN least(liver_min_x + 20.0, ivc_min_x) AND greatest(liver_min_x + 20.0, ivc_min_x)
 AND y BETWEEN least(liver_max_y - 20.0, eso_max_y) AND greatest(liver_max_y - 20.0, eso_max_y) AND nz < 0"""
_TWO = """model_id = 'liver' AND x BETWEEN least(spleen_max_x, ivc_max_x) AND greatest(spleen_max_x, ivc_max_x)
 AND y < pancreas_max_y AND ny < 0 AND nz < 0"""


@query("jn00_scalar_extremes", f"""
SELECT case_id, {", ".join(s6(a, b) for a, b in (("liver_min_x", "liver_min_x"), ("liver_max_z", "liver_max_z"),
 ("ivc_max_x", "ivc_max_x"), ("aorta_max_x", "aorta_max_x"), ("adrenal_min_z", "adrenal_min_z")))} FROM b_extreme""")
def jn00(spark, sf):
    return extremes(spark, sf).select(
        "case_id", *[r6(F.col(c)).alias(c) for c in ("liver_min_x", "liver_max_z", "ivc_max_x", "aorta_max_x", "adrenal_min_z")])


@query("agg05_plateau_centroid", f"""
SELECT case_id, model_id, count(*) AS n_plateau, {s6("avg(x)", "cx")}, {s6("avg(y)", "cy")}, {s6("avg(z)", "cz")}
FROM (SELECT case_id, model_id, x, y, round(z / 40.0) * 40.0 AS z FROM b_vertex) v
JOIN (SELECT case_id, model_id, max(round(z / 40.0) * 40.0) AS e FROM b_vertex GROUP BY ALL) USING (case_id, model_id)
WHERE abs(z - e) <= 1e-6 GROUP BY ALL""")
def agg05(spark, sf):
    v = B.model_vertices(spark, sf).withColumn("z", F.round(F.col("z") / 40.0) * 40.0)
    c = C.plateau_centroid(v, ["case_id", "model_id"], "z", True)
    return c.select("case_id", "model_id", "n_plateau", r6(F.col("x_centroid")).alias("cx"),
                    r6(F.col("y_centroid")).alias("cy"), r6(F.col("z_centroid")).alias("cz"))


@query("flt01_liver_region_one", _SEL + _ONE)
def flt01(spark, sf):
    return _ids(C.liver_region_one(with_extremes(spark, sf, "liver")))


@query("flt02_liver_region_two", _SEL + _TWO)
def flt02(spark, sf):
    return _ids(C.liver_region_two(with_extremes(spark, sf, "liver")))


@query("flt03_duodenum_bulb", _SEL + "model_id = 'duodenum' AND z > adrenal_min_z")
def flt03(spark, sf):
    return _ids(C.duodenum_bulb(with_extremes(spark, sf, "duodenum")))


@query("flt04_duodenum_remainder", _SEL.replace("b_cand", """(SELECT case_id, model_id, vertex_id, x, z, nz, aorta_max_x - 120.0 AS aorta_max_x,
 adrenal_min_z + 90.0 AS adrenal_min_z FROM b_cand)""") + "model_id = 'duodenum' AND x > aorta_max_x AND NOT z > adrenal_min_z")
def flt04(spark, sf):
    # the limits are shifted so that the synthetic cloud has points on both sides
    p = with_extremes(spark, sf, "duodenum").withColumns({
        "aorta_max_x": F.col("aorta_max_x") - 120.0, "adrenal_min_z": F.col("adrenal_min_z") + 90.0})
    return _ids(C.duodenum_remainder(p))


@query("flt05_esophagus_segment", _SEL + "model_id = 'esophagus' AND z BETWEEN eso_min_z AND liver_max_z")
def flt05(spark, sf):
    return _ids(C.esophagus_segment(with_extremes(spark, sf, "esophagus")))


@query("flt06_pancreas_visible", f"""
SELECT v.case_id, v.vertex_id, {s6('v.x', 'x')}, {s6('v.nz', 'nz')} FROM b_vertex v JOIN (
 SELECT v.case_id, avg(v.x) AS cx FROM b_vertex v JOIN (SELECT case_id, max(z) AS e FROM b_vertex WHERE model_id = 'duodenum' GROUP BY 1) m
 ON v.case_id = m.case_id AND model_id = 'duodenum' AND abs(v.z - m.e) <= 1e-6 GROUP BY 1) c ON v.case_id = c.case_id
WHERE model_id = 'pancreas' AND v.x < c.cx AND nz > cos(radians(105.0)) AND ny > 0""")
def flt06(spark, sf):
    v = B.model_vertices(spark, sf)
    top = C.plateau_centroid(v.filter("model_id = 'duodenum'"), ["case_id"], "z", True)
    top = materialize(top.select("case_id", "x_centroid"), "duodenum-top")
    return _ids(C.pancreas_visible(v.filter("model_id = 'pancreas'").join(top, "case_id")))


@query("prj15_esophagus_translated", f"""
WITH seg AS (SELECT case_id, vertex_id, x, z FROM b_cand WHERE model_id = 'esophagus' AND z BETWEEN eso_min_z AND liver_max_z),
 span AS (SELECT case_id, max(z) - min(z) AS s FROM seg GROUP BY 1)
SELECT case_id, vertex_id, segment, {s6("x", "x")}, {s6("z - segment * s", "z")}
FROM seg JOIN span USING (case_id), (VALUES (0), (1)) t(segment)""")
def prj15(spark, sf):
    seg = C.esophagus_segment(with_extremes(spark, sf, "esophagus")).select("case_id", "vertex_id", "x", "z")
    return C.with_translated_segment(seg).select(
        "case_id", "vertex_id", "segment", r6(F.col("x")).alias("x"), r6(F.col("z")).alias("z"))


def _regions(spark, sf):
    liver = with_extremes(spark, sf, "liver")
    one = C.liver_region_one(liver).withColumns({"region": F.lit("liver_region_one"), "ord": F.col("vertex_id")})
    two = C.liver_region_two(liver).withColumns(
        {"region": F.lit("liver_region_two"), "ord": F.col("vertex_id") + F.lit(1 << 40)})
    cols = ["case_id", "vertex_id", "x", "y", "z", "nx", "ny", "nz", "region", "ord"]
    return one.select(cols).unionByName(two.select(cols))


@query("set01_region_union", f"""
SELECT region, count(*) AS n, {s6("avg(x)", "x")} FROM (SELECT 'liver_region_one' AS region, x FROM b_cand WHERE {_ONE}
 UNION ALL SELECT 'liver_region_two', x FROM b_cand WHERE {_TWO}) GROUP BY region""")
def set01(spark, sf):
    return _regions(spark, sf).groupBy("region").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("x")).alias("x"))


@query("win07_merge_regions", f"""
SELECT case_id, min(vertex_id) AS vertex_id, string_agg(region, '+' ORDER BY o) AS source_region FROM (
 SELECT case_id, vertex_id, x, y, z, 'liver_region_one' AS region, 0 AS o FROM b_cand WHERE {_ONE}
 UNION ALL SELECT case_id, vertex_id, x, y, z, 'liver_region_two', 1 FROM b_cand WHERE {_TWO}) GROUP BY case_id, x, y, z""")
def win07(spark, sf):
    m = C.merge_regions(_regions(spark, sf).drop("vertex_id"), "ord")
    return m.select("case_id", (F.col("ord") % F.lit(1 << 40)).alias("vertex_id"), "source_region")


# Every point is offered twice, the copies moved by half or twice the tolerance.
cte("b_close", """
SELECT case_id, point_index, 0 AS copy, x, CASE WHEN point_index % 3 = 0 THEN ['liver'] ELSE ['spleen'] END AS t FROM b_point
UNION ALL SELECT case_id, point_index, 1, x + CASE WHEN point_index % 2 = 0 THEN 5e-10 ELSE 2e-9 END, ['aorta'] FROM b_point
""")


@query("set02_merge_close", f"""
SELECT case_id, point_index, copy, CASE WHEN point_index % 2 = 0 THEN 'aorta,' || t[1] ELSE t[1] END AS targets
FROM b_close WHERE copy = 0 OR point_index % 2 = 1""")
def set02(spark, sf):
    p = B.points(spark, sf).select("case_id", "point_index", "x", "y", "z", "nx", "ny", "nz")
    first = p.withColumns({"copy": F.lit(0), "target_ids": F.array(
        F.when(F.col("point_index") % 3 == 0, "liver").otherwise("spleen"))})
    moved = p.withColumns({"copy": F.lit(1), "target_ids": F.array(F.lit("aorta")), "x": F.col("x") + F.when(
        F.col("point_index") % 2 == 0, 5e-10).otherwise(2e-9)})
    u = first.unionByName(moved).withColumn("ord", F.col("copy") * F.lit(1 << 40) + F.col("point_index"))
    m = C.merge_close(u.drop("copy", "point_index"), "ord")
    return m.select("case_id", (F.col("ord") % F.lit(1 << 40)).cast("int").alias("point_index"),
                    F.floor(F.col("ord") / F.lit(1 << 40)).cast("int").alias("copy"),
                    F.array_join("target_ids", ",").alias("targets"))


@query("jn03_targets_mapped_back", """
SELECT case_id, point_index, array_to_string(target_ids, ',') AS targets FROM b_point WHERE nz > 0""")
def jn03(spark, sf):
    p = B.points(spark, sf)
    m = C.map_targets_back(p.filter("nz > 0").drop("target_ids"), p)
    return m.select("case_id", "point_index", F.array_join("mapped_targets", ",").alias("targets"))


_HITS = """
SELECT point_index, target_id, t FROM (
 SELECT *, (e2x * gx + e2y * gy + e2z * gz) / det AS t, (sx * hx + sy * hy + sz * hz) / det AS u, (dx * gx + dy * gy + dz * gz) / det AS v FROM (
  SELECT *, e1x * hx + e1y * hy + e1z * hz AS det FROM (
   SELECT *, dy * e2z - dz * e2y AS hx, dz * e2x - dx * e2z AS hy, dx * e2y - dy * e2x AS hz,
    sy * e1z - sz * e1y AS gx, sz * e1x - sx * e1z AS gy, sx * e1y - sy * e1x AS gz FROM (
    SELECT p.point_index, t.target_id, nx AS dx, ny AS dy, nz AS dz, x1 - x0 AS e1x, y1 - y0 AS e1y, z1 - z0 AS e1z,
     x2 - x0 AS e2x, y2 - y0 AS e2y, z2 - z0 AS e2z, x - x0 AS sx, y - y0 AS sy, z - z0 AS sz
    FROM b_point p, b_triangle t))) WHERE abs(det) > 1e-12)
WHERE u >= 0 AND v >= 0 AND u + v <= 1 AND t > 1e-6 AND t <= 100.0 + 1e-9
"""


def hits(spark, sf):
    rays = B.points(spark, sf).select(
        F.lit(0).alias("case_id"), "point_index", "x", "y", "z",
        F.col("nx").alias("dx"), F.col("ny").alias("dy"), F.col("nz").alias("dz"))
    tri = B.mesh_triangles(spark, sf).drop("mesh_id", "face_id")
    return R.target_hits(rays, tri, ["case_id", "point_index"])


@query("jn01_ray_targets", f"""
SELECT point_index, {s6("min(t)", "distance_mm")}, first(target_id ORDER BY t, target_id) AS nearest_target,
 string_agg(DISTINCT target_id, ',' ORDER BY target_id) AS targets FROM ({_HITS}) GROUP BY point_index""")
def jn01(spark, sf):
    return hits(spark, sf).select("point_index", r6(F.col("distance_mm")).alias("distance_mm"), "nearest_target",
                                  F.array_join("target_ids", ",").alias("targets"))


@query("jn04_drop_near_fixed", """
SELECT case_id, point_index FROM b_point a WHERE organ = 'duodenum' AND source_region = 'duodenum_remainder' AND NOT EXISTS (
 SELECT 1 FROM b_point b WHERE b.organ <> 'duodenum' AND b.case_id = a.case_id
 AND sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2) < 30.0 - 1e-9)""")
def jn04(spark, sf):
    p = B.points(spark, sf)
    rest = p.filter("source_region = 'duodenum_remainder'").select("case_id", "point_index", "x", "y", "z")
    fixed = p.filter("organ <> 'duodenum'").select("case_id", "x", "y", "z")
    return S.drop_near(rest, fixed, ["case_id"], 30.0).select("case_id", "point_index")


@query("jn06_on_surface", """
SELECT case_id, point_index, CASE WHEN point_index % 5 = 0 THEN 'off_surface' WHEN point_index % 5 = 1 THEN 'normal_disagrees'
 ELSE 'ok' END AS verdict, CASE WHEN point_index % 5 = 0 THEN 0 ELSE 1 END AS n_match FROM b_point""")
def jn06(spark, sf):
    p = B.points(spark, sf)
    k = F.col("point_index") % 5
    s = p.withColumns({"x": F.when(k == 0, F.col("x") + 1e-8).otherwise(F.col("x") + 4e-10),
                       "nx": F.when(k == 1, -F.col("nx")).otherwise(F.col("nx")),
                       "ny": F.when(k == 1, -F.col("ny")).otherwise(F.col("ny")),
                       "nz": F.when(k == 1, -F.col("nz")).otherwise(F.col("nz"))})
    out = S.on_surface(s.select("case_id", "point_index", "x", "y", "z", "nx", "ny", "nz"), p, ["case_id"], "point_index")
    return out.select("case_id", "point_index", "verdict", F.col("n_match").cast("int").alias("n_match"))


@query("jn07_closest_pair", f"""
SELECT a.case_id, a.organ, {s6("min(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2 + (a.z - b.z) ** 2))", "min_mm")}
FROM b_point a JOIN b_point b ON a.case_id = b.case_id AND a.organ = b.organ AND a.point_index < b.point_index GROUP BY ALL""")
def jn07(spark, sf):
    return S.closest_pair(B.points(spark, sf), ["case_id", "organ"], "point_index").select(
        "case_id", "organ", r6(F.col("min_mm")).alias("min_mm"))


def _rules(spark, seed_base=0):
    rows = [(o, r, K.POINT_LIMITS[K.REGION_LIMIT_KEY.get(r, o)], seed_base + K.REGION_SEED_OFFSET.get(r, 1))
            for o, rs in K.REGIONS_BY_ORGAN.items() for r in rs]
    return spark.createDataFrame(rows, "organ string, source_region string, need int, seed long")


def selection(spark, sf):
    """Six regions, seeds base + 0..5; the bulb first, then the rest of the
    duodenum without the points near the chosen bulb points."""

    def build():
        keys = ["case_id", "organ"]
        p = B.points(spark, sf).withColumn("ord", F.col("point_index").cast("long"))
        p = p.withColumn("grp", F.when(F.col("organ") == "duodenum", F.col("source_region")).otherwise(F.col("organ")))
        rows = [(g, K.POINT_LIMITS[K.REGION_LIMIT_KEY[g]], K.SEED + K.REGION_SEED_OFFSET[g]) for g in K.REGION_LIMIT_KEY]
        rules = spark.createDataFrame(rows, "grp string, need int, seed long")
        cases = p.select("case_id").distinct().crossJoin(rules)
        gk = ["case_id", "grp"]
        first = S.farthest_points(p.filter("grp <> 'duodenum_remainder'"), gk, cases)
        bulb = first.filter("grp = 'duodenum_bulb'").select("case_id", "x", "y", "z")
        rest = S.drop_near(p.filter("grp = 'duodenum_remainder'"), bulb, ["case_id"])
        second = S.farthest_points(rest, gk, cases)
        return first.unionByName(second)

    return stage(spark, "selection", sf, build)


@query("top02_spaced_selection_gaps", """
SELECT case_id, CASE WHEN organ = 'duodenum' THEN source_region ELSE organ END AS grp, true AS spacing_kept, true AS maximal
FROM b_point GROUP BY ALL""")
def top02(spark, sf):
    """Post-conditions of the selection on every group: no two chosen points
    nearer than the spacing, and every candidate left out is within it unless
    the group has all the points it may have."""
    keys = ["case_id", "grp"]
    p = B.points(spark, sf)
    p = p.withColumn("grp", F.when(F.col("organ") == "duodenum", F.col("source_region")).otherwise(F.col("organ")))
    sel = selection(spark, sf)
    gap = S.closest_pair(sel, keys, "ord").select(*keys, F.col("min_mm"))
    fixed = sel.select(*keys, "x", "y", "z").unionByName(
        sel.filter("grp = 'duodenum_bulb'").select("case_id", F.lit("duodenum_remainder").alias("grp"), "x", "y", "z"))
    free = S.drop_near(p.select(*keys, "point_index", "x", "y", "z"), fixed, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_free"))
    limits = F.create_map(*[F.lit(v) for g, k in K.REGION_LIMIT_KEY.items() for v in (g, K.POINT_LIMITS[k])])
    full = sel.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).withColumn("full", F.col("n") >= limits[F.col("grp")])
    groups = p.select(*keys).distinct()
    return groups.join(gap, keys, "left").join(free, keys, "left").join(full, keys, "left").select(
        *keys, F.coalesce(F.col("min_mm") >= K.SPACING_MM - 1e-9, F.lit(True)).alias("spacing_kept"),
        (F.col("n_free").isNull() | F.coalesce("full", F.lit(False))).alias("maximal"))


@query("top04_region_selection")
def top04(spark, sf):
    return selection(spark, sf).select("case_id", "grp", "step", F.col("ord").alias("point_index"))


@query("top03_plain_farthest_points", """
SELECT organ, least(count(*), 7) AS n FROM b_point GROUP BY organ""")
def top03(spark, sf):
    p = B.points(spark, sf).select("organ", F.col("point_index").cast("long").alias("ord"), "x", "y", "z")
    rules = p.select("organ").distinct().withColumns({"need": F.lit(7), "seed": F.lit(0).cast("long")})
    f = S.farthest_points(p, ["organ"], rules, None)
    return f.groupBy("organ").agg(F.countDistinct("ord").alias("n"))


@query("agg08_shortfall_rollup", """
WITH s AS (SELECT organ, source_region, count(*) AS candidate_count FROM b_point GROUP BY ALL),
 r AS (SELECT organ, source_region, candidate_count, least(candidate_count, 60) AS actual_count, 60 AS requested_count FROM s)
SELECT organ, source_region, CAST(sum(requested_count) AS BIGINT) AS requested_count, CAST(sum(candidate_count) AS BIGINT) AS candidate_count,
 CAST(sum(actual_count) AS BIGINT) AS actual_count, CAST(sum(requested_count - actual_count) AS BIGINT) AS shortfall_count,
 CAST(grouping_id(organ, source_region) AS INT) AS level FROM r GROUP BY ROLLUP (organ, source_region)""")
def agg08(spark, sf):
    p = B.points(spark, sf)
    keys = ["organ", "source_region"]
    rules = p.select(*keys).distinct().withColumn("need", F.lit(60))
    f = S.farthest_points(
        p.select(*keys, F.col("point_index").cast("long").alias("ord"), "x", "y", "z"), keys,
        rules.withColumn("seed", F.lit(0).cast("long")), None)
    return S.shortfall_rollup(S.selection_stats(p, f, rules, keys))


cte("b_twin", """
SELECT case_id, 'stomach' AS organ, point_index, source_region, yaw_policy, x, y, z, 0 AS priority FROM b_frame WHERE organ = 'stomach' AND yaw_policy = 'standard'
UNION ALL SELECT case_id, 'liver', point_index, 'liver_region_one', yaw_policy, x, y, z, 1 FROM b_frame WHERE organ = 'stomach' AND yaw_policy = 'standard'
""")


def twins(spark, sf):
    """Every standard stomach point again as a liver point of opposite normal."""

    def build():
        a = frames(spark, sf).filter("organ = 'stomach' and yaw_policy = 'standard'")
        b = a.withColumns({"organ": F.lit("liver"), "source_region": F.lit("liver_region_one")})
        return a.unionByName(b)

    return stage(spark, "twins", sf, build)


#: Points of a cluster, beyond which its poses are shuffled.
CROWD = 96


def resolved_twins(spark, sf, carry=()):
    """All poses of coincident points with their owner and its ``carry`` columns."""
    t = twins(spark, sf).unionByName(
        frames(spark, sf).filter("not (organ = 'stomach' and yaw_policy = 'standard') and organ <> 'liver'"))
    hot = materialize(D.coincident_clusters(t), "coincident")
    size = hot.groupBy("case_id", "cluster").agg(F.count(F.lit(1)).alias("n"))
    hot = materialize(hot.join(size, ["case_id", "cluster"]), "coincident")
    hit = t.join(hot, ["case_id", "organ", "point_index"])
    square = P.VERTICES[6:] + P.VERTICES[:6]

    def poses(points, **dealt):
        return P.with_priority(P.with_identity(P.expand(points, ("source_region", "cluster"), **dealt)))

    near = poses(hit.filter(F.col("n") <= CROWD), by=("case_id", "cluster"), tasks=-(-hot.count() // POINTS_PER_TASK))
    found = D.resolve_in_place(near, square, K.DUPLICATE_TOLERANCE_MM, ["cluster"], carry)
    if hot.filter(F.col("n") > CROWD).isEmpty():
        return found
    r = D.resolve_duplicates(poses(hit.filter(F.col("n") > CROWD)), square, K.DUPLICATE_TOLERANCE_MM)
    kept = r.filter("owner = pose_ord").select("case_id", "owner", *[F.col(c).alias(f"owner_{c}") for c in carry])
    return found.unionByName(r.join(kept, ["case_id", "owner"]) if carry else r, allowMissingColumns=True)


@query("jn08_coincident_points", """
SELECT a.case_id, a.organ, a.point_index FROM b_twin a""")
def jn08(spark, sf):
    t = twins(spark, sf).unionByName(
        frames(spark, sf).filter("not (organ = 'stomach' and yaw_policy = 'standard') and organ <> 'liver'"))
    return D.coincident_points(t)


@query("top05_exact_duplicates", f"""
SELECT case_id, organ, point_index, CASE WHEN organ = 'stomach' THEN 'kept' ELSE 'absorbed' END AS fate,
 3211 AS n, CASE WHEN organ = 'stomach' THEN 0 ELSE 3211 END AS n_same_angles FROM b_twin""")
def top05(spark, sf):
    r = resolved_twins(spark, sf)
    fate = F.when(F.col("owner") == F.col("pose_ord"), "kept").otherwise("absorbed")
    same = (F.col("owner") != F.col("pose_ord")) & (F.col("owner") % 10_000 == F.col("pose_ord") % 10_000)
    return r.withColumn("fate", fate).groupBy("case_id", "organ", "point_index", "fate").agg(
        F.count(F.lit(1)).cast("int").alias("n"), F.count_if(same).cast("int").alias("n_same_angles"))
