"""Queries on points, frames, poses and identifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.identity import source_priority, with_decoded
from ..functions.linalg import dot, r6, vec
from ..operators import poses as P
from ..session import stage
from ..sources import bridges as B
from .catalog import cte, query
from .oracle import pose_id_sql, r6 as s6


#: Points of a task that sorts their poses in memory.
POINTS_PER_TASK = 48


def frames(spark: SparkSession, sf: str) -> DataFrame:
    """The frame table is a stage of its own: small, used by every later one.

    Reading it back also keeps filters on derived axes from being expanded
    into one huge predicate over the raw embeddings.
    """

    def build():
        pts = P.with_policy(B.points(spark, sf), F.lit(B.AORTA_LIMIT))
        return P.ordinary_frames(pts, tuple(F.lit(v) for v in B.ANCHOR))

    return stage(spark, "frames", sf, build).filter("frame_ok")


def all_poses(spark, sf, keep=()) -> DataFrame:
    return P.expand(frames(spark, sf), keep)


def base(spark, sf) -> DataFrame:
    return P.base_poses(frames(spark, sf), ("source_region", "target_ids", "nx", "ny", "nz"))


BOX_LO, BOX_HI = (-150.0,) * 3, (150.0,) * 3
_BOX_SQL = " AND ".join(f"v{i}{a} BETWEEN -150.0 AND 150.0" for i in range(1, 5) for a in "xyz")


@query("poses_inside_volume", f"""
SELECT organ, yaw_policy, {_BOX_SQL} AS inside_fov, count(*) AS n_poses, {s6("avg(v3x)", "avg_v3x")}
FROM b_pose GROUP BY ALL""")
def poses_inside_volume(spark, sf):
    p = all_poses(spark, sf).withColumn("inside_fov", P.inside_box(BOX_LO, BOX_HI))
    return p.groupBy("organ", "yaw_policy", "inside_fov").agg(
        F.count(F.lit(1)).alias("n_poses"), r6(F.avg("v3x")).alias("avg_v3x"))


@query("prj01_lps_to_ras", f"""
SELECT case_id, organ, point_index, {s6("CASE WHEN point_index % 2 = 0 THEN -x ELSE x END", "x")},
 {s6("CASE WHEN point_index % 2 = 0 THEN -y ELSE y END", "y")}, {s6("z", "z")},
 {s6("CASE WHEN point_index % 2 = 0 THEN -nx ELSE nx END", "nx")} FROM b_point""")
def prj01(spark, sf):
    from ..operators.coordinates import to_ras

    p = B.points(spark, sf).withColumn("cs", F.when(F.col("point_index") % 2 == 0, "LPS").otherwise("RAS"))
    p = to_ras(to_ras(p, ("x", "y", "z"), F.col("cs")), ("nx", "ny", "nz"), F.col("cs"))
    return p.select("case_id", "organ", "point_index", r6(F.col("x")).alias("x"), r6(F.col("y")).alias("y"),
                    r6(F.col("z")).alias("z"), r6(F.col("nx")).alias("nx"))


@query("prj02_unit_rows", f"""
SELECT vec_id, {s6("nx", "ux")}, {s6("ny", "uy")}, {s6("nz", "uz")} FROM b_vec""")
def prj02(spark, sf):
    from ..functions.linalg import with_unit
    from ..sources.tables import table

    e = table(spark, sf, "embeddings").select(
        "vec_id", *[F.element_at("embedding", i).cast("double").alias(f"e{i}") for i in (4, 5, 6)])
    u = with_unit(e, ("ux", "uy", "uz"), vec("e4", "e5", "e6"), "len").filter(F.col("ux").isNotNull())
    return u.select("vec_id", *[r6(F.col(c)).alias(c) for c in ("ux", "uy", "uz")])


cte("b_prj03_volume", "SELECT case_id, sx, sy, sz, ox + 10.0 * case_id AS ox, oy, oz FROM (SELECT DISTINCT case_id FROM b_point), (SELECT sx, sy, sz, ox, oy, oz FROM b_volume)")


@query("prj03_world_to_index", f"""
SELECT organ, point_index, {s6("(y - oy) / sx", "ix")}, {s6("-(x - ox) / sy", "iy")}, {s6("(z - oz) / sz", "iz")}
FROM b_point JOIN b_prj03_volume USING (case_id)""")
def prj03(spark, sf):
    from ..operators.volumes import index_matrix, world_to_index

    # The bridge has one volume; each case gets its own copy of it, moved by 10 mm a case.
    cases = B.points(spark, sf).select("case_id").distinct()
    one = B.volume_meta(spark, sf).drop("case_id").limit(1)
    meta = index_matrix(cases.join(F.broadcast(one)).withColumn("ox", F.col("ox") + 10.0 * F.col("case_id"))).drop("nx", "ny", "nz")
    p = B.points(spark, sf).select("case_id", "organ", "point_index", "x", "y", "z").join(meta, "case_id")
    ix, iy, iz = world_to_index(vec("x", "y", "z"))
    return p.select("organ", "point_index", r6(ix).alias("ix"), r6(iy).alias("iy"), r6(iz).alias("iz"))


@query("prj05_square_frame", f"""
SELECT organ, point_index, {s6("pyx", "ux")}, {s6("pxx", "vx")}, {s6("-pzx", "wx")}, {s6("-pzz", "wz")},
 {s6("x + pxx * 50.0", "mx")}, {s6("z + pxz * 50.0", "mz")}, 100.0::DOUBLE AS width_mm, 100.0::DOUBLE AS length_mm FROM b_base""")
def prj05(spark, sf):
    d = P.square_frame(base(spark, sf))
    return d.select("organ", "point_index",
                    *[r6(F.col(c)).alias(c) for c in ("ux", "vx", "wx", "wz", "mx", "mz", "width_mm", "length_mm")])


@query("prj06_ordinary_frame", f"""
SELECT organ, point_index, {", ".join(s6(a, a) for a in P.AXES)} FROM b_frame""")
def prj06(spark, sf):
    return frames(spark, sf).select("organ", "point_index", *[r6(F.col(a)).alias(a) for a in P.AXES])


@query("prj08_frame_by_organ", f"""
SELECT organ, sgn < 0 AS reversed_normal, count(*) AS n, {s6("avg(ax * nx + ay * ny + az * nz)", "mean_dot")},
 {s6("avg(hy)", "mean_hy")} FROM b_frame GROUP BY ALL""")
def prj08(spark, sf):
    f = frames(spark, sf).withColumn("reversed_normal", F.col("organ").isin(*P.REVERSED))
    return f.groupBy("organ", "reversed_normal").agg(
        F.count(F.lit(1)).alias("n"),
        r6(F.avg(dot(vec("ax", "ay", "az"), vec("nx", "ny", "nz")))).alias("mean_dot"),
        r6(F.avg("hy")).alias("mean_hy"))


@query("prj09_rotation", f"""
SELECT organ, roll, count(*) AS n, {s6("avg(pxx)", "mean_xx")}, {s6("avg(pyy)", "mean_yy")}, {s6("avg(pzz)", "mean_zz")},
 {s6("avg(pxx * pyx + pxy * pyy + pxz * pyz)", "mean_xy")} FROM b_pose GROUP BY ALL""")
def prj09(spark, sf):
    p = all_poses(spark, sf)
    return p.groupBy("organ", "roll").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("ax")).alias("mean_xx"), r6(F.avg("hy")).alias("mean_yy"),
        r6(F.avg("cz")).alias("mean_zz"),
        r6(F.avg(dot(vec("ax", "ay", "az"), vec("hx", "hy", "hz")))).alias("mean_xy"))


@query("prj10_pose_vertices", f"""
SELECT organ, yaw, pitch, count(*) AS n, {", ".join(s6(f"avg({v})", v) for v in P.VERTICES)} FROM b_pose GROUP BY ALL""")
def prj10(spark, sf):
    return all_poses(spark, sf).groupBy("organ", "yaw", "pitch").agg(
        F.count(F.lit(1)).alias("n"), *[r6(F.avg(v)).alias(v) for v in P.VERTICES])


@query("prj11_pose_id", f"""
SELECT organ, count(*) AS n, min(id) AS first_id, max(id) AS last_id, CAST(sum(length(id)) AS BIGINT) AS chars,
 CAST(sum(CAST(('0x' || substr(sha256(id), 1, 8)) AS BIGINT)) AS BIGINT) AS hash_sum
FROM (SELECT organ, {pose_id_sql()} AS id FROM b_pose) GROUP BY organ""")
def prj11(spark, sf):
    p = P.with_identity(all_poses(spark, sf)).select("organ", F.col("slice_id").alias("id"))
    return p.groupBy("organ").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"),
        F.sum(F.length("id")).alias("chars"),
        F.sum(F.conv(F.substring(F.sha2("id", 256), 1, 8), 16, 10).cast("long")).alias("hash_sum"))


@query("prj12_pose_id_decode", """
SELECT record_id, CASE WHEN record_id % 5 <> 0 THEN organ END AS organ,
 CASE WHEN record_id % 5 <> 0 THEN CAST(point_index AS INT) END AS point_index,
 CASE WHEN record_id % 5 <> 0 THEN roll END AS roll, CASE WHEN record_id % 5 <> 0 THEN pitch END AS pitch,
 CASE WHEN record_id % 5 <> 0 THEN yaw END AS yaw FROM b_manifest""")
def prj12(spark, sf):
    m = B.manifest(spark, sf)
    # every fifth identifier is made non-canonical in one of three ways
    broken = F.when(F.col("record_id") % 3 == 0, F.concat("slice_id", F.lit("x"))).when(
        F.col("record_id") % 3 == 1, F.regexp_replace("slice_id", "-r[mpz]", "-rq")
    ).otherwise(F.regexp_replace("slice_id", "-y.*$", "-ym000"))
    m = m.withColumn("t", F.when(F.col("record_id") % 5 == 0, broken).otherwise(F.col("slice_id")))
    return with_decoded(m.select("record_id", "t"), "t").drop("t")


@query("prj13_yaw_policy", """
SELECT organ, source_region, yaw_policy, count(*) AS n FROM b_policy GROUP BY ALL""")
def prj13(spark, sf):
    p = P.with_policy(B.points(spark, sf), F.lit(B.AORTA_LIMIT))
    return p.groupBy("organ", "source_region", "yaw_policy").agg(F.count(F.lit(1)).alias("n"))


@query("prj14_source_priority", """
SELECT organ, CASE WHEN organ IN ('liver', 'pancreas') OR region LIKE '%supplement%' THEN 1 ELSE 0 END AS priority, count(*) AS n
FROM (SELECT organ, CASE WHEN point_index % 7 = 0 THEN source_region || '_supplement' ELSE source_region END AS region FROM b_point)
GROUP BY ALL""")
def prj14(spark, sf):
    p = B.points(spark, sf).withColumn(
        "region", F.when(F.col("point_index") % 7 == 0, F.concat("source_region", F.lit("_supplement")))
        .otherwise(F.col("source_region")))
    p = p.withColumn("priority", source_priority(F.col("organ"), F.col("region")))
    return p.groupBy("organ", "priority").agg(F.count(F.lit(1)).alias("n"))


@query("jn02_pose_expansion", """
SELECT organ, yaw_policy, count(*) AS n, CAST(sum(roll) AS BIGINT) AS s_roll, CAST(sum(pitch) AS BIGINT) AS s_pitch,
 CAST(sum(yaw) AS BIGINT) AS s_yaw, CAST(sum(ang_ord) AS BIGINT) AS s_ord FROM b_pose GROUP BY ALL""")
def jn02(spark, sf):
    return all_poses(spark, sf).groupBy("organ", "yaw_policy").agg(
        F.count(F.lit(1)).alias("n"), F.sum("roll").alias("s_roll"), F.sum("pitch").alias("s_pitch"),
        F.sum("yaw").alias("s_yaw"), F.sum("ang_ord").alias("s_ord"))


@query("agg02_candidate_pose_count", """
SELECT organ, yaw_policy, count(*) AS n_points, CAST(sum(CASE yaw_policy WHEN 'standard' THEN 3211
 WHEN 'liver_region_two' THEN 6175 ELSE 7657 END) AS BIGINT) AS n_poses FROM b_policy GROUP BY ALL""")
def agg02(spark, sf):
    return P.candidate_counts(P.with_policy(B.points(spark, sf), F.lit(B.AORTA_LIMIT)), ["organ", "yaw_policy"])


@query("agg03_point_plan", f"""
SELECT case_id, organ, point_index, source_region, yaw_policy, array_to_string(target_ids, ',') AS targets,
 {s6("ax", "ax")}, {s6("hy", "hy")}, {s6("cz", "cz")},
 CASE yaw_policy WHEN 'standard' THEN 3211 WHEN 'liver_region_two' THEN 6175 ELSE 7657 END AS candidate_pose_count FROM b_frame""")
def agg03(spark, sf):
    return P.point_plan(frames(spark, sf)).select(
        "case_id", "organ", "point_index", "source_region", "yaw_policy", F.array_join("target_ids", ",").alias("targets"),
        r6(F.col("ax")).alias("ax"), r6(F.col("hy")).alias("hy"), r6(F.col("cz")).alias("cz"), "candidate_pose_count")


@query("flt07_valid_frames", """
SELECT organ, count(*) AS n, count(*) FILTER (ql >= 1e-8) AS n_valid FROM (
 SELECT *, sqrt(qx * qx + qy * qy + qz * qz) AS ql FROM (
  SELECT organ, rx - rd * nx AS qx, ry - rd * ny AS qy, rz - rd * nz AS qz FROM (
   SELECT *, rx * nx + ry * ny + rz * nz AS rd FROM (
    SELECT organ, nx, ny, nz, CASE WHEN point_index % 3 = 0 THEN nx * 2.0 ELSE x END AS rx,
     CASE WHEN point_index % 3 = 0 THEN ny * 2.0 ELSE y + 150.0 END AS ry,
     CASE WHEN point_index % 3 = 0 THEN nz * 2.0 ELSE z END AS rz FROM b_point)))) GROUP BY organ""")
def flt07(spark, sf):
    # every third point is moved onto the line through the anchor along its normal
    p = B.points(spark, sf)
    third = F.col("point_index") % 3 == 0
    p = p.withColumns({
        "x": F.when(third, F.col("nx") * 2.0).otherwise(F.col("x")),
        "y": F.when(third, F.col("ny") * 2.0 - 150.0).otherwise(F.col("y")),
        "z": F.when(third, F.col("nz") * 2.0).otherwise(F.col("z"))})
    f = P.ordinary_frames(p, tuple(F.lit(v) for v in B.ANCHOR))
    return f.groupBy("organ").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("frame_ok")).alias("n_valid"))


@query("flt09_fov_vertices", f"""
SELECT organ, point_index, count(*) AS n, count(*) FILTER ({_BOX_SQL}) AS n_inside FROM b_pose GROUP BY ALL""")
def flt09(spark, sf):
    p = all_poses(spark, sf).withColumn("inside", P.inside_box(BOX_LO, BOX_HI))
    return p.groupBy("organ", "point_index").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("inside").alias("n_inside"))


@query("flt20_zero_pose", f"""
SELECT organ, point_index, {pose_id_sql()} AS slice_id, {s6("v1x", "v1x")}, {s6("v3z", "v3z")} FROM b_base""")
def flt20(spark, sf):
    p = P.with_identity(all_poses(spark, sf)).filter("roll = 0 and pitch = 0 and yaw = 0")
    return p.select("organ", "point_index", "slice_id", r6(F.col("v1x")).alias("v1x"), r6(F.col("v3z")).alias("v3z"))
