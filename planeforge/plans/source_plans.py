"""Queries on file readers and writers. File contents are built from the tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from .. import contract as K
from ..functions.linalg import r6
from ..operators import manifest as MF, planes as PL, poses as P
from ..session import stage_path
from ..sinks import manifest as SM, ply as PLY, rasters as SR
from ..sources import bridges as B, documents as DOC, files as FI
from ..sources.tables import table
from .catalog import query
from .oracle import pose_id_sql, r6 as s6
from .plane_plans import _COLOUR, colours
from .pose_plans import base, frames


def mesh_files(spark, sf):
    """Every cube as OBJ, ASCII STL or PLY text, in turn."""
    v = B.mesh_vertices(spark, sf).groupBy("mesh_id").agg(F.array_sort(F.collect_list(F.struct("vertex_id", "x", "y", "z"))).alias("v"))
    f = B.mesh_faces(spark, sf).groupBy("mesh_id").agg(F.array_sort(F.collect_list(F.struct("face_id", "v0", "v1", "v2"))).alias("f"))
    d = v.join(f, "mesh_id")

    def join(arr, fn):
        return F.array_join(F.transform(arr, fn), "\n")

    def num(*cs):
        return F.concat_ws(" ", *[c.cast("string") for c in cs])

    obj = F.concat(join("v", lambda p: F.concat(F.lit("v "), num(p["x"], p["y"], p["z"]))), F.lit("\n"),
                   join("f", lambda t: F.concat(F.lit("f "), num(t["v0"] + 1, t["v1"] + 1, t["v2"] + 1))))
    ply = F.concat(F.lit("ply\nformat ascii 1.0\nelement vertex 8\nproperty double x\nproperty double y\nproperty double z\nelement face 12\n"
                         "property list uchar int vertex_indices\nend_header\n"),
                   join("v", lambda p: num(p["x"], p["y"], p["z"])), F.lit("\n"), join("f", lambda t: F.concat(F.lit("3 "), num(t["v0"], t["v1"], t["v2"]))))

    def corner(i):
        return lambda t: F.concat(F.lit("vertex "), F.concat_ws(" ", *[F.element_at("v", t[f"v{i}"] + 1)[a].cast("string") for a in "xyz"]))

    stl = F.concat(F.lit("solid s\n"), join("f", lambda t: F.concat(
        F.lit("facet normal 0 0 0\nouter loop\n"), F.concat_ws("\n", corner(0)(t), corner(1)(t), corner(2)(t)), F.lit("\nendloop\nendfacet"))), F.lit("\nendsolid s"))
    k = F.col("mesh_id") % 4
    text = F.when(k == 0, obj).when(k == 1, stl).when(k == 2, ply).otherwise(F.lit("v 0 0 0\nv 1 0 0"))
    name = F.concat(F.col("mesh_id").cast("string"), B.pick((".obj", ".stl", ".ply", ".obj"), k))
    return d.select("mesh_id", name.alias("path"), text.cast("binary").alias("content"))


@query("src01_mesh_ingest", f"""
SELECT s_suppkey AS mesh_id, CASE s_suppkey % 4 WHEN 3 THEN 0 WHEN 1 THEN 36 ELSE 8 END AS n_vertices, CASE s_suppkey % 4 WHEN 3 THEN 0 ELSE 12 END AS n_faces,
 s_suppkey % 4 = 3 AS failed, CASE WHEN s_suppkey % 4 <> 3 THEN (SELECT round(min(x), 6) + 0.0 FROM b_mesh_vertex v WHERE v.mesh_id = s_suppkey) END AS min_x FROM supplier""")
def src01(spark, sf):
    p = FI.parse_meshes(mesh_files(spark, sf))
    return p.select(
        F.regexp_extract("path", r"^(\d+)", 1).cast("long").alias("mesh_id"), F.size("vertices").alias("n_vertices"), F.size("faces").alias("n_faces"),
        F.col("error").isNotNull().alias("failed"), r6(F.array_min(F.transform("vertices", lambda p: p[0]))).alias("min_x"))


def volume_files(vox, value="hu", kind="float"):
    """Volumes of five slices cut out of the part table, NRRD and NIfTI in turn."""
    import struct

    t = "<f4" if kind == "float" else "<i2"
    name = "float" if kind == "float" else "short"
    code = 16 if kind == "float" else 4
    v = vox.withColumn("slab", F.expr("cast(z div 5 as int)")).select("slab", "z", "y", "x", F.col(value).cast("double").alias("v"))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["z", "y", "x"])
        slab, nz = int(pdf["slab"].iloc[0]), pdf["z"].nunique()
        raw = pdf["v"].to_numpy().astype(t).tobytes()
        if slab % 2 == 0:
            head = (f"NRRD0004\ntype: {name}\ndimension: 3\nspace: left-posterior-superior\nsizes: 10 10 {nz}\n"
                    f"space directions: (2,0,0) (0,3,0) (0,0,4)\nencoding: raw\nendian: little\nspace origin: ({slab},20,30)\n\n")
            return pd.DataFrame([(slab, f"{slab}.nrrd", head.encode() + raw)], columns=["slab", "path", "content"])
        h = bytearray(352)
        struct.pack_into("<i", h, 0, 348)
        struct.pack_into("<8h", h, 40, 3, 10, 10, nz, 1, 1, 1, 1)
        struct.pack_into("<h", h, 70, code)
        struct.pack_into("<8f", h, 76, 1, 2, 3, 4, 1, 1, 1, 1)
        struct.pack_into("<f", h, 108, 352.0)
        struct.pack_into("<2f", h, 112, 1.0, 0.0)
        struct.pack_into("<h", h, 254, 1)
        for i, row in enumerate(((2, 0, 0, slab), (0, 3, 0, 20), (0, 0, 4, 30))):
            struct.pack_into("<4f", h, 280 + 16 * i, *row)
        return pd.DataFrame([(slab, f"{slab}.nii", bytes(h) + raw)], columns=["slab", "path", "content"])

    return v.groupBy("slab").applyInPandas(build, "slab int, path string, content binary")


@query("src02_volume_ingest", f"""
SELECT CAST(z // 5 AS INT) AS slab, count(DISTINCT z) AS n_slices, count(*) AS n_voxels, {s6("avg(hu)", "mean_hu")}, CAST(min(z // 5) AS DOUBLE) AS origin_x, 24.0::DOUBLE AS voxel_mm3,
 CASE WHEN (z // 5) % 2 = 0 THEN 'LPS' ELSE 'RAS' END AS system FROM b_voxel GROUP BY z // 5""")
def src02(spark, sf):
    s = FI.parse_volumes(volume_files(B.voxels(spark, sf))).withColumn("slab", F.regexp_extract("path", r"^(\d+)", 1).cast("int"))
    rows = FI.volume_rows(s, "hu").groupBy("path").agg(F.count(F.lit(1)).alias("n_voxels"), r6(F.avg(F.col("hu").cast("double"))).alias("mean_hu"))
    g = s.groupBy("slab", "path", "system").agg(
        F.count(F.lit(1)).alias("n_slices"), F.max(F.col("origin")[0]).alias("origin_x"),
        F.max(F.col("spacing")[0] * F.col("spacing")[1] * F.col("spacing")[2]).alias("voxel_mm3"))
    return g.join(rows, "path").drop("path")


@query("src03_label_ingest", """
SELECT CAST(z // 5 AS INT) AS slab, CASE WHEN (z // 5) % 3 = 2 THEN 'label outside 0-255' ELSE 'ok' END AS verdict FROM b_voxel GROUP BY z // 5""")
def src03(spark, sf):
    """Label volumes; every third one holds a value beyond a byte."""
    v = B.voxels(spark, sf)

    v = v.withColumn("label", F.col("label") + F.when(F.expr("(z div 5) % 3 = 2"), 300).otherwise(0))
    s = FI.parse_volumes(volume_files(v, "label", "short"), labels=True)
    return s.select(F.regexp_extract("path", r"^(\d+)", 1).cast("int").alias("slab"), F.coalesce("error", F.lit("ok")).alias("verdict")).distinct()


@query("src04_series_selection", """
WITH f AS (SELECT o_custkey AS folder, 'uid-' || (o_orderkey % 3) AS uid, count(*) AS n FROM orders WHERE o_custkey % 4 <> 3 OR o_orderkey % 3 = 0 GROUP BY ALL),
 d AS (SELECT c_custkey AS folder, CASE WHEN c_custkey % 2 = 0 THEN 'uid-1' END AS want FROM customer),
 s AS (SELECT folder, count(*) AS ns, min(uid) AS sole FROM f GROUP BY folder)
SELECT d.folder, CASE WHEN ns IS NULL THEN 'no_series' WHEN want IS NULL AND ns <> 1 THEN 'several_series' WHEN want IS NOT NULL AND f.uid IS NULL THEN 'unknown_series' ELSE 'ok' END AS verdict,
 CASE WHEN ns IS NULL OR (want IS NULL AND ns <> 1) OR (want IS NOT NULL AND f.uid IS NULL) THEN NULL ELSE coalesce(want, sole) END AS series_uid,
 CASE WHEN ns IS NULL OR (want IS NULL AND ns <> 1) OR (want IS NOT NULL AND f.uid IS NULL) THEN NULL ELSE f.n END AS n_files
FROM d LEFT JOIN s USING (folder) LEFT JOIN f ON f.folder = d.folder AND f.uid = coalesce(want, sole)""")
def src04(spark, sf):
    o = table(spark, sf, "orders").filter("o_custkey % 4 <> 3 or o_orderkey % 3 = 0").select(
        F.col("o_custkey").alias("folder"), F.concat(F.lit("uid-"), (F.col("o_orderkey") % 3).cast("string")).alias("series_uid"))
    w = table(spark, sf, "customer").select(F.col("c_custkey").alias("folder"), F.when(F.col("c_custkey") % 2 == 0, "uid-1").alias("uid"))
    return DOC.select_series(o, w)


_LINE = """CASE WHEN event_id % 7 = 0 THEN '  ' WHEN event_id % 11 = 0 THEN '[1, 2]' WHEN event_id % 13 = 0 THEN '{"k": ' WHEN event_id % 17 = 0 THEN 'true' ELSE props END"""


@query("src05_strict_jsonl", """
SELECT verdict, count(*) AS n, CAST(sum(k) AS BIGINT) AS k_sum FROM (SELECT CASE WHEN event_id % 7 = 0 THEN 'blank' WHEN event_id % 11 = 0 THEN 'not_object'
 WHEN event_id % 13 = 0 THEN 'not_json' WHEN event_id % 17 = 0 THEN 'not_object' ELSE 'ok' END AS verdict,
 CASE WHEN event_id % 7 <> 0 AND event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events) GROUP BY verdict""")
def src05(spark, sf):
    """Lines written as text files and read back by the strict reader."""
    path = stage_path(spark, "jsonl")
    table(spark, sf, "events").select(F.expr(_LINE).alias("value")).write.text(path)
    rows, bad = DOC.read_jsonl(spark, path, "k bigint", skip_blank=False)
    a = rows.groupBy(F.lit("ok").alias("verdict")).agg(F.count(F.lit(1)).alias("n"), F.sum("k").alias("k_sum"))
    b = bad.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"), F.sum(F.lit(None).cast("bigint")).alias("k_sum"))
    return a.unionByName(b)


@query("src06_json_documents", """
SELECT event_type, count(*) FILTER (event_id % 9 <> 0) AS n_ok, count(*) FILTER (event_id % 9 = 0) AS n_bad,
 CAST(sum(CASE WHEN event_id % 9 <> 0 THEN CAST(json_extract(props, '$.k') AS BIGINT) END) AS BIGINT) AS k_sum FROM events GROUP BY event_type""")
def src06(spark, sf):
    e = table(spark, sf, "events").select("event_type", F.when(F.col("event_id") % 9 == 0, F.concat(F.lit("["), "props", F.lit("]"))).otherwise(F.col("props")).alias("text"))
    d = DOC.json_documents(e, "text")
    return d.groupBy("event_type").agg(
        F.count_if(F.col("verdict") == "ok").alias("n_ok"), F.count_if(F.col("verdict") != "ok").alias("n_bad"),
        F.sum(F.try_variant_get("doc", "$.k", "bigint")).alias("k_sum"))


@query("src07_point_ply", f"""
SELECT organ, count(*) AS n, {s6("avg(x)", "x")}, {s6("avg(nz)", "nz")} FROM b_point GROUP BY organ""")
def src07(spark, sf):
    """Points as ASCII files of at most 64 rows, normals before positions."""
    p = B.points(spark, sf).withColumn("file", F.concat("organ", F.lit("-"), F.expr("point_index div 64").cast("string")))
    order = ("nx", "ny", "nz", "x", "y", "z")
    line = F.format_string(" ".join(["%.12f"] * 6), *[F.col(c) for c in order])
    body = p.groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_list(F.struct("point_index", line.alias("l")))).alias("b"))
    head = F.concat(F.lit("ply\nformat ascii 1.0\nelement vertex "), F.col("n").cast("string"), F.lit("\n" + "\n".join(f"property double {c}" for c in order) + "\nend_header\n"))
    files = body.select(F.concat("file", F.lit(".ply")).alias("path"), F.concat(head, F.array_join(F.col("b.l"), "\n"), F.lit("\n")).cast("binary").alias("content"))
    r = FI.parse_points(files)
    return r.groupBy(F.regexp_extract("path", "^([a-z]+)-", 1).alias("organ")).agg(
        F.count("point_index").alias("n"), r6(F.avg("x")).alias("x"), r6(F.avg("nz")).alias("nz"))


@query("src08_case_registry", """
SELECT 'case-' || c_custkey AS case_id, CASE WHEN c_custkey % 5 = 0 THEN '/abs/ct.nrrd' ELSE '/cases/' || (c_custkey % 10) || '/ct.nrrd' END AS ct_path,
 CASE WHEN c_custkey % 2 = 0 THEN 12.5::DOUBLE ELSE 10.0 END AS minimum_spacing_mm, CASE WHEN c_custkey % 3 = 0 THEN 128 ELSE 300 END AS output_resolution,
 CASE WHEN c_custkey % 2 = 0 THEN 77 ELSE 1000 END AS stomach_points, 500 AS liver_points, 'LPS' AS input_coordinate_system FROM customer""")
def src08(spark, sf):
    k = F.col("c_custkey")
    doc = F.to_json(F.struct(
        F.concat(F.lit("case-"), k.cast("string")).alias("case_id"), F.when(k % 5 == 0, "/abs/ct.nrrd").otherwise("ct.nrrd").alias("ct_path"), F.lit("out").alias("output_root"),
        F.when(k % 2 == 0, F.struct(F.create_map(F.lit("stomach"), F.lit(77)).alias("point_counts"), F.lit(12.5).alias("minimum_spacing_mm"))).alias("sampling"),
        F.when(k % 3 == 0, F.struct(F.lit(128).alias("output_resolution"))).alias("ct")))
    f = table(spark, sf, "customer").select(
        F.concat(F.lit("/cases/"), (k % 10).cast("string"), F.lit("/"), k.cast("string"), F.lit(".json")).alias("path"), doc.cast("binary").alias("content"))
    r = DOC.parse_registry(f)
    return r.select("case_id", "ct_path", "minimum_spacing_mm", "output_resolution", F.element_at("point_counts", "stomach").alias("stomach_points"),
                    F.element_at("point_counts", "liver").alias("liver_points"), "input_coordinate_system")


_IDS = ", ".join(f"('{n}', {v})" for n, vs in K.CATALOG_IDS.items() for v in vs)


@query("src09_catalog", f"""
SELECT organ_label, CASE WHEN organ_label IN ('aorta', 'inferior_vena_cava', 'portal_vein') THEN 'organ_and_vessel' ELSE 'organ' END AS role, count(*) AS n_voxels
FROM b_voxel JOIN (VALUES {_IDS}) t(organ_label, v) ON label = v GROUP BY ALL""")
def src09(spark, sf):
    """Voxels named through the catalogue dimension, a table of eleven rows."""
    c = DOC.catalog(spark).select("organ_label", "role", F.explode("eus_label_ids").alias("label"))
    return B.voxels(spark, sf).join(F.broadcast(c), "label").groupBy("organ_label", "role").agg(F.count(F.lit(1)).alias("n_voxels"))


# --- writers -----------------------------------------------------------------------------
@query("snk01_manifest_append", """
SELECT status, count(DISTINCT slice_id) AS n FROM (SELECT *, row_number() OVER (PARTITION BY case_id, slice_id ORDER BY record_id % 3, record_id) AS rn FROM b_manifest) WHERE rn = 1 GROUP BY status""")
def snk01(spark, sf):
    """Three overlapping batches; finished identifiers are not written again."""
    path = stage_path(spark, "manifest")
    m = B.manifest(spark, sf)
    for i in range(3):
        SM.append_manifest(m.filter(F.col("record_id") % 3 <= i), path, order=[F.col("record_id") % 3, F.col("record_id")])
    got = SM.read_manifest(spark, path, m.schema)
    return got.groupBy("status").agg(F.countDistinct("slice_id").alias("n"))


@query("snk02_fov_exclusions", """
SELECT organ, 'ct_fov_exceeded' AS exclusion_reason, count(*) AS n FROM b_manifest WHERE status = 'excluded_fov' GROUP BY organ""")
def snk02(spark, sf):
    path = stage_path(spark, "excluded")
    SM.append_exclusions(B.manifest(spark, sf).filter("status = 'excluded_fov'").withColumn("fov_diagnostics", F.struct(F.lit(0.5).alias("out_of_bounds_ratio"))), path)
    got = spark.read.parquet(path)
    return got.groupBy("organ", "exclusion_reason").agg(F.count(F.lit(1)).alias("n"))


@query("snk03_rasters", f"""
WITH e AS (SELECT plane_id, row_, col_, max(CASE vessel {_COLOUR} END) AS c, max(CASE WHEN vessel <> 'portal_vein' THEN CASE vessel {_COLOUR} END END) AS a,
  max(CASE WHEN vessel = 'portal_vein' THEN CASE vessel {_COLOUR} END END) AS p FROM b_vessel_edge GROUP BY ALL),
 px AS (SELECT plane_id, row_, col_, c, a, p, CASE WHEN col_ < 7 THEN 0 ELSE 127 END AS g FROM b_label LEFT JOIN e USING (plane_id, row_, col_)),
 v AS (SELECT plane_id, row_, col_, unnest(['ct', 'boundary_only', 'ct_overlay', 'organ_vessel_boundary', 'eus_vessel_boundary', 'ct_eus_vessel_overlay'][1:CASE plane_id % 3 WHEN 0 THEN 6 WHEN 1 THEN 3 ELSE 1 END]) AS kind,
  unnest([printf('%02X', g), printf('%06X', coalesce(c, 16777215)), printf('%06X', coalesce(c, g * 65793)), printf('%06X', coalesce(a, 16777215)), printf('%06X', coalesce(p, 16777215)),
   printf('%06X', coalesce(p, g * 65793))][1:CASE plane_id % 3 WHEN 0 THEN 6 WHEN 1 THEN 3 ELSE 1 END]) AS x FROM px)
SELECT plane_id, kind, sha256(string_agg(x, '' ORDER BY row_, col_)) AS content FROM v GROUP BY plane_id, kind""")
def snk03(spark, sf):
    """Six kinds of image with contents of their own, read back from the files."""
    path = stage_path(spark, "rasters")
    side = B.LABEL_SIDE
    gray = F.expr(f"transform(sequence(0, {side ** 2 - 1}), i -> cast(if(i % {side} < 7, 0, 127) as int))")
    portal = PL.rgb(K.VESSEL_COLORS["portal_vein"])

    def only(keep):
        return F.transform("rgb", lambda v: F.when(keep(v), v).otherwise(PL.WHITE))

    p = colours(spark, sf).select(
        "plane_id", F.lit(side).alias("h"), F.lit(side).alias("w"), gray.alias("px"), F.col("rgb").alias("boundary_only"),
        PL.composite(F.col("rgb"), PL.gray_as_rgb(gray)).alias("ct_overlay"), only(lambda v: v != portal).alias("organ_vessel_boundary"),
        only(lambda v: v == portal).alias("eus_vessel_boundary"))
    p = p.withColumn("ct_eus_vessel_overlay", PL.composite(F.col("eus_vessel_boundary"), PL.gray_as_rgb(F.col("px"))))
    SR.write_rasters(p.withColumn("status", B.pick(("gallery", "rejected", "excluded_fov"), F.col("plane_id") % 3)), "plane_id", path)
    return spark.read.parquet(path).select("plane_id", "kind", F.sha2(F.hex("image"), 256).alias("content"))


_HEAD = "['ply', 'format ascii 1.0', 'element vertex ' || n, 'property double x', 'property double y', 'property double z', 'property double nx', 'property double ny', 'property double nz', 'end_header']"


@query("snk04_point_ply", f"""
WITH c AS (SELECT organ, count(*) AS n FROM b_base GROUP BY organ)
SELECT organ, CAST(i - 11 AS BIGINT) AS ord, {_HEAD}[i] AS line FROM c, (SELECT CAST(unnest(generate_series(1, 10)) AS INT) AS i)
UNION ALL SELECT organ, point_index, printf('%.6f %.6f %.6f %.6f %.6f %.6f', x + 0.0, y + 0.0, z + 0.0, nx + 0.0, ny + 0.0, nz + 0.0) FROM b_base""")
def snk04(spark, sf):
    """Written per organ in line order and read back."""
    path = stage_path(spark, "points-ply")
    lines = PLY.point_file(frames(spark, sf), ["organ"])
    PLY.write_lines(lines, ["organ"], path, ["ord"])
    back = spark.read.text(path).groupBy("organ").agg(F.count(F.lit(1)).alias("m"))
    return lines.join(back, "organ").filter("m > 10").select("organ", "ord", "line")


@query("snk05_square_ply", f"""
SELECT organ, count(*) AS n_lines, CAST(sum(CAST(('0x' || substr(sha256(l), 1, 8)) AS BIGINT)) AS BIGINT) AS digest FROM (
 SELECT organ, unnest([{", ".join(f"printf('%.6f %.6f %.6f', v{i}x + 0.0, v{i}y + 0.0, v{i}z + 0.0)" for i in range(1, 5))}]) AS l FROM b_base) GROUP BY organ""")
def snk05(spark, sf):
    ln = PLY.square_lines(base(spark, sf), ["case_id", "organ", "point_index"])
    path = stage_path(spark, "squares-ply")
    PLY.write_lines(ln.withColumn("ord", F.col("point_index") * 4 + F.col("corner")), ["organ"], path, ["ord"])
    t = spark.read.text(path)
    return t.groupBy("organ").agg(F.count(F.lit(1)).alias("n_lines"), F.sum(
        F.conv(F.substring(F.sha2("value", 256), 1, 8), 16, 10).cast("long")).alias("digest"))


@query("snk06_summary_documents", """
SELECT case_id, count(*) FILTER (status = 'gallery') AS gallery, count(*) AS completed FROM b_manifest GROUP BY case_id""")
def snk06(spark, sf):
    path = stage_path(spark, "summary")
    c = MF.status_counts(B.manifest(spark, sf), ["case_id"])
    c.write.mode("overwrite").json(path)
    return spark.read.schema("case_id int, gallery bigint, completed bigint").json(path)


_CSV = ", ".join(f"printf('%.9f', {c} + 0.0) AS {n}" for n, c in (
    ("probe_x_mm", "x"), ("normal_z_mm", "nz"), ("local_x_y_mm", "pxy"), ("v0_x_mm", "v1x"), ("v3_z_mm", "v4z")))


@query("prj19_wide_columns", f"SELECT {pose_id_sql()} AS slice_id, organ, point_index, {_CSV} FROM b_base")
def prj19(spark, sf):
    from ..sinks.base_planes import wide_rows

    w = wide_rows(P.with_identity(base(spark, sf).withColumn("ang_ord", F.lit(0).cast("long"))))
    return w.select("slice_id", "organ", "point_index", "probe_x_mm", "normal_z_mm", "local_x_y_mm", "v0_x_mm", "v3_z_mm")


_RGB = "CASE organ " + " ".join(f"WHEN '{n}' THEN '{' '.join(map(str, c))}'" for n, c in K.EXPORT_COLORS.items()) + " END"
_OID = "list_position(['stomach','liver','pancreas','duodenum','esophagus'], organ) - 1"


_CORNER = "unnest([" + ", ".join(f"printf('%.9f %.9f %.9f', v{i}x + 0.0, v{i}y + 0.0, v{i}z + 0.0)" for i in range(1, 5)) + "])"


@query("snk07_base_plane_export", f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY {_OID}, case_id, point_index) - 1 AS i FROM b_base)
SELECT 'points' AS part, count(*) AS n, CAST(sum(CAST(('0x' || substr(sha256(printf('%.9f %.9f %.9f %.9f %.9f %.9f', x + 0.0, y + 0.0, z + 0.0, nx + 0.0, ny + 0.0, nz + 0.0) || ' ' || {_RGB} || ' ' || ({_OID})), 1, 8)) AS BIGINT)) AS BIGINT) AS digest FROM r
UNION ALL SELECT 'edges', count(*), CAST(sum(CAST(('0x' || substr(sha256(l), 1, 8)) AS BIGINT)) AS BIGINT) FROM (SELECT {_CORNER} AS l FROM r UNION ALL
 SELECT CAST(i * 4 + a AS VARCHAR) || ' ' || (i * 4 + (a + 1) % 4) || ' ' || {_RGB} || ' ' || ({_OID}) FROM r, (SELECT unnest(generate_series(0, 3)) AS a))
UNION ALL SELECT 'faces', count(*), CAST(sum(CAST(('0x' || substr(sha256(l), 1, 8)) AS BIGINT)) AS BIGINT) FROM (SELECT {_CORNER} AS l FROM r UNION ALL
 SELECT '4 ' || (i * 4) || ' ' || (i * 4 + 1) || ' ' || (i * 4 + 2) || ' ' || (i * 4 + 3) || ' ' || {_RGB} || ' ' || ({_OID}) FROM r)""")
def snk07(spark, sf):
    from ..sinks.base_planes import export

    path = stage_path(spark, "base-planes")
    export(base(spark, sf), path)
    out = None
    for part in ("points", "edges", "faces"):
        t = spark.read.text(f"{path}/{part}").filter("value not like 'e%' and value not like 'p%' and value not like 'f%'")
        d = t.agg(F.count(F.lit(1)).alias("n"), F.sum(F.conv(F.substring(F.sha2("value", 256), 1, 8), 16, 10).cast("long")).alias("digest")).select(
            F.lit(part).alias("part"), "n", "digest")
        out = d if out is None else out.unionByName(d)
    return out


_LV = ", ".join(f"('{n}', {v})" for n, vs in K.ORGAN_LABEL_VALUES.items() for v in vs)


@query("snk08_prepared_case", f"""
SELECT structure, string_agg(DISTINCT CAST(v AS VARCHAR), ',' ORDER BY CAST(v AS VARCHAR)) AS source_values, CAST(sum(n) AS BIGINT) AS voxel_count FROM (
 SELECT structure, v, (SELECT count(*) FROM b_voxel WHERE label = v) AS n FROM (VALUES {_LV}) t(structure, v)) GROUP BY structure""")
def snk08(spark, sf):
    path = stage_path(spark, "prepared")
    SM.write_prepared_case(B.voxels(spark, sf), B.volume_meta(spark, sf), path)
    d = spark.read.schema("case_id int, organs array<struct<structure:string,source_values:array<int>,voxel_count:bigint>>").json(path)
    return d.select(F.inline("organs")).withColumn("source_values", F.array_join(F.array_sort(F.col("source_values").cast("array<string>")), ","))
