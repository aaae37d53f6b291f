"""Views of the star-schema tables as points, meshes, voxels and manifests.

Each bridge is a narrow projection (no shuffle), so it scales with its table
and keeps column pruning down to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.identity import pose_id
from ..session import width
from .tables import table

AORTA_LIMIT = 20.0
ANCHOR = (0.0, -150.0, 0.0)
ORGAN_BY_LABEL = ("stomach", "liver", "pancreas", "duodenum", "esophagus")
MODELS = (
    "stomach", "liver", "pancreas", "duodenum", "esophagus",
    "aorta", "inferior_vena_cava", "spleen", "adrenal_gland_right", "gallbladder",
)


def pick(values, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _embedding_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    at = {
        n: F.element_at("embedding", i + 1).cast("double")
        for i, n in enumerate(("e1", "e2", "e3", "e4", "e5", "e6"))
    }
    e = e.select("vec_id", "label", *[c.alias(n) for n, c in at.items()])
    length = F.sqrt(F.col("e4") * F.col("e4") + F.col("e5") * F.col("e5") + F.col("e6") * F.col("e6"))
    return e.withColumn("nl", length).filter(F.col("nl") >= 1e-8).select(
        "vec_id", "label",
        (F.col("e1") * 400.0).alias("x"), (F.col("e2") * 400.0).alias("y"), (F.col("e3") * 400.0).alias("z"),
        (F.col("e4") / F.col("nl")).alias("nx"),
        (F.col("e5") / F.col("nl")).alias("ny"),
        (F.col("e6") / F.col("nl")).alias("nz"),
    )


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probe points: one per embedding."""
    p = _embedding_vectors(spark, sf_dir)
    v = F.col("vec_id")
    organ = pick(ORGAN_BY_LABEL, F.col("label") % 5)
    region = (
        F.when(organ == "liver", pick(
            ("liver_region_one", "liver_region_two", "liver_region_one+liver_region_two"), v % 3))
        .when(organ == "duodenum", pick(("duodenum_bulb", "duodenum_remainder"), v % 2))
        .otherwise(organ)
    )
    hit = v % 4 == 0
    return p.select(
        F.floor(F.col("label") / 5).cast("int").alias("case_id"),
        organ.alias("organ"),
        v.cast("int").alias("point_index"),
        "x", "y", "z", "nx", "ny", "nz",
        region.alias("source_region"),
        F.when(hit, F.array(F.lit("liver"), F.lit("pancreas")))
        .otherwise(F.array(F.lit("liver"))).alias("target_ids"),
    )


def model_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same vectors read as vertices of ten organ models."""
    p = _embedding_vectors(spark, sf_dir)
    return p.select(
        F.floor(F.col("label") / 5).cast("int").alias("case_id"),
        pick(MODELS, F.col("vec_id") % 10).alias("model_id"),
        F.col("vec_id").cast("long").alias("vertex_id"),
        "x", "y", "z", "nx", "ny", "nz",
    )


def voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 10 x 10 x n volume: HU and label per part."""
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.lit(0).alias("case_id"),
        F.expr("cast(p_partkey div 100 as int)").alias("z"),
        F.expr("cast((p_partkey div 10) % 10 as int)").alias("y"),
        (k % 10).cast("int").alias("x"),
        (F.col("p_size") * 20 - 500).cast("float").alias("hu"),
        (F.col("p_size") % 38).cast("int").alias("label"),
    )


def volume_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grid geometry: 270 x 270 x 300 mm whatever the number of slices."""
    m = voxels(spark, sf_dir).groupBy("case_id").agg(
        (F.max("x") + 1).alias("nx"), (F.max("y") + 1).alias("ny"), (F.max("z") + 1).alias("nz")
    )
    sz = F.lit(300.0) / (F.col("nz") - 1)
    return m.select(
        "case_id", "nx", "ny", "nz",
        F.lit(30.0).alias("sx"), F.lit(30.0).alias("sy"), sz.alias("sz"),
        # direction: x axis of the grid points along +y, y axis along -x
        F.lit(135.0).alias("ox"), F.lit(-135.0).alias("oy"), F.lit(-150.0).alias("oz"),
        *[F.lit(float(v)).alias(f"d{i}{j}") for i, row in enumerate(((0, -1, 0), (1, 0, 0), (0, 0, 1)))
          for j, v in enumerate(row)],
    )


CORNERS = ((0, 0, 0), (1, 0, 0), (1, 1, 0), (0, 1, 0), (0, 0, 1), (1, 0, 1), (1, 1, 1), (0, 1, 1))
FACES = (
    (0, 2, 1), (0, 3, 2), (4, 5, 6), (4, 6, 7), (0, 1, 5), (0, 5, 4),
    (1, 2, 6), (1, 6, 5), (2, 3, 7), (2, 7, 6), (3, 0, 4), (3, 4, 7),
)
TARGETS = (
    "adrenal_gland_left", "adrenal_gland_right", "aorta", "gallbladder", "inferior_vena_cava",
    "kidney_left", "kidney_right", "liver", "pancreas", "spleen", "portal_vein",
)


def cubes(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.lit(0).alias("case_id"),
        k.cast("long").alias("mesh_id"),
        pick(TARGETS, k % 11).alias("target_id"),
        ((k * 37) % 160 - 80).cast("double").alias("ox"),
        ((k * 53) % 160 - 80).cast("double").alias("oy"),
        ((k * 71) % 160 - 80).cast("double").alias("oz"),
        (k % 15 + 6).cast("double").alias("edge"),
    )


def _struct_list(rows, names):
    return F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, r)]) for r in rows])


def mesh_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight corners per supplier cube."""
    c = cubes(spark, sf_dir).select("*", F.posexplode(_struct_list(CORNERS, ("i", "j", "k"))))
    return c.select(
        "case_id", "mesh_id", "target_id", F.col("pos").cast("int").alias("vertex_id"),
        (F.col("ox") + F.col("edge") * F.col("col.i")).alias("x"),
        (F.col("oy") + F.col("edge") * F.col("col.j")).alias("y"),
        (F.col("oz") + F.col("edge") * F.col("col.k")).alias("z"),
    )


def mesh_faces(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cubes(spark, sf_dir).select("*", F.posexplode(_struct_list(FACES, ("v0", "v1", "v2"))))
    return c.select(
        "case_id", "mesh_id", "target_id", F.col("pos").cast("int").alias("face_id"),
        "col.v0", "col.v1", "col.v2",
    )


def mesh_triangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faces with their corner coordinates, built without a join."""
    rows = [tuple(float(v) for c in f for v in CORNERS[c]) for f in FACES]
    names = [f"{a}{i}" for i in range(3) for a in "xyz"]
    c = cubes(spark, sf_dir).select("*", F.posexplode(_struct_list(rows, names)))
    off = {"x": "ox", "y": "oy", "z": "oz"}
    return c.select(
        "case_id", "mesh_id", "target_id", F.col("pos").cast("int").alias("face_id"),
        *[(F.col(off[n[0]]) + F.col("edge") * F.col(f"col.{n}")).alias(n) for n in names],
    )


def manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished poses, one per order."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    organ = pick(ORGAN_BY_LABEL, F.col("o_custkey") % 5)
    p1 = F.substring("o_orderpriority", 1, 1)
    o = o.select(
        (F.col("o_custkey") % 3).cast("int").alias("case_id"),
        F.col("o_orderkey").alias("record_id"),
        organ.alias("organ"),
        F.col("o_custkey").alias("point_index"),
        ((F.col("o_orderkey") % 19) * 5 - 45).cast("int").alias("roll"),
        (F.expr("(o_orderkey div 19) % 13") * 5 - 30).cast("int").alias("pitch"),
        (F.expr("(o_orderkey div 247) % 13") * 5 - 30).cast("int").alias("yaw"),
        F.when(p1.isin("1", "2"), "gallery").when(p1 == "3", "unindexed")
        .when(p1 == "4", "rejected").otherwise("excluded_fov").alias("status"),
        F.col("o_orderdate").alias("ts"),
    )
    return o.withColumn(
        "slice_id", pose_id(F.col("organ"), F.col("point_index"), F.col("roll"), F.col("pitch"), F.col("yaw"))
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vessel features of a slice, one per line item."""
    from ..contract import BOUNDARY_ORGANS

    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag")
    return li.select(
        F.col("l_orderkey").alias("slice_key"),
        F.when(F.col("l_returnflag") == "R", "artery").otherwise("vein").alias("label"),
        F.col("l_quantity").alias("x_mm"),
        F.col("l_linenumber").cast("double").alias("y_mm"),
        (F.col("l_extendedprice") / 1000.0).alias("area_mm2"),
        pick(BOUNDARY_ORGANS, F.col("l_partkey") % 14).alias("organ_label"),
    )


LABEL_SIDE = 20
GRAY_SIDE = 32


def _plane_ids(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """Raster numbers dealt over all tasks before the rasters are built.

    Only the numbers are exchanged; a small table would otherwise build all
    of its rasters in the task that reads its single file.
    """
    ids = table(spark, sf_dir, name).select(F.col(key).alias("plane_id"))
    return ids.repartition(width(spark), "plane_id")


def label_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 20 x 20 label raster per order, packed row by row."""
    side = LABEL_SIDE
    o = _plane_ids(spark, sf_dir, "orders", "o_orderkey")
    # A raster is one of 38: all are one constant, so that no raster is computed pixel by pixel.
    offset = [(i // side // 4) * 7 + (i % side // 4) * 13 for i in range(side * side)]
    every = ", ".join(f"array({', '.join(f'{(c + b) % 38}S' for c in offset)})" for b in range(38))
    px = F.element_at(F.expr(f"array({every})"), F.pmod(F.col("plane_id") * 31, F.lit(38)).cast("int") + 1)
    return o.select("plane_id", F.lit(side).alias("h"), F.lit(side).alias("w"), px.alias("px"))


def gray_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 32 x 32 gray raster per order, black left of a moving border."""
    side = GRAY_SIDE
    o = _plane_ids(spark, sf_dir, "orders", "o_orderkey")
    px = F.expr(
        f"transform(sequence(0, {side * side - 1}), "
        f"i -> cast(if(i % {side} < plane_id % {side}, 0, 127) as smallint))"
    )
    return o.select("plane_id", F.lit(side).alias("h"), F.lit(side).alias("w"), px.alias("px"))


SKELETON_LENGTH = 60


def skeleton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skeleton voxels: a diagonal per sixty customers with one-voxel spurs."""
    c = table(spark, sf_dir, "customer").select(
        F.expr(f"cast(c_custkey div {SKELETON_LENGTH} as int)").alias("case_id"),
        F.expr(f"cast(c_custkey % {SKELETON_LENGTH} as int)").alias("r"),
    )
    spur = (F.col("r") % 4 == 2) & (F.col("r") < SKELETON_LENGTH - 2)
    rows = F.when(
        spur,
        F.array(
            F.struct(F.col("r").alias("z"), F.col("r").alias("y"), F.lit(0).alias("x")),
            F.struct((F.col("r") + 1).alias("z"), (F.col("r") - 1).alias("y"), F.lit(1).alias("x")),
        ),
    ).otherwise(F.array(F.struct(F.col("r").alias("z"), F.col("r").alias("y"), F.lit(0).alias("x"))))
    return c.select("case_id", F.inline(rows))


def centerline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bent path of sixty points per case."""
    c = table(spark, sf_dir, "customer").select("c_custkey")
    r = F.expr(f"cast(c_custkey % {SKELETON_LENGTH} as int)")
    return c.select(
        F.expr(f"cast(c_custkey div {SKELETON_LENGTH} as int)").alias("case_id"),
        r.alias("seq"),
        (r * 1.5 - 40.0).alias("x"),
        (F.when(r % 20 < 10, r % 10).otherwise(10 - r % 10) * 2.0 - 10.0).alias("y"),
        (r * r * 0.01 - 20.0).alias("z"),
    )


def status_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest rows as they arrive, about a tenth of them repeats."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", "ts")
    return e.select(
        F.concat(F.lit("s"), (F.col("event_id") - F.when(F.col("event_id") % 10 == 9, 9).otherwise(0))
                 .cast("string")).alias("slice_id"),
        F.when(F.col("event_type") == "click", "gallery").when(F.col("event_type") == "view", "unindexed")
        .when(F.col("event_type") == "error", "rejected").otherwise("excluded_fov").alias("status"),
        F.col("ts").cast("timestamp").alias("ts"), "event_id",
    )


BORDER_SIDE = 100


def border_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 100 x 100 gray raster and an outside mask per supplier.

    Black left of a column, above a row, or in a regular pattern; the outside
    mask follows the border with an offset of up to two pixels.
    """
    n = BORDER_SIDE
    s = _plane_ids(spark, sf_dir, "supplier", "s_suppkey")
    r, c = f"(i div {n})", f"(i % {n})"
    edge = f"if(plane_id % 3 = 1, (plane_id * 11) % {n}, (plane_id * 7) % {n})"
    at = f"if(plane_id % 3 = 1, {r}, {c})"
    black = f"if(plane_id % 3 = 2, ({r} * 31 + {c} * 17 + plane_id * 13) % 10 < plane_id % 10, {at} < {edge})"
    px = F.expr(f"transform(sequence(0, {n * n - 1}), i -> cast(if({black}, 0, 127) as smallint))")
    out = F.expr(
        f"transform(sequence(0, {n * n - 1}), i -> cast(if(plane_id % 4 <> 0 and {at} < {edge} + plane_id % 5 - 2, 1, 0) as smallint))")
    return s.select("plane_id", F.lit(n).alias("h"), F.lit(n).alias("w"), px.alias("px"), out.alias("out"))
