"""Base squares as points, edges, faces and a wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..contract import SAMPLING_ORGANS
from ..functions.ranking import dense_index
from ..session import materialize
from .ply import export_colour, header, numbers

# --- fixed values: the nine vectors of the wide table and their columns ------
VECTORS = {
    "probe": ("x", "y", "z"), "normal": ("nx", "ny", "nz"), "local_x": ("ax", "ay", "az"), "local_y": ("hx", "hy", "hz"),
    "local_z": ("cx", "cy", "cz"), "v0": ("v1x", "v1y", "v1z"), "v1": ("v2x", "v2y", "v2z"), "v2": ("v3x", "v3y", "v3z"), "v3": ("v4x", "v4y", "v4z"),
}
TAIL = ["property uchar red", "property uchar green", "property uchar blue", "property ushort organ_id"]
XYZ = ["property float x", "property float y", "property float z"]


def wide_rows(planes: DataFrame) -> DataFrame:
    """27 text columns with nine decimals after the three identifying ones."""
    names = {f"{name}_{a}_mm": c for name, cols in VECTORS.items() for a, c in zip("xyz", cols)}
    text = planes.select("slice_id", "organ", "point_index", F.split(numbers("%.9f", *names.values()), " ").alias("__v"))
    return text.select("slice_id", "organ", "point_index", *[F.col("__v")[i].alias(n) for i, n in enumerate(names)])


def _write(lines: DataFrame, head: list[str], path: str) -> None:
    """Body rows in order below the header, as text part files."""
    spark = lines.sparkSession
    top = spark.createDataFrame([(i - len(head), t) for i, t in enumerate(head)], "ord long, line string")
    top.unionByName(lines.select(F.col("ord").cast("long"), "line")).repartitionByRange("ord").sortWithinPartitions("ord").select(
        F.col("line").alias("value")).write.mode("overwrite").text(path)


def export(planes: DataFrame, path: str) -> None:
    """Points, edges and faces; row numbers come from a distributed ranking."""
    k = F.array_position(F.array(*[F.lit(o) for o in SAMPLING_ORGANS]), F.col("organ"))
    d = dense_index(planes.withColumns({"__all": F.lit(0), "__k": k}), ["__all"], ["__k", "case_id", "point_index"], "i")
    d = materialize(d.withColumn("tail", F.concat(export_colour(F.col("organ")), F.lit(" "), (F.col("__k") - 1).cast("string"))), "export")
    n = d.count()
    _write(
        d.select(F.col("i").alias("ord"), F.concat_ws(" ", numbers("%.9f", "x", "y", "z", "nx", "ny", "nz"), "tail").alias("line")),
        header([f"element vertex {n}", *XYZ, "property float nx", "property float ny", "property float nz", *TAIL]), f"{path}/points")
    corners = F.array(*[F.struct(F.lit(i).alias("c"), numbers("%.9f", *(f"v{i + 1}{a}" for a in "xyz")).alias("line")) for i in range(4)])
    v = d.select("i", F.inline(corners)).select((F.col("i") * 4 + F.col("c")).alias("ord"), "line")
    ends = F.array(*[F.struct(F.lit(a).alias("a"), F.lit((a + 1) % 4).alias("b")) for a in range(4)])
    e = d.select("i", "tail", F.inline(ends))
    e = e.select((F.lit(4 * n) + F.col("i") * 4 + F.col("a")).alias("ord"), F.concat_ws(
        " ", (F.col("i") * 4 + F.col("a")).cast("string"), (F.col("i") * 4 + F.col("b")).cast("string"), "tail").alias("line"))
    _write(
        v.unionByName(e),
        header([f"element vertex {4 * n}", *XYZ, f"element edge {4 * n}", "property int vertex1", "property int vertex2", *TAIL]), f"{path}/edges")
    f = d.select((F.lit(4 * n) + F.col("i")).alias("ord"), F.concat_ws(
        " ", F.lit("4"), *[(F.col("i") * 4 + j).cast("string") for j in range(4)], "tail").alias("line"))
    _write(
        v.unionByName(f),
        header([f"element vertex {4 * n}", *XYZ, f"element face {n}", "property list uchar int vertex_indices", *TAIL]), f"{path}/faces")
