"""ASCII point and square exports as ordered text rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..contract import EXPORT_COLORS

# --- fixed values: header lines --------------------------------------------
POINT_PROPERTIES = ("x", "y", "z", "nx", "ny", "nz")


def header(kind_lines: list[str]) -> list[str]:
    return ["ply", "format ascii 1.0", *kind_lines, "end_header"]


def numbers(fmt: str, *cols: str) -> Column:
    """Numbers as C's printf writes them: the binary value is rounded, ties to even.

    Java's formatter rounds the shortest decimal form half up instead.
    """
    line = " ".join([fmt] * len(cols))

    @F.pandas_udf("string")
    def written(*values: pd.Series) -> pd.Series:
        return pd.Series([line % row for row in zip(*values)], dtype=object)

    return written(*[F.col(c) + F.lit(0.0) for c in cols])


def point_lines(points: DataFrame) -> DataFrame:
    """One text line per point: position and normal at six decimals."""
    return points.select("case_id", "organ", "point_index", numbers("%.6f", "x", "y", "z", "nx", "ny", "nz").alias("line"))


def square_lines(poses: DataFrame, order: list[str], fmt: str = "%.6f") -> DataFrame:
    """Four lines per square, corner order kept, no faces."""
    rows = F.array(*[
        F.struct(F.lit(i).alias("corner"), numbers(fmt, *(f"v{i}{a}" for a in "xyz")).alias("line")) for i in range(1, 5)])
    return poses.select(*order, F.inline(rows))


def point_headers(counts: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Header lines of each file; negative numbers sort before the body."""
    text = [
        F.lit("ply"), F.lit("format ascii 1.0"), F.concat(F.lit("element vertex "), F.col(count).cast("string")),
        *[F.lit(f"property double {p}") for p in POINT_PROPERTIES], F.lit("end_header"),
    ]
    n = len(text)
    rows = F.array(*[F.struct(F.lit(i - n).cast("long").alias("ord"), t.alias("line")) for i, t in enumerate(text)])
    return counts.select(*keys, F.inline(rows))


def point_file(points: DataFrame, keys: list[str]) -> DataFrame:
    """Header and body of every point file as (keys, ord, line)."""
    body = points.select(*keys, F.col("point_index").cast("long").alias("ord"), numbers("%.6f", *POINT_PROPERTIES).alias("line"))
    counts = body.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return point_headers(counts, keys, "n").unionByName(body)


def write_lines(lines: DataFrame, keys: list[str], path: str, order: list[str]) -> None:
    """Ordered text files below one directory per key value.

    Rows are range partitioned on key and order, so a large file becomes
    several part files whose names sort in line order.
    """
    (
        lines.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
        .select(*keys, F.col("line").alias("value"))
        .write.mode("overwrite").partitionBy(*keys).text(path)
    )


def export_colour(organ: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, c in EXPORT_COLORS.items():
        out = F.when(organ == name, F.lit(" ".join(str(v) for v in c))).otherwise(out)
    return out
