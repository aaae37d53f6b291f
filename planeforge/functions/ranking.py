"""Positions inside large groups without putting a group into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import materialize, width


def ranged(df: DataFrame, keys: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows cut into ordered ranges, with the rank offset of every range.

    The ranges are written out, so their numbers cannot change between the
    counting pass and the ranking pass.
    """
    n = width(df.sparkSession)
    cut = df.repartitionByRange(n, *keys, *order).withColumn("__part", F.spark_partition_id())
    cut = materialize(cut, "ranges")
    counts = cut.groupBy(*keys, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy(*keys).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.withColumn("__off", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    return cut, offsets


def dense_index(df: DataFrame, keys: list[str], order: list[str], name: str) -> DataFrame:
    """0, 1, 2 ... per group in the given order."""
    cut, offsets = ranged(df, keys, order)
    local = F.row_number().over(W.partitionBy(*keys, "__part").orderBy(*order)) - 1
    out = cut.withColumn("__loc", local).join(offsets.drop("__n"), [*keys, "__part"])
    return out.withColumn(name, F.col("__off") + F.col("__loc")).drop("__part", "__loc", "__off")


def nth_row(df: DataFrame, keys: list[str], order: list[str], nth: DataFrame) -> DataFrame:
    """The row at position ``nth.k`` of every group; only its range is ranked."""
    cut, offsets = ranged(df, keys, order)
    hit = offsets.join(nth, keys).filter("__off <= k and k < __off + __n")
    rows = cut.join(hit, [*keys, "__part"])
    local = F.row_number().over(W.partitionBy(*keys, "__part").orderBy(*order)) - 1
    return rows.withColumn("__loc", local).filter("__off + __loc = k").select(*df.columns)
