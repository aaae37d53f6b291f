"""Small helpers shared by the text operators: column names, whole-text readers, components of a graph."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize, width

#: ASCII white space, the only separators of words in the contracts of operators 3 and 7.
ASCII_SPACE = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_name(df: DataFrame, stem: str) -> str:
    """``stem``, or a longer name, that no column of ``df`` has (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def column(df: DataFrame, name: str) -> Column:
    """A top-level column, whatever characters its name holds."""
    return df["`" + name.replace("`", "``") + "`"]


def least_over(edges: DataFrame, spark: SparkSession, name: str, rounds: int = 60) -> DataFrame:
    """Connected components of the undirected graph ``edges(a, b)`` as (node, root), root the least node.

    Alternating large-star and small-star steps: every step is a hash aggregate and a join on the node, so no
    component is gathered anywhere; each round is written to the shared folder, which cuts lineage. A node of very
    many links is a hot key only of the neighbour table, and the step needs just its least neighbour: that is a
    partial aggregate, joined back, where adaptive execution may split the large side.
    """
    links = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    before = None
    for _ in range(rounds):
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        # Large star: each larger neighbour of a node is hung on the node's least neighbour.
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: each smaller neighbour, and the node itself, is hung on the least of them.
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        after = materialize(small.select("e.a", "e.b").where("a <> b").distinct(), name)
        mark = after.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        links = after
        if mark == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = mark
    raise RuntimeError(f"{name}: components did not settle in {rounds} rounds")


def unique_folder(spark: SparkSession, name: str) -> str:
    from ..session import shared_folder

    return f"{shared_folder(spark)}/planeforge/{name}-{uuid.uuid4().hex}"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Rows of an Arrow batch, unless the session chose its own number: whole texts can be long."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == "10000":
        spark.conf.set(key, str(rows))


def spread(df: DataFrame, spark: SparkSession) -> DataFrame:
    """Deals rows evenly over all tasks, for stages whose rows cost far more than reading them."""
    return df.repartition(width(spark))


__all__ = ["ASCII_SPACE", "T", "column", "documents", "free_name", "least_over", "materialize", "small_batches", "spread", "unique_folder", "width"]
