"""Rows arriving over time: ignore repeats, keep counts, resume after a stop."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def arrivals(spark: SparkSession, path: str, schema: StructType, per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if per_trigger:
        r = r.option("maxFilesPerTrigger", per_trigger)
    return r.json(path)


def _present(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def ingest_counts(spark: SparkSession, source: str, schema: StructType, root: str, per_trigger: int = 4) -> DataFrame:
    """Unique rows appended to a table, and the running count per status.

    The streaming state holds one entry per identifier, partitioned by it;
    the checkpoint makes a restart continue where the last trigger ended. The
    counts are read from the table, so they cost one partial aggregate.
    """
    unique = arrivals(spark, source, schema, per_trigger).dropDuplicates(["slice_id"])
    q = (
        unique.writeStream.format("parquet").outputMode("append").option("path", f"{root}/rows")
        .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    )
    q.awaitTermination()
    return spark.read.schema(schema).parquet(f"{root}/rows").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def watermarked_counts(stream: DataFrame, delay: str, window: str) -> DataFrame:
    """Counts per status and event-time window; repeats within the delay go."""
    return (
        stream.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["slice_id"])
        .groupBy(F.window("ts", window), "status").agg(F.count(F.lit(1)).alias("n"))
    )


def _run_id(spark: SparkSession, checkpoint: str) -> str:
    """The name of the runs that share a checkpoint, written beside it once."""
    path = f"{checkpoint.rstrip('/')}-run"
    if not _present(spark, path):
        spark.createDataFrame([(f"r{uuid.uuid4().hex}",)], "run string").coalesce(1).write.parquet(path)
    return spark.read.parquet(path).first()["run"]


def resume_run(spark: SparkSession, source: str, schema: StructType, manifest: str, checkpoint: str, process=None) -> None:
    """Process planned rows that have no terminal status yet.

    Each micro-batch drops what the manifest already holds with an anti join
    and is written under its run and batch number, so a batch that is replayed
    after a lost driver replaces its own rows instead of adding to them. The
    run is the stream's own identifier, kept in its checkpoint: a new
    checkpoint on an old manifest is a new run and replaces nothing.
    """
    source_rows = arrivals(spark, source, schema)
    run = _run_id(spark, checkpoint)

    def step(batch: DataFrame, number: int) -> None:
        s = batch.sparkSession
        rows = batch.groupBy("slice_id").agg(F.min("status").alias("status"))
        if _present(s, manifest):
            seen = s.read.parquet(manifest).filter((F.col("batch") != number) | (F.col("run") != run)).select("slice_id")
            rows = rows.join(seen, "slice_id", "left_anti")
        if process is not None:
            rows = process(rows)
        rows.write.mode("overwrite").parquet(f"{manifest}/run={run}/batch={number}")

    q = (
        source_rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    q.awaitTermination()
