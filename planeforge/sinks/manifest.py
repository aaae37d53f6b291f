"""Manifest, exclusion, summary and prepared-case writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .. import contract as K
from ..operators.volumes import structure_presence

PARTS = ["case_id", "status"]


def read_manifest(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The whole manifest; a state's manifest is the same table, one partition."""
    return spark.read.schema(schema).parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def append_manifest(rows: DataFrame, path: str, order) -> None:
    """Append rows whose identifier is not finished yet, each once.

    Repeats inside the batch are settled by the smallest order value with an
    aggregate, finished ones by an anti join. One table serves as root and
    state manifest, so the two cannot disagree.
    """
    spark = rows.sparkSession
    key = ["case_id", "slice_id"]
    rest = [c for c in rows.columns if c not in key]
    first = rows.groupBy(*key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(*key, "r.*").select(*rows.columns)
    if _exists(spark, path):
        first = first.join(read_manifest(spark, path, rows.schema).select(*key), key, "left_anti")
    first.write.partitionBy(*PARTS).mode("append").parquet(path)


def append_exclusions(rows: DataFrame, path: str) -> None:
    """Squares beyond the volume: reason, diagnosis, and a CT raster only."""
    rows.withColumns({"status": F.lit("excluded_fov"), "exclusion_reason": F.lit("ct_fov_exceeded")}).write.partitionBy(
        *PARTS).mode("append").parquet(path)


def write_prepared_case(vox: DataFrame, meta: DataFrame, path: str, values: dict = K.ORGAN_LABEL_VALUES) -> None:
    """One document per case: structures, source values, voxel counts, geometry."""
    counts = structure_presence(vox, values).select("case_id", "structure", "voxel_count")
    names = F.create_map(*[c for n, vs in values.items() for c in (F.lit(n), F.array(*[F.lit(v) for v in vs]))])
    organs = counts.groupBy("case_id").agg(F.array_sort(F.collect_list(
        F.struct("structure", F.element_at(names, F.col("structure")).alias("source_values"), "voxel_count"))).alias("organs"))
    geometry = meta.select("case_id", F.struct(*[c for c in meta.columns if c != "case_id"]).alias("geometry"))
    organs.join(geometry, "case_id").write.mode("overwrite").json(path)
