"""A training-data pipeline over ``documents``; each stage reads what the stage before it wrote."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from planeforge.llm import common, cotraining, near_copies, packing, quality_rules, secrets, simhash, words
from planeforge.session import materialize, ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents outside the adaptive thresholds of their language and source go."""
    return quality_rules.keep_good(docs)


def apply_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier rejects go. It learns from samples of the unfiltered documents."""
    ship(spark)
    return cotraining.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), known=common.documents(spark, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts are brought together by SimHash and by min-hash bands; of each group linked by a similarity of at least 0.8 the least doc_id stays."""
    ship(spark)
    return near_copies.keep_one(docs, bits=simhash.BITS)


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret in a text is replaced by a mark; all documents stay."""
    ship(spark)
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's tokens get places in sequences of 2048."""
    ship(spark)
    return packing.pack(packing.cut(docs, words.public_path("word_bpe_49k.json")))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", apply_rules),
    ("quality_classifier", apply_classifier),
    ("simhash_near_dedup", drop_near_copies),
    ("secret_scans", hide_secrets),
    ("best_fit_packing", pack_sequences),
]

#: Tokens and fingerprints have no SQL; tests hold the pipeline against a plain Python version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
