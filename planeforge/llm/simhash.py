"""Operator 7: SimHash near-duplicates by deletion-variant signatures.

Two 64-bit fingerprints that differ in at most three bits differ in at most one bit on one of their two halves. So each
half is indexed by its 32 one-wildcard variants (the half with one bit deleted): a pair to be linked shares a variant,
found by an equality join, and is verified on all 64 bits. Fingerprints are made distinct first, so copies of any
number are one entry.

A variant that very many fingerprints share is not compared pair by pair. Its members agree on 31 bits of one half, so
three differences are left for the other half at most, and one of its quarters again has at most one: hot variants are
indexed anew by the wildcard variants of both quarters, and once more by those of eighths. After that members agree on
53 bits, which leaves at most 2048 distinct fingerprints: a proven bound. Every level is the same equality join, no link
is lost, and only keys that two fingerprints share go on. Linked fingerprints leave a task as a forest (one link a
member), never as all pairs; components are found by rounds of joins on the fingerprint.

Rows: every input row gives one output row; repeated and tied rows are copies of each other. A null text is an empty
one; texts without words have fingerprint zero. A null doc_id counts for no component's name: the name is null where a
component has no other. An empty table gives an empty table. Only the id and text columns are read; ``keep_one`` returns
all columns as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, documents, free_name, least_over, materialize, small_batches, width

SHINGLE = 3
SEED = 42
BITS = 3
#: Members of a variant that are compared with each other in a task; more are indexed by shorter pieces.
CROWD = 2048


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint as a signed 64-bit number: a bit is set if it is set in over half of the shingles' hashes."""
    import xxhash

    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = np.array([digest(b" ".join(words), SEED)], "<u8")
    else:
        runs = zip(*(words[k:] for k in range(shingle)), strict=False)
        hashes = np.fromiter((digest(b" ".join(r), SEED) for r in runs), "<u8", len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for part in range(0, len(hashes), 65_536):
        some = hashes[part : part + 65_536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(some, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint(text: Column) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([fingerprint_of(t if isinstance(t, str) else None) for t in batch], dtype="int64")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "long")(text)


def _index(rows: DataFrame, size: int) -> DataFrame:
    """The variants of two pieces of ``size`` bits that begin at bit ``low`` of the fingerprints of rows (fp, low, key).

    A variant is a piece with one bit deleted; its key also holds the key so far. What stays free is the other piece.
    """
    out = []
    for k in (0, 1):
        piece = F.expr(f"shiftrightunsigned(fp, low + {k * size})").bitwiseAND(F.lit((1 << size) - 1))
        for bit in range(size):
            above = F.shiftleft(F.shiftrightunsigned(piece, bit + 1), bit)
            below = piece.bitwiseAND(F.lit((1 << bit) - 1))
            out.append(F.xxhash64("key", F.lit(k * 64 + bit), above.bitwiseOR(below)))
    return rows.select("fp", "low", F.posexplode(F.array(*out)).alias("place", "key")).select(
        "fp", F.when(F.col("place") < size, F.col("low") + size).otherwise(F.col("low")).alias("low"), "key"
    )


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, least member) of the components of the links a-b."""
    names, places = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b = places[: len(a)], places[len(a) :]
    root = np.arange(len(names))
    while True:
        least = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, root[a], least)
        np.minimum.at(after, root[b], least)
        after = after[after]
        if (after == root).all():
            break
        root = after
    moved = root != np.arange(len(names))
    return names[moved], names[root[moved]]


def _linked(key: np.ndarray, fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of equal key within ``bits`` bits; rows are sorted by key, and no key has over ``CROWD`` rows."""
    left, right = [], []
    at = np.arange(len(key))
    step = 1
    while len(at):
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        near = np.bitwise_count((fp[at] ^ fp[at + step]).view(np.uint64)) <= bits
        left.append(fp[at[near]])
        right.append(fp[at[near] + step])
        step += 1
    return np.concatenate([*left, fp[:0]]), np.concatenate([*right, fp[:0]])


def _compare(rows: DataFrame, bits: int) -> DataFrame:
    """Links among rows (key, fp) of equal key, as forests; keys of at most ``CROWD`` rows."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest_key, rest_fp = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def found(key: np.ndarray, fp: np.ndarray) -> Iterator[pd.DataFrame]:
            a, b = _linked(key, fp, bits)
            if len(a):
                a, b = _forest(a, b)
                yield pd.DataFrame({"a": a, "b": b})

        for batch in batches:
            key = np.concatenate([rest_key, batch["key"].to_numpy(np.int64)])
            fp = np.concatenate([rest_fp, batch["fp"].to_numpy(np.int64)])
            cut = int(np.searchsorted(key, key[-1])) if len(key) else 0  # the last key may go on
            yield from found(key[:cut], fp[:cut])
            rest_key, rest_fp = key[cut:], fp[cut:]
        yield from found(rest_key, rest_fp)

    dealt = rows.repartition(width(rows.sparkSession), "key").sortWithinPartitions("key", "fp")
    return dealt.select("key", "fp").mapInPandas(run, "a long, b long")


def links(fps: DataFrame, bits: int = BITS, crowd: int = CROWD) -> DataFrame:
    """Forest links (a, b) that connect all distinct fingerprints of ``fps(fp)`` within ``bits`` <= 3 bits."""
    if not 0 <= bits <= 3:
        raise ValueError("two halves with one wildcard hold for at most three bits")
    rows, found = fps.select("fp", F.lit(0).alias("low"), F.lit(0).cast("long").alias("key")), None
    for size in (32, 16, 8):
        rows = _index(rows, size)
        sizes = materialize(rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "shared-keys")
        shared = materialize(rows.join(sizes.hint("merge"), "key"), "shared-variants")  # the same way at every size
        part = _compare(shared.where(F.col("n") <= crowd) if size > 8 else shared, bits)
        found = part if found is None else found.unionAll(part)
        rows = shared.where(F.col("n") > crowd).select("fp", "low", "key")
        if size == 8 or rows.isEmpty():
            break
    return materialize(found.distinct(), "links")


def components(marked: DataFrame, id_name: str, fp_name: str, bits: int = BITS) -> DataFrame:
    """(fp, component_id, n_docs) for each distinct fingerprint of ``marked``; n_docs counts the rows of the component."""
    spark = marked.sparkSession
    own = marked.groupBy(F.col(fp_name).alias("fp")).agg(F.min(id_name).alias("least"), F.count("*").alias("n"))
    own = materialize(own, "fingerprints")
    roots = least_over(links(own.select("fp"), bits), spark, "components")
    named = own.join(roots, own["fp"] == roots["node"], "left").select("fp", "least", "n", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("n_docs"))
    return named.select("fp", "root").join(least, "root").select("fp", "root", "component_id", "n_docs")


def group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id, n_docs) of every row."""
    small_batches(docs.sparkSession)
    marked = materialize(docs.select(column(docs, id_col).cast("long").alias("doc_id"), fingerprint(column(docs, text_col).cast("string")).alias("fp")), "marked")
    groups = materialize(components(marked, "doc_id", "fp", bits), "groups")
    joined = marked.join(groups.drop("root"), "fp")
    return joined.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "n_docs")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the row of least id stays (nulls last)."""
    small_batches(docs.sparkSession)
    fp, row = free_name(docs, "fp"), free_name(docs, "row")
    marked = docs.withColumn(fp, fingerprint(column(docs, text_col).cast("string"))).withColumn(row, F.monotonically_increasing_id())
    marked = materialize(marked, "marked")
    narrow = marked.select(column(marked, id_col).cast("long").alias("doc_id"), F.col(fp).alias("fp"), F.col(row).alias("row"))
    groups = materialize(components(narrow, "doc_id", "fp", bits), "groups")
    # The least row of each fingerprint first, so that copies meet in partial aggregates.
    first = narrow.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    kept = first.join(groups, "fp").groupBy("root").agg(F.min("first").alias("first")).select(F.col("first")["row"].alias(row))
    # A merge join at every size: what is kept grows with the input, so it is never broadcast.
    return marked.join(materialize(kept, "kept").hint("merge"), row, "left_semi").select(*[column(marked, c) for c in docs.columns])


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group(documents(spark, sf_dir)).select("doc_id", "fingerprint", "component_id")
