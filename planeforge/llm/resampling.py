"""Operator 12: importance resampling towards a target, with hashed n-gram features from prefix checksums.

A text's words are joined by single spaces and scanned once, storing the running CRC-32 at every word's start and end. The
CRC-32 of any n-gram then needs no further pass over its bytes: of text AB, crc(B) = crc(AB) xor (crc(A) shifted by the
length of B), where the shift multiplies by a power of x modulo the polynomial over GF(2), a linear map that four tables of
256 entries apply to a whole column of checksums (lengths below ``SHORT`` have tables of their own, longer ones are put
together from powers of two).

The buckets of a document's features are written once, as 16-bit numbers. Bucket counts of the corpus and of the target are
summed in each task and then over tasks: ``BUCKETS`` numbers whatever the tables hold, so the gains are sent to all tasks.
Drawing ranks all documents by score in written ranges, so no task sorts them all.

Rows: every input row gives one output row, repeated and tied rows too (of equal score and id the heavier, then the longer comes first); a
null text has no words, weight 0 and is never drawn; a null id is hashed as an empty string and comes after others of
equal score; an empty table gives an empty table, an empty target counts as one without features. Only the id and text columns
are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ranking import dense_index
from .common import column, documents, materialize

# Fixed values of the contract.
BUCKETS = 10_000
LONGEST = 2
LEAST_WORDS = 20
SHARE = 25
SALT = 7
LETTERS = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))
#: The polynomial of CRC-32, lowest power in the highest bit.
POLYNOMIAL = 0xEDB88320

#: Lengths with shift tables of their own.
SHORT = 64
#: Bytes of features that a task holds before it hands them on.
AT_ONCE = 8 << 20
_SPLIT = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b in LETTERS else 0x20 for b in range(256))


@cache
def _byte_table() -> np.ndarray:
    """What each byte adds to a checksum that moves on by eight bits."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(POLYNOMIAL), t >> 1)
    return t


def _as_tables(images: np.ndarray) -> np.ndarray:
    """Four tables of 256 entries of the linear map that takes bit i to images[i]."""
    out = np.zeros((4, 256), np.uint32)
    for place in range(4):
        for bit in range(8):
            out[place, 1 << bit : 2 << bit] = out[place, : 1 << bit] ^ images[8 * place + bit]
    return out


def _apply(tables: np.ndarray, v: np.ndarray) -> np.ndarray:
    return tables[0][v & 255] ^ tables[1][v >> 8 & 255] ^ tables[2][v >> 16 & 255] ^ tables[3][v >> 24]


@cache
def _short_tables() -> np.ndarray:
    """[place, length * 256 + byte]: tables of the shifts by 0 to SHORT - 1 bytes."""
    images, all_tables = np.uint32(1) << np.arange(32, dtype=np.uint32), []
    for _ in range(SHORT):
        all_tables.append(_as_tables(images))
        images = _byte_table()[images & 255] ^ (images >> 8)
    return np.ascontiguousarray(np.stack(all_tables, 1).reshape(4, -1))


@cache
def _power_tables(power: int) -> np.ndarray:
    """Tables of the shift by 2 ** power bytes."""
    if power == 0:
        return _short_tables().reshape(4, SHORT, 256)[:, 1]
    half = _power_tables(power - 1)
    return _as_tables(_apply(half, _apply(half, np.uint32(1) << np.arange(32, dtype=np.uint32))))


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Checksums (uint32) moved on by ``length`` zero bytes each."""
    tables, base = _short_tables(), np.minimum(length, SHORT - 1) << 8
    out = np.zeros(len(crc), np.uint32)
    for place in range(4):
        out ^= tables[place][base + (crc >> np.uint32(8 * place) & np.uint32(255))]
    long = np.flatnonzero(length >= SHORT)
    if len(long):
        v, rest, power = crc[long], length[long], 0
        while rest.any():
            odd = np.flatnonzero(rest & 1)
            v[odd] = _apply(_power_tables(power), v[odd])
            rest, power = rest >> 1, power + 1
        out[long] = v
    return out


def words_of(text: str | None) -> list[bytes]:
    """Words of the text in UTF-8, A-Z in lower case."""
    return text.encode().translate(_SPLIT).split() if text else []


def feature_crcs(words: list[bytes], longest: int = LONGEST) -> np.ndarray:
    """CRC-32 of all runs of 1 to ``longest`` words, joined by a space; runs of one length together."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint32)
    # The scan: the checksum after each word of the text, each word but the first with the space before it.
    chunks = (b" " + b" ".join(words)).split(b" ")[1:]
    spaced = [chunks[0], *(b" " + w for w in chunks[1:])]
    ends = np.fromiter(accumulate(spaced, lambda crc, chunk: zlib.crc32(chunk, crc), initial=0), np.uint32, n + 1)
    sizes = np.fromiter(map(len, words), np.int64, n)
    # The checksum at a word's start is that of the end before it, moved on by the space.
    turned = ~ends[1:-1]
    starts = np.zeros(n, np.uint32)
    starts[1:] = ~(_byte_table()[(turned ^ np.uint32(0x20)) & np.uint32(255)] ^ (turned >> np.uint32(8)))
    after = np.cumsum(sizes + 1)
    out = []
    for k in range(1, min(longest, n) + 1):
        length = after[k - 1 :] - np.concatenate([[0], after[: n - k]]) - 1
        out.append(ends[k:] ^ shifted(starts[: n - k + 1], length))
    return np.concatenate(out)


def features(docs: DataFrame, id_col: str | None, text_col: str, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(doc_id, n_words, n_features, packed): the features' buckets as little-endian unsigned 16-bit numbers."""
    if buckets > 1 << 16:
        raise ValueError("buckets do not fit 16 bits")

    names = ["doc_id", "n_words", "n_features", "packed"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, held = [], 0
            for doc_id, text in zip(batch["doc_id"].astype("Int64"), batch["text"], strict=True):
                words = words_of(text if isinstance(text, str) else None)
                got = feature_crcs(words, longest)
                found.append((doc_id, len(words), len(got), (got % np.uint32(buckets)).astype("<u2").tobytes()))
                held += len(found[-1][-1])
                if held > AT_ONCE:
                    yield pd.DataFrame(found, columns=names).astype({"doc_id": "Int64"})
                    found, held = [], 0
            if found:
                yield pd.DataFrame(found, columns=names).astype({"doc_id": "Int64"})

    key = column(docs, id_col).cast("long") if id_col else F.lit(None).cast("long")
    narrow = docs.select(key.alias("doc_id"), column(docs, text_col).cast("string").alias("text"))
    return narrow.mapInPandas(run, "doc_id long, n_words long, n_features long, packed binary")


def bucket_counts(found: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) of all rows: each task adds up its own, at most ``buckets`` rows of each are summed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for packed in batch["packed"]:
                total += np.bincount(np.frombuffer(packed, "<u2"), minlength=buckets)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": used, "n": total[used]})

    return found.select("packed").mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """floor(1000 * ln of the smoothed ratio of target and source share) of each bucket; exactly ``buckets`` numbers."""
    spark = source.sparkSession
    both = spark.range(buckets).select(F.col("id").alias("bucket")).join(source.withColumnRenamed("n", "s"), "bucket", "left").join(target.withColumnRenamed("n", "t"), "bucket", "left")
    both = both.fillna(0, ["s", "t"])
    totals = both.agg(F.sum("s"), F.sum("t")).first()
    s, t = (F.col(c).cast("double") for c in "st")
    ratio = (t + 1.0) * F.lit(float(totals[0] + buckets)) / ((s + 1.0) * F.lit(float(totals[1] + buckets)))
    return [r.gain for r in both.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain")).orderBy("bucket").collect()]


def weight(packed: Column, per_bucket: list[int]) -> Column:
    """Floored mean of the gains of a row's features; 0 without features."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        table = np.array(per_bucket, np.int64)
        for batch in batches:
            own = (np.frombuffer(p, "<u2") for p in batch)
            yield pd.Series([int(table[b].sum()) // len(b) if len(b) else 0 for b in own], dtype="int64")

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "long")(packed)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: int = SHARE, salt: int = SALT) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): rank is the place among the drawn rows, null for all others."""
    found = materialize(features(docs, id_col, text_col), "features")
    per_bucket = gains(bucket_counts(found), bucket_counts(features(target, None, text_col)))
    draw = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((draw + 0.5) / 4294967296.0))).cast("long")
    scored = found.select("doc_id", "n_words", "n_features", weight(F.col("packed"), per_bucket).alias("weight"))
    scored = materialize(scored.withColumn("score", F.col("weight") + noise), "scored")
    fit = F.coalesce(F.col("n_words") >= LEAST_WORDS, F.lit(False))
    n_drawn = scored.where(fit).count() * share // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.desc("weight"), F.desc("n_features")]
    placed = dense_index(scored.where(fit), [], order, "at")
    rank = F.when(F.col("at") < n_drawn, F.col("at") + 1).cast("long")
    columns = ["doc_id", "n_features", "weight", "score"]
    return placed.select(*columns, rank.alias("rank")).unionAll(scored.where(~fit).select(*columns, F.lit(None).cast("long")))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
