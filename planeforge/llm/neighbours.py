"""Operator 9: approximate nearest neighbours by adaptive dimension scan.

Vectors are dealt to lists by their nearest centroid and rotated by a fixed random rotation, after which every group of
columns tells equally much about a distance. A list is stored in blocks, a block as groups of columns. A query reads the
lists whose centroids are nearest. Within a block, distances grow by a group of columns at a time, and a candidate is
given up as soon as its partial distance, scaled up to all dimensions, is too far above the k-th best so far for the
difference to be chance (a one-sided test that allows ``SLACK`` standard deviations). What is left is measured exactly, on the original
vectors in double precision.

Centroids are fitted on a bounded sample (``SAMPLE`` vectors, ``MAX_LISTS`` centroids); every vector is indexed. Lists and
queries are dealt to blocks of about ``BLOCK`` vectors and ``CHUNK`` queries by a hash, as many as they need, so a list
with a third of all rows is many blocks, and a task handles one block with one chunk at a time.

Rows: vectors that are null, of another length than most, zero, or hold null or non-finite components take no part.
A repeated row is a candidate each time, but asked once: queries are the distinct (vec_id, vector), and a vec_id with two
vectors gets k neighbours for each of them under its one query_id. Rows with the query's own vec_id, or without one, are none. Equal distances are
ordered by vec_id. With fewer than k candidates all are returned; an empty table gives an empty table. Only the id and
vector columns are read, so other columns and their names do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column, materialize

K = 10
SAMPLE = 16_384
MAX_LISTS = 4096
PROBES = 32
BLOCK = 256
CHUNK = 64
COLUMNS = 16
SLACK = 3.0
#: Share of the lists that is read where ``PROBES`` lists would be less. Vectors without clusters, such as the synthetic
#: ones, need about this share for a recall of 0.95; clustered ones need far less.
SHARE = 0.6
RESULT = "ask long, query_id long, vec_id long, score double"


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of a few large rows, for what is run inside."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def centroids_of(sample: np.ndarray, n: int, rounds: int = 8) -> np.ndarray:
    """Means of ``n`` groups of the distinct vectors of a sample."""
    sample = np.unique(sample, axis=0)
    rng = np.random.default_rng(7)
    means = sample[rng.permutation(len(sample))[:n]].copy()
    for _ in range(rounds):
        own = nearest(sample, means, 1)[:, 0]
        counts = np.bincount(own, minlength=len(means))
        sums = np.zeros_like(means)
        np.add.at(sums, own, sample)
        means[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return means


def nearest(vectors: np.ndarray, means: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest means of each vector, nearest first."""
    out = []
    square = (means * means).sum(1)
    for part in range(0, len(vectors), 1024):
        far = square - 2 * vectors[part : part + 1024] @ means.T
        some = np.argpartition(far, min(n, far.shape[1]) - 1, axis=1)[:, :n] if n < far.shape[1] else np.tile(np.arange(far.shape[1]), (len(far), 1))
        order = np.argsort(np.take_along_axis(far, some, 1), axis=1, kind="stable")
        out.append(np.take_along_axis(some, order, 1))
    return np.concatenate(out) if out else np.zeros((0, n), int)


def scan_block(ids: np.ndarray, vectors: np.ndarray, columns: list[np.ndarray], query_id: int, query: np.ndarray, turned: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k nearest of a block to one query, by (distance, id); ``columns`` are groups of rotated dimensions."""
    at = np.flatnonzero(ids != query_id)
    if len(at) > k:
        whole = len(turned)
        first = at[: max(4 * k, 32)]
        limit = np.partition(sum(((c[first] - q) ** 2).sum(1) for c, q in zip(columns, np.split(turned, np.cumsum([c.shape[1] for c in columns])[:-1]), strict=True)), k - 1)[k - 1]
        so_far, done = np.zeros(len(at)), 0
        for c in columns:
            so_far += ((c[at] - turned[done : done + c.shape[1]]) ** 2).sum(1)
            done += c.shape[1]
            slack = (1 + SLACK / np.sqrt(done)) ** 2 if done < whole else 1 + 1e-4
            keep = so_far * (whole / done) <= limit * slack + 1e-12
            at, so_far = at[keep], so_far[keep]
        if len(at) > k:
            bound = np.partition(so_far, k - 1)[k - 1]
            at = at[so_far <= bound * (1 + 1e-4) + 1e-12]
    score = np.sqrt(((vectors[at] - query) ** 2).sum(1))
    order = np.lexsort((ids[at], score))[:k]
    return ids[at][order], score[order]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    v = column(vectors, vector_col).cast("array<double>")
    df = vectors.select(column(vectors, id_col).cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and size(v) > 0")
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    return df.where(good)


def search(vectors: DataFrame, chosen: str, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows that the condition ``chosen`` on vec_id names, against all rows."""
    spark = vectors.sparkSession
    all_ = usable(vectors, id_col, vector_col)
    lengths = all_.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if lengths is None:
        return empty
    d, n = lengths["d"], lengths["count"]
    all_ = all_.where(F.size("v") == d)
    ids = all_.select("vec_id", F.xxhash64("vec_id").alias("h")).orderBy("h", "vec_id").limit(SAMPLE).select("vec_id").distinct()
    sample = all_.join(F.broadcast(ids), "vec_id").select("v").limit(2 * SAMPLE).toPandas()["v"]  # bounded: SAMPLE ids
    means = centroids_of(np.stack(sample.to_list()), int(min(MAX_LISTS, np.ceil(np.sqrt(n)))))
    lists = len(means)
    turn = np.linalg.qr(np.random.default_rng(11).standard_normal((d, d)))[0]
    cuts = list(range(COLUMNS, d, COLUMNS))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                own = nearest(np.stack(batch["v"].to_list()), means, 1)[:, 0]
                yield pd.DataFrame({"list": own.astype(np.int32), "vec_id": batch["vec_id"], "v": batch["v"]})

    dealt = all_.mapInPandas(deal, "list int, vec_id long, v array<double>").withColumn("row", F.monotonically_increasing_id())
    with batches_of(spark, 1000):
        dealt = materialize(dealt, "dealt-vectors")
    sizes = {r["list"]: r["count"] for r in dealt.groupBy("list").count().collect()}  # one row a list: at most MAX_LISTS
    held = np.array([sizes.get(i, 0) for i in range(lists)])
    blocks = np.maximum(1, -(-held // BLOCK))
    parts = spark.createDataFrame([(i, int(b)) for i, b in enumerate(blocks)], "list int, blocks int")

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        v = np.stack(group["v"].to_list())
        turned = b"".join(np.ascontiguousarray(c, np.float32).tobytes() for c in np.split(v @ turn, cuts, axis=1))
        asks = group["ask"].to_numpy(np.int64).tobytes()
        return pd.DataFrame({"list": [key[0]], "part": [key[1]], "asks": [asks], "ids": [group["vec_id"].to_numpy(np.int64).tobytes()], "v": [v.tobytes()], "turned": [turned]})

    schema = "list int, part int, asks binary, ids binary, v binary, turned binary"
    salted = dealt.join(F.broadcast(parts), "list").withColumn("part", F.pmod(F.xxhash64("row"), "blocks").cast("int"))
    stored = materialize(salted.select("list", "part", F.col("row").alias("ask"), "vec_id", "v").groupBy("list", "part").applyInPandas(pack, schema).drop("asks"), "blocks")

    probes = max(PROBES, int(np.ceil(SHARE * lists)))

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filled = np.flatnonzero(held)
        for batch in batches:
            if not len(batch):
                continue
            near = filled[nearest(np.stack(batch["v"].to_list()), means[filled], len(filled))]
            reach = np.cumsum(held[near], axis=1)
            # The nearest lists, and further ones until k others are among them.
            n_lists = np.maximum(min(probes, len(filled)), 1 + (reach <= k).sum(1))
            for ask, name, v, own, m in zip(batch["ask"], batch["vec_id"], batch["v"], near, n_lists, strict=True):
                own = own[:m]
                yield pd.DataFrame({"list": own.astype(np.int32), "ask": ask, "vec_id": name, "v": [v] * len(own)})

    once = dealt.where(chosen).groupBy("vec_id", "v").agg(F.min("row").alias("ask"))
    asked = once.select("ask", "vec_id", "v").mapInPandas(probe, "list int, ask long, vec_id long, v array<double>")
    asked = materialize(asked, "queries")
    chunks = asked.groupBy("list").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    own_chunk = asked.join(F.broadcast(chunks), "list").withColumn("part", F.pmod(F.xxhash64("ask"), "chunks").cast("int"))
    packed = own_chunk.select("list", "part", "ask", "vec_id", "v").groupBy("list", "part").applyInPandas(pack, schema)
    packed = packed.select("list", *[F.col(c).alias(f"q_{c}") for c in ("asks", "ids", "v", "turned")])
    packed = packed.join(F.broadcast(parts), "list").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")
    tiles = packed.join(stored, ["list", "part"])

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        widths = np.diff([0, *cuts, d])
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids, v = np.frombuffer(row.ids, np.int64), np.frombuffer(row.v).reshape(-1, d)
                flat = np.frombuffer(row.turned, np.float32)
                ends = np.cumsum(widths) * len(ids)
                columns = [flat[e - w * len(ids) : e].reshape(-1, w) for w, e in zip(widths, ends, strict=True)]
                q_ids, q_v = np.frombuffer(row.q_ids, np.int64), np.frombuffer(row.q_v).reshape(-1, d)
                found = [scan_block(ids, v, columns, name, query, query @ turn, k) for name, query in zip(q_ids, q_v, strict=True)]
                near, score = map(np.concatenate, zip(*found, strict=True))
                sizes = [len(x) for x, _ in found]
                yield pd.DataFrame({"ask": np.repeat(np.frombuffer(row.q_asks, np.int64), sizes), "query_id": np.repeat(q_ids, sizes), "vec_id": near, "score": score})

    with batches_of(spark, 32):
        best = materialize(tiles.select("ids", "v", "turned", "q_asks", "q_ids", "q_v").mapInPandas(measure, RESULT), "tiles")
    rank = F.row_number().over(Window.partitionBy("ask").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 100 = 0")
