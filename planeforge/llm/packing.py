"""Operator 2: best-fit packing after Martello-Toth dominance reduction.

Pieces are numbers from 1 to the capacity, so an instance of any size is a histogram of at most ``capacity`` counts.
The reduction looks at a length i and the sets of one or two others that may share its sequence. A set that dominates
all others (whatever else could stand beside i can be exchanged for it without needing another sequence) is fixed, as
often as its lengths last:
  * nothing else fits beside i: {i};
  * the longest j that fits fills the sequence, or no two others fit: {i, j};
  * at most two others fit, and no two that fit are longer together than j: {i, j};
  * at most two others fit, and with b the longest beside i and j, no pair has a shorter member above b: {i, j, b}.
This goes on until nothing can be fixed. What is left is packed best-fit, longest first, by groups of sequences with
equal room. Planning handles the bounded histogram only; the documents are assigned by Spark: a piece's rank among
the pieces of its length (its rank in its own task, plus the counts of the tasks before) names its place in the plan.

Rows: every row of the pieces gets one place, repeated and tied rows too; a null or empty text is the end id alone;
an empty table gives an empty table; other columns pass through, and helper columns take names that are free.
No key is gathered: counts are partial aggregates by task and length, even where one length has a third of the rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import words
from .common import column, documents, free_name, materialize, small_batches

CAPACITY = 2048
END_ID = 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(docs: DataFrame, path: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of at most ``capacity`` ids of every whole text and its end id; only longer documents are cut."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = words.encoder(path, True)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            for name, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = enc.ids(text if isinstance(text, str) else None).tobytes() + end
                rows += [(name, k // capacity // 4, k // 4, len(x) // 4, zlib.crc32(x)) for k in range(0, len(ids), 4 * capacity) for x in [ids[k : k + 4 * capacity]]]
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"})

    small_batches(docs.sparkSession)
    source = docs.select(column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).cast("string").alias("text"))
    return source.mapInPandas(run, PIECES)


class Instance:
    """Counts of lengths that are still to be packed, and the patterns fixed so far with their numbers."""

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.capacity = capacity
        self.counts = [0] * (capacity + 1)
        for length, n in counts.items():
            self.counts[length] = n
        self.fixed: list[tuple[tuple[tuple[int, int], ...], int]] = []

    def longest(self, room: int, taken: Counter) -> int:
        """The longest length of at most ``room`` beside what is taken, or 0."""
        for length in range(min(room, self.capacity), 0, -1):
            if self.counts[length] > taken[length]:
                return length
        return 0

    def shortest(self, taken: Counter, n: int = 3) -> list[int]:
        out: list[int] = []
        for length in range(1, self.capacity + 1):
            if free := self.counts[length] - taken[length]:
                out += [length] * min(free, n - len(out))
                if len(out) == n:
                    break
        return out

    def dominant(self, i: int) -> tuple[int, ...] | None:
        """A set with ``i`` that dominates every other one, if that can be proved."""
        room, taken = self.capacity - i, Counter([i])
        j = self.longest(room, taken)
        if not j:
            return (i,)
        low = self.shortest(taken)
        if j == room or len(low) < 2 or low[0] + low[1] > room:
            return i, j
        if len(low) == 3 and sum(low) <= room:
            return None
        best_sum = best_short = 0  # of pairs that fit
        for q in range(room // 2, 0, -1):
            if self.counts[q] > taken[q]:
                p = self.longest(room - q, taken + Counter([q]))
                if p >= q:
                    best_sum, best_short = max(best_sum, p + q), max(best_short, q)
                    if best_sum > j and best_short:
                        break
        if best_sum <= j:
            return i, j
        b = self.longest(room - j, taken + Counter([j]))
        return (i, j, b) if b and best_short <= b else None

    def fix(self, pattern: tuple[tuple[int, int], ...], times: int) -> None:
        for length, k in pattern:
            self.counts[length] -= k * times
        self.fixed.append((pattern, times))

    def reduce(self) -> None:
        changed = True
        while changed:
            changed = False
            for i in range(self.capacity, 0, -1):
                while self.counts[i] and (found := self.dominant(i)):
                    need = Counter(found)
                    self.fix(tuple(need.items()), min(self.counts[x] // k for x, k in need.items()))
                    changed = True

    def best_fit(self) -> None:
        """Longest first, each into the sequence it leaves least room in."""
        open_: dict[int, list[tuple[tuple[tuple[int, int], ...], int]]] = {}
        for length in range(self.capacity, 0, -1):
            n, self.counts[length] = self.counts[length], 0
            rooms = sorted(r for r in open_ if r >= length)
            while n:
                room = rooms[0] if rooms else self.capacity
                groups = open_.get(room, [])
                if not groups and rooms:
                    rooms.pop(0)
                    continue
                pattern, bins = groups.pop() if groups else ((), n)
                k = min(room // length, n)
                used = min(bins, n // k)
                if groups is not None and bins > used and pattern:
                    groups.append((pattern, bins - used))
                open_.setdefault(room - k * length, []).append(((*pattern, (length, k)), used))
                n -= k * used
        self.fixed += [g for groups in open_.values() for g in groups]


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Patterns ((length, copies), ...) and how often each is used; together they hold exactly the counts."""
    instance = Instance(counts, capacity)
    instance.reduce()
    instance.best_fit()
    return instance.fixed


def _runs(patterns: list[tuple[tuple[tuple[int, int], ...], int]]) -> tuple[np.ndarray, ...]:
    """For each length, stretches of ranks: first rank, first sequence, offset and copies in a sequence."""
    used: Counter = Counter()
    rows, sequence = [], 0
    for pattern, times in patterns:
        offset = 0
        for length, k in pattern:
            rows.append(((length << 44) + used[length], sequence, offset, k))
            used[length] += k * times
            offset += k * length
        sequence += times
    rows.sort()
    return tuple(np.array([r[c] for r in rows], np.int64) for c in range(4))


def pack(pieces: DataFrame, capacity: int = CAPACITY, length_col: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``; lengths are from 1 to ``capacity``."""
    part, rank, length = free_name(pieces, "part"), free_name(pieces, "rank"), length_col
    schema = T.StructType([*pieces.schema.fields, T.StructField(part, T.LongType()), T.StructField(rank, T.LongType())])

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, own = np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            sizes = batch[length].to_numpy(np.int64)
            if len(sizes) and not 1 <= sizes.min() <= sizes.max() <= capacity:
                raise ValueError(f"lengths must be from 1 to {capacity}")
            ranks = batch.groupby(length).cumcount().to_numpy() + seen[sizes]
            seen += np.bincount(sizes, minlength=capacity + 1)
            yield batch.assign(**{part: own, rank: ranks})

    # Pieces are written first: numbered in the stage that makes them, each task would hold two Python workers, which are
    # used again for either work, so that both would come to hold a tokenizer and its words.
    numbered = materialize(materialize(pieces, "pieces").mapInPandas(number, schema), "packing")
    by_part = numbered.groupBy(part, length).agg(F.count("*").alias("n"))
    counts = {r[0]: r[1] for r in by_part.groupBy(length).agg(F.sum("n")).collect()}  # at most ``capacity`` rows
    keys, sequences, offsets, copies = _runs(plan(counts, capacity))
    before = Window.partitionBy(length).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    base = by_part.select(part, length, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"))
    base_name = free_name(numbered, "base")
    joined = numbered.join(base.withColumnRenamed("n", base_name), [part, length])

    def place(sizes: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sizes, ranks = sizes.to_numpy(np.int64), ranks.to_numpy(np.int64)
        key = (sizes << 44) + ranks
        run = np.searchsorted(keys, key, "right") - 1
        step = key - keys[run]
        return pd.DataFrame({"sequence_id": sequences[run] + step // copies[run], "offset": offsets[run] + step % copies[run] * sizes})

    place.__annotations__ = {"sizes": pd.Series, "ranks": pd.Series, "return": pd.DataFrame}
    at = free_name(joined, "at")
    placed = joined.withColumn(at, F.pandas_udf(place, "sequence_id long, offset long")(F.col(length), F.col(rank) + F.col(base_name)))
    return placed.select(*[column(placed, c) for c in pieces.columns], F.col(at)["sequence_id"].alias("sequence_id"), F.col(at)["offset"].alias("offset"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(cut(documents(spark, sf_dir), words.public_path("word_bpe_49k.json")))
