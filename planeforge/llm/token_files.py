"""Operator 6: token ids in files of directly addressable codes.

Every id is split into chunks of eight bits. Level 0 holds the lowest chunk of all ids, level 1 the next chunk of the
ids that have one, and so on; a bitmap at each level tells which ids go on, and a rank directory (ones before every
512 bits) finds an id's place on the next level. Any token is read with one step a level, without decoding a block.

Files: one Parquet folder. A row is a block of whole documents: ``shard``, ``first`` (ids before it in the shard),
``doc_ids``, ``ends`` (ids of the block up to each document's end) and ``codes`` (the levels). Shards are ranges of
doc_id, so the order of shards, blocks and documents is ascending doc_id; a shard's own start is the sum of the shards
before it, taken from the files. Blocks close after ``BLOCK`` ids; a longer document has a block of its own.

Rows: repeated rows are written once each, ties of doc_id in the order of a hash of the text; a null doc_id comes
first; a null or empty text has the end id only; an empty table gives no rows. Only the id and text columns are read,
so other columns and their names do not matter. Ranges are also cut inside one doc_id, so a frequent one is no hot key.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import words
from .common import column, documents, small_batches, unique_folder, width

BLOCK = 16_384
#: Bits between two entries of a rank directory.
STEP = 512
MAGIC = b"DAC1"
END_ID = 2
FILES = "shard long, first long, n_tokens long, doc_ids array<long>, ends array<long>, codes binary"


class Codes:
    """Directly addressable codes of a list of unsigned 32-bit numbers."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> None:
        self.levels = levels

    @classmethod
    def of(cls, ids: np.ndarray) -> Codes:
        levels, rest = [], np.asarray(ids, "<u4")
        while True:
            more = rest > 255
            bits = np.packbits(more, bitorder="little")
            ones = np.add.reduceat(more, np.arange(0, len(more), STEP)) if len(more) else np.zeros(0, int)
            levels.append(((rest & 255).astype(np.uint8), bits, np.concatenate([[0], np.cumsum(ones)]).astype("<u4")))
            if not more.any():
                return cls(levels)
            rest = rest[more] >> 8

    def to_bytes(self) -> bytes:
        parts = [MAGIC, len(self.levels).to_bytes(4, "little")]
        for level in self.levels:
            for array in level:
                data = array.tobytes()
                parts += [len(data).to_bytes(4, "little"), data]
        return b"".join(parts)

    @classmethod
    def read(cls, data: bytes) -> Codes:
        """Views of the bytes; nothing is decoded."""
        if data[:4] != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        levels, at = [], 8
        for _ in range(int.from_bytes(data[4:8], "little")):
            arrays = []
            for kind in (np.uint8, np.uint8, np.dtype("<u4")):
                size = int.from_bytes(data[at : at + 4], "little")
                arrays.append(np.frombuffer(data, kind, size // np.dtype(kind).itemsize, at + 4))
                at += 4 + size
            levels.append(tuple(arrays))
        return cls(levels)

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def take(self, places: np.ndarray) -> np.ndarray:
        """The numbers at any places, in their order."""
        out = np.zeros(len(places), "<u4")
        at, which = np.asarray(places, np.int64), np.arange(len(places))
        for k, (chunk, bits, ranks) in enumerate(self.levels):
            out[which] |= chunk[at].astype("<u4") << np.uint32(8 * k)
            on = bits[at >> 3] >> (at & 7).astype(np.uint8) & 1 > 0
            at, which = at[on], which[on]
            if not len(at):
                break
            at = self._rank(bits, ranks, at)
        return out

    def part(self, start: int, stop: int) -> np.ndarray:
        """The numbers at the places from ``start`` to before ``stop``: a slice of each level."""
        out = np.zeros(stop - start, "<u4")
        where = slice(None)
        for k, (chunk, bits, ranks) in enumerate(self.levels):
            out[where] |= chunk[start:stop].astype("<u4") << np.uint32(8 * k)
            if k + 1 == len(self.levels):
                break
            on = np.unpackbits(bits[start >> 3 : (stop + 7) >> 3], bitorder="little")[start & 7 :][: stop - start].view(bool)
            where = np.flatnonzero(on) if k == 0 else where[on]
            ends = self._rank(bits, ranks, np.array([start]))
            start, stop = int(ends[0]), int(ends[0]) + len(where)
        return out

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ones before each place: the directory's entry and at most ``STEP`` bits."""
        step = at // STEP
        window = np.zeros((len(at), STEP // 8), np.uint8) if len(at) < 64 else None
        if window is None:  # many places: the ones of all bytes once
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)])
            whole = before[at >> 3]
        else:
            begin = step * (STEP // 8)
            columns = begin[:, None] + np.arange(STEP // 8)
            inside = columns < (at >> 3)[:, None]
            window = np.where(inside, bits[np.minimum(columns, len(bits) - 1)], 0)
            whole = ranks[step].astype(np.int64) + np.bitwise_count(window).sum(1, dtype=np.int64)
        last = bits[at >> 3] & ((1 << (at & 7)) - 1).astype(np.uint8)
        return whole + np.bitwise_count(last)


def write(docs: DataFrame, path: str, folder: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> None:
    """Encodes every whole text and writes the files; one shuffle, of the texts, by ranges of doc_id."""
    spark = docs.sparkSession

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc, shard = words.encoder(path, False), TaskContext.get().partitionId()
        end = np.array([end_id], "<u4")
        first, ids, names, ends, size = 0, [], [], [], 0

        def block() -> pd.DataFrame:
            codes = Codes.of(np.concatenate(ids)).to_bytes()
            return pd.DataFrame({"shard": [shard], "first": [first], "n_tokens": [size], "doc_ids": [names], "ends": [ends], "codes": [codes]})

        for batch in batches:
            for name, text in zip(batch["doc_id"], batch["text"], strict=True):
                own = enc.ids(text if isinstance(text, str) else None)
                ids += [own, end]
                size += len(own) + 1
                names.append(None if pd.isna(name) else int(name))
                ends.append(size)
                if size >= BLOCK:
                    yield block()
                    first, ids, names, ends, size = first + size, [], [], [], 0
        if ends:
            yield block()

    small_batches(spark)
    source = docs.select(column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).cast("string").alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    dealt = source.repartitionByRange(width(spark), *order).sortWithinPartitions(*order)
    dealt.mapInPandas(run, FILES).write.parquet(folder)


def starts(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, base): ids of all shards before; one small row a shard."""
    sizes = spark.read.schema(FILES).parquet(folder).groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def token_at(spark: SparkSession, folder: str, places: DataFrame) -> DataFrame:
    """(place, id) for the global token places of ``places(place long)``: the block by its range, then the codes.

    Blocks and places meet on the shard and a grid of ``BLOCK`` ids; a block lists the grid cells it covers.
    """
    blocks = spark.read.schema(FILES).parquet(folder).join(starts(spark, folder), "shard")
    blocks = blocks.select((F.col("base") + F.col("first")).alias("first"), "n_tokens", "codes")
    blocks = blocks.withColumn("cell", F.explode(F.sequence(F.floor(F.col("first") / BLOCK), F.floor((F.col("first") + F.col("n_tokens") - 1) / BLOCK))))
    asked = places.select("place", F.floor(F.col("place") / BLOCK).alias("cell"))
    found = asked.join(blocks, "cell").where("place >= first and place < first + n_tokens")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            ids = [int(Codes.read(c).take(np.array([p]))[0]) for c, p in zip(batch["codes"], batch["at"], strict=True)]
            yield pd.DataFrame({"place": batch["place"], "id": ids})

    return found.select("place", (F.col("place") - F.col("first")).alias("at"), "codes").mapInPandas(run, "place long, id long")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, first, names, ends, data in zip(*(batch[c] for c in ("shard", "first", "doc_ids", "ends", "codes")), strict=True):
                codes, ends = Codes.read(data), np.asarray(ends, np.int64)
                begin = np.concatenate([[0], ends[:-1]])
                ids = codes.part(0, len(codes)).tobytes()
                crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(begin, ends, strict=True)]
                yield pd.DataFrame({"shard": shard, "doc_id": pd.array([None if n is None or n != n else int(n) for n in names], "Int64"), "place": first + begin, "n_tokens": ends - begin, "ids_crc32": crc})

    small_batches(spark, 100)
    rows = spark.read.schema(FILES).parquet(folder).mapInPandas(run, "shard long, doc_id long, place long, n_tokens long, ids_crc32 long")
    return rows.join(starts(spark, folder), "shard").select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids_crc32")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = unique_folder(spark, "op6")
    write(documents(spark, sf_dir), words.public_path("byte_bpe_50k.json"), folder)
    return read(spark, folder)
