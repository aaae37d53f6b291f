"""Operator 11: phrase collocations by direct-address tiling.

Texts become blocks: of one language each, with a dictionary of their own and the words as numbers into it, 0 between pieces.
All further work is on blocks; a text is read once.

1. Words that come often enough in their language are ranked by frequency; a block asks once for each word of its dictionary.
2. Level k joins the phrases of k - 1 words (their ranks) and the words after them (theirs) into pairs. A block counts its own
   pairs in tiles of ``SIDE`` x ``SIDE`` ranks: tiles with many pairs, those of low ranks, are dense arrays that ``bincount``
   fills by direct address; all others are lists sorted by (tile, cell) whose runs are counted. What leaves a block is one
   row for each different pair, so the hottest pair is one row a block, and Spark adds the blocks' counts up in a window that
   leaves frequent pairs with their blocks: every pair is shuffled once.
3. Pairs that come often enough are re-ranked, in classes of about equal frequency, and sent to the blocks that hold them, where they are the phrases
   of the next level; a block keeps their places only. A phrase's parts come at least as often as the phrase, so nothing else can be part of a longer one.

The score of a cut needs the counts of its two parts, which are frequent phrases too: an equality join, salted, as one word
may begin a large share of all phrases. A phrase is dropped if a longer one comes as often; then one with a single further
word does so too, so the prefixes and suffixes of the next level tell. Scores are exact: decimals of 38 digits hold 1000 a n and
l r for counts below 10 ** 16. The best of each language are cut per salt first and then ranked.

Rows: repeated rows count each time; a null text is an empty one; a null language and the language ``und`` are one; ties in
score are broken by count, then by phrase in byte order; an empty table gives an empty table. A piece may be of any length; a
block closes behind the document in which it passes ``BLOCK`` bytes. Only the text and language columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column, documents, materialize

# Fixed values of the contract.
BREAKS = b".,;:!?\n\x0b\x0c\r"
LONGEST = 5
LEAST = 100
BEST = 2000
NO_LANGUAGE = "und"

#: Bytes of text in the open blocks of a task.
BLOCK = 8 << 20
#: Ranks along a side of a tile, and pairs from which a tile is a dense array.
SIDE = 1024
DENSE = SIDE * SIDE // 32
#: Bytes of a text that are cut into words at once.
SLICE = 1 << 20
SALTS = 8
_FOLD = bytes(10 if b in BREAKS else 32 if b == 9 else b | 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))


class _Numbers(dict):
    """word -> 1, 2, 3 ...; a piece's end is 0, nothing between two spaces -1."""

    def __init__(self) -> None:
        super().__init__({b"\n": 0, b"": -1})

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self) - 1
        return number


class _Open:
    """A block that is being filled."""

    def __init__(self) -> None:
        self.numbers, self.parts = _Numbers(), []

    def add(self, text: str, size: int = SLICE) -> int:
        data, start = text.encode().translate(_FOLD), 0
        while start < len(data):
            end = data.find(b" ", start + size)
            end = len(data) if end < 0 else end
            words = data[start:end].replace(b"\n", b" \n ").split(b" ")
            found = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
            self.parts.append(found[found >= 0].astype("<u4"))
            start = end
        self.parts.append(np.zeros(1, "<u4"))
        return len(data)

    def row(self, name: int, lang: str) -> tuple:
        stream = np.concatenate(self.parts)
        counts = np.bincount(stream, minlength=len(self.numbers) - 1)[1:]
        return name, lang, packed(stream), [w.decode() for w in list(self.numbers)[2:]], counts


def packed(numbers: np.ndarray) -> bytes:
    """Numbers as planes of equal bytes, compressed: high bytes are nearly all zero."""
    return zlib.compress(np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, numbers.itemsize).T.tobytes(), 1)


def unpacked(data: bytes, kind: str = "<i8") -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zlib.decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def blocks(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", most: int = BLOCK) -> DataFrame:
    """(block, lang, stream, words, counts) of all texts, written."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened: dict[str, _Open] = {}
        name, held = TaskContext.get().partitionId() << 32, 0

        def closed() -> Iterator[pd.DataFrame]:
            nonlocal name
            for lang, block in opened.items():
                yield pd.DataFrame([block.row(name, lang)], columns=["block", "lang", "stream", "words", "counts"])
                name += 1
            opened.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                held += opened.setdefault(lang, _Open()).add(text)
                if held > most:
                    yield from closed()
                    held = 0
        yield from closed()

    narrow = docs.select(F.coalesce(column(docs, lang_col).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), column(docs, text_col).cast("string").alias("text"))
    narrow = narrow.where("text <> ''")
    return materialize(narrow.mapInPandas(run, "block long, lang string, stream binary, words array<string>, counts array<long>"), "blocks")


def tiled(a: np.ndarray, b: np.ndarray, side: int = SIDE, dense: int = DENSE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, n): how often each pair of ranks comes."""
    if not len(a):
        return a, b, np.zeros(0, np.int64)
    across = int(b.max()) // side + 1
    tile, cell = a // side * across + b // side, a % side * side + b % side
    order = np.argsort(tile, kind="stable")
    tile, cell = tile[order], cell[order]
    starts = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
    sizes = np.diff(np.append(starts, len(tile)))
    sparse = np.ones(len(tile), bool)
    tiles, cells, counts = [], [], []
    for start, size in zip(starts[sizes >= dense].tolist(), sizes[sizes >= dense].tolist(), strict=True):
        sparse[start : start + size] = False
        filled = np.bincount(cell[start : start + size], minlength=side * side)
        cells.append(np.flatnonzero(filled))
        counts.append(filled[cells[-1]])
        tiles.append(np.full(len(cells[-1]), tile[start]))
    tile, cell = tile[sparse], cell[sparse]
    order = np.lexsort((cell, tile))
    tile, cell = tile[order], cell[order]
    fresh = np.flatnonzero(np.concatenate([[True], (tile[1:] != tile[:-1]) | (cell[1:] != cell[:-1])])) if len(tile) else np.zeros(0, np.int64)
    tiles.append(tile[fresh])
    cells.append(cell[fresh])
    counts.append(np.diff(np.append(fresh, len(tile))))
    tile, cell = np.concatenate(tiles), np.concatenate(cells)
    return tile // across * side + cell // side, tile % across * side + cell % side, np.concatenate(counts)


#: Of a block: the places of its frequent phrases (as steps), their ranks, and the ranks of their last words (null: the same).
_STATE = "block long, lang string, steps binary, ranks binary, lasts binary"


def _pairs(block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, ranks of a phrase, ranks of the next word) where the phrase one word later is frequent too."""
    places, ranks = np.cumsum(unpacked(block.steps)), unpacked(block.ranks)
    lasts = ranks if block.lasts is None else unpacked(block.lasts)
    at = np.flatnonzero(places[1:] == places[:-1] + 1)
    return places[at], ranks[at], lasts[at + 1]


def _state(block, places: np.ndarray, ranks: np.ndarray, lasts: np.ndarray | None) -> pd.DataFrame:
    row = (block.block, block.lang, packed(np.diff(places, prepend=0)), packed(ranks), None if lasts is None else packed(lasts))
    return pd.DataFrame([row], columns=["block", "lang", "steps", "ranks", "lasts"])


def _frequent(rows: DataFrame, keys: list[str], least: int, name: str) -> DataFrame:
    """``rows(block, number, lang, *keys, n)`` of the keys that come ``least`` times in all, with that count and a rank; written.

    Rows meet once, by key. Each task numbers its keys within classes of about equal count while they pass; the largest
    number of any task in each class, a few hundred rows a language, tells where a class begins. So ranks from 1 follow
    the classes from the most frequent down and no two keys share one, but no row moves again to get its rank.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple, int] = {}
        part, last, number, kind = TaskContext.get().partitionId(), None, -1, -1
        for batch in batches:
            if not len(batch):
                continue
            own = [batch[c].to_numpy() for c in ("lang", *keys)]
            fresh = np.zeros(len(batch), bool)
            fresh[0] = tuple(c[0] for c in own) != last
            for c in own:
                fresh[1:] |= c[1:] != c[:-1]
            last = tuple(c[-1] for c in own)
            total = batch["n"].to_numpy(np.int64)
            power = np.maximum(np.floor(np.log2(total)).astype(np.int64), 3)
            classes = power * 8 + (total >> (power - 3))
            numbers, kinds, starts = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64), np.flatnonzero(fresh)
            before = int(starts[0]) if len(starts) else len(batch)
            numbers[:before], kinds[:before] = number, kind
            ends = np.append(starts[1:], len(batch))[: len(starts)]  # one key may fill a whole batch
            for start, end, lang, c in zip(starts.tolist(), ends.tolist(), batch["lang"].to_numpy()[starts], classes[starts].tolist(), strict=True):
                number = seen.get((lang, c), 0)
                seen[lang, c], kind = number + 1, c
                numbers[start:end], kinds[start:end] = number, c
            yield batch.assign(part=part, kind=kinds, nth=numbers)

    whole = F.sum("n").over(Window.partitionBy("lang", *keys))
    often = rows.withColumn("n", whole).where(F.col("n") >= least)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in often.schema)
    often = materialize(often.mapInPandas(run, fields + ", part long, kind long, nth long"), name)
    parts = (often.agg(F.max("part")).first()[0] or 0) + 1
    most = often.groupBy("lang", "kind").agg((F.max("nth") + 1).alias("most"))
    before = F.coalesce(F.sum("most").over(Window.partitionBy("lang").orderBy(F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    begins = materialize(most.select("lang", "kind", before.alias("before")), "classes")
    rank = (F.col("before") + F.col("nth")) * parts + F.col("part") + 1
    return often.join(begins, ["lang", "kind"]).select("block", "number", "lang", *keys, "n", rank.alias("rank"))


def _known(state: DataFrame, found: DataFrame) -> DataFrame:
    """``state`` with the frequent entries of each block, which its own dictionary bounds; a block without any goes."""
    sent = found.groupBy("block").agg(F.collect_list("number").alias("of_number"), F.collect_list("rank").alias("of_rank"))
    return state.join(sent.hint("merge"), "block")


def _start(blocks: DataFrame, found: DataFrame) -> DataFrame:
    """The state of single words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                stream = unpacked(r.stream, "<u4")
                of = np.zeros(max(int(r.of_number.max()), int(stream.max())) + 1, "<i8")
                of[r.of_number] = r.of_rank
                ranks = of[stream]
                places = np.flatnonzero(ranks)
                yield _state(r, places, ranks[places], None)

    joined = _known(blocks.select("block", "lang", "stream"), found)
    return materialize(joined.mapInPandas(run, _STATE), "state-1")


def _count(state: DataFrame, side: int, dense: int) -> DataFrame:
    """(block, number, lang, a, b, n): the different pairs of each block."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                a, b, n = tiled(*_pairs(r)[1:], side, dense)
                yield pd.DataFrame({"block": r.block, "number": np.arange(len(a)), "lang": r.lang, "a": a, "b": b, "n": n})

    return state.mapInPandas(run, "block long, number long, lang string, a long, b long, n long")


def _step(state: DataFrame, found: DataFrame, level: int, side: int, dense: int) -> DataFrame:
    """The state of phrases of ``level`` words; ``found`` numbers pairs as ``_count`` does."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                places, a, b = _pairs(r)
                of_a, of_b, _ = tiled(a, b, side, dense)
                of_a, of_b, rank = of_a[r.of_number], of_b[r.of_number], r.of_rank
                order = np.lexsort((of_b, of_a))
                of_a, of_b, rank = of_a[order], of_b[order], rank[order]
                # A pair as one number: the place of a among those of the block, times the width of b.
                own, wide = np.unique(of_a), int(b.max()) + 1
                at = np.minimum(np.searchsorted(own, a), len(own) - 1)
                have, ask = np.searchsorted(own, of_a) * wide + of_b, at * wide + b
                hit = np.minimum(np.searchsorted(have, ask), len(have) - 1)
                good = (own[at] == a) & (have[hit] == ask)
                yield _state(r, places[good], rank[hit[good]], b[good])

    return materialize(_known(state, found).mapInPandas(run, _STATE), f"state-{level}")


def frequent_phrases(docs: DataFrame, text_col: str, lang_col: str, longest: int, least: int, block: int, side: int, dense: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) of all phrases of 1 to ``longest`` words that come ``least`` times, and (lang, n) words of a language."""
    own = blocks(docs, text_col, lang_col, block)
    sizes = own.groupBy("lang").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda x, y: x + y)).alias("n"))
    each = own.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w"))
    each = each.select("block", (F.col("at") + 1).cast("long").alias("number"), "lang", F.col("w.words").alias("phrase"), F.col("w.counts").alias("n"))
    found = _frequent(each, ["phrase"], least, "words")
    single = materialize(found.groupBy("lang", "rank", "phrase").agg(F.max("n").alias("n")), "phrases-1")
    state, levels = _start(own, found), [single]
    for level in range(2, longest + 1):
        found = _frequent(_count(state, side, dense), ["a", "b"], least, f"pairs-{level}")
        different = found.groupBy("lang", "a", "b", "rank").agg(F.max("n").alias("n"))
        head = levels[-1].select("lang", F.col("rank").alias("a"), F.col("phrase").alias("head"))
        tail = single.select("lang", F.col("rank").alias("b"), F.col("phrase").alias("tail"))
        named = different.join(head, ["lang", "a"]).join(tail, ["lang", "b"])
        levels.append(materialize(named.select("lang", "rank", F.concat_ws(" ", "head", "tail").alias("phrase"), "n"), f"phrases-{level}"))
        if level < longest:
            state = _step(state, found, level, side, dense)
    known = levels[0].select("lang", "phrase", "n")
    for phrases in levels[1:]:
        known = known.unionAll(phrases.select("lang", "phrase", "n"))
    return known, materialize(sizes, "sizes")


def _salted(df: DataFrame) -> DataFrame:
    """``df`` once for each salt."""
    return df.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, least: int = LEAST, best: int = BEST,
    block: int = BLOCK, side: int = SIDE, dense: int = DENSE,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to ``longest`` words of each language."""
    known, sizes = frequent_phrases(docs, text_col, lang_col, longest, least, block, side, dense)
    wordwise = F.split("phrase", " ")
    size = F.size(wordwise)

    def part(start: int | Column, length: Column) -> Column:
        return F.array_join(F.slice(wordwise, start, length), " ")

    # What a longer phrase that comes as often holds, goes.
    wider = known.where(size > 2).select("lang", "n", F.explode(F.array(part(1, size - 1), part(2, size - 1))).alias("phrase"))
    wider = wider.groupBy("lang", "phrase").agg(F.max("n").alias("wider"))
    left = known.where(size > 1).join(wider, ["lang", "phrase"], "left").where(F.coalesce(F.col("wider") < F.col("n"), F.lit(True)))
    cuts = left.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", part(1, F.col("k")).alias("first"), part(F.col("k") + 1, size).alias("rest"))
    cuts = cuts.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    parts = _salted(known)
    cuts = cuts.join(parts.select("lang", "salt", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "salt", "first"])
    cuts = cuts.join(parts.select("lang", "salt", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "salt", "rest"])
    cuts = cuts.join(_salted(sizes), ["lang", "salt"])
    score = F.expr("(cast(1000 as decimal(4, 0)) * (cast(a as decimal(16, 0)) * cast(n as decimal(16, 0)))) div (cast(l as decimal(16, 0)) * cast(r as decimal(16, 0)))")
    cuts = cuts.withColumn("score", score)
    scored = cuts.groupBy("lang", "phrase", "a", "n", "salt").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = scored.select("lang", "salt", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    for keys in (["lang", "salt"], ["lang"]):
        scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= best)
    return scored.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


OP11_SQL = f"""
WITH p AS (
  SELECT lang, piece, w FROM (
    SELECT lang, piece, list_filter(string_split_regex(words, '[ \\t]+'), lambda x: x <> '') AS w FROM (
      SELECT lang, row_number() OVER () AS piece, words FROM (
        SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang,
               unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS words
        FROM documents)))
  WHERE len(w) > 0
), g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, {LONGEST + 1}) AS t(k) WHERE len(w) >= k)
), f AS (
  SELECT lang, phrase, k, count(*) AS n FROM g GROUP BY ALL HAVING count(*) >= {LEAST}
), sizes AS (
  SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang
), inside AS (
  SELECT DISTINCT lang, array_to_string(string_split(phrase, ' ')[i:i + j - 1], ' ') AS phrase, n
  FROM (SELECT *, unnest(range(1, k - j + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS j FROM f WHERE k > 2))
), kept AS (
  SELECT * FROM f WHERE k > 1 AND NOT EXISTS (SELECT 1 FROM inside WHERE inside.lang = f.lang AND inside.phrase = f.phrase AND 100 * inside.n >= 100 * f.n)
), cuts AS (
  SELECT lang, phrase, n AS a, j, array_to_string(string_split(phrase, ' ')[1:j], ' ') AS first, array_to_string(string_split(phrase, ' ')[j + 1:k], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS j FROM kept)
), scored AS (
  SELECT cuts.lang, cuts.phrase, a, x.n AS l, y.n AS r, sizes.n AS n, j, (1000::HUGEINT * a * sizes.n) // (x.n::HUGEINT * y.n) AS score
  FROM cuts JOIN f AS x ON x.lang = cuts.lang AND x.phrase = first JOIN f AS y ON y.lang = cuts.lang AND y.phrase = rest JOIN sizes ON sizes.lang = cuts.lang
), one AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l,
       r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM one QUALIFY rank <= {BEST}
"""
