"""Near-duplicates by five-word similarity: min-hash bands find candidates, exact Jaccard on the shingles decides.

A text is the set of its five-word shingles (lower case, ASCII white space). Of each set ``BANDS`` x ``ROWS`` min-hashes
are taken; two sets of similarity 0.8 agree on a whole band of four with probability 0.41, so on one of 16 bands with
0.9998. Bands are joined by equality; a fingerprint of 64 bits would need a radius of about 16 bits for the same pairs,
and pieces short enough for that are shared by texts that have nothing in common.

Equal sets are one entry. Keys with the same members are compared once. Sets of a key of over ``CROWD`` sets, such as texts
of one form letter, are indexed by their rarest shingles: in any one order of the shingles, two sets of similarity 0.8 share
one of the first few of each, and how few follows from their sizes (about a ninth of a set, where sizes are equal). So a
link among texts that are nearly similar anyway is found by what only those two have, and not by chance. Crowded keys are
also dealt to random parts of about ``CROWD`` sets, which links a family whose members are all similar. Where more than
``CROWD`` sets share a rare shingle too, all pairs of sets that are not linked by then are measured, in blocks: a task
holds two blocks, so such a key needs many tasks and no task much memory. All pairs of a part are measured exactly, by
products of their membership tables over ranges of shingles. Linked sets leave a task as a forest.

With ``bits``, sets whose SimHash fingerprints (operator 7) are linked within so many bits, found by that operator's deletion
variants, come together too, and the exact measure follows as for all others.

Texts are never shuffled: what is asked for or kept is a bit a row, joined to the rows where they lie.

Rows: texts without words, null ones included, are equal, and so are repeated rows. Of each component the row of least id
stays (nulls last; of equal ids one row). An empty table stays empty. Columns are returned as they are, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .common import column, free_name, least_over, materialize, small_batches, width
from .simhash import _forest, fingerprint
from .simhash import links as near_fingerprints

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 16, 4
CROWD = 256
#: Ratio of the sizes of one size class, and numbers that a task looks up at once when it measures pairs.
STEP = 1.05
RANGE = 1 << 20
#: Parts up to this many sets are measured pair by pair.
FEW = 8
#: Equal min-hashes of 64 below which such a pair is not measured: at similarity 0.8 that is four deviations down.
LEAST_EQUAL = 38
_RNG = np.random.default_rng(5)
_TIMES = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)


def shingles_of(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; a shorter text is one shingle."""
    import xxhash

    own = text.encode().lower().split() if text else []
    if not own:
        return np.zeros(0, "<u8")
    runs = zip(*(own[k:] for k in range(shingle)), strict=False) if len(own) > shingle else [own]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(b" ".join(r)) for r in runs), "<u8"))


def sketch_of(text: str | None) -> tuple[int, list[int], bytes]:
    """(name of the set, keys of its bands, one byte of each min-hash)."""
    import xxhash

    own = shingles_of(text)
    if not len(own):
        return 0, [], b""
    least = np.full(len(_TIMES), np.iinfo(np.uint64).max, "<u8")
    for part in range(0, len(own), 4096):
        least = np.minimum(least, (own[None, part : part + 4096] * _TIMES[:, None] + _PLUS[:, None]).min(1))
    keys = [xxhash.xxh64_intdigest(least[k * ROWS : (k + 1) * ROWS].tobytes(), k) for k in range(BANDS)]
    name = xxhash.xxh64_intdigest(own.tobytes(), 1)
    signed = np.array([name, *keys], "<u8").view("<i8").tolist()
    return signed[0], signed[1:], (least & np.uint64(255)).astype(np.uint8).tobytes()


def sketch(text: Column) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words.forget()
        for batch in batches:
            yield pd.DataFrame([sketch_of(t if isinstance(t, str) else None) for t in batch], columns=["name", "keys", "sig"])

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(run, "name long, keys array<long>, sig binary")(text)


def _sets(text: Column) -> Column:
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([np.sort(shingles_of(t if isinstance(t, str) else None).view("<i8")) for t in batch], dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, "array<long>")(text)


def _common(own: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two of the sorted sets share."""
    shared = np.zeros((len(own), len(own)), np.float64)
    ranges = 1 + sum(map(len, own)) // RANGE
    edges = np.array([-(1 << 63) + ((1 << 64) * k) // ranges for k in range(1, ranges)], np.int64)
    cuts = [np.concatenate([[0], np.searchsorted(x, edges), [len(x)]]) for x in own]
    for k in range(ranges):
        part = [x[c[k] : c[k + 1]] for x, c in zip(own, cuts, strict=True)]
        _, column, times = np.unique(np.concatenate(part), return_inverse=True, return_counts=True)
        number = np.cumsum(times > 1) - 1  # of the shingles that several sets hold
        row = np.repeat(np.arange(len(own)), [len(x) for x in part])
        several = times[column] > 1
        row, column = row[several], number[column[several]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for low in range(0, int(number[-1]) + 1 if len(number) else 0, 4096):
            a, b = np.searchsorted(column, [low, low + 4096])
            table = np.zeros((len(own), 4096), np.float32)
            table[row[a:b], column[a:b] - low] = 1
            shared += table @ table.T
    return shared


def _linked(names: np.ndarray, sigs: list[bytes], own: list[np.ndarray], similar: float) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the pairs of one part whose sets are similar."""
    if len(names) > FEW:
        both, sizes = _common(own), np.array([len(x) for x in own])
        i, j = np.nonzero(np.triu(both >= similar * (sizes[:, None] + sizes - both), 1))
        a, b = names[i], names[j]
    else:
        sig = np.frombuffer(b"".join(sigs), np.uint8).reshape(len(names), -1)
        pairs = []
        for i in range(len(names) - 1):
            for j in i + 1 + np.flatnonzero((sig[i + 1 :] == sig[i]).sum(1) >= LEAST_EQUAL):
                both = len(np.intersect1d(own[i], own[j], assume_unique=True))
                if both >= similar * (len(own[i]) + len(own[j]) - both):
                    pairs.append((names[i], names[j]))
        a, b = np.array(pairs, np.int64).reshape(-1, 2).T
    return _forest(a, b) if len(a) else (a, b)


def _compare(parts: DataFrame, similar: float) -> DataFrame:
    """Links among rows (key, name, sig, own) of equal key."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words.forget()
        rest = None

        def found(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
            for _, g in rows.groupby("key", sort=False):
                a, b = _linked(g["name"].to_numpy(np.int64), list(g["sig"]), [np.asarray(x, np.int64) for x in g["own"]], similar)
                if len(a):
                    yield pd.DataFrame({"a": a, "b": b})

        for batch in batches:
            if len(batch):
                rows = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
                last = rows["key"] == rows["key"].iloc[-1]  # the last key may go on
                yield from found(rows[~last])
                rest = rows[last]
        if rest is not None:
            yield from found(rest)

    dealt = parts.repartition(width(parts.sparkSession), "key").sortWithinPartitions("key")
    return dealt.select("key", "name", "sig", "own").mapInPandas(run, "a long, b long")


def _sized(rows: DataFrame) -> DataFrame:
    """Rows (key, name, ...) of the keys that two sets share, with n; keys of the same members once."""
    mark = [F.count("*").alias("n"), F.bit_xor(F.xxhash64("name")).alias("x"), F.sum(F.xxhash64("name", F.lit(1)).cast("decimal(20,0)")).alias("y")]
    sizes = rows.groupBy("key").agg(*mark).where("n > 1").groupBy("n", "x", "y").agg(F.min("key").alias("key")).select("key", "n")
    return materialize(rows.join(materialize(sizes, "shared-bands").hint("merge"), "key"), "shared-sets")


def _dealt(keyed: DataFrame, crowd: int) -> DataFrame:
    """(key, name): crowded keys of rows (key, name, n) dealt to random parts."""
    salt = F.pmod(F.xxhash64("name", "key"), F.ceil(F.col("n") / crowd))
    return keyed.select(F.when(F.col("n") > crowd, F.xxhash64("key", salt)).otherwise(F.col("key")).alias("key"), "name")


def rare_keys(sets: DataFrame, similar: float) -> DataFrame:
    """(key, name): two of ``sets(name, own)`` that are similar have a key in common.

    With sizes x and y they share at least ``similar / (1 + similar) * (x + y)`` shingles. Of each, all but that many,
    and one more, come first in the order of frequency, so these have one in common. A key is such a shingle and two
    classes of sizes, as the number of shingles depends on the other set's least size.
    """
    each = sets.select("name", F.size("own").alias("size"), F.explode("own").alias("shingle"))
    often = each.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    shared = each.join(often.hint("merge"), "shingle").groupBy("name", "size").agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("shared"))
    reach = math.ceil(-math.log(similar) / math.log(STEP)) + 1
    own = F.floor(F.log("size") / math.log(STEP)).cast("int")
    rows = shared.select("name", "size", "shared", own.alias("own"), F.explode(F.sequence(F.lit(-reach), F.lit(reach))).alias("d"))
    other = F.greatest(F.floor(F.pow(F.lit(STEP), F.col("own") + F.col("d"))), F.ceil(F.col("size") * similar - 1e-9), F.lit(1))
    first = F.col("size") - F.ceil((F.col("size") + other) * (similar / (1 + similar)) - 1e-9) + 1
    # Shingles that no other set holds come first and need no key.
    n = F.greatest(first - (F.col("size") - F.size("shared")), F.lit(0)).cast("int")
    rows = rows.select("name", "own", "d", F.explode(F.slice("shared", 1, n)).alias("s"))
    classes = F.least("own", F.col("own") + F.col("d")), F.greatest("own", F.col("own") + F.col("d"))
    return rows.select(F.xxhash64("s.shingle", *classes).alias("key"), "name")


def _picked(marked: DataFrame, row: str, rows: DataFrame) -> DataFrame:
    """The rows of ``marked`` whose number ``row`` is in ``rows(row)``: words of 64 bits are sent along, a bit a row of the table."""
    bits = rows.groupBy(F.expr("shiftright(row, 6)").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(row & 63 as int))")).alias("bits"))
    word, held = free_name(marked, "word"), free_name(marked, "bits")
    bits = materialize(bits, "picked-rows").select(F.col("word").alias(word), F.col("bits").alias(held))
    own = column(marked, row)
    found = marked.join(F.broadcast(bits), F.shiftright(own, 6) == F.col(word)).where(F.expr(f"(shiftrightunsigned({held}, cast({row} & 63 as int)) & 1) = 1"))
    return found.select(*[column(found, c) for c in marked.columns])


def open_pairs(keyed: DataFrame, roots: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(key, name): parts that bring together every two sets of a key of ``keyed(key, name)`` that ``roots(node, root)`` does not link.

    The sets of a key are cut into blocks of about ``crowd``. A block holds one component, or many small ones; two blocks of
    the same component do not meet.
    """
    rooted = keyed.select("key", "name").join(roots.hint("merge"), F.col("name") == F.col("node"), "left")
    rooted = materialize(rooted.select("key", "name", F.coalesce("root", "name").alias("root")), "crowded-sets")
    sizes = rooted.groupBy("key", "root").agg(F.count("*").alias("m")).withColumn("large", F.col("m") * 2 > crowd)
    whole = sizes.groupBy("key").agg(F.count("*").alias("roots"), F.sum(F.when(~F.col("large"), F.col("m"))).alias("small")).where("roots > 1")
    cuts = F.ceil(F.when(F.col("large"), F.col("m")).otherwise(F.col("small")) / crowd)
    sizes = sizes.join(whole.hint("merge"), "key").select("key", "root", F.when(F.col("large"), F.col("root")).alias("one"), cuts.alias("cuts"))
    sizes = materialize(sizes, "crowded-roots")

    def block(nth: Column) -> Column:
        return F.xxhash64("key", F.col("one").isNull(), F.coalesce("one", F.lit(0)), nth).alias("block")

    nth = F.pmod(F.when(F.col("one").isNull(), F.xxhash64("root")).otherwise(F.xxhash64("name")), F.col("cuts"))
    held = rooted.join(sizes.hint("merge"), ["key", "root"]).select(block(nth), "name")
    cut = sizes.select("key", "one", "cuts").distinct()
    blocks = cut.select("key", "one", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cuts") - 1)).alias("nth"))
    blocks = materialize(blocks.select("key", "one", block(F.col("nth"))), "crowded-blocks")
    other = blocks.select("key", F.col("one").alias("one2"), F.col("block").alias("block2"))
    met = blocks.join(other.hint("merge"), "key").where("block <= block2 and (one is null or one2 is null or one <> one2)")
    met = met.select(F.xxhash64("block", "block2").alias("key"), F.explode(F.array_distinct(F.array("block", "block2"))).alias("block"))
    return met.join(held.hint("merge"), "block").select("key", "name")


def similar_components(first: DataFrame, sets: DataFrame, similar: float = SIMILAR, crowd: int = CROWD) -> DataFrame:
    """(node, root) of the sets that are linked: similar ones that share a key of ``first(key, name, n)``, of ``sets(name, row, sig, own)``."""
    spark = sets.sparkSession

    def links(parts: DataFrame) -> DataFrame:
        return materialize(_compare(materialize(parts, "parts").join(sets.hint("merge"), "name"), similar).distinct(), "links")

    hot = sets.select("name", "row").join(first.where(F.col("n") > crowd).select("name").distinct().hint("merge"), "name")
    rare = _sized(rare_keys(_picked(sets.select("name", "row", "own"), "row", hot), similar))
    found = links(_dealt(first, crowd).unionAll(_dealt(rare, crowd)))
    roots = least_over(found, spark, "components")
    crowded = rare.where(F.col("n") > crowd)
    if crowded.isEmpty():
        return roots
    return least_over(found.unionAll(links(open_pairs(crowded, roots, crowd))), spark, "components")


def fingerprint_groups(own: DataFrame, bits: int) -> DataFrame:
    """(key, name, n): the sets of ``own(name, fp)`` whose SimHash fingerprints are linked within ``bits`` bits, groups of any size."""
    spark = own.sparkSession
    fps = materialize(own.select("fp").distinct(), "fingerprints")
    roots = least_over(near_fingerprints(fps, bits), spark, "fingerprint-groups").select(F.col("node").alias("fp"), "root")
    named = own.select("fp", "name").join(roots.hint("merge"), "fp", "left")
    return _sized(named.select(F.xxhash64(F.lit("simhash"), F.coalesce("root", "fp")).alias("key"), "name"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR, crowd: int = CROWD, bits: int | None = None) -> DataFrame:
    """The rows of ``docs`` without near-duplicates, with all their columns as they are."""
    spark = docs.sparkSession
    small_batches(spark)
    s, fp, row = free_name(docs, "sketch"), free_name(docs, "fp"), free_name(docs, "row")
    text = column(docs, text_col).cast("string")
    made = {s: sketch(text), fp: fingerprint(text) if bits is not None else F.lit(0).cast("long")}
    marked = materialize(docs.withColumns(made).withColumn(row, F.monotonically_increasing_id()), "marked")
    narrow = marked.select(column(marked, id_col).cast("long").alias("doc_id"), F.col(row).alias("row"), F.col(s).alias("s"), F.col(fp).alias("fp"))
    # The least row of each set first, so that copies meet in partial aggregates; rows differ, so what follows is never compared.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "fp", F.col("s")["keys"].alias("keys")))
    own = narrow.groupBy(F.col("s")["name"].alias("name")).agg(least.alias("f"))
    own = materialize(own.select("name", F.struct("f.none", "f.doc_id", "f.row").alias("first"), "f.fp", "f.keys"), "own-sets")
    first = _sized(own.select("name", F.explode("keys").alias("key"))).select("key", "name", "n")
    if bits is not None:
        first = first.unionAll(fingerprint_groups(own, bits).select("key", "name", "n"))
    asked = own.join(first.select("name").distinct().hint("merge"), "name").select(F.col("first")["row"].alias("row"))
    texts = _picked(marked.select(s, row, column(marked, text_col).cast("string").alias(free_name(marked, "text_"))), row, asked)
    sets = texts.select(F.col(s)["name"].alias("name"), F.col(row).alias("row"), F.col(s)["sig"].alias("sig"), _sets(F.col(free_name(marked, "text_"))).alias("own"))
    sets = materialize(sets, "sets")
    roots = similar_components(first, sets, similar, crowd)
    named = own.join(roots.hint("merge"), own["name"] == roots["node"], "left").select(F.coalesce("root", "name").alias("root"), "first")
    kept = named.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first")["row"].alias("row"))
    out = _picked(marked, row, kept)
    return out.select(*[column(out, c) for c in docs.columns])
