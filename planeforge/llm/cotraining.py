"""Operator 1: quality classifier by co-training of a text-content view and a page-metadata view.

Two logistic classifiers look at parts of a document that hardly depend on each other: the text view at its words
(hashed) and their shapes, the metadata view at language, source, length and layout. Each round, each view scores all
unlabelled documents, and of those that the other view has not got yet the ``HANDED`` it is surest of go to the other
view's training set, for each label; how sure it is, is calibrated on held-out labelled documents. After the rounds both views are calibrated on labelled documents they never saw,
and a small logistic model of the two calibrated log-odds gives the score, which is worked out for every document.

The labelled rows to fit on are a bounded sample by a hash of doc_id, ``LABELLED`` (three in ten of them held out for
calibration). Unlabelled documents are not sampled: the hashed features of all documents are written once, every round
sends the weights, arrays of fixed size, to the tasks, and only the rows handed over come to the driver, as features.
Documents of equal scores in both views, such as copies, are handed over once, whatever their number; of equally sure
ones the smaller doc_id goes first.

Rows: every input row gets a score, repeated and tied rows the same; a null text is an empty one, null language, source
and n_chars are values of their own; an empty table gives an empty table. Of several labels of a doc_id the largest
quality counts; labels without doc_id or quality are left out. Of labelled rows of one doc_id that of least features
is learned from; rows without doc_id are scored, but not learned from. Without documents of both labels there is nothing to
learn: every score is 1. Only the named columns are read; ``keep_good`` keeps all columns as they are.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, documents, free_name, materialize, small_batches
from .words import Memory

LABELLED = 3000
ROUNDS = 3
#: Documents that a view hands over for each label and round at most, and how sure it must be.
HANDED = 150
SURE = 0.95
#: Documents below this score are rejected.
THRESHOLD = 0.2
TEXT_SIZE = 1 << 16
META_SIZE = 1 << 12

_LETTERS, _DIGITS = re.compile(r"[^\W\d_]+"), re.compile(r"\d+")


_CAPITALS = bytes(range(65, 91))
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def _slot(name: str, size: int) -> int:
    return zlib.crc32(name.encode()) % size


def shape(word: str) -> str:
    """Runs of capitals, other letters and digits as one sign each; marks as they are."""
    return _DIGITS.sub("9", _LETTERS.sub(lambda m: "X" if len(m[0]) > 1 and m[0].isupper() else "Xx" if m[0][0].isupper() else "x", word))[:12]


class Sparse(NamedTuple):
    """Rows of feature slots with weights; each row's squares add up to one."""

    slots: list[np.ndarray]
    weights: list[np.ndarray]


def _word_slots(word: str) -> bytes:
    return np.array([_slot("w" + word.lower()[:40], TEXT_SIZE), _slot("s" + shape(word), TEXT_SIZE)], "<u4").tobytes()


_WORDS = Memory(_word_slots, 200_000)


def text_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots of words, shapes and repeated neighbours with their counts."""
    words = text.split()
    if not words:
        return np.array([_slot("empty", TEXT_SIZE)]), np.ones(1, np.int64)
    slots = np.frombuffer(b"".join(map(_WORDS.__getitem__, words)), "<u4")
    again = sum(map(str.__eq__, words, words[1:]))
    slots, counts = np.unique(np.append(slots, _slot(f"again{round(10 * again / len(words))}", TEXT_SIZE)), return_counts=True)
    counts[slots == _slot(f"again{round(10 * again / len(words))}", TEXT_SIZE)] += len(words) // 4
    return slots.astype(np.int64), counts


def text_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the text view with the square roots of their shares."""
    slots, counts = text_counts(text)
    return slots, np.sqrt(counts / counts.sum())


def meta_features(text: str, lang: str | None, source: str | None, n_chars: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Slots of language, source, and steps of length and layout."""
    n = max(1, len(text))
    lines = text.split("\n")
    data = text.encode()
    # ASCII capitals, digits and marks are counted by leaving them out.
    upper = len(data) - len(data.translate(None, _CAPITALS))
    digits = len(data) - len(data.translate(None, b"0123456789"))
    marks = len(data) - len(data.translate(None, _MARKS))
    step = lambda x: round(4 * math.log2(1 + x))
    names = [
        f"lang {lang}", f"source {source}", f"chars {None if n_chars is None or n_chars != n_chars else step(n_chars) // 4}", f"lines {step(len(lines)) // 2}",
        f"line {step(n / len(lines)) // 4}", f"upper {round(20 * upper / n)}", f"marks {round(25 * marks / n)}",
        f"digits {step(100 * digits / n)}", f"double {round(10 * (1 - len(set(lines)) / len(lines)))}", f"bytes {round(20 * (len(data) / n - 1))}",
    ]
    return np.array([_slot(x, META_SIZE) for x in names]), np.full(len(names), len(names) ** -0.5)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class View:
    """Logistic regression on sparse rows, fitted by adaptive gradient steps over all rows at once."""

    def __init__(self, size: int) -> None:
        self.weights, self.bias = np.zeros(size), 0.0

    def fit(self, rows: Sparse, labels: np.ndarray, picked: np.ndarray, steps: int = 80, rate: float = 0.7, decay: float = 1e-2) -> None:
        sizes = np.array([len(rows.slots[i]) for i in picked])
        slots, values = np.concatenate([rows.slots[i] for i in picked]), np.concatenate([rows.weights[i] for i in picked])
        of, y = np.repeat(np.arange(len(picked)), sizes), labels[picked]
        # Both labels weigh the same.
        share = np.where(y > 0.5, 0.5 / max(1, (y > 0.5).sum()), 0.5 / max(1, (y <= 0.5).sum()))
        w, b = np.zeros(len(self.weights)), 0.0
        sum_w, sum_b = np.full(len(w), 1e-8), 1e-8
        for _ in range(steps):
            p = _sigmoid(np.bincount(of, values * w[slots], len(picked)) + b)
            g = (p - y) * share
            gw, gb = np.bincount(slots, values * g[of], len(w)) + decay * w / len(picked), g.sum()
            sum_w, sum_b = sum_w + gw * gw, sum_b + gb * gb
            w, b = w - rate * gw / np.sqrt(sum_w), b - rate * gb / math.sqrt(sum_b)
        self.weights, self.bias = w, b

    def odds(self, slots: np.ndarray, values: np.ndarray) -> float:
        return float(self.weights[slots] @ values + self.bias)

    def scaled(self, scale: np.ndarray) -> View:
        """The view whose odds are these times ``scale[0]`` plus ``scale[1]``."""
        out = View(0)
        out.weights, out.bias = self.weights * scale[0], self.bias * scale[0] + scale[1]
        return out

    def all_odds(self, rows: Sparse) -> np.ndarray:
        return np.array([self.odds(s, v) for s, v in zip(rows.slots, rows.weights, strict=True)])


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Weights of a small logistic model by Newton steps, slightly shrunk; the last column of ``x`` is one."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = _sigmoid(x @ w)
        w = w - np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (p - y) + 0.1 * w)
    return w


class Model(NamedTuple):
    text: View
    meta: View
    text_scale: np.ndarray
    meta_scale: np.ndarray
    joint: np.ndarray

    def scores(self, text: tuple, meta: tuple) -> tuple[float, float, float]:
        """Calibrated text and metadata scores, and the joint one."""
        return tuple(self.calibrated(np.array([self.text.odds(*text)]), np.array([self.meta.odds(*meta)]))[0].tolist())

    def calibrated(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        """The same three scores of many rows, from their log-odds."""
        t, m = text * self.text_scale[0] + self.text_scale[1], meta * self.meta_scale[0] + self.meta_scale[1]
        return _sigmoid(np.column_stack([t, m, t * self.joint[0] + m * self.joint[1] + self.joint[2]]))


class Offer(NamedTuple):
    """A document that view ``receiver`` (0: text, 1: metadata) gets with a label."""

    row: int
    receiver: int
    label: float
    text: tuple[np.ndarray, np.ndarray]
    meta: tuple[np.ndarray, np.ndarray]


#: The surest documents by the two views, for each receiver and label, without those of the rows already handed to it.
Offers = Callable[[tuple[View, View], tuple[set[int], set[int]]], list[Offer]]


def co_train(text: Sparse, meta: Sparse, labels: np.ndarray, held: np.ndarray, rounds: int = ROUNDS, offers: Offers | None = None) -> Model | None:
    """``labels`` are 0 or 1; rows of ``held`` are for calibration only; ``offers`` searches the unlabelled documents.

    None without both labels.
    """
    fit = ~held
    if len(np.unique(labels[fit])) < 2 or len(np.unique(labels[held])) < 2:
        return None
    views = (View(TEXT_SIZE), View(META_SIZE))
    own = [(Sparse([x.slots[i] for i in np.flatnonzero(fit)], [x.weights[i] for i in np.flatnonzero(fit)]), labels[fit].tolist()) for x in (text, meta)]
    taken: tuple[set[int], set[int]] = (set(), set())
    h = np.flatnonzero(held)
    kept = [Sparse([x.slots[i] for i in h], [x.weights[i] for i in h]) for x in (text, meta)]
    # Platt's targets: few held-out documents can show little sureness.
    many = (labels[h] > 0.5).sum(), (labels[h] <= 0.5).sum()
    goal = np.where(labels[h] > 0.5, (many[0] + 1) / (many[0] + 2), 1 / (many[1] + 2))
    for turn in range(rounds + 1):
        for view, (x, y) in zip(views, own, strict=True):
            view.fit(x, np.array(y), np.arange(len(y)))
        odds = [view.all_odds(x) for view, x in zip(views, kept, strict=True)]
        scales = [_logistic(np.column_stack([o, np.ones(len(h))]), goal) for o in odds]
        if turn == rounds or offers is None:
            break
        # A view is as sure as held-out documents show it to be, not as it thinks.
        for offer in offers(tuple(view.scaled(s) for view, s in zip(views, scales, strict=True)), taken):
            x, y = own[offer.receiver]
            slots, weights = (offer.text, offer.meta)[offer.receiver]
            x.slots.append(slots)
            x.weights.append(weights)
            y.append(offer.label)
            taken[offer.receiver].add(offer.row)
    calibrated = [np.column_stack([o, np.ones(len(h))]) @ s for o, s in zip(odds, scales, strict=True)]
    return Model(*views, *scales, _logistic(np.column_stack([*calibrated, np.ones(len(h))]), labels[h]))


COLUMNS = {k: k for k in ("doc_id", "text", "lang", "source", "n_chars")}


def features(docs: DataFrame, columns: dict[str, str] = COLUMNS) -> DataFrame:
    """(row, doc_id, ts, tc, ms) of every row, written: slots and counts of the text view, slots of the metadata view."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                text = r.text if isinstance(r.text, str) else ""
                slots, counts = text_counts(text)
                out.append((r.row, r.doc_id, slots.astype("<u2").tobytes(), counts.astype("<u4").tobytes(), meta_features(text, r.lang, r.source, r.n_chars)[0].astype("<u2").tobytes()))
            yield pd.DataFrame(out, columns=["row", "doc_id", "ts", "tc", "ms"]).astype({"doc_id": "Int64"})

    small_batches(docs.sparkSession)
    kinds = (("doc_id", "long"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "double"))
    plain = docs.select(F.monotonically_increasing_id().alias("row"), *[column(docs, columns[k]).cast(t).alias(k) for k, t in kinds])
    return materialize(plain.mapInPandas(run, "row long, doc_id long, ts binary, tc binary, ms binary"), "features")


def _unpacked(ts: bytes, tc: bytes, ms: bytes) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Slots and weights of the text view and of the metadata view."""
    counts, meta = np.frombuffer(tc, "<u4"), np.frombuffer(ms, "<u2").astype(np.int64)
    return (np.frombuffer(ts, "<u2").astype(np.int64), np.sqrt(counts / counts.sum())), (meta, np.full(len(meta), len(meta) ** -0.5))


def _both_odds(views: tuple[View, View], batch: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Log-odds of every row of a batch of features by both views."""
    n = len(batch)
    sizes = [np.fromiter(map(len, batch[c]), np.int64, n) // 2 for c in ("ts", "ms")]
    ts, ms = (np.frombuffer(b"".join(batch[c]), "<u2") for c in ("ts", "ms"))
    of, of_meta = (np.repeat(np.arange(n), x) for x in sizes)
    counts = np.frombuffer(b"".join(batch["tc"]), "<u4").astype(float)
    total = np.bincount(of, counts, n)
    text = np.bincount(of, np.sqrt(counts / total[of]) * views[0].weights[ts], n) + views[0].bias
    meta = np.bincount(of_meta, views[1].weights[ms], n) / np.sqrt(sizes[1]) + views[1].bias
    return text, meta


def searcher(table: DataFrame, marks: DataFrame, handed: int = HANDED, sure: float = SURE) -> Offers:
    """Offers from all documents of the ``features`` in ``table`` that have no mark."""
    spark = table.sparkSession
    least = math.log(sure / (1 - sure))

    def offers(views: tuple[View, View], taken: tuple[set[int], set[int]]) -> list[Offer]:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                if len(batch):
                    text, meta = _both_odds(views, batch)
                    yield pd.DataFrame({"row": batch["row"], "doc_id": batch["doc_id"], "odds0": text, "odds1": meta})

        scores = table.where("doc_id is not null").mapInPandas(run, "row long, doc_id long, odds0 double, odds1 double")
        scores = scores.join(marks.select("doc_id"), "doc_id", "left_anti")
        # Rows handed over so far: at most 4 * ``handed`` a round.
        had = [(row, row in taken[0], row in taken[1]) for row in sorted(taken[0] | taken[1])]
        scores = scores.join(F.broadcast(spark.createDataFrame(had, "row long, had0 boolean, had1 boolean")), "row", "left")
        marked = [F.max(F.coalesce(F.col(f"had{k}"), F.lit(False))).alias(f"had{k}") for k in (0, 1)]
        each = materialize(scores.groupBy("odds0", "odds1").agg(F.min(F.struct("doc_id", "row")).alias("first"), *marked), "pool-scores")
        best = None
        for receiver in (0, 1):
            odds = F.col(f"odds{1 - receiver}")
            for label, own in ((1.0, odds), (0.0, -odds)):
                top = each.where(~F.col(f"had{receiver}") & (own >= least)).orderBy(own.desc(), "first").limit(handed)
                top = top.select(F.col("first.row").alias("row"), F.lit(receiver).alias("receiver"), F.lit(label).alias("label"), own.alias("own"), F.col("first.doc_id").alias("of"))
                best = top if best is None else best.unionAll(top)
        got = table.join(F.broadcast(best), "row").select("row", "receiver", "label", "own", "of", "ts", "tc", "ms").collect()
        got.sort(key=lambda r: (r.receiver, -r.label, -r.own, r.of))
        return [Offer(r.row, r.receiver, r.label, *_unpacked(r.ts, r.tc, r.ms)) for r in got]

    return offers


def train(table: DataFrame, labels: DataFrame, labelled: int = LABELLED, handed: int = HANDED) -> Model | None:
    """Fits on a bounded sample of the labelled documents of the ``features`` in ``table``, and on what all others offer."""
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("double").alias("label"))
    marks = marks.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    ids = table.select("doc_id").where("doc_id is not null").distinct()
    some = marks.join(ids, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    some = materialize(some, "sample")  # at most ``labelled`` rows
    got = table.join(F.broadcast(some), "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct("ts", "tc", "ms")).alias("f"))
    got = got.select("doc_id", "label", "f.*").toPandas().sort_values("doc_id")
    if not len(got):
        return None
    held = np.array([zlib.crc32(str(i).encode()) % 10 < 3 for i in got["doc_id"]])
    rows = [_unpacked(*map(bytes, r)) for r in zip(got["ts"], got["tc"], got["ms"], strict=True)]
    views = [Sparse([r[k][0] for r in rows], [r[k][1] for r in rows]) for k in (0, 1)]
    return co_train(*views, got["label"].to_numpy(float), held, offers=searcher(table, marks, handed))


def scored(model: Model | None, text: Column, lang: Column, source: Column, n_chars: Column) -> Column:
    """A struct of text_score, meta_score and score."""

    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for t, *rest in zip(*batch, strict=True):
                t = t if isinstance(t, str) else ""
                out.append(model.scores(text_features(t), meta_features(t, *rest)) if model else (1.0, 1.0, 1.0))
            yield pd.DataFrame(out, columns=["text_score", "meta_score", "score"])

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, ...]], "return": Iterator[pd.DataFrame]}
    kinds = zip((text, lang, source, n_chars), ("string", "string", "string", "double"), strict=True)
    return F.pandas_udf(run, "text_score double, meta_score double, score double")(*[c.cast(t) for c, t in kinds])


def classify(docs: DataFrame, labels: DataFrame, columns: dict[str, str] = COLUMNS) -> DataFrame:
    """(doc_id, text_score, meta_score, score, kept) of every row."""
    table = features(docs, columns)
    model = train(table, labels)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n = len(batch)
            out = model.calibrated(*_both_odds((model.text, model.meta), batch)) if model and n else np.ones((n, 3))
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "text_score": out[:, 0], "meta_score": out[:, 1], "score": out[:, 2]})

    out = table.select("doc_id", "ts", "tc", "ms").mapInPandas(run, "doc_id long, text_score double, meta_score double, score double")
    return out.withColumn("kept", F.col("score") >= THRESHOLD)


def keep_good(docs: DataFrame, labels: DataFrame, columns: dict[str, str] = COLUMNS, known: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns. ``known``: other documents to learn from, if ``docs`` are

    what an earlier filter left of them and hold hardly a bad one.
    """
    s = free_name(docs, "score")
    model = train(features(docs if known is None else known, columns), labels)
    out = docs.withColumn(s, scored(model, *[column(docs, columns[k]) for k in ("text", "lang", "source", "n_chars")]))
    return out.where(F.col(s)["score"] >= THRESHOLD).select(*[column(out, c) for c in docs.columns])


def op1_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
