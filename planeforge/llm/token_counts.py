"""Operator 8: token counts of sections by offset-mapped attribution.

A whole document is encoded once; every token keeps the span of code points it stands for (as the tokenizer reports
them: a leading space is not part of the span). The spans are interval-joined with the sections, both in order, so the
join is two binary searches for each token. A token that lies in one section is counted there. The rule for the rest:
  * a token that crosses a boundary goes to the section that holds most of its characters, the earlier one of equals;
  * a token that meets no section (line ends, mostly) is counted to section -1, "outside".
So the counts of a document's sections add up to its tokens.

Sections are an array column of (section, start, end), ordered, end exclusive, without overlaps. ``line_sections``
makes them from a text: lines, and lines longer than ``LONGEST`` in windows of that many code points. Without the column
the same sections are cut where the tokens are counted, and never travel as rows between Python and the JVM.

Rows: every input row gives its own rows, repeated and tied rows too (they repeat); a null or empty text has no
sections and no rows; an empty table gives an empty table. Only the named columns are read, so other columns and
their names do not matter. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import words
from .common import column, documents, small_batches

LONGEST = 512
SCHEMA = "doc_id long, section int, start int, end int, n_tokens long, n_crossing long"


class Spans:
    """Token spans of whole texts, as code points, from the ids and the number of bytes of each token.

    A token that begins or ends within a character stands for the whole character, as the tokenizers library reports it;
    a text with a special token goes to that library.
    """

    def __init__(self, path: str) -> None:
        self.encoder = words.encoder(path, False)
        self.sizes = np.zeros(self.encoder.tokenizer.get_vocab_size(), np.int64)
        for token in self.encoder.tokenizer.get_vocab(False).values():
            self.sizes[token] = self.encoder.size(token)

    def of(self, text: str) -> np.ndarray:
        if self.encoder.has_special(text):
            return np.array(self.encoder.tokenizer.encode(text, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)
        end = np.cumsum(self.sizes[np.frombuffer(self.encoder.packed(text), "<u2")])
        start = np.r_[0, end[:-1]] if len(end) else end
        if not text.isascii():
            # Characters begun up to each byte.
            begun = np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)
            start, end = begun[start] - 1, begun[end - 1]
        return np.stack([start, end], 1)


def allot(spans: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token its section (-1: none), and whether it crosses a boundary of sections."""
    start, stop = spans[:, 0], np.maximum(spans[:, 1], spans[:, 0] + 1)
    first = np.searchsorted(end, start, "right")
    last = np.searchsorted(begin, stop, "left") - 1
    to = np.where(last >= first, first, -1)
    crossing = last > first
    for t in np.flatnonzero(crossing):
        among = np.arange(first[t], last[t] + 1)
        shared = np.minimum(end[among], stop[t]) - np.maximum(begin[among], start[t])
        to[t] = among[np.argmax(shared)]
    return to, crossing


_SPANS: dict[str, Spans] = {}


def lines(text: str) -> np.ndarray:
    """Begin and end of each section of a text: its lines, longer ones in windows of ``LONGEST`` code points."""
    sizes = np.fromiter(map(len, text.split("\n")), np.int64)
    at = np.cumsum(sizes + 1) - sizes - 1
    if len(sizes) and sizes.max() <= LONGEST:
        some = sizes > 0
        return np.stack([at[some], at[some] + sizes[some]], 1)
    windows = -(-sizes // LONGEST)
    within = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    begin = np.repeat(at, windows) + within * LONGEST
    return np.stack([begin, np.minimum(begin + LONGEST, np.repeat(at + sizes, windows))], 1)


def line_sections(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, sections) with the lines of each text as sections."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([[{"section": k, "start": a, "end": b} for k, (a, b) in enumerate(lines(t).tolist())] if isinstance(t, str) else [] for t in batch], dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    cut = F.pandas_udf(run, "array<struct<section:int,start:int,end:int>>")
    text = column(docs, text_col).cast("string")
    return docs.select(column(docs, id_col).cast("long").alias("doc_id"), text.alias("text"), cut(text).alias("sections"))


def attribute(docs: DataFrame, path: str) -> DataFrame:
    """Tokens of each section of ``docs(doc_id, text, sections)``; n_crossing: those that also reach into others.

    Without a column of sections the lines are taken, cut in the same Python worker.
    """
    given = "sections" in docs.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if path not in _SPANS:
            _SPANS[path] = Spans(path)
        spans_of = _SPANS[path].of
        for batch in batches:
            for lo in range(0, len(batch), 100):
                some, names, parts = batch.iloc[lo : lo + 100], [], []
                for name, text, sections in zip(some["doc_id"], some["text"], some["sections"] if given else [None] * len(some), strict=True):
                    if not isinstance(text, str) or not text:
                        continue
                    if given:
                        section, begin, end = (np.array([x[c] for x in (() if sections is None else sections)], np.int64) for c in ("section", "start", "end"))
                    else:
                        begin, end = lines(text).T
                        section = np.arange(len(begin))
                    to, crossing = allot(spans_of(text), begin, end)
                    n = np.bincount(to + 1, minlength=len(section) + 1)
                    crossed = np.bincount(to[crossing] + 1, minlength=len(section) + 1)
                    keep = slice(0 if n[0] else 1, None)
                    names.append(name)
                    parts.append((np.r_[-1, section][keep], np.r_[-1, begin][keep], np.r_[-1, end][keep], n[keep], crossed[keep]))
                if parts:
                    out = pd.DataFrame(dict(zip(("section", "start", "end", "n_tokens", "n_crossing"), map(np.concatenate, zip(*parts, strict=True)), strict=True)))
                    own = pd.array([None if pd.isna(n) else int(n) for n in names], "Int64")
                    out.insert(0, "doc_id", own.repeat([len(p[0]) for p in parts]))
                    yield out

    small_batches(docs.sparkSession)
    return docs.select("doc_id", "text", *(["sections"] if given else [])).mapInPandas(run, SCHEMA)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return attribute(docs, words.public_path("byte_bpe_50k.json"))
