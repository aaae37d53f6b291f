"""Operator 4: secret scans by one combined deterministic automaton.

All rules are compiled into one minimised transition array and every byte of a text is looked at once, whatever the
number of rules. Where a run of possible ends stops, a small automaton of that rule, read backwards and bounded by the
rule's span before, gives the leftmost start: so spans are leftmost and do not overlap, for each kind. A later end that the
span before reaches too makes it longer, as the last line of a key does; the rule's own automaton, kept at the span's end,
tells so by the bytes in between alone, so a key of any number of escaped line ends takes time in proportion to its length.
A match that fails a kind's length still uses up its characters.

Rows: every input row gives one output row, repeated and tied rows too; a null text is an empty one and has no spans;
an empty table gives an empty table. Only the id and text columns are read (``redact`` keeps all columns as they are
and changes the text only), so other columns and their names do not matter. Nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .automaton import Automaton
from .common import column, documents, small_batches

# Kinds of the contract, then the kinds added here (prefixes that public services document).
RULES = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=\-]+""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}",
    "github": r"gh[opsu]_[A-Za-z0-9]+",
    "slack": r"xox[abprs]-[A-Za-z0-9]+",
    "google": r"AIza[A-Za-z0-9_\-]+",
    # The header, what an encrypted key says of itself, base64 lines (line ends may be written as \n), and the last line.
    "private_key": r"-----BEGIN ([A-Z]+ ){0,2}PRIVATE KEY-----"
    r"((\x0D?\x0A|\\n)Proc-Type: 4,ENCRYPTED(\x0D?\x0A|\\n)DEK-Info: [A-Z0-9\-]+,[A-Fa-f0-9]+)?"
    r"([A-Za-z0-9+/=\x0D\x0A]|\\[nr])*(-----END ([A-Z]+ ){0,2}PRIVATE KEY-----)?",
}
#: Least characters of a whole match. Shorter ones are dropped, but use up their characters.
LEAST = {"access": 20, "github": 40, "slack": 15, "google": 39}
BASE = ("assign", "access", "hex")
#: The value of an assignment, for its length; matched against a span that the automaton found.
_VALUE = re.compile(rb"""[A-Za-z_]+["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""")
LEAST_VALUE = 6


class Scanner:
    def __init__(self, rules: dict[str, str]) -> None:
        self.kinds = list(rules)
        self.all = Automaton(list(rules.values()))
        self.back = [Automaton([r], anywhere=False, backwards=True) for r in rules.values()]
        self.on = [Automaton([r], anywhere=False) for r in rules.values()]

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """(start, end, kind) in code points, ordered; kind is the rule's place in the list."""
        if not text:
            return []
        data, out = text.encode(), []
        held: list[tuple[int, int] | None] = [None] * len(self.kinds)  # the last span of each kind; it may still grow
        state, seen = [0] * len(self.kinds), [0] * len(self.kinds)  # of its rule from the span's start, up to which place

        def leave(k: int) -> None:
            start, end = held[k]
            if end - start >= LEAST.get(self.kinds[k], 0) and (self.kinds[k] != "assign" or len(_VALUE.fullmatch(data, start, end)[1]) >= LEAST_VALUE):
                out.append((start, end, k))

        for end, fell in self.all.ends(data):
            for k in range(len(self.kinds)):
                if not fell >> k & 1:
                    continue
                if held[k]:
                    state[k] = self.on[k].after(data, seen[k], end, state[k])
                    seen[k] = end
                    if state[k] >= self.on[k].accepting:  # the span goes on after bytes that end nothing
                        held[k] = held[k][0], end
                        continue
                start = self.back[k].furthest(data, end, held[k][1] if held[k] else 0)
                if start is not None:
                    if held[k]:
                        leave(k)
                    held[k], seen[k] = (start, end), end
                    state[k] = self.on[k].after(data, start, end, self.on[k].start)
        for k in range(len(self.kinds)):
            if held[k]:
                leave(k)
        if out and len(data) != len(text):
            out = [(len(data[:a].decode()), len(data[:b].decode()), k) for a, b, k in out]
        return sorted(out, key=lambda x: (x[0], x[2]))

    def redacted(self, text: str, mark: str = "[secret]") -> str:
        parts, at = [], 0
        for start, end, _ in self.spans(text):
            if start >= at:
                parts += [text[at:start], mark]
            at = max(at, end)
        return "".join([*parts, text[at:]])


_SCANNERS: dict[tuple, Scanner] = {}


def scanner(rules: dict[str, str]) -> Scanner:
    """Compiled once in a Python worker."""
    key = tuple(rules.items())
    if key not in _SCANNERS:
        _SCANNERS[key] = Scanner(rules)
    return _SCANNERS[key]


def scan(docs: DataFrame, rules: dict[str, str] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans): spans are an array of (start, end, rank, kind), ordered by start, then rank of the kind."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        s = scanner(rules)
        for batch in batches:
            found = [[{"start": a, "end": b, "rank": k, "kind": s.kinds[k]} for a, b, k in s.spans(t)] if isinstance(t, str) else [] for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "spans": found})

    small_batches(docs.sparkSession)
    source = docs.select(column(docs, id_col).cast("long").alias("doc_id"), column(docs, text_col).cast("string").alias("text"))
    return source.mapInPandas(run, "doc_id long, spans array<struct<start:int,end:int,rank:int,kind:string>>")


def redact(docs: DataFrame, rules: dict[str, str] = RULES, text_col: str = "text") -> DataFrame:
    """The same rows and columns; every secret in the text is replaced by a mark. A null text stays null."""

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        s = scanner(rules)
        for batch in batches:
            yield pd.Series([s.redacted(t) if isinstance(t, str) else None for t in batch], dtype=object)

    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    small_batches(docs.sparkSession)
    clean = F.pandas_udf(run, "string")(column(docs, text_col).cast("string"))
    return docs.select(*[clean.alias(c) if c == text_col else column(docs, c) for c in docs.columns])


def written(spans: Column) -> Column:
    """kind:start:end of an array of spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(documents(spark, sf_dir))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *map(count, BASE), F.sha2(F.encode(written(base), "UTF-8"), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))
