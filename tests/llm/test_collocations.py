import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from planeforge.llm import collocations

from .cases import SCHEMA, rows


def plain(table, longest, least, best):
    counts, sizes, out = defaultdict(Counter), Counter(), []
    for lang, text in table:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for lang, f in counts.items():
        often = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        hidden = {q[i:j] for q, n in often.items() for i in range(len(q)) for j in range(i + 1, len(q) + 1) if j - i < len(q) and 100 * n >= 100 * f[q[i:j]]}
        scored = []
        for p, a in often.items():
            if p not in hidden:
                score, k = min((1000 * a * sizes[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for at, (score, a, phrase, left, right) in enumerate(sorted(scored)[:best]):
            out.append((lang, at + 1, phrase.decode(), -a, left, right, sizes[lang], -score))
    return Counter(out)


def texts(seed=1):
    rng = random.Random(seed)
    words = ["The", "of", "and", "new", "york", "City", "café", "x", "İ", "\x1cq", "日本", "a" * 300]
    out = []
    for _ in range(150):
        out.append((rng.choice(["en", "en", "en", "de", None, "und"]), "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".\n", "\x0b"]) for _ in range(rng.randint(0, 60)))))
    return out + [("en", "new york city of")] * 30 + [("de", "only here\nonly here " * 40), ("fr", ", . \t ;"), ("fr", None)] + [(r[2], r[1]) for r in rows()]


@pytest.mark.parametrize(("block", "side", "dense", "size"), [(1 << 23, 1024, 1 << 15, 1 << 20), (400, 2, 2, 3), (3000, 3, 1, 50)])
def test_collocations_against_a_plain_version(spark, block, side, dense, size, monkeypatch):
    monkeypatch.setattr(collocations, "SLICE", size)
    table = texts()
    docs = spark.createDataFrame([(t, g, "x", 1, "y", "z", "v") for g, t in table], "text string, lang string, block string, n int, phrase string, rank string, salt string").repartition(3)
    got = collocations.collocations(docs, least=4, best=25, block=block, side=side, dense=dense).collect()
    assert Counter(tuple(r) for r in got) == plain(table, 5, 4, 25)


def test_a_key_may_fill_whole_batches(spark):
    table = texts(7)
    docs = spark.createDataFrame([(t, g) for g, t in table], "text string, lang string").repartition(3)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    try:
        got = collocations.collocations(docs, least=4, best=25, block=60).collect()
    finally:
        spark.conf.set(name, before)
    assert Counter(tuple(r) for r in got) == plain(table, 5, 4, 25)


def test_nothing_is_frequent_and_an_empty_table(spark):
    docs = spark.createDataFrame(rows(n=20), SCHEMA)
    assert collocations.collocations(docs, least=10**6).count() == 0
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_tiles_count_pairs_both_ways():
    rng = np.random.default_rng(2)
    for side, dense in ((4, 1), (4, 30), (4, 10**9), (1024, 50)):
        a, b = rng.zipf(1.4, 4000) % 5000, rng.zipf(1.3, 4000) % 7000
        got = {(x, y): n for x, y, n in zip(*(v.tolist() for v in collocations.tiled(a, b, side, dense)), strict=True)}
        assert got == Counter(zip(a.tolist(), b.tolist(), strict=True))


def test_a_long_text_is_cut_into_slices():
    text = "ab cd\tef. " * 50_000 + "z" * 100_000
    one, other = collocations._Open(), collocations._Open()
    one.add(text, 1 << 30)
    other.add(text, 1000)
    assert np.array_equal(np.concatenate(one.parts), np.concatenate(other.parts))


def test_exact_scores_beyond_64_bits(spark):
    words = "a b " * 3
    docs = spark.createDataFrame([("en", words)], "lang string, text string")
    (row,) = [r for r in collocations.collocations(docs, least=3, longest=2).collect() if r.phrase == "a b"]
    assert (row.a, row.l, row.r, row.n, row.score) == (3, 3, 3, 6, 2000)
