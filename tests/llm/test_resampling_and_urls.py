import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from planeforge.llm import resampling, url_rules

from .cases import SCHEMA, rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return w, [zlib.crc32(g.encode()) % 10_000 for g in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]]


def plain_resample(table, target):
    source, goal = Counter(), Counter()
    for _, text in table:
        source.update(plain_features(text)[1])
    for text in target:
        goal.update(plain_features(text)[1])
    s, t = sum(source.values()), sum(goal.values())
    gain = [math.floor(1000 * math.log((goal[b] + 1.0) * (s + 10_000.0) / ((source[b] + 1.0) * (t + 10_000.0)))) for b in range(10_000)]
    out = []
    for key, text in table:
        w, f = plain_features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append([key, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w)])
    fit = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, -r[2], -r[1]))
    for at, r in enumerate(fit[: 25 * len(fit) // 100]):
        r[4] = at + 1
    return Counter(tuple(r[:5]) for r in out)


def test_checksums_of_all_runs_by_shift_and_by_bytes():
    rng = random.Random(3)
    for case in range(200):
        sizes = [1, 2, 63, 64, 65, 900] if case % 4 == 0 else [1, 3, 8]
        w = [bytes(rng.choice(b"abcxyz\xc3\xa9") for _ in range(rng.choice(sizes))) for _ in range(rng.randint(0, 25))]
        for longest in (1, 2, 5):
            want = [zlib.crc32(b" ".join(w[i : i + k])) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]
            assert resampling.feature_crcs(w, longest).tolist() == want


@pytest.mark.parametrize("held", [8 << 20, 1])
def test_resampling_against_a_plain_version(spark, held, monkeypatch):
    monkeypatch.setattr(resampling, "AT_ONCE", held)
    table, target = rows(n=90), [r[1] for r in rows(seed=8, n=20)]
    docs = spark.createDataFrame(table, SCHEMA).repartition(3)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    got = Counter(tuple(r) for r in resampling.resample(docs, goal).collect())
    assert got == plain_resample([r[:2] for r in table], target)


def test_resampling_of_empty_tables(spark):
    none, docs = spark.createDataFrame([], SCHEMA), spark.createDataFrame(rows(n=30), SCHEMA)
    assert resampling.resample(none, docs).count() == 0
    got = Counter(tuple(r) for r in resampling.resample(docs, none).collect())
    assert got == plain_resample([r[:2] for r in rows(n=30)], [])


def test_one_very_long_text(spark):
    words = ["of", "x" * 70_000, "ever"] * 4000
    assert len(resampling.feature_crcs([w.encode() for w in words])) == 23_999
    text = " ".join(["word", "next"] * 400_000)
    docs = spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.n_features for r in resampling.resample(docs, docs).collect()}
    assert got == {1: 1_599_999, 2: 0}


def urls(seed=1, n=400):
    rng = random.Random(seed)
    hosts = ["example.org", "www.example.org", "notexample.org", "a.example.com", "b.shop.example.com", "c.example.net", "com", "", "EXAMPLE.ORG"]
    out = []
    for i in range(n):
        host = hosts[0] if i % 3 == 0 else rng.choice(hosts)
        url = rng.choice(["http", "HTTPS"]) + "://" + host + rng.choice(["", "/", "/es/1", "/en/1x", "/en/2", "/fr/", "/de/7.html", "/de", "/es"])
        out.append((i, url + rng.choice(["", "?b=1&a=2&b=3", "?", "#top", "?q=/es/#x", "/?=1&&"])))
    extra = [None, "", "no scheme", "://", "http://", "x://example.org/es/://com/de/", "http://a\nb.example.org/en/1\n", "http://" + "a." * 5000 + "com/de/", "http://é.Example.com/FR/", "http://u@example.org:80/es/"]
    return out + [(n + i, u) for i, u in enumerate(extra)] + [(None, out[0][1]), out[1], out[1]]


def sql_of(table):
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", table)
    return con.execute(url_rules.OP13_SQL).fetchall()


@pytest.mark.parametrize("seed", [1, 2])
def test_urls_against_sql(spark, seed):
    pages = spark.createDataFrame([(*r, "x", 1.0, "y", "z", "v") for r in urls(seed)], "page_id long, url string, host string, items double, row string, verdict string, fixed string").repartition(3)
    got = Counter(tuple(r) for r in url_rules.filter_urls(pages).collect())
    assert got == Counter(sql_of(urls(seed)))
    assert sum(r[4] == "block" and r[3] is None for r in got), "mined rules block some page"


def test_fixed_rules_by_hand(spark):
    want = {
        "http://example.org/es/1": ("example.org/es/", "block"), "http://x.example.org/es/": ("example.org/es/", "block"), "http://notexample.org/es/": ("org/", "allow"),
        "http://example.org/en/19": ("example.org/en/1", "block"), "http://example.org/en/2": ("org/", "allow"), "http://org/": ("org/", "allow"),
        "https://A.COM/fr/?x": ("com/fr/", "allow"), "https://a.com/FR/": (None, "allow"), "https://a.com/de/": ("com/de/", "block"), "http://example.org?/es/": (None, "allow"),
    }
    pages = spark.createDataFrame(list(enumerate(want)), "page_id long, url string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_rules.filter_urls(pages).collect()}
    for i, (url, (rule, verdict)) in enumerate(want.items()):
        assert got[i][0] == rule, url
        assert rule is None or got[i][1] == verdict, url


def test_urls_without_labels_and_an_empty_table(spark):
    schema = "page_id long, url string"
    assert url_rules.filter_urls(spark.createDataFrame([], schema)).count() == 0
    got = url_rules.filter_urls(spark.createDataFrame([(1, None), (2, "http://a.net/x")], schema)).collect()
    assert sorted(tuple(r) for r in got) == [(1, "", "", None, "allow"), (2, "a.net", "/x", None, "allow")]


def test_rules_are_mined_pruned_and_sure(spark):
    rng = np.random.default_rng(4)
    data = [(["a=1", f"b={k}", f"c={rng.integers(3)}"], "block" if k == 2 else "allow") for k in rng.integers(0, 4, 400).tolist()]
    rules = url_rules.mine(spark.createDataFrame(data, "items array<string>, label string")).collect()
    assert {(tuple(r["items"]), r.label) for r in rules} == {(("b=2",), "block"), (("b=0",), "allow"), (("b=1",), "allow"), (("b=3",), "allow")}
    assert all(r.sure == 1.0 and r.anchor == r["items"][0] for r in rules)
