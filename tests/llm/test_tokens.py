import hashlib
import math
import random
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from planeforge.llm import bpe_trie, packing, token_counts, token_files, words

from .cases import SCHEMA, rows

WORDS, BYTES = words.public_path("word_bpe_49k.json"), words.public_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(x):
    return tuple((v is not None, v) for v in x)


def library(path, text):
    return words.load(path).encode(text or "", add_special_tokens=False).ids


def test_chunks_together_are_the_whole_encoding():
    rng = random.Random(4)
    texts = ["".join(rng.choice("ab É'.,!<|>\n\t 0😀 ") for _ in range(60)) for _ in range(300)]
    texts += ["'s't're'Ve'll " * 20 + "ſ's İ'S", " " * 5000, "a" * 5000, " \t\n" * 2000 + "x", "a<|endoftext|> b", "\x1c\x85\u2028\ufeff日本😀ﬁ" * 30, "\x00\x7f\xad" * 9]
    for path, kind in ((WORDS, words.Encoder), (BYTES, words.ByteEncoder)):
        enc, lib = kind(path), words.load(path)
        for t in texts:
            assert enc.ids(t).tolist() == lib.encode(t, add_special_tokens=False).ids, t


def test_memory_is_bounded():
    m = words.Memory(lambda k: -k, 10)
    assert [m[k] for k in range(100)] == [-k for k in range(100)]
    assert len(m) <= 10 and len(m.old) <= 10


def test_trie_encodes_and_decodes_like_the_library(docs, empty):
    lib = words.load(WORDS)
    got = bpe_trie.decode(bpe_trie.encode(docs, WORDS), WORDS).collect()
    want = []
    for r in rows():
        ids = lib.encode(r[1] or "", add_special_tokens=False).ids
        want.append((r[0], len(ids), np.array(ids, "<u4").tobytes(), lib.decode(ids, skip_special_tokens=False)))
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert bpe_trie.decode(bpe_trie.encode(empty, WORDS), WORDS).count() == 0


def test_trie_shares_prefixes_and_agrees_with_plain_merging():
    v = bpe_trie.Vocabulary(WORDS)
    rng = random.Random(9)
    some = {"".join(rng.choice("thenio") for _ in range(rng.randint(1, 14))) for _ in range(3000)}
    got = v.encode(some)
    for w in some:
        assert np.frombuffer(got[w], "<u2").tolist() == [v.ids[t] for t in v.merged(v.symbols(w + v.end))]


def test_codes_give_any_token():
    rng = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 513, 3000):
        for top in (200, 50_000, 1 << 32):
            a = rng.integers(0, top, n, dtype=np.uint64).astype("<u4")
            c = token_files.Codes.read(token_files.Codes.of(a).to_bytes())
            assert len(c) == n and (c.take(np.arange(n)) == a).all()
            for _ in range(10 if n else 0):
                places = rng.integers(0, n, 30)
                i, j = sorted(rng.integers(0, n + 1, 2))
                assert (c.take(places) == a[places]).all() and (c.part(i, j) == a[i:j]).all()
    with pytest.raises(ValueError):
        token_files.Codes.read(b"something else")


def test_token_files_round_trip(spark, docs, empty, tmp_path):
    token_files.write(docs, BYTES, f"{tmp_path}/f")
    got = sorted(token_files.read(spark, f"{tmp_path}/f").collect(), key=lambda r: r.start)
    # Ascending ids, nulls first; ties may come in any order of their texts.
    assert [r.doc_id for r in got] == [None, None, *sorted(r[0] for r in rows() if r[0] is not None)]
    by_id = {}
    for r in rows():
        ids = np.array([*library(BYTES, r[1]), 2], "<u4")
        by_id.setdefault(r[0], []).append((len(ids), zlib.crc32(ids.tobytes())))
    at = 0
    for r in got:
        assert r.start == at and (r.n_tokens, r.ids_crc32) in by_id[r.doc_id]
        at += r.n_tokens
    every = np.concatenate([np.array([*library(BYTES, x[1]), 2]) for x in sorted(rows(), key=lambda x: x[0] or -1) if x[0] is not None])
    first = sum(r.n_tokens for r in got[:2])
    places = [first, first + 5, first + len(every) - 1, first + len(every) // 2]
    found = {r.place: r.id for r in token_files.token_at(spark, f"{tmp_path}/f", spark.createDataFrame([(p,) for p in places], "place long")).collect()}
    assert found == {p: every[p - first] for p in places}
    token_files.write(empty, BYTES, f"{tmp_path}/e")
    assert token_files.read(spark, f"{tmp_path}/e").count() == 0


def test_packing_is_whole_and_gapless(docs, empty):
    pieces = packing.cut(docs, WORDS, 64)
    got = packing.pack(pieces.withColumn("base", F.lit(1)), 64).toPandas()
    want = Counter()
    for r in rows():
        ids = [*library(WORDS, r[1]), 0]
        for k in range(0, len(ids), 64):
            part = np.array(ids[k : k + 64], "<u4")
            want[r[0], k // 64, k, len(part), zlib.crc32(part.tobytes())] += 1
    ids = [None if x != x else int(x) for x in got.doc_id.astype(float)]
    assert Counter(zip(ids, got.piece, got.start, got.length, got.ids_crc32, strict=True)) == want
    got = got.sort_values(["sequence_id", "offset"])
    groups = got.groupby("sequence_id").length
    assert (got.offset == groups.cumsum() - got.length).all() and groups.sum().max() <= 64
    assert groups.ngroups <= 1.02 * math.ceil(got.length.sum() / 64) + 1
    assert packing.pack(packing.cut(empty, WORDS)).count() == 0


def fewest(items, capacity):
    best = [len(items)]
    items = sorted(items, reverse=True)

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for k, room in enumerate(rooms):
            if room >= items[i] and room not in rooms[:k]:
                go(i + 1, [*rooms[:k], room - items[i], *rooms[k + 1 :]])
        go(i + 1, [*rooms, capacity - items[i]])

    go(0, [])
    return best[0]


def test_dominance_reduction_keeps_the_optimum():
    rng = random.Random(2)
    for _ in range(400):
        capacity = rng.choice([10, 12, 15, 20, 30])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 8))]
        instance = packing.Instance(Counter(items), capacity)
        instance.reduce()
        rest = [length for length, n in enumerate(instance.counts) for _ in range(n)]
        assert sum(n for _, n in instance.fixed) + fewest(rest, capacity) == fewest(items, capacity), items
        plan = packing.plan(Counter(items), capacity)
        held = Counter()
        for pattern, n in plan:
            assert sum(x * k for x, k in pattern) <= capacity
            for x, k in pattern:
                held[x] += k * n
        assert held == Counter(items)


def test_token_counts_of_sections(docs, empty):
    lib = words.load(BYTES)
    got = Counter(map(tuple, token_counts.attribute(token_counts.line_sections(docs), BYTES).collect()))
    want = Counter()
    for r in rows():
        if not r[1]:
            continue
        sections, at = [], 0
        for line in r[1].split("\n"):
            sections += [(at + k, at + min(k + token_counts.LONGEST, len(line))) for k in range(0, len(line), token_counts.LONGEST)]
            at += len(line) + 1
        n, crossing = Counter(), Counter()
        for a, b in lib.encode(r[1], add_special_tokens=False).offsets:
            b = max(b, a + 1)
            shares = [max(0, min(b, e) - max(a, s)) for s, e in sections]
            to = shares.index(max(shares)) if any(shares) else -1
            n[to] += 1
            crossing[to] += sum(x > 0 for x in shares) > 1
        for i, (s, e) in enumerate(sections):
            want[r[0], i, s, e, n[i], crossing[i]] += 1
        if n[-1]:
            want[r[0], -1, -1, -1, n[-1], 0] += 1
    assert got == want
    assert token_counts.attribute(token_counts.line_sections(empty), BYTES).count() == 0


def test_digests_of_the_queries(spark, tmp_path):
    spark.createDataFrame(rows(), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in bpe_trie.op5_bpe_trie(spark, str(tmp_path)).collect()}
    ids = np.array(library(WORDS, rows()[0][1]), "<u4")
    assert got[0].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest() and got[0].n_tokens == len(ids)
    assert {c: t for c, t in packing.op2_best_fit_packing(spark, str(tmp_path)).dtypes} == {
        "doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint",
    }


def test_long_words_and_other_white_space_go_through_the_trie():
    path = words.public_path("word_bpe_49k.json")
    library, own = words.load(path), bpe_trie.TrieEncoder(path)
    own.tokenizer = SimpleNamespace(normalizer=library.normalizer, pre_tokenizer=library.pre_tokenizer)  # cannot encode
    letters = "".join(chr(97 + k * k % 7919 % 26) for k in range(60_000))
    texts = [letters, "a\tb\r\nc<|endoftext|>d e<|startoftext|><|endoftext|>\u3000x\n\n", "don't\tI'LL\u00a012.5", "\t", "<|endoftext|", "   x"]
    tracemalloc.start()
    found = [np.frombuffer(x, "<u2").tolist() for x in own.packed(texts)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert peak < 200 << 20  # all prefixes with their ids would take about 2 GB
