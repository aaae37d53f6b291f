import functools
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from planeforge.llm import common, cotraining, neighbours, packing, quality_rules, secrets, simhash, words

from .cases import SCHEMA, prose, rows
from .test_scans import plain_spans


def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps):
    """The least id reachable from each, by comparing all pairs."""
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    array = np.array(fps, np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(array[:i] ^ array[i]) <= 3):
            root[find(i)] = find(int(j))
    least = {}
    for i, name in enumerate(ids):
        if name is not None:
            least[find(i)] = min(name, least.get(find(i), name))
    return [least.get(find(i)) for i in range(len(fps))]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def test_components_of_a_small_table(spark, docs):
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.group(docs).collect())
    fps = [plain_fingerprint(r[1]) for r in rows()]
    names = plain_components([r[0] for r in rows()], fps)
    assert got == Counter((r[0], f"{f:016x}", c) for r, f, c in zip(rows(), fps, names, strict=True))
    assert simhash.group(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("crowd", [2048, 4])
def test_no_link_is_lost_in_crowds(spark, crowd, monkeypatch):
    """Chains and balls around one fingerprint, once with every level of shorter pieces in use."""
    rng = random.Random(crowd)
    base = rng.getrandbits(64)
    fps = [base]
    while len(fps) < 300:
        x = rng.choice(fps) if rng.random() < 0.8 else base ^ rng.getrandbits(64)
        for _ in range(rng.choice([1, 2, 3, 3, 4, 5])):
            x ^= 1 << rng.randrange(64)
        fps.append(x)
    monkeypatch.setattr(simhash, "links", functools.partial(simhash.links, crowd=crowd))
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame(list(enumerate(signed)), "doc_id long, fp long")
    got = {r.fp: r.component_id for r in simhash.components(df, "doc_id", "fp").collect()}
    want = plain_components(range(len(fps)), fps)
    assert all(got[s] == w for s, w in zip(signed, want, strict=True))


def test_components_of_a_long_path(spark):
    n = 300
    edges = spark.createDataFrame([(i * 7919 % n, (i + 1) * 7919 % n) for i in range(n - 1)], "a long, b long")
    assert {(r.node, r.root) for r in common.least_over(edges, spark, "path").collect()} == {(i, 0) for i in range(1, n)}


def test_one_document_of_each_group_stays(docs):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    names = plain_components([r[0] for r in rows()], [plain_fingerprint(r[1]) for r in rows()])
    # Nulls name no component here: every component of the table has an id.
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(names))


def exact(vectors, ids, query, k):
    far = np.sqrt(((vectors - vectors[query]) ** 2).sum(1))
    other = np.flatnonzero(ids != ids[query])
    order = other[np.lexsort((ids[other], far[other]))][:k]
    return list(zip(ids[order].tolist(), far[order].tolist(), strict=True))


def test_neighbours_recall_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(3)
    v = rng.standard_normal((1500, 20)).astype(np.float32).astype(float)
    v[40:100] = v[0]  # many equal ones
    table = [(int(i), [float(x) for x in row], "clash") for i, row in enumerate(v)]
    odd = [(5000, None), (5100, []), (5200, [0.0] * 20), (5300, [float("nan")] * 20), (5400, [None, *[1.0] * 19]), (5500, [float("inf")] * 20), (5600, [1.0] * 3), (None, [1.0] * 20)]
    df = spark.createDataFrame(table + [(*x, "clash") for x in odd], "vec_id long, embedding array<double>, score string")
    got = neighbours.search(df, "vec_id % 100 = 0").collect()
    ids = np.arange(1500)
    found = hits = 0
    for q in range(0, 1500, 100):
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, 11))
        assert [(r.score, r.vec_id) for r in own] == sorted((r.score, r.vec_id) for r in own)
        want = exact(v, ids, q, 10)
        for r in own:
            assert r.score == np.sqrt(((v[r.vec_id] - v[q]) ** 2).sum())
        found += len(want)
        hits += len({r.vec_id for r in own} & {w for w, _ in want})
        if q == 0:
            assert [r.vec_id for r in own] == list(range(40, 50))
    assert {r.query_id for r in got} == set(range(0, 1500, 100)) and hits >= 0.9 * found


def test_neighbours_of_few_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert neighbours.search(spark.createDataFrame([], schema), "vec_id % 100 = 0").count() == 0
    few = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(0, 400, 100)], schema)
    got = sorted(map(tuple, neighbours.search(few, "vec_id % 100 = 0").collect()))
    assert [(q, k, v) for q, k, v, _ in got][:3] == [(0, 1, 100), (0, 2, 200), (0, 3, 300)] and len(got) == 12


def labelled(n=500):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choice("abcdefghilmnoprst") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    out = []
    for i in range(n):
        text = prose(rng, rng.randint(30, 120), vocabulary)
        good = rng.random() < 0.7
        if not good:
            text = rng.choice([text.upper().replace(" ", "!! "), text.replace(" ", "*** "), " ".join(w for w in text.split() for _ in range(6))])
        out.append((i, text, "en", f"src{i % 5}", len(text), good))
    return out


def test_co_training_on_held_out_documents(spark):
    data = labelled()
    docs = spark.createDataFrame([r[:5] for r in data], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(r[0], int(r[5])) for r in data if r[0] % 2] + [(None, 1), (1, None), (99_999, 0)], "doc_id long, quality int")
    got = cotraining.classify(docs, labels).collect()
    unseen = [(r.kept, data[r.doc_id][5]) for r in got if r.doc_id % 2 == 0]
    assert len(got) == len(data) and np.mean([k == g for k, g in unseen]) >= 0.97
    assert np.mean([k for k, g in unseen if g]) >= 0.98
    assert all(0 <= s <= 1 for r in got for s in (r.text_score, r.meta_score, r.score))
    again = {r.doc_id: r.score for r in cotraining.classify(docs.repartition(5), labels).collect()}
    assert max(abs(again[r.doc_id] - r.score) for r in got) < 1e-9


def test_co_training_without_labels_and_with_odd_rows(spark, docs):
    one = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    assert {r.score for r in cotraining.classify(docs, one).collect()} == {1.0}
    both = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    got = cotraining.classify(docs, both)
    assert got.count() == len(rows()) and got.where("score is null").count() == 0
    assert cotraining.keep_good(docs, both).columns == docs.columns
    nothing = spark.createDataFrame([], SCHEMA)
    assert cotraining.classify(nothing, both).count() == 0


def plain_offers(rows, handed, seen=None):
    """The offers of unlabelled ``rows(row, doc_id, text slots and weights, meta slots and weights)``, by sorting them all."""

    def offers(views, taken):
        odds = {r[0]: (views[0].odds(*r[2]), views[1].odds(*r[3])) for r in rows}
        same = {}
        for r in sorted(rows, key=lambda r: (r[1], r[0])):
            same.setdefault(tuple(round(x, 9) for x in odds[r[0]]), []).append(r)
        out = []
        for receiver in (0, 1):
            for label, sign in ((1.0, 1), (0.0, -1)):
                free = [g[0] for g in same.values() if not any(r[0] in taken[receiver] for r in g)]
                sure = [(sign * odds[r[0]][1 - receiver], r) for r in free]
                sure = sorted((x for x in sure if x[0] >= math.log(cotraining.SURE / (1 - cotraining.SURE))), key=lambda x: (-round(x[0], 9), x[1][1]))
                out += [cotraining.Offer(r[0], receiver, label, r[2], r[3]) for _, r in sure[:handed]]
        if seen is not None:
            seen.append([(o.row, o.receiver, o.label) for o in out])
        return out

    return offers


def test_all_unlabelled_documents_are_searched_like_a_plain_version(spark, monkeypatch):
    """Documents handed over in each round, and the weights, against co-training in one process; a third are copies."""
    data = labelled(300)
    data += [(300 + i, *data[7][1:]) for i in range(150)]
    docs = spark.createDataFrame([r[:5] for r in data], "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    marks = {r[0]: float(r[5]) for r in data if r[0] % 3 == 0 and r[0] < 300}
    labels = spark.createDataFrame([(k, int(v)) for k, v in marks.items()], "doc_id long, quality int")
    table = cotraining.features(docs)
    rows_of = {r.row: r.doc_id for r in table.collect()}
    seen, wanted, searcher = [], [], cotraining.searcher

    def watched(*args):
        search = searcher(*args)

        def offers(views, taken):
            found = search(views, taken)
            seen.append([(rows_of[o.row], o.receiver, o.label) for o in found])
            return found

        return offers

    monkeypatch.setattr(cotraining, "searcher", watched)
    model = cotraining.train(table, labels, handed=20)
    rows = {r[0]: (cotraining.text_features(r[1]), cotraining.meta_features(r[1], r[2], r[3], float(r[4]))) for r in data}
    views = [cotraining.Sparse([rows[i][k][0] for i in marks], [rows[i][k][1] for i in marks]) for k in (0, 1)]
    held = np.array([zlib.crc32(str(i).encode()) % 10 < 3 for i in marks])
    pool = [(i, i, *v) for i, v in rows.items() if i not in marks]
    want = cotraining.co_train(*views, np.array(list(marks.values())), held, offers=plain_offers(pool, 20, wanted))
    assert [sorted(x) for x in seen] == [sorted(x) for x in wanted] and len(wanted) == cotraining.ROUNDS
    for receiver in (0, 1):
        got = [x[0] for turn in wanted for x in turn if x[1] == receiver]
        assert len(got) == len(set(got)) > 40  # no document is offered twice
        assert len([i for i in got if data[i][1] == data[7][1]]) <= 1  # copies go once
    assert np.abs(model.text.weights - want.text.weights).max() < 1e-6 and np.abs(model.joint - want.joint).max() < 1e-6


def test_views_teach_each_other():
    """A view with few own labels improves by what the other hands over."""
    rng = np.random.default_rng(5)
    n, y = 600, rng.integers(0, 2, 600).astype(float)

    def view(noise):
        return cotraining.Sparse([np.array([int(v if rng.random() > noise else 1 - v), 2 + int(rng.integers(50))]) for v in y], [np.array([0.9, 0.3])] * n)

    strong, weak = view(0.0), view(0.1)
    own = [cotraining.Sparse(v.slots[:40], v.weights[:40]) for v in (strong, weak)]
    pool = [(i, i, (strong.slots[i], strong.weights[i]), (weak.slots[i], weak.weights[i])) for i in range(40, n)]
    held = np.arange(40) % 2 == 0
    right = []
    for rounds in (0, 3):
        model = cotraining.co_train(*own, y[:40], held, rounds, plain_offers(pool, 28))
        p = np.array([model.scores((strong.slots[i], strong.weights[i]), (weak.slots[i], weak.weights[i])) for i in range(n)])
        right.append(((p > 0.5) == (y[:, None] > 0.5)).mean(0))
    assert right[1][1] >= right[0][1] and right[1][1] >= 0.88  # the weak view cannot pass 0.9
    assert right[1][2] >= 0.93
    assert cotraining.co_train(*own, np.ones(40), held) is None


def test_pipeline_against_a_plain_version(spark, tmp_path):
    data = [r[:5] for r in rows(n=120) if r[0] is not None] + [(1000 + r[0], *r[1:5]) for r in labelled(200)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(data, schema).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1000 + r[0], int(r[5])) for r in labelled(200)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    folder = str(tmp_path)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = common.materialize(stage(spark, docs, folder), name)
        stages[name] = docs
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    for name in list(stages)[:-1]:
        assert stages[name].schema.names == documents.columns

    def content(df):
        return Counter(tuple(r) for r in df.collect())

    # Rules: the rows whose verdict is true; ids that repeat have equal texts here, so ids tell rows apart.
    kept = {r.doc_id for r in quality_rules.rules(documents).where("kept").collect()}
    assert content(stages["quality_rules"]) == content(documents.where(F.col("doc_id").isin(list(kept))))
    # Classifier: rejects what it scores low, keeps the good ones it was shown.
    left, before = content(stages["quality_classifier"]), content(stages["quality_rules"])
    assert left <= before
    good = {1000 + r[0] for r in labelled(200) if r[5]} & {r[0] for r in before}
    assert len(good & {r[0] for r in left}) >= 0.98 * len(good)
    # Near copies: one of each component of all pairs.
    table = list(left.elements())
    names = similar_components([r[1] for r in table], [r[0] for r in table])
    assert sorted(r.doc_id for r in stages["simhash_near_dedup"].collect()) == sorted(names)
    # Secrets: all rows stay, none holds a secret, other texts are as they were.
    texts = {r.doc_id: r.text for r in stages["secret_scans"].collect()}
    for r in stages["simhash_near_dedup"].collect():
        scanner = secrets.scanner(secrets.RULES)
        assert texts[r.doc_id] == (scanner.redacted(r.text) if plain_spans(r.text) else r.text)
    # Packing: every token of every document once.
    lib = words.load(words.public_path("word_bpe_49k.json"))
    packed = stages["best_fit_packing"].toPandas()
    assert packed.groupby("doc_id").length.sum().to_dict() == {i: len(lib.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts.items()}
    assert packed.groupby("sequence_id").length.sum().max() <= packing.CAPACITY
    run = corpus_pipeline.run(spark, folder).toPandas()
    assert Counter(zip(run.doc_id, run.piece, run.ids_crc32, strict=True)) == Counter(zip(packed.doc_id, packed.piece, packed.ids_crc32, strict=True))


def similar_components(texts, ids):
    """The least id reachable over five-word similarities of at least 0.8, by comparing all pairs."""
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) > 5 else {tuple(w)})
    root = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if root[i] != root[j] and len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                root = [root[j] if x == root[i] else x for x in root]
    return {min(i for i, r in zip(ids, root, strict=True) if r == x) for x in root}


@pytest.mark.parametrize("crowd", [256, 8])
def test_pipeline_stage_drops_copies_of_a_few_edits(spark, crowd):
    from planeforge.llm import near_copies

    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(2000)]
    texts = [None, "", " ", "a b", "A  b", "a b c"]
    for n in (40, 80, 150, 400):
        for _ in range(6):
            base = [rng.choice(vocabulary) for _ in range(n)]
            texts.append(" ".join(base))
            for edits in (1, 2, 4):
                some = list(base)
                for at in rng.sample(range(n), edits):
                    some[at] = rng.choice(vocabulary)
                texts.append(" ".join(some))
    hub = [rng.choice(vocabulary) for _ in range(200)]
    for i in range(60):  # one large group
        texts.append(" ".join([*hub[:i], "new", *hub[i + 1 :]]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = near_copies.keep_one(docs, crowd=crowd)
    assert kept.columns == docs.columns
    want = similar_components(texts, range(len(texts)))
    got = [r.doc_id for r in kept.collect()]
    assert sorted(got) == sorted(want)
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()) == sorted(want)


def test_close_pairs_among_texts_of_one_form_letter(spark):
    """Pairs of similarity just above 0.8 in a family whose other pairs lie just below; keys are crowded at 8."""
    from planeforge.llm import near_copies

    rng = random.Random(11)
    letter = [f"l{i}" for i in range(160)]
    texts = []
    for i in range(340):
        own = [f"o{i}_{k}" for k in range(20)]
        texts.append(letter + own)
        if i % 6 == 0:  # a partner that shares some of what is its own
            texts.append(letter + own[:4] + [f"p{i}_{k}" for k in range(16)])
    texts = [" ".join(t) for t in texts]
    rng.shuffle(texts)
    want = similar_components(texts, range(len(texts)))
    assert len(texts) - len(want) >= 55
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = [r.doc_id for r in near_copies.keep_one(docs, crowd=8).collect()]
    assert sorted(got) == sorted(want)


def test_near_copies_of_odd_rows(spark, docs):
    from planeforge.llm import near_copies

    assert near_copies.keep_one(spark.createDataFrame([], SCHEMA)).collect() == []
    kept = near_copies.keep_one(docs)
    assert kept.columns == docs.columns
    table = rows()
    found = [r.text for r in kept.collect()]
    assert len(found) == len(similar_components([r[1] for r in table], range(len(table))))
    assert sum(not (t or "").strip() for t in found) == 1  # texts without words are equal


def test_shared_shingles_are_counted_over_ranges(monkeypatch):
    from planeforge.llm import near_copies

    rng = np.random.default_rng(3)
    pool = rng.integers(-(1 << 63), (1 << 63) - 1, 900)
    own = [np.unique(rng.choice(pool, n)) for n in (0, 1, 5, 400, 800, 800, 300, 2, 40, 600)]
    want = [[len(np.intersect1d(a, b)) for b in own] for a in own]
    for size in (1 << 20, 100):
        monkeypatch.setattr(near_copies, "RANGE", size)
        got = near_copies._common(own)
        apart = ~np.eye(len(own), dtype=bool)
        assert (got[apart] == np.array(want)[apart]).all()


def test_a_repeated_query_row_keeps_its_ten_neighbours(spark):
    rng = np.random.default_rng(4)
    v = rng.standard_normal((300, 12))
    table = [(i, [float(x) for x in row]) for i, row in enumerate(v)]
    other = (200, [float(x) for x in rng.standard_normal(12)])
    df = spark.createDataFrame([*table, table[100], table[100], other], "vec_id long, embedding array<double>").repartition(3)
    got = Counter((r.query_id, r["rank"]) for r in neighbours.search(df, "vec_id % 100 = 0").collect())
    assert got == Counter({(q, k): 1 + (q == 200) for q in (0, 100, 200) for k in range(1, 11)})
    own = {r.vec_id for r in neighbours.search(df, "vec_id = 100").collect()}
    assert len(own) == 10
