"""Crowded groups of fingerprints are compared whole."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from planeforge.llm import near_copies


def family(pairs=24, shared=150):
    """Sets of one form letter; sets 2k and 2k + 1 are just similar, all others just not."""
    g = np.random.default_rng(5)
    letter = g.integers(-(1 << 62), 1 << 62, shared)
    sets = []
    for _ in range(pairs):
        both, own = g.integers(-(1 << 62), 1 << 62, 6), g.integers(-(1 << 62), 1 << 62, (2, 18))
        sets += [np.unique(np.concatenate([letter, both, o])) for o in own]
    return sets


def jaccard(a, b):
    both = len(np.intersect1d(a, b))
    return both / (len(a) + len(b) - both)


def test_a_crowded_fingerprint_group_loses_no_pair(spark):
    sets = family()
    want = {(i, j) for i, j in itertools.combinations(range(len(sets)), 2) if jaccard(sets[i], sets[j]) >= 0.8}
    assert want == {(i, i + 1) for i in range(0, len(sets), 2)}
    own = spark.createDataFrame([(i, 77) for i in range(len(sets))], "name long, fp long")
    table = spark.createDataFrame([(i, i, bytes(64), x.tolist()) for i, x in enumerate(sets)], "name long, row long, sig binary, own array<long>")
    # No min-hash band is shared: the group of equal fingerprints, of over ``crowd`` sets, is all that brings them together.
    groups = near_copies.fingerprint_groups(own, 3)
    assert groups.count() == len(sets)
    found = near_copies.similar_components(groups.select("key", "name", "n"), table, crowd=4)
    assert {(r.root, r.node) for r in found.collect()} == want


def test_open_pairs_meet_whatever_the_blocks(spark):
    """Two sets of a key that are not linked share a part; two blocks of one component do not meet."""
    root = {**{n: 0 for n in range(40)}, **{n: 40 for n in range(40, 43)}, **{n: 50 for n in range(50, 70)}}
    names = [*range(43), *range(50, 70), *range(100, 112)]
    keyed = spark.createDataFrame([(k, n) for k in (1, 2) for n in names] + [(3, n) for n in range(40)], "key long, name long")
    roots = spark.createDataFrame([(n, r) for n, r in root.items() if n != r], "node long, root long")
    parts = near_copies.open_pairs(keyed, roots, 8).groupBy("key").agg(F.collect_list("name").alias("names")).collect()
    met = {(min(a, b), max(a, b)) for p in parts for a, b in itertools.combinations(p["names"], 2)}
    assert {(a, b) for a, b in itertools.combinations(names, 2) if root.get(a, a) != root.get(b, b)} <= met
    assert max(len(p["names"]) for p in parts) <= 40
    whole = [p for p in parts if {root.get(n, n) for n in p["names"]} == {0}]
    assert not whole
