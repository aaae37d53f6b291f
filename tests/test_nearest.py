"""The nearest search against all pairs: far points, crowded targets, ties."""

import numpy as np
import pytest

from planeforge.operators import centerline as CL


def nearest(spark, points, targets, **kw):
    p = spark.createDataFrame([(1, i, *map(float, x)) for i, x in enumerate(points)], "case_id int, p long, x double, y double, z double")
    t = spark.createDataFrame([(1, i, *map(float, x)) for i, x in enumerate(targets)], "case_id int, seq long, x double, y double, z double")
    return {r.p: (r.distance_mm, r.seq) for r in CL.nearest(p, t, ["case_id"], ["p"], "seq", **kw).collect()}


def plain(points, targets):
    out = {}
    for i, p in enumerate(points):
        d = np.sqrt(((targets - p) ** 2).sum(1))
        out[i] = (d.min(), int(np.flatnonzero(np.isclose(d, d.min(), rtol=0, atol=1e-12))[0]))
    return out


def test_far_points_and_many_targets_stay_linear(spark, monkeypatch):
    rng = np.random.default_rng(3)
    n = 100_000
    angle = np.linspace(0, 60, n)
    targets = np.stack([40 * np.cos(angle), 40 * np.sin(angle), angle * 3], 1) + rng.normal(0, 0.5, (n, 3))
    points = np.concatenate([rng.normal(0, 900, (150, 3)), rng.normal(0, 30, (50, 3))])
    rows = []
    own = CL.materialize

    def counted(df, name):
        out = own(df, name)
        if name == "nearest-cells":
            rows.append(out.count())
        return out

    monkeypatch.setattr(CL, "materialize", counted)
    got, want = nearest(spark, points, targets), plain(points, targets)
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()}
    assert all(abs(got[k][0] - want[k][0]) < 1e-9 for k in want)
    # All pairs would be 2 * 10 ** 7; what is opened is a few cells a point and level.
    assert max(rows) < 40 * len(points) and sum(rows) < 300 * len(points)


@pytest.mark.parametrize("leaf", [1, 3, 64])
def test_ties_repeats_and_one_crowded_cell(spark, leaf):
    targets = np.array([(0, 0, 0), (0, 0, 0), (1e-4, 0, 0), (2e-4, 0, 0), (3e-4, 0, 0), (4, 0, 0), (-4, 0, 0), (0, 4, 0), (100, 100, 100)], float)
    points = np.array([(0, 0, 0), (0, 0, 2.5), (0, 0, 500), (2, 0, 0), (-300, 0, 0), (1.5e-4, 0, 0), (99, 99, 99), (-8, 8, 0)], float)
    got, want = nearest(spark, points, targets, leaf=leaf), plain(points, targets)
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()}


def test_a_case_without_targets_has_no_rows(spark):
    assert nearest(spark, np.zeros((2, 3)), np.zeros((0, 3))) == {}
