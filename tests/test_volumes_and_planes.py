"""Hand-computed values for sampling, quality, labels, sections, graphs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from planeforge import contract as K
from planeforge.operators import centerline as CL, graph as G, meshes as M, planes as PL, sampling as S, section as X, volumes as V
from planeforge.operators.poses import square_frame
from planeforge.sources import bridges as B

META = "case_id int, nx int, ny int, nz int, sx double, sy double, sz double, ox double, oy double, oz double, " + ", ".join(f"d{i}{j} double" for i in range(3) for j in range(3))


def meta(spark, n, spacing=(1., 1., 1.), origin=(0., 0., 0.), d=(1., 0., 0., 0., 1., 0., 0., 0., 1.)):
    return V.index_matrix(spark.createDataFrame([(0, *n, *spacing, *origin, *d)], META))


def square(spark, corners, probe=(0., 0., 0.)):
    row = (0, 0, *probe, *[float(v) for c in corners for v in c])
    return spark.createDataFrame([row], "case_id int, point_index int, x double, y double, z double, " + ", ".join(f"v{i}{a} double" for i in range(1, 5) for a in "xyz"))


def volume(spark, arr, name="hu"):
    z, y, x = np.indices(arr.shape)
    rows = [(0, *map(int, t), float(v)) for *t, v in zip(z.ravel(), y.ravel(), x.ravel(), arr.ravel())]
    return spark.createDataFrame(rows, f"case_id int, z int, y int, x int, {name} double")


def test_affine_volume_is_sampled_exactly_by_both_paths(spark):
    z, y, x = np.indices((8, 8, 8))
    vox = volume(spark, x + 10.0 * y + 100.0 * z)
    d = np.array([[0, -1, 0], [1, 0, 0], [0, 0, 1.0]])
    sp, o = np.array([2., 3., 4.]), np.array([10., 20., 30.])
    at = lambda i: d @ (np.array(i) * sp) + o
    sq = square(spark, [at((1, 2, 3)), at((3, 2, 3)), at((3, 4, 3)), at((1, 4, 3))])
    m = meta(spark, (8, 8, 8), sp.tolist(), o.tolist(), d.ravel().tolist())
    want = np.array([[321, 322, 323], [331, 332, 333], [341, 342, 343.]])
    key = ["case_id", "point_index"]
    coef = S.spline_coefficients(vox)
    px = S.pixel_index(S.pixel_grid(sq, 3).join(m, "case_id"))
    rows = S.sample_cubic_rows(px, coef, key).orderBy("row_", "col_").collect()
    assert np.allclose([r["hu"] for r in rows], want.ravel(), atol=1e-6)
    parts = S.sample_blocks(sq, S.volume_blocks(coef, "c"), m, 3, key, 3)
    packed = S.assemble(sq, parts, key, 3, -1000.0).first()["px"]
    assert np.allclose(packed, want.ravel(), atol=1e-3)


def test_block_path_over_many_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(S, "TILES_PER_CHUNK", 2)
    g = np.random.default_rng(5)
    arr = g.normal(0, 100, (20, 37, 18))
    vox, m = volume(spark, arr), meta(spark, (18, 37, 20))
    sq = square(spark, [(-2, 1, 3), (16.5, 2, 12), (17, 36, 18.7), (-1.5, 35, 9.7)])
    key = ["case_id", "point_index"]
    coef = S.spline_coefficients(vox).cache()
    px = S.pixel_index(S.pixel_grid(sq, 40).join(m, "case_id"))
    want = {(r["row_"], r["col_"]): r["hu"] for r in S.sample_cubic_rows(px, coef, key).collect()}
    got = S.assemble(sq, S.sample_blocks(sq, S.volume_blocks(coef, "c"), m, 40, key, 3), key, 40, -1000.0).first()["px"]
    assert max(abs(want[(i // 40, i % 40)] - v) for i, v in enumerate(got)) < 1e-3
    assert sum(v == -1000.0 for v in got) > 0


def test_gray_window(spark):
    r = spark.createDataFrame([(40.0,), (-160.0,), (240.0,), (900.0,)], "h double").select(S.gray(F.col("h")).alias("g")).collect()
    assert [x["g"] for x in r] == [127, 0, 255, 255]


def test_fov_diagnosis(spark):
    sq = square(spark, [(-1, 0, 0), (3, 0, 0), (3, 3, 0), (-1, 3, 0)])
    r = S.fov_diagnosis(sq, meta(spark, (4, 4, 4)), 3, ["case_id", "point_index"]).first()
    assert r["out_ratio"] == pytest.approx(1 / 3) and r["x_low"] == pytest.approx(1 / 3) and r["x_high"] == 0
    assert r["probe_inside"] and (r["ix_min"], r["ix_max"]) == (-1, 3)


def planes(spark, *grids):
    rows = [(i, *g.shape, [int(v) for v in g.ravel()]) for i, g in enumerate(grids)]
    return spark.createDataFrame(rows, "plane_id long, h int, w int, px array<smallint>")


def share(r):
    px = np.full((100, 100), 127)
    px.ravel()[np.random.default_rng(0).choice(px.size, int(px.size * r), replace=False)] = 0
    return px


def half(n):
    px = np.full((100, 100), 127)
    px[:, :n] = 0
    return px


def test_quality(spark):
    p = planes(spark, share(.40), share(.60), share(.61), half(20), half(61), np.full((100, 100), 127), half(61).T)
    q = {r["plane_id"]: r for r in PL.quality(p, ["plane_id"]).collect()}
    assert [q[i]["reason"] for i in range(7)] == [None, None, "black_ratio", "black_boundary_line", "black_boundary_line", None, "black_boundary_line"]
    assert q[0]["black_ratio"] == .40 and q[4]["black_ratio_exceeded"] and not q[1]["black_ratio_exceeded"]
    assert q[3]["line_length_px"] >= .7 * np.hypot(100, 100)


def test_quick_rejection_never_hides_a_border():
    g = np.random.default_rng(2)
    yy, xx = np.indices((100, 100))
    for _ in range(60):
        a, b = g.uniform(0, np.pi), g.uniform(30, 70)
        mask = (xx - b) * np.cos(a) + (yy - b) * np.sin(a) < 0
        noisy = mask ^ (g.random(mask.shape) < 0.09)
        assert PL.may_split(mask, PL.RULES) and PL.may_split(noisy, PL.RULES)
    assert not PL.may_split(share(.5) < 50, PL.RULES)


def test_rejected_by_the_volume_border(spark):
    out = np.zeros((100, 100), dtype=int)
    out[:, :50] = 1
    p = planes(spark, half(50)).withColumn("out", F.array(*[F.lit(int(v)) for v in out.ravel()]))
    line = PL.with_border(p, ["plane_id"])
    a = PL.with_line_alignment(p.join(line, "plane_id"), ["plane_id"])
    r = PL.rejection_cause(PL.overlap_counts(p).join(a, "plane_id")).first()
    assert r["black_out_ratio"] == 1.0 and r["n_out"] == 5000 and r["cause"] == "fov_boundary_aligned"


def test_labels_and_features(spark):
    one = np.full((9, 9), 6)
    one[4, 4] = 11
    main, dual = np.zeros((9, 9), int), np.zeros((9, 9), int)
    main[3:6, 3:6], dual[3:6, 3:6] = 23, 26
    diag = np.zeros((11, 11), int)
    diag[4, 4] = diag[5, 5] = 8
    merged = np.zeros((12, 12), int)
    merged[4:7, 4:6], merged[4:7, 6:8], merged[0:3, 8:11] = 26, 33, 9
    p = planes(spark, one, main, dual, diag, merged)
    labels = {r["plane_id"]: r["organ_labels"] for r in PL.organs_present(p).collect()}
    assert labels == {0: ["liver", "pancreas"], 1: ["portal_vein"], 2: ["portal_vein"], 3: ["aorta"], 4: ["inferior_vena_cava", "portal_vein"]}
    f = PL.vessel_components(p, ["plane_id"], 110.0, 110.0).collect()
    kept = [(r["plane_id"], r["label"]) for r in f if not r["touches_edge"]]
    assert sorted(kept) == [(2, "portal_vein"), (3, "aorta"), (4, "portal_vein")]
    assert next(r for r in f if r["plane_id"] == 4 and r["label"] == "portal_vein")["area_mm2"] == pytest.approx(1200.0)
    d = PL.vessel_components(planes(spark, diag), ["plane_id"], 100.0, 200.0).first()
    assert (d["x_mm"], d["y_mm"], d["area_mm2"]) == pytest.approx((45.0, 90.0, 400.0))
    c = PL.boundary_colours(planes(spark, one), ["plane_id"], K.ORGAN_LABEL_VALUES, K.ORGAN_COLORS).first()["rgb"]
    img = np.array(c).reshape(9, 9)
    assert (img[0] == PL.WHITE).all() and (img[:, -1] == PL.WHITE).all() and (img[3:6, 3:6] != PL.WHITE).any()


def test_component_labels_on_a_spiral():
    m = np.zeros((31, 31), dtype=bool)
    y, x, dy, dx, run = 15, 15, 0, 2, 1
    while 2 <= y < 29 and 2 <= x < 29:
        for _ in range(2):
            for _ in range(run):
                for k in range(2):
                    m[min(max(y + (dy // 2) * k, 0), 30), min(max(x + (dx // 2) * k, 0), 30)] = True
                y, x = y + dy, x + dx
            dy, dx = dx, -dy
        run += 1
    assert len(np.unique(PL.components(m[None].astype(int))[0][m])) == 1
    two = np.zeros((5, 5), dtype=bool)
    two[0, 0] = two[4, 4] = True
    assert len(np.unique(PL.components(two[None].astype(int))[0][two])) == 2


def mesh_rows(spark, boxes):
    rows = []
    for mid, (lo, edge) in enumerate(boxes):
        for i, f in enumerate(B.FACES):
            rows.append((0, mid, i, *f, *[float(lo[a] + edge * v) for c in f for a, v in enumerate(B.CORNERS[c])]))
    return spark.createDataFrame(rows, "case_id int, mesh_id long, face_id int, v0 int, v1 int, v2 int, " + ", ".join(f"{a}{i} double" for i in range(3) for a in "xyz"))


def section(spark, boxes, corners):
    sq, key = square_frame(square(spark, corners)), ["case_id", "point_index"]
    mk, pk = ["case_id", "mesh_id"], ["case_id", "point_index", "mesh_id"]
    t = mesh_rows(spark, boxes)
    pairs = X.candidate_pairs(sq, X.mesh_boxes(t, mk), key, mk)
    looped = X.with_loops(X.segments(sq, t, pairs, key, mk), pk)
    return pairs, X.loop_measures(looped, pk), X.clipped_measures(looped, pk)


SQUARE4 = [(-2, -2, 0), (2, -2, 0), (2, 2, 0), (-2, 2, 0)]


def test_box_section(spark):
    boxes = [((-.5, -.5, -.5), 1.0), ((-1., -1., 4.), 2.0), ((8., 8., -1.), 2.0), ((1.5, -.5, -.5), 1.0)]
    pairs, full, cut = section(spark, boxes, SQUARE4)
    assert sorted(r["mesh_id"] for r in pairs.collect()) == [0, 3]
    f = {r["mesh_id"]: r for r in full.collect()}
    assert f[0]["complete"] and f[0]["area_mm2"] == pytest.approx(1.0) and (f[0]["u_mm"], f[0]["v_mm"]) == pytest.approx((2.0, 2.0))
    assert not f[3]["complete"]
    c = {r["mesh_id"]: r for r in cut.collect()}
    assert c[3]["area_mm2"] == pytest.approx(0.5) and c[3]["u_mm"] == pytest.approx(3.75)


def test_polygon_clip_against_corner():
    poly = np.array([[-1., -1.], [3., -1.], [3., 3.], [-1., 3.]])
    a, u, v = X.polygon_measures(X.clip(poly, 2.0, 2.0))
    assert (a, u, v) == pytest.approx((4.0, 1.0, 1.0))
    assert len(X.clip(poly + 10, 2.0, 2.0)) == 0


def tree(spark, size, arms):
    c = size // 2
    rows = [(0, c, c, c)]
    for d, n in arms:
        rows += [(0, *[c + k * s for k in d]) for s in range(1, n + 1)]
    return spark.createDataFrame(rows, "case_id int, z int, y int, x int")


def test_spur_pruning(spark):
    v = tree(spark, 9, (((-1, -1, -1), 3), ((1, 1, -1), 2), ((1, -1, 1), 1)))
    kept, verdict = G.prune_spurs(v, ["case_id"], 1.0, 5.0)
    r = verdict.first()
    assert kept.count() == 6 and r["verdict"] == "ok" and r["pruned_mm"] == pytest.approx(3 ** .5)
    assert kept.filter("z = 5 and y = 3 and x = 5").isEmpty()
    long = tree(spark, 15, (((-1, -1, -1), 4), ((1, 1, -1), 4), ((1, -1, 1), 4)))
    assert G.prune_spurs(long, ["case_id"], 1.0, 5.0)[1].first()["verdict"] == "too_long"
    tie = tree(spark, 15, (((-1, -1, -1), 5), ((1, 1, -1), 2), ((1, -1, 1), 2)))
    assert G.prune_spurs(tie, ["case_id"], 1.0, 5.0)[1].first()["verdict"] == "ambiguous"


def test_path_between_hints(spark):
    v = tree(spark, 21, (((-1, -1, -1), 7), ((1, 1, -1), 7), ((1, -1, 1), 6)))
    n = lambda z, y, x: (z * (1 << 21) + y) * (1 << 21) + x
    ends = spark.createDataFrame([(0, n(3, 3, 3), n(17, 17, 3))], "case_id int, start long, stop long")
    p = G.tree_path(v, ends, ["case_id"]).orderBy("seq").collect()
    assert len(p) == 15 and p[0]["node"] == n(3, 3, 3) and p[-1]["node"] == n(17, 17, 3)
    assert [r["seq"] for r in p] == list(range(15)) and p[-1]["along"] == pytest.approx(14 * 3 ** .5)
    rep = G.tree_report(v, ["case_id"]).first()
    assert (rep["n_nodes"], rep["n_edges"], rep["n_ends"], rep["n_branch"], rep["is_tree"]) == (21, 20, 3, 1, True)


def test_components_of_a_random_graph(spark):
    g = np.random.default_rng(4)
    e = [(0, int(a), int(b)) for a, b in g.integers(0, 300, (220, 2))] + [(0, 400, i) for i in range(401, 480)] + [(0, i, i + 1) for i in range(500, 600)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for _, a, b in e:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    nodes = sorted({n for _, a, b in e for n in (a, b)})
    nd = spark.createDataFrame([(0, n) for n in nodes], "g int, node long")
    ed = spark.createDataFrame(e, "g int, src long, dst long")
    got = {r["node"]: r["comp"] for r in G.connected_components(nd, ed, ["g"]).collect()}
    assert got == {n: find(n) for n in nodes}


def test_winding_and_main_shell(spark):
    t = mesh_rows(spark, [((0., 0., 0.), 2.0), ((10., 0., 0.), 3.0)])
    t = t.withColumns({**{f"v{i}": (F.col("mesh_id") * 8 + F.col(f"v{i}")).cast("long") for i in range(3)},
                       "face_id": F.col("mesh_id") * 12 + F.col("face_id"), "turn": F.col("face_id") % 3 == 0, "obj": F.lit(1)})
    t = M.turned_faces(t).drop("turn")
    r = M.main_shell(t, ["obj"]).first()
    assert (r["n_shells"], r["shell"], r["kept_faces"], r["verdict"]) == (2, 12, 12, "ok") and r["volume_mm3"] == pytest.approx(27.0)
    assert M.main_shell(t.filter("face_id <> 0"), ["obj"]).first()["verdict"] == "open_shell"


def test_running_length_over_blocks_and_tangents(spark):
    n = 2500
    line = spark.createDataFrame([(0, i, float(i % 2), float(i), 0.0) for i in range(n)], "case_id int, seq int, x double, y double, z double")
    c = CL.cumulative_length(line, ["case_id"])
    rows = c.orderBy("seq").collect()
    assert np.allclose([r["cum_mm"] for r in rows], np.arange(n) * 2 ** .5)
    straight = spark.createDataFrame([(0, i, 0.0, 0.0, float(i)) for i in range(30)], "case_id int, seq int, x double, y double, z double")
    t = CL.tangents(CL.cumulative_length(straight, ["case_id"]), ["case_id"]).collect()
    assert len(t) == 30 and all((r["tx"], r["ty"]) == (0, 0) and r["tz"] == pytest.approx(1.0) for r in t)
    short = CL.cumulative_length(straight.filter("seq < 5"), ["case_id"])
    assert CL.faults(short, ["case_id"]).first()["too_short"] and CL.tangents(short, ["case_id"]).isEmpty()


def test_masks_and_surface_crossings(spark):
    m = spark.createDataFrame([(0, 1, 1, 1), (0, 1, 1, 2)], "case_id int, z int, y int, x int")
    c = V.surface_crossings(m, ["case_id"])
    assert c.count() == 10 and c.filter("axis = 0").count() == 2 and sorted(r["ix"] for r in c.filter("axis = 0").collect()) == [.5, 2.5]
