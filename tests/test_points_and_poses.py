"""Hand-computed values for filters, rays, selection, frames and poses."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from planeforge import contract as K
from planeforge.functions.angles import angle_grid
from planeforge.functions.identity import pose_id, with_decoded
from planeforge.operators import candidates as C, centerline as CL, dedup as D, poses as P, rays as R, spacing as S
from planeforge.sources import bridges as B


def pts(spark, rows, names="x y z nx ny nz"):
    cols = "point_index int, " + ", ".join(f"{n} double" for n in names.split())
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], cols).withColumns(
        {"case_id": F.lit(0), "organ": F.lit("stomach"),
         "source_region": F.lit("stomach"), "target_ids": F.array(F.lit("liver"))})


def col(df, name):
    return sorted(r[name] for r in df.select(name).collect())


def test_angle_grid_sizes_and_values(spark):
    n = {r["yaw_policy"]: r["count"] for r in angle_grid(spark).groupBy("yaw_policy").count().collect()}
    assert n == {"standard": 3211, "duodenum_bulb": 7657, "pancreas_special": 7657, "liver_region_two": 6175}
    y = {r["yaw_policy"]: (r["a"], r["b"]) for r in angle_grid(spark).groupBy("yaw_policy").agg(F.min("yaw").alias("a"), F.max("yaw").alias("b")).collect()}
    assert y["duodenum_bulb"] == (-120, 30) and y["liver_region_two"] == (-60, 60)


def test_rotation_is_rz_ry_rx(spark):
    r = angle_grid(spark).filter("yaw_policy = 'standard' and roll = 5 and pitch = 5 and yaw = 5").first()
    a = math.radians(5)
    c, s = math.cos(a), math.sin(a)
    rx = np.array([[1, 0, 0], [0, c, -s], [0, s, c]])
    ry = np.array([[c, 0, s], [0, 1, 0], [-s, 0, c]])
    rz = np.array([[c, -s, 0], [s, c, 0], [0, 0, 1]])
    got = np.array([[r[f"r{i}{j}"] for j in range(3)] for i in range(3)])
    assert np.allclose(got, rz @ ry @ rx, atol=1e-12, rtol=0)


def test_ordinary_frame(spark):
    p = pts(spark, [(0.0, 0.0, 0.0, 2.0, 0.0, 0.0)])
    r = P.ordinary_frames(p, (F.lit(0.0), F.lit(-10.0), F.lit(0.0))).first()
    assert [r[a] for a in P.AXES] == [1, 0, 0, 0, 1, 0, 0, 0, 1]


def test_degenerate_frame_is_marked(spark):
    p = pts(spark, [(0.0, 5.0, 0.0, 0.0, 1.0, 0.0), (0.0, 5.0, 0.0, 0.0, 0.0, 0.0)])
    assert col(P.ordinary_frames(p, (F.lit(0.0), F.lit(0.0), F.lit(0.0))), "frame_ok") == [False, False]


def test_duodenum_frame(spark):
    line = spark.createDataFrame([(0, i, 0.0, 0.0, float(i)) for i in range(11)], "case_id int, seq int, x double, y double, z double")
    p = pts(spark, [(2.0, 0.0, 5.0, 1.0, 0.0, 0.0)])
    near = CL.nearest(p, line, ["case_id"], ["point_index"], "seq")
    t = near.withColumns({"tx": F.lit(0.0), "ty": F.lit(0.0), "tz": F.lit(1.0)})
    r = P.duodenum_frames(p.join(t, ["case_id", "point_index"])).first()
    assert r["seq"] == 5 and r["frame_ok"]
    assert np.allclose([r[a] for a in P.AXES], [1, 0, 0, 0, 0, -1, 0, 1, 0])


def test_poses_of_one_point(spark):
    p = pts(spark, [(0.0, 0.0, 0.0, 1.0, 0.0, 0.0)]).withColumn("yaw_policy", F.lit("standard"))
    d = P.with_identity(P.expand(P.ordinary_frames(p, (F.lit(0.0), F.lit(-1.0), F.lit(0.0)))))
    assert d.count() == 3211 and d.select("slice_id").distinct().count() == 3211
    n = d.filter("roll = 0 and pitch = 0 and yaw = 0").first()
    assert [(n["v3x"] + n["v4x"]) / 2, (n["v1x"] + n["v2x"]) / 2, (n["v1y"] + n["v2y"]) / 2] == [100, 0, 0]
    up = d.filter("roll = 0 and pitch = 0 and yaw = 5").first()
    assert up["ay"] > 0
    first = d.orderBy("pose_ord").first()
    assert first["slice_id"] == "stomach-000000-rm045-pm030-ym030"


def test_pose_id_round_trip(spark):
    good = ["liver-000012-rm045-pz000-yp005", "stomach-000000-rz000-pz000-yz000"]
    bad = ["liver-000012-rm000-pz000-yp005", "liver-12-rz000-pz000-yz000", "lung-000012-rz000-pz000-yz000", "liver-000012-rz005-pz000-yz000"]
    d = spark.createDataFrame([(t,) for t in good + bad], "t string")
    got = {r["t"]: r for r in with_decoded(d, "t").collect()}
    assert (got[good[0]]["roll"], got[good[0]]["pitch"], got[good[0]]["yaw"]) == (-45, 0, 5)
    assert all(got[b]["organ"] is None for b in bad)
    r = spark.range(1).select(pose_id(F.lit("liver"), F.lit(1234567), F.lit(-5), F.lit(0), F.lit(30)).alias("i")).first()
    assert r["i"] == "liver-1234567-rm005-pz000-yp030"


def with_limits(df, **limits):
    return df.withColumns({k: F.lit(v) for k, v in limits.items()})


def test_region_filters_keep_exact_bounds(spark):
    one = with_limits(
        pts(spark, [(-100., 80., 0., 0., 0., -1.), (-80., 60., 0., 0., 0., -1.), (-10., 10., 0., 0., 0., -1.), (-50., 20., 0., 0., 1., 0.)]),
        liver_min_x=-100.0, ivc_min_x=-10.0, liver_max_y=80.0, esophagus_max_y=10.0)
    assert col(C.liver_region_one(one), "x") == [-80, -10]
    s = 1 / math.sqrt(2)
    two = with_limits(
        pts(spark, [(-40., 19., 0., 0., -s, -s), (30., 19., 0., 0., -s, -s), (-5., 20., 0., 0., -s, -s), (-5., 19., 0., 0., 0., -1.)]),
        spleen_max_x=-40.0, ivc_max_x=30.0, pancreas_max_y=20.0)
    assert col(C.liver_region_two(two), "x") == [-40, 30]
    duo = with_limits(pts(spark, [(5., 0., 11., 0., 0., 1.), (5., 0., 10., 0., 0., 1.), (11., 0., 9., 0., 0., 1.), (10., 0., 9., 0., 0., 1.)]),
                      adrenal_min_z=10.0, aorta_max_x=10.0)
    assert col(C.duodenum_bulb(duo), "z") == [11] and col(C.duodenum_remainder(duo), "x") == [11]
    eso = with_limits(pts(spark, [(0., 0., z, 1., 0., 0.) for z in (-5., 0., 5., 15.)]), esophagus_min_z=-5.0, liver_max_z=10.0)
    assert col(C.esophagus_segment(eso), "z") == [-5, 0, 5]


def test_pancreas_filter_and_plateau(spark):
    c, s = math.cos(math.radians(105)), math.sin(math.radians(105))
    d = spark.createDataFrame([(0, 2., 0., 9.), (0, 8., 2., 9.), (0, 20., 0., 5.)], "case_id int, x double, y double, z double")
    top = C.plateau_centroid(d, ["case_id"], "z", True)
    assert top.first()["x_centroid"] == 5.0
    p = pts(spark, [(4., 0., 0., 0., 1., 0.), (5., 0., 0., 0., 1., 0.), (4., 1., 0., s, 0., c), (4., 2., 0., 0., 0., 1.)])
    assert [tuple(r) for r in C.pancreas_visible(p.join(top, "case_id")).select("x", "y").collect()] == [(4.0, 0.0)]


def box(spark, target, cx, half=1.0):
    rows = []
    for i, f in enumerate(B.FACES):
        rows.append((0, target, i, *[float(half * (2 * v - 1) + (cx if a == 0 else 0)) for c in f for a, v in enumerate(B.CORNERS[c])]))
    return spark.createDataFrame(rows, "case_id int, target_id string, face_id int, " + ", ".join(f"{a}{i} double" for i in range(3) for a in "xyz"))


def rays(spark, rows):
    return spark.createDataFrame([(0, i, *r) for i, r in enumerate(rows)], "case_id int, id int, x double, y double, z double, dx double, dy double, dz double")


def test_ray_hits(spark):
    r = rays(spark, [(0., .1, .2, 1., 0., 0.), (0., 5., 0., -1., 0., 0.), (0., 10., 0., 1., 0., 0.)])
    t = box(spark, "liver", 10.0).unionByName(box(spark, "pancreas", 20.0)).unionByName(box(spark, "spleen", 102.0))
    got = R.target_hits(r, t, ["case_id", "id"]).collect()
    assert len(got) == 1 and got[0]["id"] == 0
    assert got[0]["nearest_target"] == "liver" and got[0]["target_ids"] == ["liver", "pancreas"]
    assert got[0]["distance_mm"] == pytest.approx(9.0)
    assert R.target_hits(r, box(spark, "liver", 102.0), ["case_id", "id"]).count() == 0


def fps(spark, xs, need, spacing, seed=0):
    c = spark.createDataFrame([(0, i, float(x), 0.0, 0.0) for i, x in enumerate(xs)], "g int, ord long, x double, y double, z double")
    rules = spark.createDataFrame([(0, need, seed)], "g int, need int, seed long")
    return [r["ord"] for r in S.farthest_points(c, ["g"], rules, spacing).orderBy("step").collect()]


def test_farthest_points_line(spark):
    assert fps(spark, [0, 5, 10, 15, 20], 5, 10.0) == [4, 0, 2]


def brute_fps(xyz, need, seed, spacing):
    d = np.full(len(xyz), np.inf)
    cur, out = int(np.random.default_rng(seed).integers(len(xyz))), []
    while len(out) < min(need, len(xyz)):
        out.append(cur)
        d = np.minimum(d, np.sqrt(((xyz - xyz[cur]) ** 2).sum(1)))
        d[out] = -np.inf
        cur = int(np.argmax(d))
        if d[cur] < spacing - 1e-9:
            break
    return out


def test_farthest_points_of_large_groups_match_one_by_one_selection(spark, monkeypatch):
    monkeypatch.setattr(S, "BATCH", 16)
    g = np.random.default_rng(3)
    xyz = g.uniform(-60, 60, (400, 3)).round(1)
    c = spark.createDataFrame([(0, i, *map(float, p)) for i, p in enumerate(xyz)], "g int, ord long, x double, y double, z double")
    rules = spark.createDataFrame([(0, 25, 7)], "g int, need int, seed long")
    got = [r["ord"] for r in S.farthest_points(c, ["g"], rules, 10.0).orderBy("step").collect()]
    assert got == brute_fps(xyz, 25, 7, 10.0)


def test_drop_near_fixed_points(spark):
    p = spark.createDataFrame([(0, i, x, 0.0, 0.0) for i, x in enumerate((0.2, 10.2, 20.2, 10.0 - 5e-10))], "g int, id int, x double, y double, z double")
    f = spark.createDataFrame([(0, 0.0, 0.0, 0.0)], "g int, x double, y double, z double")
    assert col(S.drop_near(p, f, ["g"]), "id") == [1, 2, 3]


def test_closest_pair_in_a_crowd(spark):
    g = np.random.default_rng(1)
    xyz = np.r_[g.uniform(0, 3, (400, 3)), g.uniform(-400, 400, (20, 3))]
    far = np.array([[0, 0, 0], [0, 0, 700.0]])
    rows = [(0, i, *map(float, p)) for i, p in enumerate(xyz)] + [(1, i, *map(float, p)) for i, p in enumerate(far)] + [(2, i, 1.0, 1.0, 1.0) for i in range(300)]
    df = spark.createDataFrame(rows, "g int, id int, x double, y double, z double")
    got = {r["g"]: r["min_mm"] for r in S.closest_pair(df, ["g"], "id").collect()}
    d = np.sqrt(((xyz[:, None] - xyz[None]) ** 2).sum(-1))
    assert got[0] == pytest.approx(d[np.triu_indices(len(xyz), 1)].min()) and got[1] == 700.0 and got[2] == 0.0


def test_tolerance_does_not_chain(spark):
    rows = [(0, i, v, 0.0, 0.0) for i, v in enumerate((0.0, 0.75e-9, 1.5e-9))]
    n = spark.createDataFrame(rows, "g int, node long, x double, y double, z double")
    got = {r["node"]: r["owner"] for r in D.first_kept(n, ["g"], "node", "node", ("x", "y", "z"), 1e-9).collect()}
    assert got == {0: 0, 1: 0, 2: 2}


def test_priority_decides_before_order_and_copies_fold(spark):
    rows = [(0, 1, 5, 1.0), (0, 0, 9, 1.0), (0, 0, 10, 1.0 + 5e-10), (0, 1, 11, 3.0)]
    p = spark.createDataFrame(rows, "case_id int, priority int, pose_ord long, a double").withColumns({"b": F.col("a"), "c": F.col("a")})
    got = {r["pose_ord"]: r["owner"] for r in D.resolve_duplicates(p, ["a", "b", "c"], 1e-9).collect()}
    assert got == {5: 9, 9: 9, 10: 9, 11: 11}


def test_candidate_counts_without_expansion(spark):
    p = pts(spark, [(0., 0., 0., 1., 0., 0.)] * 3).withColumn("yaw_policy", F.lit("liver_region_two"))
    assert P.candidate_counts(p, ["organ"]).first()["n_poses"] == 3 * 6175


def test_square_inside_box_is_closed(spark):
    p = pts(spark, [(0., 0., 0., 1., 0., 0.)]).withColumn("yaw_policy", F.lit("standard"))
    b = P.base_poses(P.ordinary_frames(p, (F.lit(0.0), F.lit(-1.0), F.lit(0.0))))
    assert b.select(P.inside_box((0., -50., 0.), (100., 50., 0.)).alias("i")).first()["i"]
    assert not b.select(P.inside_box((1e-9, -50., 0.), (100., 50., 0.)).alias("i")).first()["i"]
    assert K.SIDE_MM == 100.0
