from planeforge.operators import rays as R


def test_copies_of_triangles_are_tested_once(spark, monkeypatch):
    names = [f"{a}{i}" for i in range(3) for a in "xyz"]
    one, two = (-1.0, -1.0, 5.0, 2.0, -1.0, 5.0, -1.0, 2.0, 5.0), (-1.0, -1.0, 9.0, 2.0, -1.0, 9.0, -1.0, 2.0, 9.0)
    rows = [(0, "liver", *one)] * 30 + [(0, "spleen", *one), (0, "liver", *two)]
    tri = spark.createDataFrame(rows, "case_id int, target_id string, " + ", ".join(f"{n} double" for n in names)).repartition(3)
    rays = spark.createDataFrame([(0, 1, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)], "case_id int, point_index int, x double, y double, z double, dx double, dy double, dz double")
    met, cells = [], R.triangle_cells

    def noted(triangles, *rest):
        met.append(triangles.count())
        return cells(triangles, *rest)

    monkeypatch.setattr(R, "triangle_cells", noted)
    got = R.target_hits(rays, tri, ["case_id", "point_index"]).collect()
    assert met == [3]
    assert [(r.distance_mm, r.nearest_target, r.target_ids) for r in got] == [(5.0, "liver", ["liver", "spleen"])]
