"""Cases of the fourth review: work that stays in its task, and the same rows as before."""

import re

from pyspark.sql import functions as F

from planeforge.operators import dedup as D, manifest as MF
from planeforge.plans.registry import QUERIES


def squares(spark):
    # at 1: a copy and one within the tolerance; at 2: a chain of which the last stays; at 3 and 4: alone
    at = [(1, 1, 5, 1.0), (1, 0, 9, 1.0), (1, 0, 10, 1.0 + 5e-10), (2, 0, 20, 2.0), (2, 0, 21, 2.0 + 0.75e-9), (2, 0, 22, 2.0 + 1.5e-9),
          (3, 1, 30, 3.0), (3, 0, 31, 3.0 + 2e-3), (4, 0, 40, -0.0), (4, 1, 41, 0.0)]
    p = spark.createDataFrame([(0, *r) for r in at], "case_id int, cluster int, priority int, pose_ord long, a double")
    return p.withColumns({"b": F.col("a"), "c": F.col("a"), "name": F.concat(F.lit("p"), "pose_ord")})


def test_duplicates_resolved_in_place_are_the_shuffled_ones(spark):
    p = squares(spark)
    want = {r["pose_ord"]: r["owner"] for r in D.resolve_duplicates(p, ["a", "b", "c"], 1e-9).collect()}
    got = D.resolve_in_place(p, ["a", "b", "c"], 1e-9, ["cluster"], ("name", "priority")).collect()
    assert {r["pose_ord"]: r["owner"] for r in got} == want and len(got) == 10
    assert want[5] == want[10] == 9 and want[21] == 20 and want[22] == 22 and want[41] == 40
    assert all(r["owner_name"] == f"p{r['owner']}" for r in got)
    first = {r["pose_ord"]: r["priority"] for r in got}
    assert all(r["owner_priority"] == first[r["owner"]] for r in got)


def test_in_place_exchanges_no_pose(spark):
    p = squares(spark).filter("cluster = 3").repartition(3, "case_id", "cluster")
    r = D.resolve_in_place(p, ["a", "b", "c"], 1e-9, ["cluster"]).groupBy("case_id", "cluster", "pose_ord").count()
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_points_at_a_cell_wall_link_their_clusters(spark):
    rows = [(0, "stomach", i, x, 0.5e-6, 0.5e-6) for i, x in enumerate((0.2e-6, 1e-6, 1.8e-6, 5.5e-6, 5.6e-6, 9.5e-6))]
    p = spark.createDataFrame(rows, "case_id int, organ string, point_index int, x double, y double, z double")
    c = {r["point_index"]: r["cluster"] for r in D.coincident_clusters(p).collect()}
    assert set(c) == {0, 1, 2, 3, 4} and c[0] == c[1] == c[2] and c[3] == c[4] != c[0]


def test_planned_and_finished_rows_meet_without_an_exchange(spark):
    key = ["case_id", "point", "roll"]
    plan = spark.range(40).select(F.lit(0).alias("case_id"), (F.col("id") % 4).alias("point"), F.col("id").alias("roll"), (F.col("id") * 0.5).alias("v"))
    plan = plan.repartition(5, "case_id", "point")
    done = plan.filter("roll <> 7").withColumns({"v": F.when(F.col("roll") == 8, -1.0).otherwise(F.col("v")), "build_git_commit": F.when(F.col("roll") == 9, "bad").otherwise("good")})
    stray = done.filter("roll = 3").withColumn("roll", F.lit(99).cast("long"))
    m = MF.field_mismatches(plan, done, key, ["v"], allowed_commits=["good"])
    assert m._jdf.queryExecution().executedPlan().toString().count("Exchange") == 2  # of the points, on either side
    found = {r["roll"]: r["mismatches"] for r in MF.field_mismatches(plan, done.unionByName(stray), key, ["v"], allowed_commits=["good"]).collect()}
    assert len(found) == 39 and {k: v for k, v in found.items() if v} == {8: ["v"], 9: ["build_git_commit"]}


def test_pixels_meet_voxels_and_cells_by_shuffle(spark):
    q = QUERIES["jn22_block_path_agrees"](spark, "/root/testdata/sf0.001")
    joins = [x for x in q._jdf.queryExecution().executedPlan().toString().splitlines() if re.search(r"Join \[[^\]]*\bx#", x)]
    assert len(joins) == 2 and all("SortMergeJoin" in x for x in joins)


def test_queries_run_compiled_methods_in_any_session(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    other = spark.newSession()
    other.conf.set(key, "65535")  # Spark's default
    QUERIES["prj05_square_frame"](other, "/root/testdata/sf0.001")
    assert other.conf.get(key) == "8000"
    other.conf.set(key, "20000")
    QUERIES["prj05_square_frame"](other, "/root/testdata/sf0.001")
    assert other.conf.get(key) == "20000"
