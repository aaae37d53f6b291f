"""Open and stale poses by bitmaps against plain sets."""

import random

from planeforge.functions.angles import angle_grid
from planeforge.operators import progress

KEY = ["case_id", "point"]


def test_pending_and_stale_are_plain_differences(spark):
    rng = random.Random(2)
    grid = {}
    for r in angle_grid(spark).select("yaw_policy", *progress.ANGLES).collect():
        grid.setdefault(r[0], set()).add(tuple(r)[1:])
    policies = sorted(grid)
    points = [(c, p, policies[(c + p) % len(policies)]) for c in range(2) for p in range(4)]
    everywhere = sorted(set().union(*grid.values()))
    done = [(c, p, *rng.choice(everywhere)) for _ in range(6000) for c, p in [(rng.randrange(3), rng.randrange(1, 5))]]
    done += [(0, 1, 1, 0, 0), (0, 1, 0, -1000, 0), (0, 2, 0, 0, 5000), (0, 1, 1, 0, 0)] + [(1, 1, *a) for a in grid[points[5][2]]]
    plan = {(c, p, *a) for c, p, policy in points for a in grid[policy]}
    at = spark.createDataFrame(points, "case_id int, point int, yaw_policy string")
    df = spark.createDataFrame(done, "case_id int, point int, roll int, pitch int, yaw int").repartition(4)
    columns = [*KEY, *progress.ANGLES]
    left = progress.pending(at, df, KEY)
    got = [tuple(r) for r in left.select(*columns).collect()]
    assert len(got) == len(set(got)) and set(got) == plan - set(done)
    gone = [tuple(r) for r in progress.stale(at, df, KEY).select(*columns).collect()]
    assert len(gone) == len(set(gone)) and set(gone) == set(done) - plan
    nothing = df.limit(0)
    assert progress.pending(at, nothing, KEY).count() == len(plan) and progress.stale(at, nothing, KEY).count() == 0
    assert progress.pending(at.limit(0), df, KEY).count() == 0 and progress.stale(at.limit(0), df, KEY).count() == len(set(done))


def test_no_pose_is_shuffled(spark):
    at = spark.createDataFrame([(0, 1, "standard")], "case_id int, point int, yaw_policy string")
    df = spark.createDataFrame([(0, 1, 0, 0, 0)], "case_id int, point int, roll int, pitch int, yaw int")
    for found in (progress.pending(at, df, KEY), progress.stale(at, df, KEY)):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join" in line]
        assert joins and not any("yaw#" in line.split("Join", 1)[1].replace("yaw_policy", "") for line in joins)
