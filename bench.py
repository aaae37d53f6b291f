"""Headline queries, timed. Prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from planeforge.plans import registry  # noqa: E402
from planeforge.session import build_session  # noqa: E402

HEADLINE = (
    "poses_inside_volume",  # expansion of all points and volume test
    "prj10_pose_vertices",
    "flt09_fov_vertices",
    "jn01_ray_targets",  # rays against triangles
    "jn07_closest_pair",
    "jn11_pending_poses",  # plan minus finished
    "jn15_pose_geometry_audit",
    "aud06_coverage",
    "agg01_library_summary",
    "agg04_multiset_digest",
    "smp02_cubic_sample",  # block-wise spline sampling
    "jn09_plane_triangle_segments",
    "agg13_organs_present",
    "itr1_mask_components",
    "flt10_black_ratio",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cores, max(8, int(cores)))
    spark.range(1000).selectExpr("sum(id)").collect()
    only = sys.argv[1:]
    times: dict[str, float] = {}
    for name in HEADLINE:
        if only and not any(o in name for o in only):
            continue
        start = time.time()
        registry.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
