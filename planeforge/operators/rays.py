"""Forward rays against triangles: an equi-join on grid cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..contract import RAY_LENGTH_MM, RAY_MIN_MM, RAY_TOLERANCE_MM
from ..functions.linalg import cross, dot, sub, vec
from ..functions.spatial import CELL, cell_of, with_box_cells

CELL_MM = 25.0
PIECES = 8


def ray_cells(rays: DataFrame, length: float = RAY_LENGTH_MM, cell: float = CELL_MM) -> DataFrame:
    """Cells along each ray: the ray is cut into short pieces, each with a tight box.

    Needs x, y, z and the unit direction dx, dy, dz. The distinct cells of one
    ray are found inside its row, so no shuffle is needed to remove repeats.
    """
    step = (length + 1e-6) / PIECES

    def piece(i):
        t0, t1 = i * F.lit(step), (i + 1) * F.lit(step)
        bounds = []
        for c, d in zip("xyz", ("dx", "dy", "dz")):
            a, b = F.col(c) + F.col(d) * t0, F.col(c) + F.col(d) * t1
            bounds.append(F.sequence(cell_of(F.least(a, b) - 1e-6, cell), cell_of(F.greatest(a, b) + 1e-6, cell)))
        xs, ys, zs = bounds
        return F.flatten(F.transform(xs, lambda i: F.flatten(F.transform(
            ys, lambda j: F.transform(zs, lambda k: F.struct(i.alias("i"), j.alias("j"), k.alias("k")))))))

    cells = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(PIECES - 1)), piece)))
    return rays.withColumn("__c", F.explode(cells)).select(
        "*", *[F.col(f"__c.{a}").alias(n) for a, n in zip("ijk", CELL)]
    ).drop("__c")


def triangle_cells(triangles: DataFrame, cell: float = CELL_MM) -> DataFrame:
    lo = [F.least(*[F.col(f"{a}{i}") for i in range(3)]) - 1e-6 for a in "xyz"]
    hi = [F.greatest(*[F.col(f"{a}{i}") for i in range(3)]) + 1e-6 for a in "xyz"]
    return with_box_cells(triangles, lo, hi, cell)


def distinct_triangles(triangles: DataFrame) -> DataFrame:
    """Triangles of equal corners once for each target: a copy is hit where its like is, at the same distance."""
    return triangles.select("case_id", "target_id", *[f"{a}{i}" for i in range(3) for a in "xyz"]).distinct()


def with_hit_distance(df: DataFrame) -> DataFrame:
    """Distance ``t`` along the unit ray to the triangle, null for a miss."""
    o, d = vec("x", "y", "z"), vec("dx", "dy", "dz")
    p0, p1, p2 = (vec(*(f"{a}{i}" for a in "xyz")) for i in range(3))
    df = df.withColumns(dict(zip(
        ("e1x", "e1y", "e1z", "e2x", "e2y", "e2z", "sx", "sy", "sz"), (*sub(p1, p0), *sub(p2, p0), *sub(o, p0)))))
    e1, e2, s = vec("e1x", "e1y", "e1z"), vec("e2x", "e2y", "e2z"), vec("sx", "sy", "sz")
    df = df.withColumns(dict(zip(("hx", "hy", "hz", "gx", "gy", "gz"), (*cross(d, e2), *cross(s, e1)))))
    h, g = vec("hx", "hy", "hz"), vec("gx", "gy", "gz")
    df = df.withColumns({"det": dot(e1, h), "un": dot(s, h), "vn": dot(d, g), "tn": dot(e2, g)})
    ok = F.abs("det") > 1e-12
    u, v, t = (F.when(ok, F.col(n) / F.col("det")) for n in ("un", "vn", "tn"))
    df = df.withColumns({"u": u, "v": v, "tt": t})
    hit = (F.col("u") >= 0) & (F.col("v") >= 0) & (F.col("u") + F.col("v") <= 1)
    return df.withColumn("t", F.when(hit, F.col("tt"))).drop(
        "e1x", "e1y", "e1z", "e2x", "e2y", "e2z", "sx", "sy", "sz", "hx", "hy", "hz", "gx", "gy", "gz",
        "det", "un", "vn", "tn", "u", "v", "tt",
    )


def target_hits(rays: DataFrame, triangles: DataFrame, key: list[str], length: float = RAY_LENGTH_MM) -> DataFrame:
    """Per ray with any hit: nearest target, its distance, all targets hit.

    Per (ray, target) minima are taken first, map side; the final group of a
    ray therefore holds at most one row per target of its case. A crowded
    cell only makes more pairs of one join key, which adaptive skew handling
    splits over tasks. Copies of a triangle are tested once.
    """
    joined = ray_cells(rays, length).join(triangle_cells(distinct_triangles(triangles)), ["case_id", *CELL])
    hits = with_hit_distance(joined).filter(
        (F.col("t") > RAY_MIN_MM) & (F.col("t") <= length + RAY_TOLERANCE_MM)
    )
    nearest = hits.groupBy(*key, "target_id").agg(F.min("t").alias("t"))
    return nearest.groupBy(*key).agg(
        F.min(F.struct("t", "target_id")).alias("b"),
        F.array_sort(F.collect_set("target_id")).alias("target_ids"),
    ).select(*key, F.col("b.t").alias("distance_mm"), F.col("b.target_id").alias("nearest_target"), "target_ids")
