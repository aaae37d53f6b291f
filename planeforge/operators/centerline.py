"""Arc length, tangents and nearest points along many centrelines."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window as W, functions as F

from ..contract import TANGENT_WINDOW_MM, UNIT_EPS
from ..functions.spatial import CELL, distance, with_cell, with_near_cells
from ..session import materialize

BLOCK = 1024
BUCKET_MM = 10.0
#: Targets in a cell of the nearest search, and the edge below which cells are not halved.
LEAF = 64
LEAST_CELL_MM = 1e-6


def cumulative_length(line: DataFrame, keys: list[str]) -> DataFrame:
    """Running length along ``seq``; long lines are summed block by block.

    A line of any length is cut into blocks of 1024 points. The last point of
    a block is also given to the next one, so each step is computed inside a
    block; block totals are then added up and laid over the rows.
    """
    blk = F.floor(F.col("seq") / F.lit(BLOCK))
    tail = F.col("seq") % BLOCK == BLOCK - 1
    spread = line.select(
        *keys, "seq", "x", "y", "z",
        F.explode(F.when(tail, F.array(blk, blk + 1)).otherwise(F.array(blk))).alias("blk"))
    w = W.partitionBy(*keys, "blk").orderBy("seq")
    step = F.sqrt(sum((F.col(a) - F.lag(a).over(w)) * (F.col(a) - F.lag(a).over(w)) for a in "xyz"))
    rows = spread.withColumn("step", F.coalesce(step, F.lit(0.0))).filter(F.floor(F.col("seq") / F.lit(BLOCK)) == F.col("blk"))
    rows = rows.withColumn("part", F.sum("step").over(W.partitionBy(*keys, "blk").orderBy("seq").rowsBetween(W.unboundedPreceding, 0)))
    totals = rows.groupBy(*keys, "blk").agg(F.sum("step").alias("t"))
    before = totals.withColumn("before", F.coalesce(
        F.sum("t").over(W.partitionBy(*keys).orderBy("blk").rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
    return rows.join(before.drop("t"), [*keys, "blk"]).select(
        *keys, "seq", "x", "y", "z", "step", (F.col("before") + F.col("part")).alias("cum_mm"))


def faults(cum: DataFrame, keys: list[str], window_mm: float = TANGENT_WINDOW_MM) -> DataFrame:
    """Per line: repeated points, or shorter than the tangent window."""
    return cum.groupBy(*keys).agg(
        F.count_if((F.col("seq") > 0) & (F.col("step") < UNIT_EPS)).alias("n_zero_steps"),
        F.max("cum_mm").alias("length_mm")).withColumn("too_short", F.col("length_mm") < window_mm)


def points_at(cum: DataFrame, targets: DataFrame, keys: list[str], ids: list[str]) -> DataFrame:
    """Linear interpolation at arc lengths: a range join on length buckets.

    ``targets`` has keys, ids and ``at_mm``, already clipped to the line.
    """
    nxt = cum.select(*keys, (F.col("seq") - 1).alias("seq"), F.col("cum_mm").alias("cum2"),
                     *[F.col(a).alias(f"{a}2") for a in "xyz"])
    seg = cum.join(nxt, [*keys, "seq"], "left").withColumn("hi", F.coalesce("cum2", F.lit(float("inf"))))
    last = F.coalesce("cum2", "cum_mm")
    seg = seg.withColumn("b", F.explode(F.sequence(
        F.floor(F.col("cum_mm") / BUCKET_MM).cast("long"), F.floor(last / BUCKET_MM).cast("long"))))
    t = targets.withColumn("b", F.floor(F.col("at_mm") / BUCKET_MM).cast("long"))
    j = t.join(seg.drop("seq", "step"), [*keys, "b"]).filter((F.col("at_mm") >= F.col("cum_mm")) & (F.col("at_mm") < F.col("hi")))
    f = F.when(F.col("cum2").isNull(), 0.0).otherwise((F.col("at_mm") - F.col("cum_mm")) / (F.col("cum2") - F.col("cum_mm")))
    return j.withColumn("f", f).select(
        *keys, *ids, "at_mm", *[F.coalesce(F.col(a) + F.col("f") * (F.col(f"{a}2") - F.col(a)), F.col(a)).alias(a) for a in "xyz"])


def tangents(cum: DataFrame, keys: list[str], window_mm: float = TANGENT_WINDOW_MM) -> DataFrame:
    """Unit chords over the window around each point, one-sided at the ends."""
    total = materialize(cum.groupBy(*keys).agg(F.max("cum_mm").alias("total")), "line-length")
    half = window_mm / 2.0
    d = cum.join(total, keys).filter(F.col("total") >= window_mm)
    left = F.when(F.col("cum_mm") < half, 0.0).when(F.col("total") - F.col("cum_mm") < half, F.col("total") - window_mm).otherwise(
        F.col("cum_mm") - half)
    right = F.when(F.col("cum_mm") < half, window_mm).when(F.col("total") - F.col("cum_mm") < half, F.col("total")).otherwise(
        F.col("cum_mm") + half)
    ends = F.array(F.struct(F.lit(0).alias("side"), left.alias("at_mm")), F.struct(F.lit(1).alias("side"), right.alias("at_mm")))
    tg = d.select(*keys, "seq", F.inline(ends)).join(total, keys).withColumn(
        "at_mm", F.least(F.greatest(F.col("at_mm"), F.lit(0.0)), F.col("total"))).drop("total")
    p = points_at(cum, tg, keys, ["seq", "side"])
    chord = p.groupBy(*keys, "seq").agg(*[
        F.sum(F.when(F.col("side") == 1, F.col(a)).otherwise(-F.col(a))).alias(f"c{a}") for a in "xyz"])
    chord = chord.withColumn("n", F.sqrt(F.col("cx") * F.col("cx") + F.col("cy") * F.col("cy") + F.col("cz") * F.col("cz")))
    return chord.filter(F.col("n") >= UNIT_EPS).select(*keys, "seq", *[(F.col(f"c{a}") / F.col("n")).alias(f"t{a}") for a in "xyz"])


def nearest(points: DataFrame, targets: DataFrame, keys: list[str], ids: list[str], order: str, start_mm: float = 8.0, leaf: int = LEAF) -> DataFrame:
    """Nearest target of each point, the smallest ``order`` on equal distance.

    Cells are halved until none holds more than ``leaf`` targets (equal positions are folded beforehand). Points look into
    the 27 cells around them; a hit no farther than the cell size is final. Everyone else goes down from the few coarsest
    cells: each cell has one target as its representative, whose distance bounds the point's nearest from above, and only
    cells that are nearer than the bound are opened. So a far point meets a few cells a level, not all targets.
    """
    f3 = ("fx", "fy", "fz")
    t = targets.groupBy(*keys, "x", "y", "z").agg(F.min(order).alias(order)).select(
        *keys, order, *[F.col(a).alias(f"f{a}") for a in "xyz"])
    t = materialize(t, "nearest-targets")
    open_ = materialize(points.select(*keys, *ids, "x", "y", "z").join(t.select(*keys).distinct(), keys, "left_semi"), "nearest-open")
    size = start_mm
    while size > LEAST_CELL_MM and not with_cell(t, f3, size).groupBy(*keys, *CELL).count().filter(F.col("count") > leaf).isEmpty():
        size /= 2.0

    def found(rows: DataFrame) -> DataFrame:
        return rows.select(*keys, *ids, F.col("b.d").alias("distance_mm"), F.col(f"b.{order}").alias(order), *[F.col(f"b.f{a}").alias(f"m{a}") for a in "xyz"])

    def closest(rows: DataFrame) -> DataFrame:
        return rows.groupBy(*keys, *ids).agg(F.min(F.struct(distance(("x", "y", "z"), f3).alias("d"), order, *f3)).alias("b"))

    near = closest(with_cell(open_, ("x", "y", "z"), size).join(with_near_cells(t, f3, size), [*keys, *CELL]))
    state = materialize(open_.join(near, [*keys, *ids], "left"), "nearest")
    hit = F.coalesce(F.col("b.d") <= size, F.lit(False))
    far = state.filter(~hit).select(*keys, *ids, "x", "y", "z", F.coalesce("b.d", F.lit(float("inf"))).alias("bound"))
    if far.isEmpty():
        return found(state)

    def cells(level: int) -> DataFrame:
        """Cells of ``size`` times a power of two with their representative and parent."""
        at = with_cell(t, f3, size * 2.0**level).groupBy(*keys, *CELL).agg(F.min(F.struct(order, *f3)).alias("r"))
        return at.select(*keys, *CELL, *[F.col(f"r.{a}").alias(a) for a in f3], *[F.floor(F.col(c) / 2).cast("long").alias(f"up_{c}") for c in CELL])

    def opened(pairs: DataFrame, level: int) -> DataFrame:
        """Of the rows of points and cells those that may hold the nearest target."""
        edge = size * 2.0**level
        gap = sum(g * g for g in (F.greatest(F.col(c) * edge - F.col(a), F.col(a) - (F.col(c) + 1) * edge, F.lit(0.0)) for c, a in zip(CELL, "xyz")))
        best = F.least("bound", F.min(distance(("x", "y", "z"), f3)).over(W.partitionBy(*keys, *ids)))
        kept = pairs.withColumn("bound", best).filter(F.sqrt(gap) <= F.col("bound") + 1e-9)
        return materialize(kept.select(*keys, *ids, "x", "y", "z", "bound", *CELL), "nearest-cells")

    span = t.agg(F.greatest(*[F.max(a) - F.min(a) for a in f3])).first()[0]
    level = max(0, math.ceil(math.log2(max(span / size, 1.0))))
    pairs = opened(far.join(cells(level), keys), level)
    while level:
        level -= 1
        up = pairs.select(*keys, *ids, "x", "y", "z", "bound", *[F.col(c).alias(f"up_{c}") for c in CELL])
        pairs = opened(up.join(cells(level), [*keys, *[f"up_{c}" for c in CELL]]), level)
    last = closest(pairs.join(with_cell(t, f3, size), [*keys, *CELL]))
    return found(state.filter(hit)).unionByName(found(last))
