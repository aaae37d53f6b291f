"""Spacing rules between points, and farthest-point selection."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F

from ..contract import SPACING_MM, SPACING_TOLERANCE_MM
from ..functions.ranking import nth_row
from ..functions.spatial import CELL, cell_of, distance, with_cell, with_near_cells
from ..session import materialize

XYZ = ("x", "y", "z")
FXYZ = ("fx", "fy", "fz")


def drop_near(points: DataFrame, fixed: DataFrame, keys: list[str], spacing: float = SPACING_MM) -> DataFrame:
    """Points no nearer than the spacing to any fixed point of their group."""
    f = fixed.select(*keys, *[F.col(c).alias(n) for c, n in zip(XYZ, FXYZ)])
    # One fixed point per fine cell and position is enough; copies fold map side.
    f = with_near_cells(f.distinct(), FXYZ, spacing)
    near = distance(XYZ, FXYZ) < spacing - SPACING_TOLERANCE_MM
    p = with_cell(points, XYZ, spacing)
    cond = near
    for k in (*keys, *CELL):
        cond = cond & (p[k].eqNullSafe(f[k]) if k in keys else p[k] == f[k])
    return p.join(f, cond, "left_anti").drop(*CELL)


def on_surface(samples: DataFrame, allowed: DataFrame, keys: list[str], id_col: str,
               tolerance: float = 1e-9, dot_tolerance: float = 1e-8) -> DataFrame:
    """Per sample: vertices within tolerance, best normal agreement, verdict."""
    size = 1e-6
    s = samples
    for i, c in enumerate(XYZ):
        s = s.withColumn(f"__a{i}", F.array_distinct(F.array(
            F.floor((F.col(c) - tolerance) / size), F.floor((F.col(c) + tolerance) / size))))
    for i, n in enumerate(CELL):
        s = s.withColumn(n, F.explode(f"__a{i}"))
    a = allowed.select(*keys, *[F.col(c).alias(n) for c, n in zip(XYZ, FXYZ)],
                       *[F.col(c).alias(f"f{c}") for c in ("nx", "ny", "nz")]).distinct()
    a = a.withColumns({n: cell_of(F.col(c), size) for n, c in zip(CELL, FXYZ)})
    m = s.join(a, [*keys, *CELL]).filter(distance(XYZ, FXYZ) <= tolerance)
    dot = F.col("nx") * F.col("fnx") + F.col("ny") * F.col("fny") + F.col("nz") * F.col("fnz")
    best = m.groupBy(*keys, id_col).agg(F.count(F.lit(1)).alias("n_match"), F.max(dot).alias("best_dot"))
    out = samples.select(*keys, id_col).join(best, [*keys, id_col], "left")
    return out.select(
        *keys, id_col, F.coalesce("n_match", F.lit(0)).alias("n_match"), "best_dot",
        F.when(F.col("n_match").isNull(), "off_surface")
        .when(F.col("best_dot") < 1.0 - dot_tolerance, "normal_disagrees").otherwise("ok").alias("verdict"),
    )


CROWD = 64


def closest_pair(points: DataFrame, keys: list[str], id_col: str, start_mm: float = SPACING_MM) -> DataFrame:
    """Smallest distance between two points of each group.

    The cell size is tuned per group before any pair is formed: while a cell
    holds more than 64 points it is halved (by counting, two of them must be
    closer than half the size), while no pair is found it is doubled. Pairs
    are then formed only between neighbouring cells of at most 64 points, so
    a crowded spot never yields all pairs of its points. Exact copies are
    settled beforehand by a partial aggregate.
    """
    same = points.groupBy(*keys, *XYZ).agg(F.count(F.lit(1)).alias("n"), F.min(id_col).alias(id_col))
    same = materialize(same, "distinct-points")
    per = same.groupBy(*keys).agg(F.sum("n").alias("total"), F.max("n").alias("copies"))
    done = per.filter("total >= 2 and copies > 1").select(*keys, F.lit(0.0).alias("min_mm"))
    parts = [done]
    active = materialize(per.filter("total >= 2 and copies = 1").select(*keys, F.lit(start_mm).alias("size")), "sizes")
    pts = same.select(*keys, id_col, *XYZ)
    while True:
        cells = with_cell(pts.join(active, keys), XYZ, F.col("size"))
        busy = cells.groupBy(*keys, *CELL).agg(F.count(F.lit(1)).alias("m")).groupBy(*keys).agg(F.max("m").alias("m"))
        nxt = materialize(active.join(busy, keys).select(
            *keys, F.when(F.col("m") > CROWD, F.col("size") / 2).otherwise(F.col("size")).alias("size"),
            (F.col("m") > CROWD).alias("shrunk")), "sizes")
        active = nxt.drop("shrunk")
        if nxt.filter("shrunk").isEmpty():
            break
    while not active.isEmpty():
        sized = pts.join(active, keys)
        left = with_cell(sized, XYZ, F.col("size"))
        right = with_near_cells(
            sized.select(*keys, "size", F.col(id_col).alias("__id"), *[F.col(c).alias(n) for c, n in zip(XYZ, FXYZ)]),
            FXYZ, F.col("size")).drop("size")
        found = left.join(right, [*keys, *CELL]).filter(F.col(id_col) < F.col("__id")).groupBy(*keys).agg(
            F.min(distance(XYZ, FXYZ)).alias("min_mm"))
        state = materialize(active.join(found, keys, "left"), "closest")
        parts.append(state.filter("min_mm <= size").select(*keys, "min_mm"))
        active = state.filter("min_mm is null or min_mm > size").select(*keys, (F.col("size") * 2).alias("size"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


BATCH = 2048
PARTS = 64


def _pick(pdf: pd.DataFrame) -> pd.DataFrame:
    """Greedy steps that are certain from the farthest rows of a group alone.

    A row outside the batch is no farther than the batch's last row and can
    only come nearer, so every step whose winner ranks before that row is the
    step the whole group would take.
    """
    pdf = pdf.sort_values(["d", "ord"], ascending=[False, True], ignore_index=True)
    xyz = pdf[["x", "y", "z"]].to_numpy()
    d, o = pdf["d"].to_numpy().copy(), pdf["ord"].to_numpy()
    first = int(pdf["first"].iloc[0])
    need, have = int(pdf["need"].iloc[0]), int(pdf["have"].iloc[0])
    spacing = float(pdf["spacing"].iloc[0])
    whole = len(pdf) < int(pdf["batch"].iloc[0])
    last_d, last_o = d[-1], o[-1]
    order: list[int] = []
    while have + len(order) < need:
        best = d.max() if len(d) else -np.inf
        if not best >= spacing - SPACING_TOLERANCE_MM:
            break
        tied = np.flatnonzero(d == best)
        i = int(tied[np.argmin(o[tied])])
        if have + len(order) == 0:
            i = first
        if not whole and (best < last_d or (best == last_d and o[i] > last_o)):
            break
        order.append(i)
        diff = xyz - xyz[i]
        d = np.minimum(d, np.sqrt((diff * diff).sum(axis=1)))
        d[order] = -np.inf
    out = pdf.iloc[order].copy()
    out["step"] = np.arange(have, have + len(order), dtype="int64")
    return out


def _small_groups(base: DataFrame, keys: list[str], rules: DataFrame, floor_mm: float, cols: list[str]) -> DataFrame:
    """Groups known to hold fewer rows than one batch are finished in one pass."""
    rows = base.join(rules.select(*keys, "need", "k"), keys).select(
        *keys, "ord", *XYZ, F.lit(float("inf")).alias("d"), F.col("need").cast("long"),
        F.lit(0).cast("long").alias("have"), F.lit(floor_mm).alias("spacing"), F.col("k").alias("first"), F.lit(BATCH).alias("batch"))
    schema = rows.select(*keys, "ord", *XYZ, F.lit(0).cast("long").alias("step")).schema
    out = rows.groupBy(*keys).applyInPandas(lambda pdf: _pick(pdf)[cols], schema)
    return materialize(out, "fps-small")


def farthest_points(cands: DataFrame, keys: list[str], rules: DataFrame, spacing: float | None = SPACING_MM) -> DataFrame:
    """Farthest-point selection in every group at once, groups of any size.

    ``cands`` has keys, ord, x, y, z; ``rules`` has keys, need, seed. The start
    row is the one the seeded generator draws. Each round takes the farthest
    rows of a group (a per-partition top list before the shuffle), makes all
    certain steps on that bounded batch, and lowers the distances of the rest
    where they are. Rows nearer than the spacing are dropped: they can never
    be chosen. With ``spacing=None`` only the count limits the selection.
    """
    floor_mm = -1.0 if spacing is None else spacing
    base = materialize(cands.select(*keys, "ord", *XYZ), "fps-candidates")
    counts = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).join(rules, keys)

    @F.pandas_udf("long")
    def draw(seed: pd.Series, n: pd.Series) -> pd.Series:
        return pd.Series([int(np.random.default_rng(int(s)).integers(int(m))) for s, m in zip(seed, n)])

    rules2 = materialize(counts.filter("need > 0").withColumn("k", draw("seed", "n")), "fps-rules")
    cols = [*keys, "ord", *XYZ, "step"]
    whole = _small_groups(base, keys, rules2.filter(F.col("n") < BATCH), floor_mm, cols)
    rules2 = rules2.filter(F.col("n") >= BATCH)
    if rules2.isEmpty():
        return whole
    start = nth_row(base, keys, ["ord"], rules2.select(*keys, "k")).withColumn("step", F.lit(0).cast("long"))
    new = materialize(start.select(*cols), "fps-step")
    chosen = [whole, new]
    left = base.withColumn("d", F.lit(float("inf")))
    while True:
        spots = new.groupBy(*keys).agg(F.collect_list(F.struct(*XYZ)).alias("spots"), F.max("step").alias("last"))
        spots = spots.join(rules2.select(*keys, "need"), keys).filter(F.col("last") + 1 < F.col("need"))
        spots = materialize(spots, "fps-spots")

        def to(s):
            d = [F.col(c) - s[c] for c in XYZ]
            return F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])

        near = F.array_min(F.transform("spots", to))
        left = left.join(spots, keys).withColumn("d", F.least(F.col("d"), near))
        left = left.join(new.select(*keys, "ord"), [*keys, "ord"], "left_anti")
        left = materialize(
            left.filter(F.col("d") >= floor_mm - SPACING_TOLERANCE_MM).select(*keys, "ord", *XYZ, "d", "need", "last"),
            "fps-left",
        )
        # Top lists of parts of a group first: the last one then ranks at most PARTS batches, whatever the group holds.
        far = [F.col("d").desc(), F.col("ord")]
        part = W.partitionBy(*keys, F.pmod(F.xxhash64("ord"), F.lit(PARTS))).orderBy(*far)
        some = left.withColumn("rn", F.row_number().over(part)).filter(F.col("rn") <= BATCH)
        batch = some.withColumn("rn", F.row_number().over(W.partitionBy(*keys).orderBy(*far))).filter(F.col("rn") <= BATCH).select(
            *keys, "ord", *XYZ, "d", F.col("need").cast("long"), (F.col("last") + 1).alias("have"),
            F.lit(floor_mm).alias("spacing"), F.lit(-1).cast("long").alias("first"), F.lit(BATCH).alias("batch"))
        new = materialize(
            batch.groupBy(*keys).applyInPandas(
                lambda pdf: _pick(pdf)[cols], new.select(*cols).schema), "fps-step")
        if new.isEmpty():
            break
        chosen.append(new)
        left = left.drop("need", "last")
    out = chosen[0]
    for c in chosen[1:]:
        out = out.unionByName(c)
    return out


def selection_stats(cands: DataFrame, chosen: DataFrame, rules: DataFrame, keys: list[str]) -> DataFrame:
    """Requested, candidate, actual and missing counts of every group."""
    n = cands.groupBy(*keys).agg(F.count(F.lit(1)).alias("candidate_count"))
    a = chosen.groupBy(*keys).agg(F.count(F.lit(1)).alias("actual_count"))
    s = rules.join(n, keys, "left").join(a, keys, "left").fillna(0, ["candidate_count", "actual_count"])
    return s.select(
        *keys, F.col("need").cast("long").alias("requested_count"), "candidate_count", "actual_count",
        F.greatest(F.col("need") - F.col("actual_count"), F.lit(0)).cast("long").alias("shortfall_count"),
    )


def shortfall_rollup(stats: DataFrame) -> DataFrame:
    """Counts per region rolled up to organ and to everything."""
    cols = ["requested_count", "candidate_count", "actual_count", "shortfall_count"]
    return stats.rollup("organ", "source_region").agg(
        *[F.sum(c).alias(c) for c in cols], F.grouping_id().cast("int").alias("level"))
