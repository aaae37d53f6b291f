"""Grid buckets that turn distance and overlap conditions into equi-joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CELL = ("kx", "ky", "kz")


def cell_of(c: Column, size) -> Column:
    return F.floor(c / size).cast("long")


def with_cell(df: DataFrame, xyz, size, names=CELL) -> DataFrame:
    return df.withColumns({n: cell_of(F.col(c), size) for n, c in zip(names, xyz)})


def with_near_cells(df: DataFrame, xyz, size, names=CELL) -> DataFrame:
    """One row per cell of the 3 x 3 x 3 neighbourhood of the row's own cell."""
    around = F.array(
        *[
            F.struct(*[F.lit(v).cast("long").alias(n) for n, v in zip(("i", "j", "k"), (i, j, k))])
            for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)
        ]
    )
    df = with_cell(df, xyz, size, ("__i", "__j", "__k")).withColumn("__n", F.explode(around))
    return df.withColumns(
        {n: F.col(f"__{a}") + F.col(f"__n.{a}") for n, a in zip(names, ("i", "j", "k"))}
    ).drop("__i", "__j", "__k", "__n")


def with_box_cells(df: DataFrame, lo, hi, size, names=CELL) -> DataFrame:
    """One row per cell a closed box overlaps; ``lo`` and ``hi`` are columns."""
    for n, a, b in zip(names, lo, hi):
        df = df.withColumn(n, F.explode(F.sequence(cell_of(a, size), cell_of(b, size))))
    return df


def distance(a, b) -> Column:
    d = [F.col(p) - F.col(q) for p, q in zip(a, b)]
    return F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])
