"""Three-vectors as tuples of columns; everything stays in generated code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..contract import UNIT_EPS

Vec = tuple[Column, Column, Column]


def vec(*names: str) -> Vec:
    return tuple(F.col(n) for n in names)  # type: ignore[return-value]


def lit3(values) -> Vec:
    return tuple(F.lit(float(v)) for v in values)  # type: ignore[return-value]


def dot(a: Vec, b: Vec) -> Column:
    return a[0] * b[0] + a[1] * b[1] + a[2] * b[2]


def cross(a: Vec, b: Vec) -> Vec:
    return (
        a[1] * b[2] - a[2] * b[1],
        a[2] * b[0] - a[0] * b[2],
        a[0] * b[1] - a[1] * b[0],
    )


def add(a: Vec, b: Vec) -> Vec:
    return (a[0] + b[0], a[1] + b[1], a[2] + b[2])


def sub(a: Vec, b: Vec) -> Vec:
    return (a[0] - b[0], a[1] - b[1], a[2] - b[2])


def scale(a: Vec, s) -> Vec:
    return (a[0] * s, a[1] * s, a[2] * s)


def norm(a: Vec) -> Column:
    return F.sqrt(dot(a, a))


def with_vec(df, names, value: Vec):
    """Add three columns in one projection."""
    return df.withColumns(dict(zip(names, value)))


def with_unit(df, names, value: Vec, length: str):
    """Add ``value`` and its length, then divide; too short gives null."""
    raw = [f"__{n}" for n in names]
    df = df.withColumns(dict(zip(raw, value)))
    df = df.withColumn(length, norm(vec(*raw)))
    ok = F.col(length) >= UNIT_EPS
    df = df.withColumns({n: F.when(ok, F.col(r) / F.col(length)) for n, r in zip(names, raw)})
    return df.drop(*raw)


def inverse3(m: list[list[Column]]) -> list[list[Column]]:
    """Cofactor inverse of a 3x3 matrix of columns."""
    (a, b, c), (d, e, f), (g, h, i) = m
    det = a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)
    cof = [
        [e * i - f * h, c * h - b * i, b * f - c * e],
        [f * g - d * i, a * i - c * g, c * d - a * f],
        [d * h - e * g, b * g - a * h, a * e - b * d],
    ]
    return [[x / det for x in row] for row in cof]


def r6(c: Column) -> Column:
    """Six decimals without a negative zero, the form results are compared in.

    The binary value is scaled and rounded, as SQL engines round doubles;
    Spark's own rounding starts from the shortest decimal form.
    """
    return F.round(c * F.lit(1e6), 0) / F.lit(1e6) + F.lit(0.0)
