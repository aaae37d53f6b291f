"""Digests that do not depend on row order, built from sum and bit_xor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

LIMBS = 8
BASE = 1 << 32


def limbs(text: Column) -> list[Column]:
    """SHA-256 of ``text`` as eight 32-bit numbers, most significant first."""
    h = F.sha2(text, 256)
    return [F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("long") for i in range(LIMBS)]


def _hex8(c: Column) -> Column:
    return F.lpad(F.lower(F.hex(c)), 8, "0")


def multiset_digest(df: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """Count, sum modulo 2^256 and XOR of the row hashes of each group.

    Limb sums stay below 2^63 for two thousand million rows of a group per
    partial, so sums are carried as decimals and the carry is applied once.
    """
    # One struct column keeps the hash from being computed once per limb.
    hashed = df.select(*keys, F.sha2(text, 256).alias("h"))
    parts = {
        f"l{i}": F.conv(F.substring("h", 8 * i + 1, 8), 16, 10).cast("long") for i in range(LIMBS)
    }
    hashed = hashed.select(*keys, *[c.alias(n) for n, c in parts.items()])
    aggs = [F.count(F.lit(1)).alias("n")]
    # High and low halves keep every sum inside a long for 2^47 rows.
    for i in range(LIMBS):
        aggs += [
            F.sum(F.shiftright(f"l{i}", 16)).alias(f"h{i}"),
            F.sum(F.col(f"l{i}").bitwiseAND(F.lit(65535))).alias(f"w{i}"),
            F.bit_xor(f"l{i}").alias(f"x{i}"),
        ]
    out = hashed.groupBy(*keys).agg(*aggs)
    carry: Column = F.lit(0).cast("long")
    digits: list[Column] = []
    # Carry from the least significant 16 bits upwards.
    for i in reversed(range(LIMBS)):
        low = F.col(f"w{i}") + carry
        high = F.col(f"h{i}") + F.shiftright(low, 16)
        out = out.withColumn(f"lo{i}", low.bitwiseAND(F.lit(65535))).withColumn(f"hi{i}", high)
        carry = F.shiftright(F.col(f"hi{i}"), 16)
        digits.insert(
            0,
            _hex8(
                F.shiftleft(F.col(f"hi{i}").bitwiseAND(F.lit(65535)), 16).bitwiseOR(F.col(f"lo{i}"))
            ),
        )
    return out.select(
        *keys,
        "n",
        F.concat(*digits).alias("sha256_sum"),
        F.concat(*[_hex8(F.col(f"x{i}")) for i in range(LIMBS)]).alias("sha256_xor"),
    )


def canonical(*cols: Column) -> Column:
    """Fields joined with an unprintable separator; nulls are told apart."""
    return F.concat_ws("\u0001", *[F.coalesce(c.cast("string"), F.lit("\u0000")) for c in cols])


def fixed9(c: Column) -> Column:
    return F.format_string("%.9f", c + F.lit(0.0))
