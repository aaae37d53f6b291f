"""Which poses of a point are finished, held as one bit a place of the angle grid.

Finished poses become bits before they are shuffled: a task sends one number for 64 places of a point, and numbers of
the same place are merged by ``bit_or``. What is still open is the grid of the point's policy without these bits, worked
out where the point is; so neither planned nor finished poses are shuffled.

Repeated finished poses set the same bit. A finished pose whose angles lie on no grid, or whose point no plan has, is
stale. Points without finished poses are open whole; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..contract import ANGLE_STEP, PITCH_RANGE, ROLL_RANGE, YAW_RANGES
from ..functions.angles import angle_count, angle_grid

ANGLES = ["roll", "pitch", "yaw"]
#: One range of yaw that holds those of all policies.
YAW = (min(lo for lo, _ in YAW_RANGES.values()), max(hi for _, hi in YAW_RANGES.values()))
N_ROLL, N_PITCH, N_YAW = (angle_count(r) for r in (ROLL_RANGE, PITCH_RANGE, YAW))
WORDS = -(-N_ROLL * N_PITCH * N_YAW // 64)


def place(roll: Column, pitch: Column, yaw: Column) -> Column:
    """Number of the three angles on the widest grid, null if one is on no step of it."""
    steps, inside = [], F.lit(True)
    for angle, (lo, hi) in ((roll, ROLL_RANGE), (pitch, PITCH_RANGE), (yaw, YAW)):
        inside = inside & angle.between(lo, hi) & (F.pmod(angle - lo, F.lit(ANGLE_STEP)) == 0)
        steps.append(F.floor((angle - lo) / ANGLE_STEP))
    return F.when(inside, (steps[2] * N_PITCH + steps[1]) * N_ROLL + steps[0]).cast("int")


def words_of(poses: DataFrame, key: list[str]) -> DataFrame:
    """(key, word, n): 64 places of each key as the bits of one number; words without a pose have no row."""
    at = poses.select(*key, place(*(F.col(a) for a in ANGLES)).alias("place")).where("place is not null")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place") % 64)
    return at.groupBy(*key, F.floor(F.col("place") / 64).cast("int").alias("word")).agg(F.bit_or(bit).alias("n"))


def bitmaps(poses: DataFrame, key: list[str]) -> DataFrame:
    """(key, bits): the places of each key's poses as an array of ``WORDS`` numbers of 64 bits."""
    held = words_of(poses, key).groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("held"))
    dense = F.transform(F.sequence(F.lit(0), F.lit(WORDS - 1)), lambda w: F.coalesce(F.element_at("held", w), F.lit(0).cast("long")))
    return held.select(*key, dense.alias("bits"))


def pending(points: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """(key, yaw_policy, angles): planned poses of ``points(key, yaw_policy)`` that ``done(key, angles)`` does not hold."""
    grid = angle_grid(points.sparkSession).select("yaw_policy", *ANGLES, place(*(F.col(a) for a in ANGLES)).alias("place"))
    rows = points.select(*key, "yaw_policy").join(bitmaps(done, key), key, "left").join(F.broadcast(grid), "yaw_policy")
    word = F.get("bits", F.floor(F.col("place") / 64).cast("int"))
    held = F.call_function("shiftright", word, F.col("place") % 64).bitwiseAND(F.lit(1).cast("long"))
    return rows.where(F.coalesce(held, F.lit(0).cast("long")) == 0).select(*key, "yaw_policy", *ANGLES)


def stale(points: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    """(key, angles): distinct finished poses that no plan of ``points`` has."""
    spark = points.sparkSession
    grids = words_of(angle_grid(spark), ["yaw_policy"]).withColumnRenamed("n", "planned")
    held = words_of(done, key).join(points.select(*key, "yaw_policy").distinct(), key, "left")
    left = F.col("n").bitwiseAND(F.bitwise_not(F.coalesce("planned", F.lit(0).cast("long"))))
    rows = held.join(F.broadcast(grids), ["yaw_policy", "word"], "left").select(*key, "word", left.alias("n"))
    # A key that two policies plan is stale only where neither has the place.
    rows = rows.groupBy(*key, "word").agg(F.bit_and("n").alias("n")).where("n <> 0")
    bits = F.sequence(F.lit(0), F.lit(63))
    rows = rows.select(*key, "word", F.explode(F.filter(bits, lambda b: F.call_function("shiftright", F.col("n"), b).bitwiseAND(F.lit(1).cast("long")) == 1)).alias("b"))
    at = F.col("word") * 64 + F.col("b")
    rows = rows.select(
        *key,
        (at % N_ROLL * ANGLE_STEP + ROLL_RANGE[0]).cast("int").alias("roll"),
        (F.floor(at / N_ROLL) % N_PITCH * ANGLE_STEP + PITCH_RANGE[0]).cast("int").alias("pitch"),
        (F.floor(at / (N_ROLL * N_PITCH)) * ANGLE_STEP + YAW[0]).cast("int").alias("yaw"))
    off = done.where(place(*(F.col(a) for a in ANGLES)).isNull()).select(*key, *ANGLES).distinct()
    return rows.unionByName(off)
