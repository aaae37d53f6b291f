"""The angle dimension: one row per policy and (roll, pitch, yaw)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..contract import ANGLE_STEP, PITCH_RANGE, ROLL_RANGE, YAW_RANGES

ROTATION = [f"r{i}{j}" for i in range(3) for j in range(3)]


def angle_count(bounds: tuple[int, int]) -> int:
    return (bounds[1] - bounds[0]) // ANGLE_STEP + 1


def policy_pose_count(policy: str) -> int:
    return angle_count(ROLL_RANGE) * angle_count(PITCH_RANGE) * angle_count(YAW_RANGES[policy])


def policy_dim(spark: SparkSession) -> DataFrame:
    """Four rows: policy and the number of poses it expands a point into."""
    rows = [(p, *YAW_RANGES[p], policy_pose_count(p)) for p in YAW_RANGES]
    return spark.createDataFrame(rows, "yaw_policy string, yaw_lo int, yaw_hi int, n_poses int")


def angle_grid(spark: SparkSession) -> DataFrame:
    """At most 24 700 rows, a size that does not depend on the data."""

    def steps(lo, hi):
        return F.sequence(lo, hi, F.lit(ANGLE_STEP))

    df = (
        policy_dim(spark)
        .select("yaw_policy", F.posexplode(steps(F.col("yaw_lo"), F.col("yaw_hi"))).alias("yi", "yaw"))
        .select("*", F.posexplode(steps(F.lit(PITCH_RANGE[0]), F.lit(PITCH_RANGE[1]))).alias("pi", "pitch"))
        .select("*", F.posexplode(steps(F.lit(ROLL_RANGE[0]), F.lit(ROLL_RANGE[1]))).alias("ri", "roll"))
    )
    trig = {}
    for short, name in (("y", "yaw"), ("p", "pitch"), ("r", "roll")):
        rad = F.radians(F.col(name).cast("double"))
        trig[f"s{short}"] = F.sin(rad)
        trig[f"c{short}"] = F.cos(rad)
    df = df.withColumns(trig)
    sy, cy, sp, cp, sr, cr = (F.col(n) for n in ("sy", "cy", "sp", "cp", "sr", "cr"))
    rot = {
        "r00": cy * cp,
        "r10": sy * cp,
        "r20": -sp,
        "r01": cy * sp * sr - sy * cr,
        "r11": sy * sp * sr + cy * cr,
        "r21": cp * sr,
        "r02": cy * sp * cr + sy * sr,
        "r12": sy * sp * cr - cy * sr,
        "r22": cp * cr,
    }
    n_roll, n_pitch = angle_count(ROLL_RANGE), angle_count(PITCH_RANGE)
    ang = (F.col("yi") * n_pitch + F.col("pi")) * n_roll + F.col("ri")
    return df.withColumns(rot).select(
        "yaw_policy", "roll", "pitch", "yaw", ang.cast("long").alias("ang_ord"), *ROTATION
    )
