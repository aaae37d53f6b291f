"""Pose identifiers: build, take apart, accept only canonical ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..contract import POSE_ORGAN_ORDER, SAMPLING_ORGANS

POSE_ID_PATTERN = (
    "^(" + "|".join(SAMPLING_ORGANS) + r")-(\d{6})-r([mpz]\d{3})-p([mpz]\d{3})-y([mpz]\d{3})$"
)


def angle_token(a: Column) -> Column:
    sign = F.when(a < 0, F.lit("m")).when(a > 0, F.lit("p")).otherwise(F.lit("z"))
    return F.concat(sign, F.lpad(F.abs(a).cast("string"), 3, "0"))


def padded_index(i: Column) -> Column:
    """Six digits at least; longer numbers keep all their digits."""
    text = i.cast("string")
    return F.when(F.length(text) < 6, F.lpad(text, 6, "0")).otherwise(text)


def pose_id(organ: Column, index: Column, roll: Column, pitch: Column, yaw: Column) -> Column:
    return F.concat(
        organ, F.lit("-"), padded_index(index),
        F.lit("-r"), angle_token(roll), F.lit("-p"), angle_token(pitch), F.lit("-y"), angle_token(yaw),
    )


def _angle(token: Column) -> Column:
    n = F.substring(token, 2, 3).try_cast("int")
    head = F.substring(token, 1, 1)
    return F.when(head == "m", -n).when(head == "p", n).when(n == 0, F.lit(0))


PARTS = ("organ", "point_index", "roll", "pitch", "yaw")


def with_decoded(df: DataFrame, text: str, prefix: str = "") -> DataFrame:
    """Add the parts of an identifier; all null unless it encodes back to itself.

    Split, read, and check are three projections: each small, the text is
    taken apart once, and the pattern is matched once.
    """
    p = F.split(F.when(F.col(text).rlike(POSE_ID_PATTERN), F.col(text)), "-")
    df = df.withColumn("__p", p)
    raw = [F.try_element_at("__p", F.lit(i)) for i in range(1, 6)]
    df = df.withColumns({
        "__organ": raw[0], "__point_index": raw[1].try_cast("int"),
        **{f"__{n}": _angle(F.substring(c, 2, 4)) for n, c in zip(("roll", "pitch", "yaw"), raw[2:])}})
    same = pose_id(*(F.col(f"__{n}") for n in PARTS)) == F.col(text)
    df = df.withColumn("__ok", F.coalesce(same, F.lit(False)))
    return df.withColumns({f"{prefix}{n}": F.when(F.col("__ok"), F.col(f"__{n}")) for n in PARTS}).drop(
        "__p", "__ok", *[f"__{n}" for n in PARTS])


def organ_rank(organ: Column) -> Column:
    return F.array_position(F.array(*[F.lit(o) for o in POSE_ORGAN_ORDER]), organ) - 1


def pose_order(organ: Column, index: Column, ang_ord: Column) -> Column:
    """Protocol order as one number: organ, point, yaw, pitch, roll."""
    return (organ_rank(organ) * F.lit(10_000_000_000) + index.cast("long")) * 10_000 + ang_ord


def source_priority(organ: Column, region: Column) -> Column:
    return F.when(organ.isin("liver", "pancreas") | region.contains("supplement"), F.lit(1)).otherwise(F.lit(0))


def yaw_policy(organ: Column, region: Column, x: Column, targets: Column, limit: Column) -> Column:
    special = (organ == "pancreas") | ((organ == "stomach") & F.array_contains(targets, "pancreas"))
    two = F.array_contains(F.split(region, r"\+"), "liver_region_two")
    return (
        F.when(region == "duodenum_bulb", F.lit("duodenum_bulb"))
        .when((organ == "liver") & two, F.lit("liver_region_two"))
        .when(special & (x > limit), F.lit("pancreas_special"))
        .otherwise(F.lit("standard"))
    )
