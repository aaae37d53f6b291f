"""Which surface points may carry a probe: extremes, regions, merges."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from ..session import materialize

COS_105 = math.cos(math.radians(105.0))


def model_extremes(vertices: DataFrame) -> DataFrame:
    """Per case, the extremes of every model the filters refer to.

    One pass with conditional aggregates; one narrow row per case, written so
    that the planner sees its true size before it decides to broadcast.
    """
    m = F.col("model_id")

    def at(fn, model, col):
        return fn(F.when(m == model, F.col(col)))

    agg = vertices.groupBy("case_id").agg(
        at(F.min, "liver", "x").alias("liver_min_x"),
        at(F.max, "liver", "y").alias("liver_max_y"),
        at(F.max, "liver", "z").alias("liver_max_z"),
        at(F.min, "inferior_vena_cava", "x").alias("ivc_min_x"),
        at(F.max, "inferior_vena_cava", "x").alias("ivc_max_x"),
        at(F.max, "esophagus", "y").alias("esophagus_max_y"),
        at(F.min, "esophagus", "z").alias("esophagus_min_z"),
        at(F.max, "spleen", "x").alias("spleen_max_x"),
        at(F.max, "pancreas", "y").alias("pancreas_max_y"),
        at(F.min, "adrenal_gland_right", "z").alias("adrenal_min_z"),
        at(F.max, "aorta", "x").alias("aorta_max_x"),
    )
    return materialize(agg, "extremes")


def plateau_centroid(vertices: DataFrame, keys: list[str], axis: str, maximum: bool, atol: float = 1e-6) -> DataFrame:
    """Mean of the points within ``atol`` of the extreme along an axis."""
    extreme = (F.max if maximum else F.min)(axis)
    top = materialize(vertices.groupBy(*keys).agg(extreme.alias("__e")), "plateau")
    return (
        vertices.join(top, keys)
        .filter(F.abs(F.col(axis) - F.col("__e")) <= atol)
        .groupBy(*keys)
        .agg(*[F.avg(a).alias(f"{a}_centroid") for a in "xyz"], F.count(F.lit(1)).alias("n_plateau"))
    )


def _between_sorted(c, a, b):
    return (c >= F.least(a, b)) & (c <= F.greatest(a, b))


def liver_region_one(p: DataFrame) -> DataFrame:
    c = F.col
    return p.filter(
        _between_sorted(c("x"), c("liver_min_x") + 20.0, c("ivc_min_x"))
        & _between_sorted(c("y"), c("liver_max_y") - 20.0, c("esophagus_max_y"))
        & (c("nz") < 0)
    )


def liver_region_two(p: DataFrame) -> DataFrame:
    c = F.col
    return p.filter(
        _between_sorted(c("x"), c("spleen_max_x"), c("ivc_max_x"))
        & (c("y") < c("pancreas_max_y")) & (c("ny") < 0) & (c("nz") < 0)
    )


def duodenum_bulb(p: DataFrame) -> DataFrame:
    return p.filter(F.col("z") > F.col("adrenal_min_z"))


def duodenum_remainder(p: DataFrame) -> DataFrame:
    return p.filter((F.col("x") > F.col("aorta_max_x")) & ~(F.col("z") > F.col("adrenal_min_z")))


def esophagus_segment(p: DataFrame) -> DataFrame:
    return p.filter((F.col("z") >= F.col("esophagus_min_z")) & (F.col("z") <= F.col("liver_max_z")))


def pancreas_visible(p: DataFrame) -> DataFrame:
    """Needs ``x_centroid``, the top plateau of the duodenum, in the row."""
    return p.filter((F.col("x") < F.col("x_centroid")) & (F.col("nz") > COS_105) & (F.col("ny") > 0))


def with_translated_segment(segment: DataFrame) -> DataFrame:
    """The segment and a copy moved down by its own extent along z."""
    span = materialize(segment.groupBy("case_id").agg((F.max("z") - F.min("z")).alias("span")), "span")
    both = segment.join(span, "case_id")
    original = both.withColumn("segment", F.lit(0))
    moved = both.withColumns({"z": F.col("z") - F.col("span"), "segment": F.lit(1)})
    return original.unionByName(moved)


def merge_regions(df: DataFrame, order: str) -> DataFrame:
    """Equal points become one; region names join in first-seen order.

    ``df`` holds case_id, x..nz, region and an order number. A group holds at
    most one entry per region, because equal pairs are reduced first.
    """
    key = ["case_id", "x", "y", "z"]
    first = df.groupBy(*key, "region").agg(
        F.min(F.struct(order, "nx", "ny", "nz")).alias("f")
    )
    merged = first.groupBy(*key).agg(
        F.min("f").alias("f"),
        F.array_join(
            F.transform(
                F.array_sort(F.collect_list(F.struct(F.col(f"f.{order}").alias("o"), "region"))),
                lambda s: s["region"],
            ),
            "+",
        ).alias("source_region"),
    )
    return merged.select(*key, f"f.{order}", "f.nx", "f.ny", "f.nz", "source_region")


def merge_close(df: DataFrame, order: str, tolerance: float = 1e-9) -> DataFrame:
    """First of the points that agree within ``tolerance`` on each axis.

    Exact copies are folded first, so a hot group of copies is reduced map
    side. What remains is settled by rounds: a point with no earlier open
    neighbour stays, and takes its open neighbours with it.
    """
    from .dedup import first_kept

    key = ["case_id", "x", "y", "z"]
    sets = df.select("*", F.explode("target_ids").alias("t")).groupBy(*key).agg(
        F.array_sort(F.collect_set("t")).alias("targets")
    )
    folded = df.groupBy(*key).agg(F.min(F.struct(order, "nx", "ny", "nz")).alias("f"))
    nodes = folded.join(sets, key, "left").select(
        *key, F.col(f"f.{order}").alias("node"), "f.nx", "f.ny", "f.nz",
        F.coalesce("targets", F.array().cast("array<string>")).alias("targets"),
    )
    nodes = materialize(nodes, "close-nodes")
    owner = first_kept(nodes, ["case_id"], "node", "node", ("x", "y", "z"), tolerance)
    tagged = nodes.join(owner, ["case_id", "node"])
    groups = (
        tagged.select("case_id", "owner", F.explode_outer("targets").alias("t"))
        .groupBy("case_id", "owner").agg(F.array_sort(F.collect_set("t")).alias("target_ids"))
    )
    kept = tagged.filter("owner = node").drop("owner", "targets")
    return kept.join(groups.withColumnRenamed("owner", "node"), ["case_id", "node"]).withColumnRenamed("node", order)


def map_targets_back(points: DataFrame, source: DataFrame) -> DataFrame:
    """Target sets of selected points by exact coordinates; a miss is an error."""
    key = ["case_id", "x", "y", "z"]
    sets = source.select(*key, F.explode_outer("target_ids").alias("t")).groupBy(*key).agg(
        F.array_sort(F.collect_set("t")).alias("mapped_targets"), F.lit(True).alias("__hit")
    )
    out = points.join(sets, key, "left")
    missing = F.raise_error(F.lit("a selected point has no target evidence")).cast("boolean")
    return out.filter(F.coalesce(F.col("__hit"), missing)).drop("__hit")
