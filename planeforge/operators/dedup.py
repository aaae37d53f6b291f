"""Duplicate resolution: the earliest of a set of near-equal rows stays."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import materialize
from .graph import connected_components


#: Edge of the cells in which near squares are sought, far wider than any tolerance.
CELL_MM = 1e-3


def _near_pairs(nodes: DataFrame, keys: list[str], node: str, rank: str, coords, tolerance: float) -> DataFrame:
    """Pairs (node, earlier neighbour) that agree within tolerance everywhere.

    Buckets use the first three coordinates with cells far wider than the
    tolerance; a row is repeated only when it lies next to a cell wall.
    """
    size = CELL_MM
    c3 = coords[:3]
    cells = [
        F.array_distinct(F.array(
            F.floor((F.col(c) - tolerance) / size), F.floor((F.col(c) + tolerance) / size)))
        for c in c3
    ]
    cols = [*keys, node, *([rank] if rank != node else []), *coords]
    right = nodes.select(*cols)
    for i, c in enumerate(cells):
        right = right.withColumn(f"__k{i}", F.explode(c))
    left = nodes.select(*cols).withColumns({f"__k{i}": F.floor(F.col(c) / size) for i, c in enumerate(c3)})
    ren = {c: f"r_{c}" for c in dict.fromkeys((node, rank, *coords))}
    right = right.withColumnsRenamed(ren)
    joined = left.join(right, [*keys, "__k0", "__k1", "__k2"])
    earlier = (F.col(f"r_{rank}") < F.col(rank)) | (
        (F.col(f"r_{rank}") == F.col(rank)) & (F.col(f"r_{node}") < F.col(node))
    )
    same = F.lit(True)
    for c in coords:
        same = same & (F.abs(F.col(c) - F.col(f"r_{c}")) <= tolerance)
    return joined.filter(earlier & same).select(
        *keys, F.col(node).alias("node"), F.col(rank).alias("rank"),
        F.col(f"r_{node}").alias("nbr"), F.col(f"r_{rank}").alias("nbr_rank"),
    )


def first_kept(nodes: DataFrame, keys: list[str], node: str, rank: str, coords, tolerance: float) -> DataFrame:
    """Owner of every node under the greedy rule "first come, neighbours go".

    A node whose earlier neighbours are all absorbed is kept; a node next to
    an earlier kept node is absorbed by the earliest such node. Rounds settle
    all nodes whose fate no longer depends on open ones, so there is no
    chaining through the tolerance and no group is handled by one task.
    """
    pairs = materialize(_near_pairs(nodes, keys, node, rank, coords, tolerance), "near-pairs")
    state = nodes.select(*keys, F.col(node).alias("node"))
    if pairs.isEmpty():
        return state.withColumn("owner", F.col("node")).withColumnRenamed("node", node)
    touched = pairs.select(*keys, "node").distinct()
    status = state.join(touched.withColumn("t", F.lit(1)), [*keys, "node"], "left").select(
        *keys, "node", F.when(F.col("t").isNull(), F.lit("kept")).otherwise("open").alias("st"),
    )
    status = materialize(status, "dedup-status")
    while not status.filter("st = 'open'").isEmpty():
        look = pairs.join(
            status.select(*keys, F.col("node").alias("nbr"), F.col("st").alias("nst")), [*keys, "nbr"]
        ).groupBy(*keys, "node").agg(
            F.max(F.col("nst") == "kept").alias("any_kept"), F.max(F.col("nst") == "open").alias("any_open")
        )
        status = materialize(
            status.join(look, [*keys, "node"], "left").select(
                *keys, "node",
                F.when(F.col("st") != "open", F.col("st"))
                .when(F.col("any_kept"), F.lit("gone"))
                .when(F.col("any_open"), F.lit("open")).otherwise("kept").alias("st"),
            ),
            "dedup-status",
        )
    kept_nbr = pairs.join(
        status.filter("st = 'kept'").select(*keys, F.col("node").alias("nbr")), [*keys, "nbr"], "left_semi"
    ).groupBy(*keys, "node").agg(F.min(F.struct("nbr_rank", "nbr")).alias("w"))
    out = status.join(kept_nbr, [*keys, "node"], "left").select(
        *keys, "node", F.when(F.col("st") == "kept", F.col("node")).otherwise(F.col("w.nbr")).alias("owner")
    )
    return out.withColumnRenamed("node", node)


def _shared_cells(points: DataFrame, cell_mm: float) -> DataFrame:
    """(case_id, organ, point_index, hub) for each cell a point shares with another; the hub is the cell's least point."""
    key = ["case_id", "__k0", "__k1", "__k2"]
    cells = points.select(
        "case_id", "organ", "point_index", F.xxhash64("organ", "point_index").alias("__n"),
        *[
            F.array_distinct(F.array(
                F.floor((F.col(c) - 1e-9) / cell_mm), F.floor((F.col(c) + 1e-9) / cell_mm))).alias(f"__a{i}")
            for i, c in enumerate("xyz")
        ],
    )
    for i in range(3):
        cells = cells.withColumn(f"__k{i}", F.explode(f"__a{i}"))
    busy = cells.groupBy(*key).agg(F.count(F.lit(1)).alias("n"), F.min("__n").alias("hub")).filter("n > 1")
    return cells.join(busy, key).select("case_id", "organ", "point_index", "__n", "hub")


def coincident_points(points: DataFrame, cell_mm: float = 1e-6) -> DataFrame:
    """Points whose probe cell, or a cell next to it, holds another point.

    Squares can only coincide when the midpoints of their bottom edges do, so
    this reduction runs on points, thousands of times fewer than poses.
    """
    return _shared_cells(points, cell_mm).select("case_id", "organ", "point_index").distinct()


def coincident_clusters(points: DataFrame, cell_mm: float = 1e-6) -> DataFrame:
    """(case_id, organ, point_index, cluster) of the coincident points.

    Points linked by shared cells are in one cluster, so squares that coincide
    are too. Two clusters may get one number; that only puts them together.
    """
    cells = materialize(_shared_cells(points, cell_mm), "shared-cells", grows=True)
    key = ["case_id", "organ", "point_index"]
    by_point = cells.groupBy(*key, "__n").agg(F.min("hub").alias("cluster"), F.max("hub").alias("__m"))
    if not by_point.filter("cluster <> __m").isEmpty():  # a point at a cell wall links two cells
        edges = cells.select("case_id", F.col("__n").alias("src"), F.col("hub").alias("dst"))
        nodes = cells.select("case_id", F.col("__n").alias("node")).distinct()
        found = connected_components(nodes, edges, ["case_id"]).withColumnsRenamed({"node": "__n", "comp": "cluster"})
        by_point = by_point.drop("cluster").join(found, ["case_id", "__n"])
    return by_point.select(*key, "cluster")


def resolve_duplicates(poses: DataFrame, coords, tolerance: float) -> DataFrame:
    """Owner of every pose: itself when kept, else the pose that absorbs it.

    Poses with bit-equal corners are folded by a partial aggregate first: the
    smallest (priority, order) stands for the whole group, however many there
    are. Only the distinct squares go through the tolerance rounds.
    """
    key = ["case_id", *coords]
    folded = poses.groupBy(*key).agg(
        F.min(F.struct("priority", "pose_ord")).alias("f"), F.count(F.lit(1)).alias("n")
    )
    nodes = folded.select(
        *key, F.col("f.pose_ord").alias("node"),
        F.col("f.priority").alias("__p"), "n",
    )
    nodes = nodes.withColumn("rank", F.struct(F.col("__p").alias("p"), F.col("node").alias("o"))).drop("__p")
    nodes = materialize(nodes, "squares")
    owner = first_kept(nodes, ["case_id"], "node", "rank", coords, tolerance)
    by_square = nodes.select(*key, "node").join(owner, ["case_id", "node"]).drop("node")
    return poses.join(by_square, key)


def resolve_in_place(poses: DataFrame, coords, tolerance: float, within: list[str], carry: tuple[str, ...] = ()) -> DataFrame:
    """``resolve_duplicates`` for poses that are dealt to tasks by ``within``, equal for squares that can coincide.

    Bit-equal squares meet in a window of their task and no pose is shuffled.
    Only distinct squares that share a cell go through the tolerance rounds.
    The owner's ``carry`` columns are added as ``owner_<name>``. A task holds
    all poses of its groups: many copies of one square belong to the other.
    """
    group = ["case_id", *within]
    # The hash leads the sort; the coordinates themselves decide.
    rows = poses.withColumn("__h", F.xxhash64(*[F.col(c) + 0.0 for c in coords]))
    own = F.struct(F.col("pose_ord").alias("owner"), *[F.col(c).alias(f"owner_{c}") for c in carry])
    first = F.min(F.struct("priority", "pose_ord", own.alias("own"))).over(W.partitionBy(*group, "__h", *coords))
    rows = rows.withColumn("__f", first).drop("__h")
    nodes = rows.filter("pose_ord = __f.pose_ord").select(*group, *coords, F.col("pose_ord").alias("node"), F.col("priority").alias("__p"), own.alias("own"))
    cells = [
        F.array_distinct(F.array(F.floor((F.col(c) - tolerance) / CELL_MM), F.floor((F.col(c) + tolerance) / CELL_MM)))
        for c in coords[:3]
    ]
    near = nodes
    for i, c in enumerate(cells):
        near = near.withColumn(f"__k{i}", F.explode(c))
    at = ["__k0", "__k1", "__k2"]
    near = near.withColumn("__m", F.count(F.lit(1)).over(W.partitionBy(*group, *at))).filter("__m > 1").drop("__m", *at)
    near = materialize(near, "near-squares", grows=True).distinct()
    near = near.withColumn("rank", F.struct(F.col("__p").alias("p"), F.col("node").alias("o")))
    rows = rows.withColumn("own", F.col("__f.own")).drop("__f")
    if not near.isEmpty():
        moved = first_kept(near, group, "node", "rank", coords, tolerance).filter("owner <> node")
        kept = near.select(*group, F.col("node").alias("owner"), F.col("own").alias("to"))
        moved = materialize(moved.join(kept, [*group, "owner"]).drop("owner"), "moved-squares")
        rows = rows.withColumn("node", F.col("own.owner")).join(moved, [*group, "node"], "left")
        rows = rows.withColumn("own", F.coalesce("to", "own")).drop("node", "to")
    return rows.select(*[F.col(c) for c in poses.columns], "own.*")
