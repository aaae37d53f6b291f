"""Local frames, rotated squares and their identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..contract import HALF_SIDE_MM, SIDE_MM
from ..functions.angles import ROTATION, angle_grid, policy_dim
from ..functions.identity import pose_id, pose_order, source_priority, yaw_policy
from ..functions.linalg import add, cross, dot, scale, sub, vec, with_unit, with_vec
from ..session import width

POINT_KEY = ("case_id", "organ", "point_index")
AXES = ("ax", "ay", "az", "hx", "hy", "hz", "cx", "cy", "cz")
VERTICES = tuple(f"v{i}{a}" for i in range(1, 5) for a in "xyz")
REVERSED = ("liver", "pancreas")
UNIT_ROUNDING = 1e-15


def with_policy(points: DataFrame, aorta_max_x: Column) -> DataFrame:
    """Yaw policy of every point; the limit may be a column or a literal."""
    return points.withColumn(
        "yaw_policy",
        yaw_policy(F.col("organ"), F.col("source_region"), F.col("x"), F.col("target_ids"), aorta_max_x),
    )


def ordinary_frames(points: DataFrame, anchor: tuple[Column, Column, Column], forward=None) -> DataFrame:
    """x along the forward direction, y away from the anchor, z = x cross y.

    Degenerate points get a false ``frame_ok`` and null axes; nothing fails.
    """
    if forward is None:
        sign = F.when(F.col("organ").isin(*REVERSED), F.lit(-1.0)).otherwise(F.lit(1.0))
        forward = scale(vec("nx", "ny", "nz"), sign)
    df = with_unit(points, ("ax", "ay", "az"), forward, "__fl")
    # a direction of unit length, up to rounding, stays as it is
    unit = F.abs(F.col("__fl") - 1.0) <= UNIT_ROUNDING
    df = df.withColumns({n: F.when(unit, f).otherwise(F.col(n)) for n, f in zip(("ax", "ay", "az"), forward)})
    df = with_vec(df, ("__rx", "__ry", "__rz"), sub(vec("x", "y", "z"), anchor))
    df = df.withColumn("__rd", dot(vec("__rx", "__ry", "__rz"), vec("ax", "ay", "az")))
    proj = sub(vec("__rx", "__ry", "__rz"), scale(vec("ax", "ay", "az"), F.col("__rd")))
    df = with_unit(df, ("hx", "hy", "hz"), proj, "__yl")
    df = with_vec(df, ("cx", "cy", "cz"), cross(vec("ax", "ay", "az"), vec("hx", "hy", "hz")))
    return df.withColumn("frame_ok", F.col("hx").isNotNull()).drop(
        "__fl", "__rx", "__ry", "__rz", "__rd", "__yl"
    )


def duodenum_frames(points: DataFrame) -> DataFrame:
    """Frame from the nearest centreline point, joined on as mx..mz, tx..tz."""
    df = with_unit(points, ("__nx", "__ny", "__nz"), vec("nx", "ny", "nz"), "__nl")
    df = with_vec(df, ("__rx", "__ry", "__rz"), sub(vec("x", "y", "z"), vec("mx", "my", "mz")))
    df = with_unit(df, ("__tx", "__ty", "__tz"), vec("tx", "ty", "tz"), "__tl")
    df = with_unit(
        df, ("cx", "cy", "cz"), cross(vec("__tx", "__ty", "__tz"), vec("__rx", "__ry", "__rz")), "__zl"
    )
    df = df.withColumn("__nd", dot(vec("__nx", "__ny", "__nz"), vec("cx", "cy", "cz")))
    df = with_unit(
        df, ("ax", "ay", "az"),
        sub(vec("__nx", "__ny", "__nz"), scale(vec("cx", "cy", "cz"), F.col("__nd"))), "__xl",
    )
    df = with_unit(df, ("hx", "hy", "hz"), cross(vec("cx", "cy", "cz"), vec("ax", "ay", "az")), "__yl")
    ok = F.col("hx").isNotNull() & (dot(vec("ax", "ay", "az"), vec("__nx", "__ny", "__nz")) > 0)
    return df.withColumn("frame_ok", F.coalesce(ok, F.lit(False))).drop(
        *[f"__{c}" for c in ("nx", "ny", "nz", "nl", "rx", "ry", "rz", "tx", "ty", "tz", "tl", "zl", "nd", "xl", "yl")]
    )


def expand(frames: DataFrame, keep: tuple[str, ...] = (), by: tuple[str, ...] = POINT_KEY, tasks: int = 0) -> DataFrame:
    """Every pose of every point.

    The few point rows are spread over all tasks first, because each becomes
    thousands of rows; the angle grid has a fixed size and is broadcast. The
    exchange also splits the generated code between frame and pose. Points of
    equal ``by`` share a task, so groups within them need no other exchange;
    ``tasks`` asks for more tasks than the session's width.
    """
    spark = frames.sparkSession
    cols = dict.fromkeys((*POINT_KEY, "yaw_policy", "x", "y", "z", *AXES, *keep))
    spread = frames.select(*cols).repartition(max(width(spark), tasks), *by)
    df = spread.join(F.broadcast(angle_grid(spark)), "yaw_policy")
    base = [vec("ax", "ay", "az"), vec("hx", "hy", "hz"), vec("cx", "cy", "cz")]

    def rotated(j):
        return add(
            add(scale(base[0], F.col(f"r0{j}")), scale(base[1], F.col(f"r1{j}"))),
            scale(base[2], F.col(f"r2{j}")),
        )

    out = {}
    for j, name in enumerate("xyz"):
        for axis, c in zip("xyz", rotated(j)):
            out[f"p{name}{axis}"] = c
    df = df.withColumns(out)
    probe, px, py = vec("x", "y", "z"), vec("pxx", "pxy", "pxz"), vec("pyx", "pyy", "pyz")
    left, right = sub(probe, scale(py, HALF_SIDE_MM)), add(probe, scale(py, HALF_SIDE_MM))
    depth = scale(px, SIDE_MM)
    corners = [left, right, add(right, depth), add(left, depth)]
    df = df.withColumns(
        {f"v{i + 1}{a}": c for i, corner in enumerate(corners) for a, c in zip("xyz", corner)}
    )
    return df.drop(*ROTATION, *AXES).withColumnsRenamed(
        {f"p{n}{a}": f"{s}{a}" for n, s in zip("xyz", "ahc") for a in "xyz"}
    )


def with_identity(poses: DataFrame) -> DataFrame:
    return poses.withColumns(
        {
            "slice_id": pose_id(*(F.col(c) for c in ("organ", "point_index", "roll", "pitch", "yaw"))),
            "pose_ord": pose_order(F.col("organ"), F.col("point_index"), F.col("ang_ord")),
        }
    )


def with_priority(df: DataFrame) -> DataFrame:
    return df.withColumn("priority", source_priority(F.col("organ"), F.col("source_region")))


def base_poses(frames: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The unrotated square of every point, straight from its frame."""
    cols = dict.fromkeys((*POINT_KEY, "yaw_policy", "x", "y", "z", *AXES, *keep))
    df = frames.select(*cols)
    probe, px, py = vec("x", "y", "z"), vec("ax", "ay", "az"), vec("hx", "hy", "hz")
    left, right = sub(probe, scale(py, HALF_SIDE_MM)), add(probe, scale(py, HALF_SIDE_MM))
    depth = scale(px, SIDE_MM)
    corners = [left, right, add(right, depth), add(left, depth)]
    return df.withColumns(
        {
            **{f"v{i + 1}{a}": c for i, corner in enumerate(corners) for a, c in zip("xyz", corner)},
            "roll": F.lit(0), "pitch": F.lit(0), "yaw": F.lit(0),
        }
    )


def vertex_array() -> Column:
    return F.array(
        *[F.struct(*[F.col(f"v{i}{a}").alias(a) for a in "xyz"]) for i in range(1, 5)]
    )


def inside_box(lo: tuple, hi: tuple) -> Column:
    """All four corners within closed bounds; squares are affine, so corners decide."""
    test = F.lit(True)
    for i in range(1, 5):
        for a, l, h in zip("xyz", lo, hi):
            test = test & (F.col(f"v{i}{a}") >= l) & (F.col(f"v{i}{a}") <= h)
    return test


def square_frame(df: DataFrame) -> DataFrame:
    """In-plane axes u and v, normal w, centre and side lengths of a square."""
    v1, v2, v3, v4 = (vec(*(f"v{i}{a}" for a in "xyz")) for i in range(1, 5))
    df = with_unit(df, ("ux", "uy", "uz"), sub(v2, v1), "width_mm")
    df = with_unit(df, ("vx", "vy", "vz"), sub(v4, v1), "length_mm")
    df = with_unit(
        df, ("wx", "wy", "wz"), cross(vec("ux", "uy", "uz"), vec("vx", "vy", "vz")), "__wl"
    ).drop("__wl")
    centre = scale(add(v1, v3), 0.5)
    return with_vec(df, ("mx", "my", "mz"), centre)


def candidate_counts(points: DataFrame, keys: list[str]) -> DataFrame:
    """Number of poses per group without expanding them."""
    dim = policy_dim(points.sparkSession).select("yaw_policy", "n_poses")
    return points.join(F.broadcast(dim), "yaw_policy").groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_points"), F.sum("n_poses").alias("n_poses")
    )


def point_plan(frames: DataFrame) -> DataFrame:
    """One contract row per point: axes, policy and number of poses."""
    dim = policy_dim(frames.sparkSession).select("yaw_policy", F.col("n_poses").alias("candidate_pose_count"))
    return frames.join(F.broadcast(dim), "yaw_policy").select(
        *POINT_KEY, "x", "y", "z", "nx", "ny", "nz", "source_region", "yaw_policy", "target_ids",
        *AXES, "candidate_pose_count",
    )
