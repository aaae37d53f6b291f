"""Manifest rows: validity, reconciliation, resume, summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .. import contract as K
from ..functions.angles import policy_dim
from ..functions.digest import multiset_digest
from ..functions.linalg import cross, dot, vec

HEX40 = "^[0-9a-fA-F]{40}$"


def violations(*checks: tuple[str, Column]) -> Column:
    """Names of the failed checks of a row; an unknown outcome counts as failed."""
    return F.array_compact(F.array(*[
        F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in checks]))


def count_kinds(df: DataFrame, column: str, keys: list[str]) -> DataFrame:
    return df.select(*keys, F.explode(column).alias("kind")).groupBy(*keys, "kind").agg(F.count(F.lit(1)).alias("n"))


# --- one row ------------------------------------------------------------------------
def _in_steps(c: Column, bounds) -> Column:
    return (c >= bounds[0]) & (c <= bounds[1]) & ((c - bounds[0]) % K.ANGLE_STEP == 0)


def protocol_checks() -> list[tuple[str, Column]]:
    """Organ, region, policy and angles must fit each other."""
    organ, region, policy = F.col("organ"), F.col("source_region"), F.col("yaw_policy")
    region_ok = F.lit(False)
    for o, rs in K.REGIONS_BY_ORGAN.items():
        region_ok = region_ok | ((organ == o) & region.isin(*rs))
    two = F.array_contains(F.split(region, r"\+"), "liver_region_two")
    expected = (
        F.when(organ == "liver", F.when(two, "liver_region_two").otherwise("standard"))
        .when(organ == "duodenum", F.when(region == "duodenum_bulb", "duodenum_bulb").otherwise("standard"))
        .when(organ == "esophagus", "standard")
    )
    free = organ.isin("stomach", "pancreas")
    fits = F.when(free, policy.isin("standard", "pancreas_special")).otherwise(policy == expected)
    lacks = (organ == "stomach") & (policy == "pancreas_special") & ~F.array_contains("target_ids", "pancreas")
    yaw_ok = F.lit(False)
    for p, b in K.YAW_RANGES.items():
        yaw_ok = yaw_ok | ((policy == p) & _in_steps(F.col("yaw"), b))
    return [
        ("organ", ~organ.isin(*K.SAMPLING_ORGANS)),
        ("source_region", ~region_ok),
        ("yaw_policy", ~policy.isin(*K.YAW_RANGES)),
        ("region_policy", ~fits),
        ("missing_pancreas_target", lacks),
        ("roll", ~_in_steps(F.col("roll"), K.ROLL_RANGE)),
        ("pitch", ~_in_steps(F.col("pitch"), K.PITCH_RANGE)),
        ("yaw", ~yaw_ok),
    ]


def axes_ok(a=("ax", "ay", "az"), b=("hx", "hy", "hz"), c=("cx", "cy", "cz"), tol: float = 1e-8) -> Column:
    """Unit, orthogonal, right handed."""
    x, y, z = vec(*a), vec(*b), vec(*c)
    unit = F.lit(True)
    for v in (x, y, z):
        unit = unit & (F.abs(dot(v, v) - 1.0) <= tol)
    for v, w in ((x, y), (x, z), (y, z)):
        unit = unit & (F.abs(dot(v, w)) <= tol)
    return unit & (dot(cross(x, y), z) > 0)


def pose_record_checks(design: str = K.DESIGN_SHA256) -> list[tuple[str, Column]]:
    lists = [
        (n, F.col(n).isNull() | (F.size(F.array_distinct(n)) != F.size(n)))
        for n in ("target_ids", "duplicate_source_regions", "duplicate_source_pose_ids")
    ]
    return [
        ("coordinate_system", F.col("coordinate_system") != "RAS"),
        ("core_design_sha256", F.col("core_design_sha256") != design),
        ("build_git_commit", ~F.col("build_git_commit").rlike(HEX40)),
        ("source_region_empty", F.length("source_region") == 0),
        ("local_axes_world", ~axes_ok()),
        *lists,
    ]


def candidate_organs(labels: str) -> Column:
    """Sorted visible labels that are in the catalogue."""
    return F.array_sort(F.array_intersect(labels, F.array(*[F.lit(n) for n in K.CATALOG_IDS])))


def gallery_organ_checks() -> list[tuple[str, Column]]:
    names = F.array(*[F.lit(n) for n in K.BOUNDARY_ORGANS])
    return [
        ("schema_version", F.col("organ_metadata_schema_version") != K.ORGAN_METADATA_VERSION),
        ("organ_labels", (F.size(F.array_except("organ_labels", names)) > 0)
         | (F.array_sort(F.array_distinct("organ_labels")) != F.col("organ_labels"))),
        ("candidates", F.col("eus_candidate_organ_labels") != candidate_organs("organ_labels")),
    ]


def feature_bad(f, labels) -> Column:
    def finite(c):
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))

    return (
        ~F.coalesce(f["label"].isin(*labels), F.lit(False))
        | ~finite(f["x_mm"]) | ~finite(f["y_mm"]) | ~finite(f["area_mm2"]) | ~F.coalesce(f["area_mm2"] > 0, F.lit(False))
    )


def gallery_vessel_checks() -> list[tuple[str, Column]]:
    ids = F.array(*[F.lit(n) for n in K.VESSEL_IDS])
    return [
        ("schema_version", F.col("eus_vessel_metadata_schema_version") != K.VESSEL_METADATA_VERSION),
        ("labels", (F.size(F.array_except("eus_vessel_labels", ids)) > 0)
         | (F.array_sort(F.array_distinct("eus_vessel_labels")) != F.col("eus_vessel_labels"))),
        ("features", F.exists("eus_vessel_features", lambda f: feature_bad(f, K.VESSEL_IDS))),
        ("feature_not_visible", F.size(F.array_except(F.col("eus_vessel_features.label"), "eus_vessel_labels")) > 0),
    ]


def safe_path(path: Column) -> Column:
    """Relative, not empty, and never climbing above its directory.

    The depth is followed part by part: a name goes down, two dots go up.
    """
    parts = F.split(path, "/")
    step = F.transform(parts, lambda p: F.when(p == "..", -1).when(p.isin("", "."), 0).otherwise(1))
    low = F.aggregate(
        step, F.struct(F.lit(0).alias("d"), F.lit(0).alias("m")),
        lambda a, s: F.struct((a["d"] + s).alias("d"), F.least(a["m"], a["d"] + s).alias("m")), lambda a: a["m"])
    return F.coalesce((F.length(path) > 0) & ~path.startswith("/") & (low >= 0), F.lit(False))


# --- many rows ------------------------------------------------------------------------
def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def reconcile(root: DataFrame, state: DataFrame, key: list[str]) -> DataFrame:
    """Every key of either side with what is wrong about it.

    Both sides hold key, status and digest. They are folded per key before the
    join, so repeats cannot multiply.
    """
    def fold(df, p):
        return df.groupBy(*key).agg(
            F.count(F.lit(1)).alias(f"{p}_n"), F.min("status").alias(f"{p}_lo"), F.max("status").alias(f"{p}_hi"),
            F.min("digest").alias(f"{p}_dlo"), F.max("digest").alias(f"{p}_dhi"))

    j = fold(root, "r").join(fold(state, "s"), key, "full_outer")
    kind = (
        F.when(F.col("r_n").isNull(), "orphan_in_state").when(F.col("s_n").isNull(), "missing_in_state")
        .when((F.col("r_n") > 1) | (F.col("s_n") > 1), "repeated_id")
        .when(F.col("r_lo") != F.col("s_lo"), "other_status").when(F.col("r_dlo") != F.col("s_dlo"), "other_content").otherwise("ok"))
    return j.select(*key, kind.alias("kind"))


def field_mismatches(plan: DataFrame, done: DataFrame, key: list[str], fields: list[str], tolerance: dict[str, float] | None = None,
                     allowed_commits: list[str] | None = None) -> DataFrame:
    """Fields in which a finished row differs from its planned row; the key names one planned row at most.

    Both kinds of rows meet in one window, not in a join: tables dealt alike by a part of the key are not dealt again.
    """
    tolerance = tolerance or {}
    own = F.struct(*fields)
    read = F.struct(*[F.col(f).alias(f"__{f}") for f in fields], *(["build_git_commit"] if allowed_commits else []))
    both = plan.select(*key, own.alias("own")).unionByName(done.select(*key, read.alias("read")), allowMissingColumns=True)
    # The hash leads the sort; the key itself decides.
    at = W.partitionBy("__h", *key).orderBy(F.col("own").isNull())
    met = both.withColumn("__h", F.xxhash64(*key)).withColumn("own", F.first("own").over(at)).filter("own is not null and read is not null")
    checks = []
    for f in fields:
        a, b = F.col(f), F.col(f"__{f}")
        same = F.abs(a - b) <= tolerance[f] if f in tolerance else a.eqNullSafe(b)
        checks.append((f, ~same))
    if allowed_commits:
        checks.append(("build_git_commit", ~F.col("build_git_commit").isin(*allowed_commits)))
    return met.select(*key, "own.*", "read.*").select(*key, violations(*checks).alias("mismatches"))


def status_counts(m: DataFrame, keys: list[str]) -> DataFrame:
    """One row per case: a column per state and the total."""
    return m.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("completed"), *[F.count_if(F.col("status") == s).alias(s) for s in K.STATUSES])


def run_state(counts: DataFrame, total: str) -> DataFrame:
    return counts.withColumn("run_state", F.when(F.col("completed") == F.col(total), "complete").otherwise("interrupted"))


def library_summary(gallery: DataFrame, keys: list[str]) -> DataFrame:
    """Counts by metric and label from gallery rows, tall.

    One explode and one partial aggregate serve all five counts.
    """
    def tagged(metric, labels):
        return F.transform(labels, lambda v: F.struct(F.lit(metric).alias("metric"), v.alias("label")))

    has = F.when(F.size("features") > 0, F.array(F.struct(F.lit("indexed_feature_count").alias("metric"), F.lit("").alias("label"))))
    everything = F.concat(
        F.coalesce(has, F.array().cast("array<struct<metric:string,label:string>>")),
        tagged("feature_label_counts", F.col("features.label")),
        tagged("organ_label_counts", F.col("organ_labels")),
        tagged("eus_candidate_organ_label_counts", F.col("eus_candidate_organ_labels")),
        tagged("eus_vessel_label_counts", F.col("eus_vessel_labels")),
        tagged("eus_vessel_feature_counts", F.col("eus_vessel_features.label")),
    )
    return gallery.select(*keys, F.inline(everything)).groupBy(*keys, "metric", "label").agg(F.count(F.lit(1)).alias("n"))


def protocol_hash(meta: DataFrame, doc: str) -> DataFrame:
    """Hash over the locked protocol fields of a map; missing ones are listed."""
    names = F.array(*[F.lit(f) for f in sorted(K.PROTOCOL_FIELDS)])
    text = F.concat(F.lit("{"), F.array_join(
        F.transform(names, lambda k: F.concat(F.lit('"'), k, F.lit('":'), F.coalesce(F.element_at(doc, k), F.lit("null")))), ","), F.lit("}"))
    missing = F.array_except(names, F.map_keys(doc))
    return meta.withColumn("missing_fields", missing).withColumn(
        "protocol_sha256", F.when(F.size("missing_fields") == 0, F.sha2(text, 256)))


def same_multiset(a: DataFrame, b: DataFrame, keys: list[str], text: Column) -> DataFrame:
    """Per group whether two tables hold the same rows equally often."""
    da = multiset_digest(a, keys, text)
    db = multiset_digest(b, keys, text).withColumnsRenamed({"n": "n2", "sha256_sum": "s2", "sha256_xor": "x2"})
    return da.join(db, keys, "full_outer").select(
        *keys, F.coalesce("n", F.lit(0)).alias("n_left"), F.coalesce("n2", F.lit(0)).alias("n_right"),
        F.coalesce((F.col("n") == F.col("n2")) & (F.col("sha256_sum") == F.col("s2")) & (F.col("sha256_xor") == F.col("x2")), F.lit(False)).alias("same"))


def point_coverage(retained: DataFrame, absorbed: DataFrame, plan: DataFrame, key: list[str]) -> DataFrame:
    """Points whose poses, kept or absorbed, are not exactly the full angle grid.

    A pose is counted once per appearance; equal totals and no repeats mean
    full coverage because every appearance is first checked to be on the grid.
    """
    both = retained.select(*key, "roll", "pitch", "yaw").unionByName(absorbed.select(*key, "roll", "pitch", "yaw"))
    per_pose = both.groupBy(*key, "roll", "pitch", "yaw").agg(F.count(F.lit(1)).alias("m"))
    got = per_pose.groupBy(*key).agg(F.count(F.lit(1)).alias("n_distinct"), F.sum("m").alias("n_rows"))
    dim = policy_dim(plan.sparkSession).select("yaw_policy", F.col("n_poses").alias("n_expected"))
    return plan.select(*key, "yaw_policy").join(F.broadcast(dim), "yaw_policy").join(got, key, "left").select(
        *key, "n_expected", F.coalesce("n_distinct", F.lit(0)).alias("n_distinct"),
        (F.coalesce("n_rows", F.lit(0)) - F.coalesce("n_distinct", F.lit(0))).alias("n_repeats"))
