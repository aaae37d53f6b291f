"""Constraint queries over a finished library; each returns findings."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .. import contract as K
from .manifest import violations

HEX40_LOWER = "^[0-9a-f]{40}$"
FINDING = ["case_id", "check", "kind", "n"]


# --- case rows ----------------------------------------------------------------------
ALLOWED_KEYS = (
    "case_id", "ct_path", "output_root", "organ_models", "vessel_models", "sampling", "square", "ct", "filtering", "runtime",
    "geometry", "dicom_series_uid", "manual_segmentation",
)


def case_checks() -> list[tuple[str, Column]]:
    """Types, ranges, allowed values and key sets of a case row."""
    c = F.col
    num = lambda n: c(n).isNull() | F.isnan(c(n)) | (F.abs(c(n)) == float("inf"))
    ratio = lambda n: num(n) | (c(n) < 0) | (c(n) > 1)
    models = F.array(*[F.lit(m) for m in K.REQUIRED_MODELS])
    return [
        ("unexpected_key", F.size(F.array_except("keys", F.array(*[F.lit(k) for k in ALLOWED_KEYS]))) > 0),
        ("case_id", F.length("case_id") == 0),
        ("missing_model", F.size(F.array_except(models, "organ_models")) > 0),
        ("unexpected_model", F.size(F.array_except("organ_models", models)) > 0),
        ("vessel_labels", F.array_sort("vessel_labels") != F.array(F.lit("artery"), F.lit("vein"))),
        ("point_counts", (F.array_sort(F.map_keys("point_counts")) != F.array(*[F.lit(n) for n in sorted(K.POINT_LIMITS)]))
         | F.exists(F.map_values("point_counts"), lambda v: v.isNull() | (v <= 0))),
        ("ray_length_mm", num("ray_length_mm") | (c("ray_length_mm") <= 0)),
        ("output_resolution", c("output_resolution") < 1),
        ("black_threshold", (c("black_threshold") < 0) | (c("black_threshold") > 255)),
        ("black_ratio_limit", ratio("black_ratio_limit")),
        ("backend", ~c("backend").isin("auto", "gpu", "cpu")),
        ("input_coordinate_system", ~c("input_coordinate_system").isin("LPS", "RAS")),
    ]


def setting_mismatches(settings: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Listed settings that differ from the locked value, or are missing.

    ``column`` is a map from name to number; the locked list is a fixed
    dimension of a few rows.
    """
    spark = settings.sparkSession
    lock = spark.createDataFrame(list(K.LOCKED_SETTINGS.items()), "setting string, required double")
    return (
        settings.crossJoin(F.broadcast(lock)).withColumn("actual", F.try_element_at(column, F.col("setting")))
        .filter(~F.col("actual").eqNullSafe(F.col("required"))).select(*keys, "setting", "actual", "required")
    )


# --- catalogue and label values --------------------------------------------------------
def catalog_findings(entries: DataFrame, key: str) -> DataFrame:
    """Faults of catalogue versions: own rows, shared ids, fixed dual roles."""
    names = F.array(*[F.lit(b) for b in K.BANNED_CATALOG_LABELS])
    own = entries.withColumn("bad", violations(
        ("banned_label", F.array_contains(names, F.col("organ_label"))),
        ("ids_not_sorted_unique", (F.array_sort(F.array_distinct("eus_label_ids")) != F.col("eus_label_ids")) | (F.size("eus_label_ids") == 0)),
        ("role", ~F.col("role").isin("organ", "organ_and_vessel")),
        ("vessel_type", (F.col("role") == "organ") != F.col("vessel_type").isNull()),
    )).select(key, F.explode("bad").alias("kind")).groupBy(key, "kind").agg(F.count(F.lit(1)).alias("n"))
    shared = entries.select(key, F.explode(F.array_distinct("eus_label_ids")).alias("i")).groupBy(key, "i").agg(
        F.count(F.lit(1)).alias("m")).filter("m > 1").groupBy(key).agg(F.count(F.lit(1)).alias("n")).select(key, F.lit("shared_id").alias("kind"), "n")
    duals = reduce(lambda a, b: a | b, [
        (F.col("organ_label") == o) & (F.col("role") == r) & F.coalesce(F.col("vessel_type") == v, F.lit(False)) for o, (r, v) in K.DUAL_ROLES.items()])
    dual = entries.groupBy(key).agg(F.count_if(duals).alias("d")).filter(F.col("d") < len(K.DUAL_ROLES)).select(
        key, F.lit("dual_roles").alias("kind"), F.lit(1).cast("long").alias("n"))
    return own.unionByName(shared).unionByName(dual)


def shared_values(values: DataFrame, keys: list[str]) -> DataFrame:
    """Label values outside a byte or owned by several organs of a case."""
    per = values.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("organ").alias("owners"))
    kind = F.when((F.col("value") < 0) | (F.col("value") > 255), "out_of_range").when(F.col("owners") > 1, "several_owners").when(F.col("n") > 1, "repeated")
    return per.withColumn("kind", kind).filter("kind is not null").groupBy(*keys, "kind").agg(F.count(F.lit(1)).alias("n"))


# --- run documents -------------------------------------------------------------------------
def totals_findings(counts: DataFrame, meta: DataFrame) -> DataFrame:
    """Run state, totals and status counts of the document against the rows."""
    j = meta.join(counts.withColumnsRenamed({s: f"r_{s}" for s in (*K.STATUSES, "completed")}), "case_id", "left")
    bad = violations(
        ("run_state", F.col("run_state") != "complete"), ("total_squares", F.col("total_squares") != F.col("r_completed")),
        ("completed", F.col("completed") != F.col("r_completed")),
        ("status_counts", reduce(lambda a, b: a | b, [F.col(s) != F.col(f"r_{s}") for s in K.STATUSES])))
    return j.select("case_id", F.explode(bad).alias("kind"))


def sampling_findings(stats: DataFrame) -> list[tuple[str, Column]]:
    """Arithmetic every region row has to satisfy."""
    r, c, a, s = (F.col(n) for n in ("requested_count", "candidate_count", "actual_count", "shortfall_count"))
    return [
        ("shortfall", s != r - a), ("more_than_requested", a > r), ("more_than_candidates", a > c), ("empty", (c == 0) | (a == 0)),
        ("faces", F.col("input_faces") != F.col("kept_faces") + F.col("discarded_faces")), ("volume", ~(F.col("volume_mm3") > 0)),
    ]


def commit_checks() -> list[tuple[str, Column]]:
    """Current commit, sorted compatible list, and the recovery history behind it."""
    history = F.array_sort(F.array_distinct(F.flatten(F.col("history.completed"))))
    ok = lambda a: F.forall(a, lambda v: v.rlike(HEX40_LOWER)) & (F.array_sort(F.array_distinct(a)) == F.col(a))
    return [
        ("current", ~F.col("current").rlike(HEX40_LOWER)), ("compatible", ~ok("compatible")),
        ("history", F.exists("history", lambda h: ~h["recovery"].rlike(HEX40_LOWER))),
        ("evidence", F.array_sort("compatible") != history),
    ]


def provenance_checks() -> list[tuple[str, Column]]:
    hexes = {"source_manifest_sha256": 64, "core_design_sha256": 64, "build_git_commit": 40}
    out = [(n, ~F.lower(n).rlike(f"^[0-9a-f]{{{k}}}$")) for n, k in hexes.items()]
    t = F.col("translation_mm")
    return [
        *out, ("visualization_coordinate_system", F.col("visualization_coordinate_system").isNotNull() & (F.col("visualization_coordinate_system") != "RAS")),
        ("translation_mm", t.isNotNull() & (F.isnan(t) | (t == float("-inf")) | (t >= 0))),
    ]


def resume_gate(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Whether each case may resume: same protocol, and both documents there."""
    j = current.select("case_id", F.col("protocol_sha256").alias("now")).join(
        previous.select("case_id", F.col("protocol_sha256").alias("then"), "has_manifest", "has_metadata"), "case_id", "left")
    verdict = (
        F.when(F.col("has_metadata").isNull() | (~F.col("has_metadata") & ~F.col("has_manifest")), "new_run")
        .when(F.col("has_manifest") & ~F.col("has_metadata"), "metadata_missing").when(F.col("has_metadata") & ~F.col("has_manifest"), "manifest_missing")
        .when(~F.col("then").eqNullSafe(F.col("now")), "protocol_differs").otherwise("resume"))
    return j.select("case_id", verdict.alias("verdict"))


# --- report --------------------------------------------------------------------------------
def as_finding(df: DataFrame, check: str) -> DataFrame:
    """Tall form shared by all checks: case, check, kind, count."""
    n = F.col("n").cast("long") if "n" in df.columns else F.lit(1).cast("long")
    return df.select(F.col("case_id").cast("long"), F.lit(check).alias("check"), "kind", n.alias("n"))


def report(cases: DataFrame, findings: list[DataFrame]) -> DataFrame:
    """One row per case: passed or not, number of faults, faults by kind."""
    every = reduce(DataFrame.unionByName, findings).filter("n > 0").groupBy("case_id", "check", "kind").agg(F.sum("n").alias("n"))
    per = every.groupBy("case_id").agg(
        F.sum("n").alias("n_faults"),
        F.array_join(F.array_sort(F.collect_list(F.concat("check", F.lit("/"), "kind", F.lit("="), F.col("n").cast("string")))), "; ").alias("faults"))
    return cases.select(F.col("case_id").cast("long").alias("case_id")).join(per, "case_id", "left").select(
        "case_id", F.col("n_faults").isNull().alias("passed"), F.coalesce("n_faults", F.lit(0)).alias("n_faults"), F.coalesce("faults", F.lit("")).alias("faults"))
