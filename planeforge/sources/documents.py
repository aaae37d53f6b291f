"""JSON lines, JSON documents, the case registry, the catalogue, image series."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from .. import contract as K

CATALOG_SHA256 = "a9b7ebd346510856412f5315f6fa7b568be8d388beaef78f443cc317c65ab24f"
CATALOG_PATH = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "data", "organ_catalog.json")
CATALOG_SCHEMA = (
    "schema_version string, organs array<struct<organ_label:string,eus_label_ids:array<int>,eus_label_names:array<string>,"
    "role:string,vessel_type:string,canonical_vessel_label_id:int>>"
)


# --- JSON lines -------------------------------------------------------------------
def line_verdict(text: Column) -> Column:
    """ok, blank, not_json or not_object."""
    v = F.try_parse_json(text)
    return (
        F.when(F.length(F.trim(text)) == 0, "blank").when(v.isNull(), "not_json")
        .when(~F.schema_of_variant(v).startswith("OBJECT"), "not_object").otherwise("ok")
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with file and line number, however a file is split.

    A split keeps its lines in order, so a line's number is the lines in the
    earlier splits of its file plus its rank inside the split; only one count
    per split is ranked by a window.
    """
    t = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("mid"))
    per = t.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("mid").alias("first"))
    w = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    per = per.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0))).drop("n")
    return t.join(per, ["file", "block"]).select(
        "file", (F.col("before") + F.col("mid") - F.col("first") + 1).alias("line_number"), "value")


def read_jsonl(spark: SparkSession, path: str, schema: str, skip_blank: bool) -> tuple[DataFrame, DataFrame]:
    """Parsed rows, and the faulty lines with number and reason."""
    t = read_lines(spark, path).withColumn("verdict", line_verdict(F.col("value")))
    bad = t.filter(F.col("verdict") != "ok")
    if skip_blank:
        bad = bad.filter(F.col("verdict") != "blank")
    rows = t.filter("verdict = 'ok'").select("file", "line_number", F.from_json("value", schema).alias("r"))
    return rows.select("file", "line_number", "r.*"), bad.select("file", "line_number", "verdict")


def json_documents(docs: DataFrame, text: str) -> DataFrame:
    """Whole documents as VARIANT; anything but an object at the top is an error."""
    verdict = line_verdict(F.col(text))
    return docs.withColumn("verdict", verdict).withColumn("doc", F.when(F.col("verdict") == "ok", F.try_parse_json(text)))


# --- registry -----------------------------------------------------------------------
REGISTRY_SCHEMA = (
    "case_id string, ct_path string, output_root string, dicom_series_uid string, "
    "sampling struct<point_counts:map<string,int>,ray_length_mm:double,minimum_spacing_mm:double>, "
    "ct struct<output_resolution:int,window_level:double,window_width:double,fill_hu_value:double>, "
    "filtering struct<black_threshold:int,black_ratio_limit:double>, runtime struct<seed:int,workers:int,backend:string>, "
    "geometry struct<input_coordinate_system:string,canonical_coordinate_system:string>"
)


def resolve_path(path: Column, folder: Column) -> Column:
    return F.when(path.startswith("/"), path).otherwise(F.concat(folder, F.lit("/"), path))


def with_defaults(cases: DataFrame) -> DataFrame:
    """Flat case rows: given values, else the contract's; paths made absolute.

    ``cases`` has ``folder`` and the parsed struct ``c``.
    """
    d = {
        "ray_length_mm": ("sampling.ray_length_mm", K.RAY_LENGTH_MM), "minimum_spacing_mm": ("sampling.minimum_spacing_mm", K.SPACING_MM),
        "output_resolution": ("ct.output_resolution", K.RESOLUTION), "window_level": ("ct.window_level", K.WINDOW_LEVEL_HU),
        "window_width": ("ct.window_width", K.WINDOW_WIDTH_HU), "fill_hu_value": ("ct.fill_hu_value", K.FILL_HU),
        "black_threshold": ("filtering.black_threshold", K.BLACK_THRESHOLD), "black_ratio_limit": ("filtering.black_ratio_limit", K.BLACK_RATIO_LIMIT),
        "seed": ("runtime.seed", K.SEED), "workers": ("runtime.workers", 8), "backend": ("runtime.backend", "auto"),
        "input_coordinate_system": ("geometry.input_coordinate_system", "LPS"),
    }
    counts = F.create_map(*[v for k, n in K.POINT_LIMITS.items() for v in (F.lit(k), F.lit(n))])
    given = F.coalesce(F.col("c.sampling.point_counts"), F.create_map().cast("map<string,int>"))
    merged = F.map_concat(F.map_filter(counts, lambda k, _: ~F.map_contains_key(given, k)), given)
    return cases.select(
        F.col("c.case_id").alias("case_id"),
        resolve_path(F.col("c.ct_path"), F.col("folder")).alias("ct_path"),
        resolve_path(F.col("c.output_root"), F.col("folder")).alias("output_root"),
        merged.alias("point_counts"),
        *[F.coalesce(F.col(f"c.{p}"), F.lit(v)).alias(n) for n, (p, v) in d.items()])


def parse_registry(files: DataFrame) -> DataFrame:
    """Case files (JSON; YAML where the parser is installed) to case rows."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    text = files.select("path", folder.alias("folder"), F.col("content").cast("string").alias("text"))
    js = text.filter(F.lower("path").endswith(".json"))
    ym = text.filter(F.lower("path").rlike(r"\.ya?ml$"))

    def to_json(batches):
        import json

        import yaml

        for pdf in batches:
            pdf["text"] = [json.dumps(yaml.safe_load(t)) for t in pdf["text"]]
            yield pdf

    both = js.unionByName(ym.mapInPandas(to_json, "path string, folder string, text string"))
    return with_defaults(both.select("folder", F.from_json("text", REGISTRY_SCHEMA).alias("c")))


# --- catalogue -------------------------------------------------------------------------
def catalog(spark: SparkSession, path: str | None = None, sha256: str = CATALOG_SHA256) -> DataFrame:
    """The versioned organ dimension; another content or version is refused."""
    if path is None:
        with open(CATALOG_PATH, "rb") as f:
            one = spark.createDataFrame([(bytearray(f.read()),)], "content binary")
    else:
        one = spark.read.format("binaryFile").load(path).select("content")
    checked = one.select(
        F.when(F.sha2("content", 256) == sha256, F.col("content").cast("string")).otherwise(
            F.raise_error(F.lit("catalogue content differs from the approved one")).cast("string")).alias("t"))
    c = checked.select(F.from_json("t", CATALOG_SCHEMA).alias("c")).filter(F.col("c.schema_version") == K.CATALOG_VERSION)
    return c.select(F.inline("c.organs"))


# --- image series ---------------------------------------------------------------------------
def select_series(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """The one series to read per folder, or why there is none.

    ``files`` has folder and series_uid per file, ``wanted`` folder and uid
    (null where none was named). Files are counted per series map side; a
    folder of any size is then judged from its number of series.
    """
    per = files.groupBy("folder", "series_uid").agg(F.count(F.lit(1)).alias("n_files"))
    one = per.groupBy("folder").agg(F.count("series_uid").alias("n_series"), F.max("series_uid").alias("only"))
    j = wanted.join(one, "folder", "left").withColumn("pick", F.coalesce("uid", "only"))
    j = j.join(per.withColumnRenamed("series_uid", "pick"), ["folder", "pick"], "left")
    verdict = (
        F.when(F.col("n_series").isNull(), "no_series")
        .when(F.col("uid").isNull() & (F.col("n_series") != 1), "several_series")
        .when(F.col("n_files").isNull(), "unknown_series").otherwise("ok"))
    ok = F.col("verdict") == "ok"
    return j.withColumn("verdict", verdict).select(
        "folder", "verdict", F.when(ok, F.col("pick")).alias("series_uid"), F.when(ok, F.col("n_files")).alias("n_files"))
