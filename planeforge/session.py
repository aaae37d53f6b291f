"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import pathlib
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHARED: dict[str, str] = {}
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once in an application; their workers import it from there."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = pathlib.Path(__file__).parent
    archive = pathlib.Path(tempfile.mkdtemp(prefix="spark-", dir="/tmp")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in sorted(package.rglob("*")):
            if path.suffix in (".py", ".json"):
                out.write(path, path.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
    _SHIPPED.add(app)


def build_session(app: str = "planeforge", cores: str = "8", shuffle: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.driver.memory", "20g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Methods above 8000 bytes are never compiled by the JVM; smaller
        # per-expression methods are several times faster than such a one.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def compiled_methods(spark: SparkSession) -> None:
    """Generated methods that the JVM can compile, unless the session chose its own limit.

    The JVM interprets any method above 8000 bytes for ever; Spark then runs the smaller methods of single steps instead.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    if spark.conf.get(key) == "65535":
        spark.conf.set(key, "8000")


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only where a local session names none (tests, local runs) is a new one
    made: on a cluster a folder of one machine would hide rows from the others.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if configured:
        return configured
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _SHARED:
        _SHARED[app] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _SHARED[app]


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/planeforge/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, grows: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    The result survives lost executors, keeps columnar pruning, and gives the
    planner the size of its files. Regular rows are many times larger than
    their files; a table that ``grows`` with the input is therefore joined by
    shuffle at every size and never sent to the driver.
    """
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    return out.hint("merge") if grows else out


def width(spark: SparkSession) -> int:
    """Number of tasks for a stage that multiplies its input rows."""
    return max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism,
    )


_STAGES: dict[tuple, tuple[str, DataFrame]] = {}


def stage(spark: SparkSession, name: str, sf_dir: str, build) -> DataFrame:
    """A stage table written once per application and read by many queries.

    The tables' names, sizes and times are part of its key, so changed input
    is never answered from an old table.
    """
    key = (spark.sparkContext.applicationId, name, sf_dir, _input_mark(spark, sf_dir))
    if key not in _STAGES or not _present(spark, _STAGES[key][0]):
        path = stage_path(spark, name)
        df = build()
        df.write.parquet(path)
        _STAGES[key] = (path, df.schema)
    path, schema = _STAGES[key]
    return spark.read.schema(schema).parquet(path)


def _input_mark(spark: SparkSession, sf_dir: str) -> tuple:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(sf_dir)
    return tuple(files.agg(F.count("*"), F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first())


def _present(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)
