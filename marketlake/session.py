"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every operator relies on. All of them can be changed on a live session, so a
# session made by somebody else can be brought in line with `prepare`.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the next step then needs its own shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Ranks up to this are cut down in the map tasks.
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    # Long texts: bound a Python batch by bytes as well as by rows. A worker keeps the memory of
    # its largest batch, so batches are small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}

_LOCAL_WORK_ROOTS: dict[str, str] = {}
_SHIPPED_TO: set[str] = set()


def build_session(app_name: str = "marketlake", master: str | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = (
                builder.config("spark.sql.shuffle.partitions", "8")
                # Small tables: let a stage keep several tasks.
                .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
                .config("spark.driver.memory", "8g")
                .config("spark.ui.enabled", "false")
                .config("spark.ui.showConsoleProgress", "false")
            )
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    _ship_package(spark)
    return spark


def _ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED_TO:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    # The driver serves this file to executors as long as the application runs.
    archive = os.path.join(tempfile.mkdtemp(prefix="marketlake-package-"), "marketlake")
    context.addPyFile(
        shutil.make_archive(archive, "zip", os.path.dirname(package), os.path.basename(package))
    )
    _SHIPPED_TO.add(context.applicationId)


def work_root(spark: SparkSession) -> str:
    """The shared folder for tables that cut lineage.

    The cluster names it in spark.checkpoint.dir. Only a local session, where driver and
    executors share one disk, may fall back on a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    app = context.applicationId
    if app not in _LOCAL_WORK_ROOTS:
        _LOCAL_WORK_ROOTS[app] = tempfile.mkdtemp(prefix="marketlake-", dir=os.environ.get("TMPDIR", "/tmp"))
    return _LOCAL_WORK_ROOTS[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{work_root(spark)}/marketlake/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write once to the work folder and read back: every later use sees the same rows."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
