"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import atexit
import pathlib
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

PACKAGE = pathlib.Path(__file__).resolve().parent
_shipped_to: set[str] = set()

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A panel grows after its shuffle (gap filling), so small shuffles must not
    # be folded into one task.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
    # Lets a (store, item, week) join reuse data already placed by (store, item).
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # A row sent to Python may hold a whole series: keep batches near 40 MB.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    # Wide M5 files have about 2,000 day columns.
    "spark.sql.csv.parser.columnPruning.enabled": "true",
}


def build_session(app: str = "stockloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once for an application.

    Functions run by Python workers are pickled by reference, so workers need the package wherever the
    driver was started. The archive is served by the driver itself and removed when it ends.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped_to:
        return
    folder = pathlib.Path(tempfile.mkdtemp(prefix="stockloom-sources-"))
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = folder / "stockloom_sources.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(PACKAGE.rglob("*.py")):
            out.write(source, source.relative_to(PACKAGE.parent))
    context.addPyFile(str(archive))
    _shipped_to.add(context.applicationId)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where it is unset, a folder in the SQL warehouse.

    Both are shared by the driver and all executors; a machine-local folder is never used.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/stockloom-scratch"


def scratch_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/stockloom/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below this application's part of the shared folder; results may read it until :func:`drop_scratch`."""
    return f"{scratch_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read from there, for a table that many steps read."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def drop_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote for its own use; call it when its results have been read."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_folder(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the plan is cut and the rows outlive any executor."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
