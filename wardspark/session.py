"""Session construction and the shared scratch folder used by multi-step queries."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.numRecentProgressUpdates": "10000",
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Reliable folder for lineage cuts and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. A local session without one gets a
    temporary folder; a cluster session without one is an error, because executors could
    not reach a folder on the driver's disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured.rstrip("/")
    active = context.getCheckpointDir()
    if active:
        return active.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="wardspark-"))
    return context.getCheckpointDir().rstrip("/")


_scopes: list[list[str]] = []


def _hadoop_path(spark: SparkSession, path: str):
    """The path and its file system."""
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(context._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the application's folder in the shared one.

    That folder goes when the application's driver ends, with all that was staged; a ``scratch_scope`` removes its paths earlier.
    """
    folder = f"{checkpoint_root(spark)}/wardspark-{spark.sparkContext.applicationId}"
    where, system = _hadoop_path(spark, folder)
    if not system.exists(where):
        system.mkdirs(where)
        system.deleteOnExit(where)
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove what is staged inside once the block has succeeded; after a failure it stays until the application ends.

    For steps whose result is written inside the block: a DataFrame that is still to be read may need its staged tables.
    """
    _scopes.append([])
    try:
        yield
    except BaseException:
        _scopes.pop()
        raise
    for path in _scopes.pop():
        where, system = _hadoop_path(spark, path)
        system.delete(where, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame once to the shared folder and read it back.

    For results used by several later actions: the work is not repeated and survives the
    loss of executors. Starts a job.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_small(df: DataFrame) -> DataFrame:
    """Spread an input that has fewer partitions than the session has cores; a larger one stays where it is.

    A table in one small file would otherwise be worked on by one task. What is moved is at most one
    partition's worth for each core.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="wardspark-package-")) / package.name
    context.addPyFile(shutil.make_archive(str(archive), "zip", package.parent, package.name))
    _shipped.add(context.applicationId)
