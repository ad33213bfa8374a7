"""Writers: tables, small single-file exports, reports, content-addressed objects."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardspark.operators.sieve import Sieve
from wardspark.session import stage
from wardspark.sources.files import exists


def write_table(df: DataFrame, path: str, partition_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """Write a table. Rows are gathered by the partition columns first, so a partition gets few files.

    The rebalancing is adaptive: large partitions are split over tasks, small ones share a task.
    """
    if partition_by:
        df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode(mode).parquet(path)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header and untrimmed text. ``single_file`` uses one task: for reports only."""
    keep_blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    rows = df.coalesce(1) if single_file else df
    rows.write.mode("overwrite").options(header=True, **keep_blanks).csv(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report of a few rows as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def append_log(df: DataFrame, path: str, time: str = "event_time") -> None:
    """Append log documents, partitioned by service and day so that queries prune; a day gets few files."""
    dated = df.withColumn("day", F.to_date(F.coalesce(F.col(time), F.col("ingested_at"))))
    write_table(dated, path, ("service", "day"), mode="append")


def append_events(events: DataFrame, path: str) -> None:
    """Append watcher events as JSON lines; times keep their microseconds and offset."""
    stamped = events.withColumn("ts", F.col("ts").cast("timestamp"))
    stamped.write.mode("append").option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(path)


def store_objects(files: DataFrame, path: str, contents: DataFrame | None = None, on: str = "fs_path") -> None:
    """Content-addressed objects: only keys not stored yet are added.

    ``files`` holds object_key and content, or object_key and the unique ``on`` that finds it in ``contents``.
    Stored keys are left out before contents are read, so contents meet the wanted keys in one join; a bitmap of
    the wanted ones goes before it, so that the other contents are not moved.
    """
    spark = files.sparkSession
    wanted = files
    if exists(spark, path):
        stored = spark.read.parquet(path).select("object_key")
        wanted = wanted.join(stored, "object_key", "left_anti")
    if contents is not None:
        wanted = stage(wanted.select(on, "object_key"), "wanted-objects")
        near = Sieve(wanted, on, "wanted-objects").mark(contents, F.col(on)).where("_maybe").drop("_maybe")
        wanted = near.join(wanted, on)
    wanted = wanted.where(F.col("content").isNotNull()).select("object_key", "content")
    wanted.write.mode("append").parquet(path)


def upload_objects(
    files: DataFrame, put: Callable[[str, bytes], None], limit: int = 0
) -> DataFrame:
    """Send objects to an external store from the executors; rows (uploaded) per partition.

    ``put`` runs inside the tasks and must be idempotent, as tasks may be retried; the keys
    are content addresses, so sending one twice changes nothing.
    """
    chosen = files.where(F.col("content").isNotNull()).select("object_key", "content")
    if limit > 0:
        chosen = chosen.limit(limit)

    def send(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sent = 0
        for batch in batches:
            for key, data in zip(batch["object_key"], batch["content"]):
                put(key, bytes(data))
            sent += len(batch)
        yield pd.DataFrame({"uploaded": [sent]})

    return chosen.mapInPandas(send, "uploaded long")


class Snapshots:
    """A keyed table kept as numbered, immutable versions below one folder.

    A version is valid when its ``_SUCCESS`` file exists, which Spark writes last, so readers
    never see a half-written one.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, version: int) -> str:
        return f"{self.folder}/version={version:06d}"

    def latest(self) -> int:
        """Number of the newest complete version, 0 when there is none."""
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/version=*/_SUCCESS")
        files = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern)
        names = [f.getPath().getParent().getName() for f in files or []]
        return max((int(name.split("=")[1]) for name in names), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self._path(version or self.latest()))

    def commit(self, df: DataFrame) -> int:
        """Write the next version. Of two writers that took the same number one fails and must merge anew.

        A number left behind by a broken write is passed over, never overwritten.
        """
        version = self._last_number() + 1
        df.write.mode("errorifexists").parquet(self._path(version))
        return version

    def _last_number(self) -> int:
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/version=*")
        found = pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern)
        return max((int(f.getPath().getName().split("=")[1]) for f in found or []), default=0)
