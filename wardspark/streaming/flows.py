"""Structured Streaming flows. All run ``availableNow``: a pass without new data does nothing.

State is bounded by a watermark, or kept as a table that each micro-batch joins against.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wardspark.functions import paths
from wardspark.operators import arrivals as arr, validate
from wardspark.operators.quality import threshold_severity
from wardspark.session import stage
from wardspark.sources.files import exists, is_folder


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stream_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet folder, or a single file within its folder, as a stream with its schema."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if is_folder(spark, path):
        return reader.parquet(path)
    folder, name = path.rsplit("/", 1)
    return reader.option("pathGlobFilter", name).parquet(folder)


def run_to_parquet(stream: DataFrame, out: str, checkpoint: str) -> int:
    """Run until all data is read; the number of rows dropped because they came after the watermark.

    Spark counts them behind its map-side merge, so rows of one key and window that came together count once. Its
    progress list holds as many batches as ``build_session`` allows.
    """
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def run_batches(
    stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str
) -> None:
    query = (
        stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def new_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Stream of files that appear below ``root`` (path, time, length); content is not read."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    return (
        spark.readStream.format("binaryFile").schema(schema).option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob).load(root)
        .select("path", "modificationTime", "length")
    )


def debounced(stream: DataFrame, gap: str, delay: str | None = None) -> DataFrame:
    """Ready JPEG paths of a stream of arrivals; late events beyond ``delay`` are
    dropped and counted by ``run_to_parquet``."""
    named = stream.where(F.coalesce(paths.is_jpeg_name(F.col("path")), F.lit(False)))
    return arr.debounce(named.withWatermark("ts", delay or gap), gap)


def route_to_tables(arrivals: DataFrame, out: str, checkpoint: str) -> None:
    """Route arrivals into ``moved`` and ``alerts`` tables below ``out``.

    Names that any other batch has given away are taken. ``moved`` is partitioned by a prefix of the name's
    hash, and a micro-batch reads only the partitions its own names fall into. Each micro-batch is stored once and
    overwrites its own partitions, so a repeated batch changes nothing.
    """
    stream = _stream_name(checkpoint)
    prefix = hash_prefix(F.md5("destination"))

    def handle(batch: DataFrame, number: int) -> None:
        routed = stage(arr.route_arrivals(batch), "routed")
        names = routed.select(F.concat_ws("/", "split", "folder", "filename").alias("destination"))
        stored = stored_before(batch.sparkSession, f"{out}/moved", stream, number, names.select(prefix.alias("prefix")))
        taken = None if stored is None else stored.select("destination")
        given = arr.destinations(routed, taken=taken)
        write_batch(given.withColumn("prefix", prefix), f"{out}/moved", stream, number)
        arr.route_alerts(routed).write.mode("overwrite").parquet(f"{out}/alerts/stream={stream}/batch={number}")

    run_batches(arrivals, handle, checkpoint)


def inspect_to_table(files: DataFrame, out: str, checkpoint: str) -> None:
    """Inspect arriving files and append one row per file; stateless."""
    run_to_parquet(validate.inspect_files(files), out, checkpoint)


def _stream_name(checkpoint: str) -> str:
    """Names a stream by its checkpoint, which is what numbers its batches."""
    return "s" + hashlib.sha256(checkpoint.rstrip("/").encode()).hexdigest()[:16]


def hash_prefix(digest: Column, characters: int = 2) -> Column:
    """Partition of a hexadecimal hash, 256 of them for two characters; with a letter, as folder names of digits become numbers."""
    return F.concat(F.lit("h"), F.substring(digest, 1, characters))


def stored_before(
    spark: SparkSession, out: str, stream: str, number: int, prefixes: DataFrame
) -> DataFrame | None:
    """Rows of ``out`` in the given partitions, from all batches of all streams but this one, which may be a repetition.

    The prefixes of a batch are listed on the driver, one per partition at most, so that the scan opens
    no other partition: a small batch costs the same however long the history is.
    """
    if not exists(spark, out):
        return None
    touched = [r[0] for r in prefixes.distinct().collect()]
    kept = spark.read.schema(spark.read.parquet(out).schema).parquet(out)
    return kept.where(F.col("prefix").isin(touched) & ~((F.col("stream") == stream) & (F.col("batch") == number)))


def write_batch(rows: DataFrame, out: str, stream: str, number: int) -> None:
    """Store a micro-batch in its own partitions of every prefix; they alone are replaced when it is repeated."""
    tagged = rows.withColumns({"stream": F.lit(stream), "batch": F.lit(number)})
    tagged.hint("rebalance", "prefix").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "prefix", "stream", "batch").parquet(out)


def unique_contents(files: DataFrame, out: str, checkpoint: str) -> None:
    """Append the first file of every valid content that is not stored yet.

    The stored table is the state, partitioned by a prefix of the content hash: each batch keeps its smallest path per
    hash and looks up its hashes in the partitions they fall into, not in the history. Batches are numbered per
    stream, so several streams, one after the other, may fill one table; a repeated batch overwrites only itself.
    """
    stream = _stream_name(checkpoint)

    def handle(batch: DataFrame, number: int) -> None:
        first = validate.first_copies(validate.inspect_files(batch))
        fresh = stage(first.withColumn("prefix", hash_prefix(F.col("content_hash"))), "contents")
        stored = stored_before(batch.sparkSession, out, stream, number, fresh.select("prefix"))
        new = fresh if stored is None else fresh.join(stored.select("prefix", "content_hash"), ["prefix", "content_hash"], "left_anti")
        write_batch(new, out, stream, number)

    run_batches(files, handle, checkpoint)


def recent_contents(files: DataFrame, out: str, checkpoint: str, time: str, delay: str) -> int:
    """Append one file of every valid content that was not seen within ``delay`` of event time.

    Copies within ``delay`` are dropped for certain; later ones too until the watermark has passed the first. Returns the
    number of rows that came after the watermark. For endless streams in which copies come close together: the state holds only hashes that are younger than
    the watermark, in RocksDB on the executors' disks with its changes in the checkpoint, and no table is read.
    """
    spark = files.sparkSession
    inspected = validate.inspect_files(files).where(validate.usable()).withWatermark(time, delay)
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    spark.conf.set(setting, ROCKSDB)
    try:
        return run_to_parquet(inspected.dropDuplicatesWithinWatermark(["content_hash"]), out, checkpoint)
    finally:
        spark.conf.set(setting, before)


# -- late rows -------------------------------------------------------------------------------------------------

class OnTime(NamedTuple):
    """Tables that ``split_late`` fills, each by stream batch."""

    rows: str
    late: str
    marks: str


def split_late(events: DataFrame, out: str, checkpoint: str, time: str, delay: str, closes: Column) -> OnTime:
    """Part a stream into rows that still reach their window and rows that come too late, and keep both.

    ``closes``: end of the earliest window of a row. The high-water mark of a micro-batch is the greatest event time of the
    batches before it less ``delay``; a row is late when its window closed at or before that. Rows, late rows (with the mark that
    passed them) and the batch's own greatest time are written by the same micro-batch, in partitions of its number,
    so a repeated batch overwrites itself and sees the same mark. Windows over the ``rows`` as a stream with the same
    delay then drop nothing: its watermark is never ahead of the mark. A row without a time is late.
    """
    tables = OnTime(f"{out}/rows", f"{out}/late", f"{out}/marks")

    def handle(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        held = stage(batch.withColumn("_closes", closes), "arrived")
        mark = None
        if exists(spark, tables.marks):
            earlier = spark.read.schema("greatest timestamp, batch long").parquet(tables.marks).where(F.col("batch") < number)
            mark = earlier.agg(F.max("greatest") - F.expr(f"interval '{delay}'")).first()[0]
        late = F.col("_closes").isNull() if mark is None else F.coalesce(F.col("_closes") <= F.lit(mark), F.lit(True))
        parts = held.withColumn("_late", late)
        parts.where("not _late").drop("_late", "_closes").write.mode("overwrite").parquet(f"{tables.rows}/batch={number}")
        passed = F.lit(mark).cast("timestamp").alias("mark")
        parts.where("_late").drop("_late", "_closes").select("*", passed).write.mode("overwrite").parquet(f"{tables.late}/batch={number}")
        held.agg(F.max(time).cast("timestamp").alias("greatest")).write.mode("overwrite").parquet(f"{tables.marks}/batch={number}")

    run_batches(events, handle, checkpoint)
    return tables


def windowed_quality_alerts(
    issues: DataFrame, window: str, delay: str, threshold: int = 10, time: str = "detected_at"
) -> DataFrame:
    """Threshold alerts per closed time window of a stream of quality issues."""
    counted = (
        issues.withWatermark(time, delay)
        .groupBy(F.window(time, window).alias("w"))
        .agg(*[
            F.count_if(F.col("issue_type") == kind).alias(kind)
            for kind in ("corrupt", "incomplete", "duplicate")
        ])
    )
    total = F.col("corrupt") + F.col("incomplete") + F.col("duplicate")
    return counted.select(
        F.col("w.start").alias("window_start"), "corrupt", "incomplete", "duplicate",
        threshold_severity(total, threshold).alias("severity"),
    ).where(F.col("severity").isNotNull())
