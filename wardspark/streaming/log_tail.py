"""Incremental reading of growing log files by byte offset.

Spark's text source reads a file once and never again; logs grow. Each pass joins the file
listing with the stored offsets, splits what is new into byte ranges, and reads the ranges in
tasks. One very large file is many ranges, so it does not keep one task busy. Offsets are a
table, not a driver-side dictionary.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardspark.session import stage
from wardspark.sources.sinks import Snapshots

_OFFSETS = "path string, offset long"


def _open(uri: str):
    if uri.startswith("file:/"):
        uri = "/" + uri[len("file:/"):].lstrip("/")
    if uri.startswith("/"):
        return arrow_fs.LocalFileSystem().open_input_file(uri)
    system, path = arrow_fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def read_range(uri: str, start: int, low: int, high: int, end: int, block: int = 1 << 20) -> Iterator[str]:
    """Lines of a file that begin in [low, high); ``start`` begins a line, ``end`` follows a line break."""
    with _open(uri) as source:
        position = low
        if low > start:
            # The line that covers byte low-1 belongs to the range before.
            position = low - 1
        source.seek(position)
        pending, begin = b"", position
        skipping = low > start
        while position < end:
            data = source.read(min(block, end - position))
            if not data:
                break
            position += len(data)
            *whole, pending = (pending + data).split(b"\n")
            for line in whole:
                if skipping:
                    skipping = False
                elif begin < high:
                    yield line.decode("utf-8", "replace")
                begin += len(line) + 1
                if begin >= high:
                    return


def whole_length(uri: str, start: int, end: int, block: int = 1 << 16) -> int:
    """Where the last whole line of [start, end) ends, looking back from the end; ``start`` if there is none."""
    with _open(uri) as source:
        while end > start:
            low = max(start, end - block)
            source.seek(low)
            at = source.read(end - low).rfind(b"\n")
            if at >= 0:
                return low + at + 1
            end = low
    return start


def pending_ranges(listing: DataFrame, offsets: DataFrame | None, range_bytes: int) -> DataFrame:
    """Byte ranges not read yet; a file shorter than its offset was truncated and starts anew."""
    if offsets is not None:
        listing = listing.join(offsets, "path", "left")
    else:
        listing = listing.withColumn("offset", F.lit(None).cast("long"))
    known = F.coalesce("offset", F.lit(0))
    begin = F.when(known > F.col("length"), F.lit(0)).otherwise(known).cast("long")
    todo = listing.select("path", "length", begin.alias("start")).where("start < length")
    lows = F.sequence(F.col("start"), F.col("length") - 1, F.lit(range_bytes).cast("long"))
    return todo.select("path", "length", "start", F.explode(lows).alias("low")).withColumn(
        "high", F.least(F.col("low") + range_bytes, F.col("length"))
    )


class LogTail:
    """Passes over ``root``; lines and offsets are kept below ``state``."""

    def __init__(
        self, spark: SparkSession, root: str, state: str, glob: str = "*.log",
        range_bytes: int = 64 << 20,
    ):
        self.spark, self.root, self.glob, self.range_bytes = spark, root, glob, range_bytes
        self.lines_path = f"{state}/lines"
        self.offsets = Snapshots(spark, f"{state}/offsets")

    def _whole_lines(self, listing: DataFrame, before: DataFrame | None) -> DataFrame:
        """The listing with each length cut back to the last line break: an unfinished line waits."""
        known = listing.withColumn("offset", F.lit(0).cast("long")) if before is None else listing.join(
            before, "path", "left").withColumn("offset", F.coalesce("offset", F.lit(0)))
        start = F.when(F.col("offset") > F.col("length"), F.lit(0)).otherwise(F.col("offset")).cast("long")

        def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                ends = [whole_length(*r) for r in batch[["path", "start", "length"]].itertuples(index=False)]
                yield pd.DataFrame({"path": batch["path"], "length": ends})

        # One small read per file: files are spread over the tasks.
        spread = known.select("path", "length", start.alias("start")).repartition(4 * self.spark.sparkContext.defaultParallelism)
        return spread.mapInPandas(cut, "path string, length long")

    def run_once(self) -> DataFrame:
        """Read everything new and return the new lines (path, line).

        The listing is staged, so that lines and offsets come from the same file lengths. Lines
        are written below the number of the pass before its offsets are: a pass that fails is
        repeated and overwrites its own lines. A line without its line break is left for a later pass.
        """
        spark = self.spark
        listing = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", self.glob).load(self.root).select("path", "length")
        )
        done = self.offsets.latest()
        before = self.offsets.read(done) if done else None
        listing = stage(self._whole_lines(listing, before), "log-listing")
        ranges = pending_ranges(listing, before, self.range_bytes)

        def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for r in batch.itertuples(index=False):
                    lines: list[str] = []
                    for line in read_range(r.path, r.start, r.low, r.high, r.length):
                        lines.append(line)
                        if len(lines) == 10_000:
                            yield pd.DataFrame({"path": r.path, "line": lines})
                            lines = []
                    if lines:
                        yield pd.DataFrame({"path": r.path, "line": lines})

        # An explicit number: ranges are tiny rows, adaptive execution would merge them.
        spread = ranges.repartition(4 * spark.sparkContext.defaultParallelism)
        target = f"{self.lines_path}/pass={done + 1:06d}"
        spread.mapInPandas(read, "path string, line string").write.mode("overwrite").parquet(target)

        offsets = listing.select("path", F.col("length").alias("offset"))
        if before is not None:
            offsets = offsets.unionByName(before.join(listing, "path", "left_anti"))
        self.offsets.commit(offsets)
        return spark.read.schema("path string, line string").parquet(target)
