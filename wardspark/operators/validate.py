"""Content validation, duplicate detection and reject classification of file manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from wardspark.functions import content as fc, ids, paths
from wardspark.functions.clean import known
from wardspark.schemas import IMAGE_SPLITS, MIN_IMAGE_BYTES, STUDY_LABELS


def content_facts(min_bytes: int = MIN_IMAGE_BYTES) -> list[Column]:
    """What is kept of a file's content: size, validity and hash. All null or false if missing."""
    ok = fc.is_valid_jpeg(F.col("content"), min_bytes)
    return [
        F.octet_length("content").cast("bigint").alias("file_size"),
        ok.alias("is_valid_jpg"),
        F.when(ok, F.md5("content")).alias("content_hash"),
    ]


def judge(facts: DataFrame) -> DataFrame:
    """Complete the facts of manifest rows: final label, and whether split and label are known.

    A missing file (null size) has size 0 and is neither valid nor complete.
    """
    label = paths.label_or_folder(F.col("label"), F.col("folder"))
    complete = (
        known(F.col("split"), IMAGE_SPLITS) & known(label, STUDY_LABELS)
        & F.col("file_size").isNotNull()
    )
    own = ("label", "file_size", "is_valid_jpg", "content_hash")
    return facts.select(
        *[c for c in facts.columns if c not in own],
        label.alias("label"),
        F.coalesce("file_size", F.lit(0)).cast("bigint").alias("file_size"),
        F.coalesce("is_valid_jpg", F.lit(False)).alias("is_valid_jpg"),
        complete.alias("path_ok"),
        "content_hash",
    )


def inspect_files(
    files: DataFrame, min_bytes: int = MIN_IMAGE_BYTES, drop_content: bool = True
) -> DataFrame:
    """Add size, validity, label and content hash; the content itself goes no further."""
    kept = [c for c in files.columns if c != "content" or not drop_content]
    return judge(files.select(*kept, *content_facts(min_bytes)))


def usable() -> Column:
    return F.col("is_valid_jpg") & F.col("path_ok")


def first_copies(inspected: DataFrame, key: str = "file_path") -> DataFrame:
    """The smallest key of every group of equal valid contents: (content_hash, key).

    A plain minimum, so each task sends one row per hash however many copies it holds.
    """
    return (
        inspected.where(usable()).groupBy("content_hash").agg(F.min(key).alias(key))
    )


def classify(inspected: DataFrame, key: str = "file_path") -> DataFrame:
    """Add ``reject_reason``: corrupt, incomplete, duplicate, or null for the kept row.

    The kept rows are joined back on ``key``, which must be unique, not on the content hash:
    a content with very many copies then never meets in one task.
    """
    keepers = first_copies(inspected, key).select(key, F.lit(True).alias("is_first"))
    return inspected.join(keepers, key, "left").select(
        *inspected.columns,
        F.when(~F.col("is_valid_jpg"), F.lit("corrupt"))
        .when(~F.col("path_ok"), F.lit("incomplete"))
        .when(F.col("is_first").isNull(), F.lit("duplicate"))
        .alias("reject_reason"),
    )


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reject_reason").isNull()).withColumn(
        "object_key", ids.raw_object_key(F.col("content_hash"))
    )


def rejected(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reject_reason").isNotNull()).select(
        "file_path", "content_hash", "reject_reason", "file_size", "label", "split"
    )


def report_columns(times: Column | None = None) -> list[Column]:
    """Counts of the ingest report over classified files; also usable as observed metrics.

    ``times``: how often a file's line is listed. Lines that repeat a path are duplicates of it when it is kept, or
    repeat its fault.
    """
    reason, n = F.col("reject_reason"), F.lit(1) if times is None else times

    def total(condition: Column, value: Column = n) -> Column:
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("bigint")

    kept = total(reason.isNull(), F.lit(1))
    return [
        total(F.lit(True)).alias("total_scanned"),
        kept.alias("valid_unique"),
        (total(F.lit(True)) - kept).alias("rejected"),
        total(reason == "corrupt").alias("invalid_corrupt"),
        total(reason == "incomplete").alias("invalid_incomplete"),
        (total(reason == "duplicate") + total(reason.isNull(), n - 1)).alias("duplicates_removed"),
    ]


def watched(classified: DataFrame, times: Column | None = None) -> tuple[DataFrame, Observation]:
    """The rows, and the ingest report that the job that writes them will have made."""
    seen = Observation()
    return classified.observe(seen, *report_columns(times)), seen


def seen_report(spark: SparkSession, seen: Observation) -> DataFrame:
    """The observed report as one row; waits for the job that makes it."""
    names = ("total_scanned", "valid_unique", "rejected", "invalid_corrupt", "invalid_incomplete", "duplicates_removed")
    counts = seen.get
    return spark.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} bigint" for n in names))


def ingest_report(inspected: DataFrame) -> DataFrame:
    """The six counts without the per-row join.

    Duplicates are valid rows minus distinct valid contents, so counting rows per hash is
    enough: one shuffle of one small row per distinct content.
    """
    flags = inspected.select("content_hash", "is_valid_jpg", "path_ok")
    per_hash = flags.groupBy(
        F.when(usable(), F.col("content_hash")).alias("h"), "is_valid_jpg", "path_ok"
    ).agg(F.count(F.lit(1)).alias("n"))
    good = F.col("is_valid_jpg") & F.col("path_ok")

    def total(condition: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, value)), F.lit(0)).cast("bigint")

    one = F.lit(1)
    return per_hash.agg(
        total(F.lit(True), F.col("n")).alias("total_scanned"),
        total(good, one).alias("valid_unique"),
        (total(F.lit(True), F.col("n")) - total(good, one)).alias("rejected"),
        total(~F.col("is_valid_jpg"), F.col("n")).alias("invalid_corrupt"),
        total(F.col("is_valid_jpg") & ~F.col("path_ok"), F.col("n")).alias("invalid_incomplete"),
        total(good, F.col("n") - 1).alias("duplicates_removed"),
    )


def missing_files(manifest: DataFrame, listing: DataFrame) -> DataFrame:
    """Manifest rows whose file is not in the listing (both have ``file_path``)."""
    return manifest.join(listing.select("file_path").distinct(), "file_path", "left_anti")


def format_audit(files: DataFrame) -> DataFrame:
    """Files by name and real format: already JPEG, to be converted, or unreadable."""
    kind = fc.content_format(F.col("content"))
    outcome = (
        F.when(kind == "jpeg", F.lit("skipped_jpeg"))
        .when(kind == "png", F.lit("to_convert"))
        .otherwise(F.lit("failed"))
    )
    return files.select(outcome.alias("outcome")).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("files")
    )
