"""Log documents: parsing of lines, path metadata, filtered newest-first queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wardspark.functions.logs import is_blank, line_fields, parse_fields
from wardspark.functions.paths import key_value_part
from wardspark.sources.skipping import write_sorted


def parse_logs(lines: DataFrame, service: str = "log_sync") -> DataFrame:
    """Log documents of the lines (line, path); blank lines give none."""
    split = lines.where(~is_blank(F.col("line"))).withColumn("_f", line_fields(F.col("line")))
    # A generator of one row: later filters stay above it instead of repeating the parse.
    parsed = split.select(
        *lines.columns, F.inline(F.array(parse_fields(F.col("_f"), F.col("line"))))
    )
    keep = [c for c in lines.columns if c not in ("line", "path")]
    return parsed.select(
        *keep,
        "format", "event_time", "level", "logger", "message",
        F.lit(service).alias("service"),
        F.lit("file").alias("source"),
        "path",
        key_value_part(F.col("path"), "dag_id").alias("dag_id"),
        key_value_part(F.col("path"), "run_id").alias("run_id"),
        key_value_part(F.col("path"), "task_id").alias("task_id"),
    )


MOST_LOGS = 500  # documents of one answer


def query_logs(
    logs: DataFrame, service: str | None = None, level: str | None = None, limit: int = 100, most: int = MOST_LOGS,
) -> DataFrame:
    """Newest documents, filtered by what is given. A limit below 1 or above ``most`` is an error."""
    if not 1 <= limit <= most:
        raise ValueError(f"limit must be between 1 and {most}")
    if service:
        logs = logs.where(F.col("service") == service)
    if level:
        logs = logs.where(F.col("level") == level.upper())
    order = [F.col("event_time").desc_nulls_last()]
    order += [F.col(c) for c in ("event_id", "path", "message") if c in logs.columns]
    return logs.orderBy(*order).limit(limit)


def store_logs(logs: DataFrame, path: str) -> None:
    """Store documents sorted by time, with the number of documents by service, level and hour beside them."""
    write_sorted(logs, f"{path}/documents", ["event_time"], ids=("run_id",))
    stored = logs.sparkSession.read.schema(logs.schema).parquet(f"{path}/documents")
    hours = stored.groupBy("service", "level", F.date_trunc("hour", "event_time").alias("hour"))
    hours.agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/hours")


def query_stored(
    spark: SparkSession, path: str, service: str | None = None, level: str | None = None, limit: int = 100, most: int = MOST_LOGS,
) -> DataFrame:
    """``query_logs`` of stored documents that reads only the newest of them.

    The counts tell the hour from which on enough documents match; the scan takes those from there on, which lie
    together. With fewer matches than the limit all are read, undated ones too.
    """
    counts = spark.read.parquet(f"{path}/hours").where(F.col("hour").isNotNull())
    if service:
        counts = counts.where(F.col("service") == service)
    if level:
        counts = counts.where(F.col("level") == level.upper())
    # One row per hour of the whole history at most.
    later = Window.orderBy(F.desc("hour")).rowsBetween(Window.unboundedPreceding, 0)
    per_hour = counts.groupBy("hour").agg(F.sum("n").alias("n")).withColumn("upto", F.sum("n").over(later))
    since = per_hour.where(F.col("upto") >= limit).agg(F.max("hour")).first()[0]
    documents = spark.read.parquet(f"{path}/documents")
    kept = documents if since is None else documents.where(F.col("event_time") >= F.lit(since))
    return query_logs(kept, service, level, limit, most)
