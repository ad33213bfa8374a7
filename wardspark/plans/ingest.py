"""Image ingest: list or read the manifest, inspect each file once, classify, store, report.

    spark-submit --py-files wardspark.zip -m wardspark.plans.ingest ROOT OUT [MANIFEST_CSV]
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardspark.functions import paths
from wardspark.operators import quality, validate
from wardspark.operators.lookup import top_per_key
from wardspark.plans.runs import RunLog, new_run_id
from wardspark.schemas import FOLDER_LABELS, MANIFEST_CSV
from wardspark.session import build_session
from wardspark.sources import files, sinks


def load_facts(spark: SparkSession, root: str, manifest: str | None, data_root: str) -> DataFrame:
    """Facts of the listed files (null where missing) and ``listed``, the times listed.

    Contents become facts before the join with the manifest, so they are never shuffled. A
    manifest line that repeats is inspected once and counted; without a manifest the tree below
    ``root`` is the manifest.
    """
    found = files.list_images(spark, root, glob="*", content=True)
    if manifest and files.exists(spark, manifest):
        listed = files.read_csv_text(spark, manifest, MANIFEST_CSV)
        counted = listed.groupBy(*listed.columns).agg(F.count(F.lit(1)).alias("listed"))
        # One row per path decides: the first line in order of all columns carries the rest.
        order = [F.col(c) for c in MANIFEST_CSV.fieldNames() if c != "file_path"]
        totals = counted.groupBy("file_path").agg(F.sum("listed").alias("listed"))
        one = top_per_key(counted.drop("listed"), ["file_path"], order).join(totals, "file_path")
        placed = one.withColumn("fs_path", paths.resolve_local(F.col("file_path"), data_root))
        return files.attach_files(placed, found.select("fs_path", *validate.content_facts()))
    return found.where(F.col("folder").isin(*FOLDER_LABELS) & F.lower("filename").endswith(".jpg")).select(
        F.concat_ws("/", F.lit("data/raw/scans"), "split", "folder", "filename").alias("file_path"),
        "fs_path", "filename", "split", "folder", F.lit("").alias("label"),
        *validate.content_facts(), F.lit(1).cast("long").alias("listed"),
    )


def first_accepted(accepted: DataFrame, limit: int = 0) -> DataFrame:
    """The first ``limit`` accepted files by path, all of them for 0."""
    return accepted.orderBy("file_path").limit(limit) if limit > 0 else accepted


def store_accepted(spark: SparkSession, root: str, accepted: DataFrame, path: str, limit: int = 0) -> None:
    """Store the contents of accepted files under their keys; ``limit`` 0 stores all."""
    accepted = first_accepted(accepted, limit)
    contents = files.list_images(spark, root, glob="*", content=True).select("fs_path", "content")
    keyed = accepted.select("fs_path", "object_key")
    sinks.store_objects(files.attach_files(keyed, contents), path)


def run(
    spark: SparkSession, root: str, out: str, manifest: str | None = None,
    data_root: str | None = None, run_id: str | None = None, upload: bool = False,
    max_upload: int = 0,
) -> DataFrame:
    """Write ``classified``, ``validated``, ``rejected``, ``issues``, ``alerts`` and ``report``.

    File contents are read by the one job that writes ``inspected``; every later step reads
    that narrow table.
    """
    log = RunLog(spark, f"{out}/log", run_id or new_run_id("IMG"), "ingest_files", "ingest")

    def job(log: RunLog) -> DataFrame:
        facts = load_facts(spark, root, manifest, data_root or root)
        sinks.write_table(validate.judge(facts), f"{out}/inspected")
        inspected = spark.read.parquet(f"{out}/inspected")
        # The report is counted by the job that writes the rows it is about.
        watched, seen = validate.watched(validate.classify(inspected), F.col("listed"))
        sinks.write_table(watched, f"{out}/classified")
        classified = spark.read.parquet(f"{out}/classified")
        report = validate.seen_report(spark, seen).withColumn("run_id", F.lit(log.run_id)).withColumn(
            "processed_at", F.current_timestamp())
        sinks.write_report(report, f"{out}/report")
        report = spark.read.json(f"{out}/report")
        counts = report.first()
        log.counts.update(
            records_in=counts["total_scanned"], records_out=counts["valid_unique"],
            records_failed=counts["rejected"],
        )
        log.event("EVT-SCAN01", "scan", "running", counts["total_scanned"], "files listed")

        accepted = validate.accepted(classified).drop("reject_reason", "is_valid_jpg", "path_ok")
        sinks.write_table(accepted, f"{out}/validated")
        if upload:
            stored = spark.read.parquet(f"{out}/validated")
            store_accepted(spark, root, stored, f"{out}/objects", max_upload)
        rejected = validate.rejected(classified)
        sinks.write_table(rejected, f"{out}/rejected")
        sinks.write_table(quality.issue_rows(rejected, F.lit(log.run_id)), f"{out}/issues", mode="append")
        alert = quality.quality_alert(
            report.select(
                "run_id", F.col("invalid_corrupt").alias("corrupt"),
                F.col("invalid_incomplete").alias("incomplete"),
                F.col("duplicates_removed").alias("duplicate"),
            )
        )
        sinks.write_table(alert, f"{out}/alerts", mode="append")
        log.event("EVT-ING01", "ingest", "ok", counts["valid_unique"], str(counts.asDict()))
        return report

    return log.run(job)


if __name__ == "__main__":
    run(build_session("ingest"), *sys.argv[1:4]).show(truncate=False)
