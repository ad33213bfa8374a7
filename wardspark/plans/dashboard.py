"""Dashboard document as one JSON row from the stored tables.

    spark-submit --py-files wardspark.zip -m wardspark.plans.dashboard TABLES OUT
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession, functions as F

from wardspark.operators import dashboard
from wardspark.operators.totals import Partials
from wardspark.session import build_session
from wardspark.sources import files, sinks


def run(spark: SparkSession, tables: str, out: str) -> None:
    """Refresh the kept totals below ``out`` with the prediction files that are new, then write the document.

    The totals belong to the present studies and patients; when those change they are built anew.
    """
    patients, studies, runs, alerts = (
        spark.read.parquet(f"{tables}/{name}") for name in ("patients", "studies", "runs", "alerts")
    )
    state = files.fingerprint(spark, [f"{tables}/studies", f"{tables}/patients"])
    parts = Partials(spark, f"{out}/totals/{state}", f"{tables}/predictions")
    parts.refresh(lambda names: dashboard.load_parts(spark.read.parquet(*names), studies, patients))
    checks = runs.select(F.col("run_id").alias("name"), (F.col("status") != "failed").alias("ok"))
    document = dashboard.payload_from_parts(parts, patients, studies, runs, alerts, checks)
    sinks.write_report(document, f"{out}/document")


if __name__ == "__main__":
    run(build_session("dashboard"), *sys.argv[1:3])
