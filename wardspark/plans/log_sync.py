"""Log synchronisation: read what is new in the log files, parse, append to the log store.

    spark-submit --py-files wardspark.zip -m wardspark.plans.log_sync LOG_ROOT OUT
"""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession, functions as F

from wardspark.operators.logs import parse_logs
from wardspark.session import build_session
from wardspark.sources import sinks
from wardspark.streaming.log_tail import LogTail


def run(spark: SparkSession, root: str, out: str, service: str = "log_sync") -> None:
    lines = LogTail(spark, root, f"{out}/tail").run_once()
    parsed = parse_logs(lines, service).withColumn(
        "ingested_at", F.current_timestamp().cast("timestamp_ntz")
    )
    sinks.append_log(parsed, f"{out}/logs")


if __name__ == "__main__":
    run(build_session("log-sync"), *sys.argv[1:3])
