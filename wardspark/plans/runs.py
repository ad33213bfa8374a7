"""Run headers and run events, kept as appended rows; the state of a run is its last row."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardspark.operators.lookup import top_per_key
from wardspark.sources.files import exists

_RUN = (
    "run_id string, job_name string, stage string, status string, records_in long, "
    "records_out long, records_failed long, error_message string, at timestamp"
)
_EVENT = (
    "event_id string, run_id string, stage string, status string, records long, message string, "
    "logged_at timestamp"
)


def new_run_id(kind: str, now: datetime | None = None) -> str:
    return f"RUN-{(now or datetime.now(timezone.utc)).strftime('%Y%m%d-%H%M%S')}-{kind}"


class RunLog:
    """Appends to ``<folder>/runs`` and ``<folder>/events``; one small row per call."""

    def __init__(self, spark: SparkSession, folder: str, run_id: str, job: str, stage: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.run_id, self.job, self.stage = run_id, job, stage
        # Counts known so far, so that a failed run does not lose them.
        self.counts = {"records_in": 0, "records_out": 0, "records_failed": 0}

    def _append(self, name: str, schema: str, row: tuple) -> None:
        rows = self.spark.createDataFrame([row], schema)
        rows.coalesce(1).write.mode("append").parquet(f"{self.folder}/{name}")

    def state(self, status: str, error: str | None = None) -> None:
        row = (self.run_id, self.job, self.stage, status, *self.counts.values(), error,
               datetime.now(timezone.utc))
        self._append("runs", _RUN, row)

    def event(self, event_id: str, stage: str, status: str, records: int, message: str) -> None:
        row = (event_id, self.run_id, stage, status, records, message, datetime.now(timezone.utc))
        self._append("events", _EVENT, row)

    def run(self, job: Callable[[RunLog], DataFrame]) -> DataFrame:
        """Run a job between its start and finish rows; errors are recorded and raised again."""
        self.state("running")
        try:
            result = job(self)
        except Exception as error:
            self.state("failed", str(error))
            raise
        self.state("ok")
        return result


def run_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Current header of every run: its last state, with its start and finish times."""
    rows = spark.read.schema(_RUN).parquet(f"{folder.rstrip('/')}/runs")
    started = rows.groupBy("run_id").agg(F.min("at").alias("started_at"))
    # A finished state beats the running one written at the same instant.
    last = top_per_key(rows, ["run_id"], [F.col("at").desc(), (F.col("status") == "running").asc()])
    ended = F.when(F.col("status").isin("ok", "failed"), F.col("at"))
    return last.join(started, "run_id").select(
        *[c for c in rows.columns if c != "at"], "started_at", ended.alias("finished_at")
    )


def run_events(spark: SparkSession, folder: str) -> DataFrame:
    """Run events, the first of every (run, event) pair."""
    path = f"{folder.rstrip('/')}/events"
    rows = spark.read.schema(_EVENT).parquet(path) if exists(spark, path) else spark.createDataFrame([], _EVENT)
    return top_per_key(rows, ["run_id", "event_id"], [F.col("logged_at")])
