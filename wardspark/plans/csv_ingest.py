"""CSV metadata ingest: clean, split valid from invalid, merge into the stored tables.

    spark-submit --py-files wardspark.zip -m wardspark.plans.csv_ingest STUDIES_CSV OUT SITE [EVENTS_CSV]
"""

from __future__ import annotations

import sys
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from wardspark.operators import mutate, studies as st
from wardspark.plans.runs import RunLog, new_run_id
from wardspark.schemas import RUN_EVENTS_CSV, STUDIES_CSV
from wardspark.session import build_session, stage
from wardspark.sources import files
from wardspark.sources.sinks import Snapshots

_STUDY_UPDATE = ["patient_id", "file_path", "split", "label", "source_dataset", "captured_at"]


def _merge(table: Snapshots, incoming: DataFrame, key: str, update: list[str]) -> None:
    """Commit the next version: a merge, or the incoming rows for the first one."""
    table.commit(mutate.upsert(table.read(), incoming, key, update) if table.latest() else incoming)


def run(
    spark: SparkSession, studies_csv: str, out: str, site_code: str, events_csv: str | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Merge into ``patients``, ``studies``, ``runs`` and ``run_events``; return the counts.

    Everything is set-based; the driver sees one row of counts.
    """
    if not files.exists(spark, studies_csv):
        raise FileNotFoundError(studies_csv)
    log = RunLog(spark, f"{out}/log", run_id or new_run_id("CSV"), "ingest_csv", "ingesta_csv")

    def job(log: RunLog) -> DataFrame:
        now = datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
        raw = files.read_csv_text(spark, studies_csv, STUDIES_CSV)
        cleaned = stage(st.clean_studies(raw), "studies-cleaned")
        valid = st.valid_studies(cleaned)
        invalid = st.invalid_studies(cleaned).select(
            F.lit(log.run_id).alias("run_id"), F.lit("incomplete").alias("issue_type"),
            F.coalesce("study_id", "file_path", F.lit("unknown")).alias("details"), "problems",
        )
        invalid.write.mode("append").parquet(f"{out}/issues")

        people = st.derive_patients(valid.select("patient_id"), site_code)
        _merge(Snapshots(spark, f"{out}/patients"), people, "patient_id",
               ["display_name", "sex", "age_range", "site_code"])
        _merge(
            Snapshots(spark, f"{out}/studies"),
            valid.withColumn("object_key", F.lit(None).cast("string")), "study_id", _STUDY_UPDATE,
        )
        if events_csv and files.exists(spark, events_csv):
            events = stage(st.clean_events(files.read_csv_text(spark, events_csv, RUN_EVENTS_CSV), now), "events")
            every = [F.col(c) for c in events.columns if c != "event_id"]
            first = mutate.latest_per_key(events, "event_id", every)
            # Events of a new key only; the runs they name come first.
            for name, incoming, key in (
                ("runs", st.run_stubs(events, now), "run_id"),
                ("run_events", first, "event_id"),
            ):
                table = Snapshots(spark, f"{out}/{name}")
                table.commit(mutate.insert_ignore(table.read(), incoming, key) if table.latest() else incoming)

        counts = cleaned.agg(
            F.count(F.lit(1)).alias("distinct_studies"),
            F.count_if(F.size("problems") == 0).alias("valid"),
            F.count_if(F.size("problems") > 0).alias("invalid"),
        )
        totals = counts.first()
        log.counts.update(
            records_in=raw.count(), records_out=totals["valid"], records_failed=totals["invalid"]
        )
        log.event("EVT-CSV02", "ingesta_csv", "ok", totals["valid"], str(totals.asDict()))
        return counts

    return log.run(job)


if __name__ == "__main__":
    run(build_session("csv-ingest"), *sys.argv[1:5]).show()
