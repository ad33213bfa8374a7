"""Headline queries, timed warm on local[$BENCH_CPUS]; prints one JSON line.

Every query runs once to warm up and three more times; its time is the median of the three.
Results are written to Spark's no-op sink, so all rows are computed and none reach the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from wardspark.catalog import load
from wardspark.session import build_session

HEADLINE = (
    "ingest_report", "reject_reasons", "dedup_content", "patient_list", "latest_prediction",
    "recent_predictions", "recent_studies", "patient_detail", "prediction_summary",
    "predictions_percent", "study_counts_by_label", "run_status", "audit_alert",
    "constraint_violations", "fk_orphans", "upsert_patients", "upsert_studies",
    "delete_patients_cascade", "studies_clean", "stratified_split", "feature_index",
    "metrics_by_split", "tfidf_top_terms", "log_parse", "debounce_paths",
    "object_store", "dashboard_payload", "stratified_split_80_10_10", "patient_reports", "batch_scoring",
    "upsert_stored_studies", "delete_stored_cascade", "fk_exists_stored", "ingest_report_on_write",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    rounds = int(os.environ.get("BENCH_ROUNDS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = load().queries
    if names == ["all"]:
        names = sorted(queries)
    seconds: dict[str, float] = {}
    for name in names:
        times = []
        for _ in range(rounds + 1):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
        print(name, [round(t, 2) for t in times], file=sys.stderr)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
