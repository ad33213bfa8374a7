"""Counts, averages and percentages of the dashboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardspark.schemas import DATA_SPLITS, RUN_STATUSES, STUDY_LABELS, enum_rank


def _stack_totals(parts: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in parts.items():
        row = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def table_counts(parts: dict[str, DataFrame]) -> DataFrame:
    """Rows (name, n, filled) of several tables."""
    return _stack_totals(parts).select("name", "n", (F.col("n") > 0).alias("filled"))


def platform_totals(predictions: DataFrame, studies: DataFrame, patients: DataFrame) -> DataFrame:
    """One row with the three totals; the tables are counted independently."""
    return totals_row(predictions.agg(F.count(F.lit(1)).alias("n")), studies, patients)


def totals_row(predictions: DataFrame, studies: DataFrame, patients: DataFrame) -> DataFrame:
    """``platform_totals`` where the number of predictions (n) is known."""
    counted = predictions.select(F.lit("predictions_total").alias("name"), "n")
    rows = counted.unionByName(_stack_totals(
        {
            "api_uploads": studies.where(F.col("source_dataset") == "api_upload"),
            "patients_total": patients,
        }
    ))
    names = ("predictions_total", "api_uploads", "patients_total")
    return rows.agg(*[F.max(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in names])


def predictions_by_label(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("predicted_label").agg(F.count(F.lit(1)).alias("total"))


def predictions_percent(predictions: DataFrame) -> DataFrame:
    """Count and percent of all predictions per label, one decimal."""
    return percent_of(predictions_by_label(predictions))


def percent_of(counts: DataFrame) -> DataFrame:
    """``predictions_percent`` of counts per label (predicted_label, total).

    The window runs over the aggregated labels (a closed set), not over the predictions.
    """
    everything = F.sum("total").over(Window.partitionBy(F.lit(1)))
    share = F.round(F.col("total") * F.lit(100).cast("decimal(3,0)") / everything, 1)
    return counts.select(
        "predicted_label", "total", share.cast("double").alias("percent")
    )


def study_counts_by_label(studies: DataFrame) -> DataFrame:
    """Studies per label and split in the declared order of both sets, null label last."""
    return (
        studies.groupBy("label", "split")
        .agg(F.count(F.lit(1)).alias("study_count"))
        .orderBy(enum_rank("label", STUDY_LABELS), enum_rank("split", DATA_SPLITS))
    )


def prediction_summary(predictions: DataFrame) -> DataFrame:
    """Predictions per label with the average of each probability at four decimals."""

    def mean(name: str) -> Column:
        return F.round(F.avg(name), 4).cast("double").alias(f"avg_{name}")

    return predictions.groupBy("predicted_label").agg(
        F.count(F.lit(1)).alias("total"),
        mean("prob_sana"), mean("prob_neumonia"), mean("prob_covid"),
    )


def status_counts(runs: DataFrame) -> DataFrame:
    """One row of run counts by status; a status without runs counts zero."""
    shown = ("ok", "running", "failed")
    return runs.agg(*[F.count_if(F.col("status") == s).alias(s) for s in shown])


def run_headers(events: DataFrame) -> DataFrame:
    """Run header rows from run events: start, state after the last event, totals.

    ``max_by`` over (time, id) keeps one small buffer per run in each task.
    """
    order = F.struct("logged_at", "event_id")
    ended = F.col("status").isin("ok", "failed")
    return events.groupBy("run_id").agg(
        F.max_by("status", order).alias("status"),
        F.max_by("stage", order).alias("stage"),
        F.min("logged_at").alias("started_at"),
        F.max(F.when(ended, F.col("logged_at"))).alias("last_end"),
        F.sum("records").cast("bigint").alias("records_in"),
        F.coalesce(F.sum(F.when(F.col("status") == "ok", F.col("records"))), F.lit(0))
        .cast("bigint").alias("records_out"),
        F.coalesce(F.sum(F.when(F.col("status") == "failed", F.col("records"))), F.lit(0))
        .cast("bigint").alias("records_failed"),
        F.max_by(F.when(F.col("status") == "failed", F.col("message")), order)
        .alias("error_message"),
    ).select(
        "run_id", "stage", "status", "records_in", "records_out", "records_failed",
        "error_message", "started_at",
        F.when(F.col("status").isin("ok", "failed"), F.col("last_end")).alias("finished_at"),
    )


def run_rules() -> dict[str, Column]:
    """Conditions a run header must meet."""
    return {
        "records_in": F.col("records_in") >= 0,
        "records_out": F.col("records_out") >= 0,
        "records_failed": F.col("records_failed") >= 0,
        "finished_after_start": F.col("finished_at").isNull()
        | (F.col("finished_at") >= F.col("started_at")),
        "status_known": F.col("status").isin(*RUN_STATUSES),
    }


def distribution(records: DataFrame, label: str = "diagnosis") -> DataFrame:
    """Rows per class, the content of a dataset description."""
    return records.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
