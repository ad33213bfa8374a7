"""The dashboard document: totals, percentages, run summary, recent rows, alerts, health, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardspark.operators import evaluation as ev, lookup, quality, summary
from wardspark.operators.totals import Partials
from wardspark.schemas import MODEL_LABELS
from wardspark.session import stage


def _as_array(df: DataFrame, name: str, order: list) -> DataFrame:
    """One row with the rows of a bounded DataFrame as an array, in the given order."""
    keyed = df.select(F.struct(*order, F.struct(*df.columns).alias("row")).alias("e"))
    return keyed.agg(
        F.transform(F.array_sort(F.collect_list("e")), lambda e: e["row"]).alias(name)
    )


def load_parts(predictions: DataFrame, studies: DataFrame, patients: DataFrame) -> dict[str, DataFrame]:
    """What the dashboard needs of a load of predictions, in forms that merge with those of other loads.

    ``counts``: predictions by actual and predicted label (no actual one where the study is unknown). ``newest``: the first
    rows of the list of recent predictions. ``latest``: the newest prediction of each study, sorted by study, so that a
    few studies are found without reading the others.
    """
    held = stage(predictions, "load")
    truth = studies.where("label is not null").select("study_id", F.col("label").alias("actual"))
    counts = held.select("study_id", F.col("predicted_label").alias("predicted")).join(truth, "study_id", "left").groupBy(
        "actual", "predicted").agg(F.count(F.lit(1)).alias("n"))
    latest = lookup.latest_predictions(held).drop("model_name", "model_version")
    ordered = latest.repartitionByRange("study_id").sortWithinPartitions("study_id")
    return {"counts": counts, "newest": lookup.recent_predictions(held, studies, patients), "latest": ordered}


def payload_from_parts(
    parts: Partials, patients: DataFrame, studies: DataFrame, runs: DataFrame, alerts: DataFrame, checks: DataFrame,
    alert_limit: int = 50,
) -> DataFrame:
    """``payload`` from kept totals: the predictions themselves are not read."""
    counts = parts.read("counts")
    by_label = counts.groupBy(F.col("predicted").alias("predicted_label")).agg(F.sum("n").alias("total"))
    known = counts.where("actual is not null")
    order = [F.col("inferred_at").desc(), F.col("prediction_id").desc()]
    return _assembled(
        summary.percent_of(by_label),
        lookup.recent_studies(studies, patients, parts.read("latest"), indexed=True),
        parts.read("newest").orderBy(*order).limit(lookup.RECENT_PREDICTIONS),
        stage(ev.confusion_cells(known, MODEL_LABELS, n=F.col("n")), "dashboard-cells"),
        summary.totals_row(
            counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")), studies, patients),
        runs, alerts, checks, alert_limit,
    )


def payload(
    patients: DataFrame,
    studies: DataFrame,
    predictions: DataFrame,
    runs: DataFrame,
    evaluated: DataFrame,
    alerts: DataFrame,
    checks: DataFrame,
    alert_limit: int = 50,
) -> DataFrame:
    """One nested row. Every array in it is bounded: labels, or a fixed number of recent rows.

    ``alerts`` are shown newest first, ``alert_limit`` of them; ``checks`` (name, ok) give the health.
    """
    return _assembled(
        summary.predictions_percent(predictions),
        lookup.recent_studies(studies, patients, predictions),
        lookup.recent_predictions(predictions, studies, patients),
        stage(ev.confusion_cells(evaluated, MODEL_LABELS), "dashboard-cells"),
        summary.platform_totals(predictions, studies, patients),
        runs, alerts, checks, alert_limit,
    )


def _assembled(
    shares: DataFrame, newest_studies: DataFrame, newest_predictions: DataFrame, cells: DataFrame, totals: DataFrame,
    runs: DataFrame, alerts: DataFrame, checks: DataFrame, alert_limit: int,
) -> DataFrame:
    """The parts are single rows, looked up as scalar subqueries."""
    percent = _as_array(
        shares, "v",
        [(-F.col("total")).alias("k"), F.col("predicted_label").alias("l")],
    )
    recent_studies = _as_array(
        newest_studies, "v",
        [(-F.unix_micros(F.col("ingested_at").cast("timestamp"))).alias("k"), F.col("study_id").alias("l")],
    )
    recent_predictions = _as_array(
        newest_predictions, "v",
        [(-F.unix_micros(F.col("inferred_at").cast("timestamp"))).alias("k"),
         (-F.col("prediction_id")).alias("l")],
    )
    newest = alerts.orderBy(F.col("created_at").desc(), F.col("alert_id").desc()).limit(alert_limit)
    recent_alerts = _as_array(
        newest, "v",
        [(-F.unix_micros(F.col("created_at").cast("timestamp"))).alias("k"), (-F.col("alert_id")).alias("l")],
    )
    health = quality.health(checks).select(F.struct("*").alias("v"))
    metrics = ev.metrics_summary(ev.class_metrics(cells)).select(
        F.struct("accuracy", "f1_macro", "n_samples").alias("v")
    )
    errors = ev.critical_errors(cells).select(F.struct("*").alias("v"))
    status = summary.status_counts(runs).select(F.struct("*").alias("v"))
    return totals.select(
        F.struct("*").alias("metrics"),
        percent.scalar().alias("predictions_by_class"),
        status.scalar().alias("run_summary"),
        recent_studies.scalar().alias("recent_studies"),
        recent_predictions.scalar().alias("recent_predictions"),
        recent_alerts.scalar().alias("alerts"),
        health.scalar().alias("health"),
        F.struct(metrics.scalar().alias("summary"), errors.scalar().alias("errors")).alias("evaluation"),
    )
