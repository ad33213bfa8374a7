"""Studies, patients and run events read from CSV text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardspark.functions import clean, ids
from wardspark.operators.lookup import top_per_key


def clean_studies(raw: DataFrame) -> DataFrame:
    """One row per study id with normalised text, parsed time and the broken rules.

    Of repeated ids the row that sorts first over all columns stays. Rows without an id are
    all kept, each is reported as invalid; they skip the ranking, where they would meet in
    one task.
    """
    order = [F.col(c).asc_nulls_last() for c in raw.columns if c != "study_id"]
    named = top_per_key(raw.where(F.col("study_id").isNotNull()), ["study_id"], order)
    rows = named.unionByName(raw.where(F.col("study_id").isNull()))
    parsed = rows.select(
        *[c for c in raw.columns if c not in ("label", "split", "captured_at")],
        clean.category(F.col("label")).alias("label"),
        clean.category(F.col("split")).alias("split"),
        clean.timestamp(F.col("captured_at")).alias("captured_at"),
    )
    return parsed.withColumn("problems", clean.study_problems())


def valid_studies(cleaned: DataFrame) -> DataFrame:
    return cleaned.where(F.size("problems") == 0).drop("problems")


def invalid_studies(cleaned: DataFrame) -> DataFrame:
    return cleaned.where(F.size("problems") > 0)


def derive_patients(patient_ids: DataFrame, site_code: str) -> DataFrame:
    """Simulated demographics of the distinct patient ids, all from a hash of the id."""
    pid = F.col("patient_id")
    return patient_ids.select("patient_id").distinct().select(
        pid,
        ids.display_name_from_id(pid).alias("display_name"),
        ids.sex_from_id(pid).alias("sex"),
        ids.age_range_from_id(pid).alias("age_range"),
        F.lit(site_code).alias("site_code"),
    )


def derive_studies(files: DataFrame, captured_at: Column, source: str) -> DataFrame:
    """Study rows of image files (file_path, split, label)."""
    path = F.col("file_path")
    return files.select(
        ids.study_id_from_path(path).alias("study_id"),
        ids.patient_id_from_path(path).alias("patient_id"),
        path,
        "split",
        "label",
        F.lit(source).alias("source_dataset"),
        F.lit("CR").alias("modality"),
        F.lit("chest").alias("body_part"),
        captured_at.alias("captured_at"),
    )


def manifest_events(files: DataFrame, run_id: str, at: str) -> DataFrame:
    """The two run events of a manifest build over image files (label): built, then checked by class."""
    begun = F.lit(at).cast("timestamp_ntz")
    counted = files.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("label").alias("classes"),
                        F.array_join(F.sort_array(F.collect_set("label")), ", ").alias("names"))
    built = F.struct(F.lit("EVT-001").alias("event_id"), F.lit("ingesta").alias("stage"), F.lit("manifest built").alias("message"),
                     begun.alias("logged_at"))
    checked = F.struct(
        F.lit("EVT-002").alias("event_id"), F.lit("validacion").alias("stage"),
        F.concat(F.col("n"), F.lit(" images in "), F.col("classes"), F.lit(" classes: "), F.col("names")).alias("message"),
        (begun + F.expr("interval '5' minute")).alias("logged_at"))
    return counted.select("n", F.inline(F.array(built, checked))).select(
        "event_id", F.lit(run_id).alias("run_id"), "stage", F.lit("ok").alias("status"),
        F.col("n").alias("records"), "message", "logged_at",
    )


def clean_events(raw: DataFrame, run_time: str) -> DataFrame:
    """Run events with parsed time (``run_time`` where unreadable), count and message."""
    return raw.select(
        "event_id", "run_id", "stage", "status",
        clean.int_or_zero(F.col("records")).alias("records"),
        F.coalesce("message", F.lit("")).alias("message"),
        F.coalesce(
            clean.timestamp(F.col("logged_at")), F.lit(run_time).cast("timestamp_ntz")
        ).alias("logged_at"),
    )


def run_stubs(events: DataFrame, run_time: str) -> DataFrame:
    """Header rows for the runs named by events."""
    at = F.lit(run_time).cast("timestamp_ntz")
    return events.where(F.col("run_id").isNotNull()).select("run_id").distinct().select(
        "run_id",
        F.lit("historical_csv").alias("job_name"),
        F.lit("ingesta_csv").alias("stage"),
        F.lit("ok").alias("status"),
        at.alias("started_at"),
        at.alias("finished_at"),
    )
