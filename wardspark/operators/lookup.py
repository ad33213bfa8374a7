"""Joins and key lookups of the query layer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardspark.session import stage
from wardspark.sources.skipping import rows_with


RECENT_PREDICTIONS = 100  # rows of the list


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of every key.

    The rank filter is pushed below the shuffle (window group limit), so each task sends at
    most n rows per key even when one key holds most of the table.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def latest_predictions(predictions: DataFrame) -> DataFrame:
    """The newest prediction of every study; the larger id wins between equal times."""
    order = [F.col("inferred_at").desc(), F.col("prediction_id").desc()]
    return top_per_key(predictions, ["study_id"], order)


def confidence() -> Column:
    return F.greatest("prob_covid", "prob_neumonia", "prob_sana")


def patient_list(patients: DataFrame, sites: DataFrame, studies: DataFrame) -> DataFrame:
    """Patients with site name and number of studies, zero included.

    Studies are counted per patient before the join, so a busy patient is one row by then.
    """
    counted = studies.groupBy("patient_id").agg(F.count("study_id").alias("study_count"))
    return (
        patients.join(sites.select("site_code", "site_name"), "site_code")
        .join(counted, "patient_id", "left")
        .select(
            "patient_id", "display_name", "sex", "age_range", "site_code", "site_name",
            F.coalesce("study_count", F.lit(0)).cast("bigint").alias("study_count"),
        )
    )


def studies_with_latest(studies: DataFrame, predictions: DataFrame) -> DataFrame:
    """Every study with its newest prediction, or nulls."""
    latest = latest_predictions(predictions).select(
        "study_id", "predicted_label", "prediction_id", "inferred_at",
        confidence().alias("confidence"),
    )
    return studies.join(latest, "study_id", "left")


def recent_studies(
    studies: DataFrame, patients: DataFrame, predictions: DataFrame, limit: int = 24, indexed: bool = False,
) -> DataFrame:
    """Newest studies with a stored object, their newest prediction and patient name.

    Both left joins keep one row per study, so the limit is taken first and its rows are written once:
    at most ``limit`` keys (checked) are broadcast and the large tables are only filtered. ``indexed``: the predictions are
    stored sorted by study, so that the keys go into their scan.
    """
    if not 0 < limit <= 10_000:
        raise ValueError("limit must be between 1 and 10000")
    newest = stage(
        studies.where(F.col("object_key").isNotNull())
        .select("study_id", "patient_id", "source_dataset", "ingested_at", "object_key")
        .orderBy(F.col("ingested_at").desc(), "study_id")
        .limit(limit),
        "recent-studies",
    )
    wanted = F.broadcast(newest.select("study_id"))
    near = rows_with(predictions, "study_id", newest.select("study_id")) if indexed else predictions
    latest = latest_predictions(near.join(wanted, "study_id", "left_semi")).select(
        "study_id", "predicted_label", confidence().alias("confidence")
    )
    names = patients.join(
        F.broadcast(newest.select("patient_id").distinct()), "patient_id", "left_semi"
    ).select("patient_id", F.col("display_name").alias("patient_name"))
    return (
        newest.join(F.broadcast(latest), "study_id", "left")
        .join(names, "patient_id", "left")
        .select("study_id", "source_dataset", "ingested_at", "object_key",
                "predicted_label", "confidence", "patient_name")
    )


def recent_predictions(
    predictions: DataFrame, studies: DataFrame, patients: DataFrame, limit: int = RECENT_PREDICTIONS
) -> DataFrame:
    """Newest predictions of uploaded studies with their patient.

    Studies meet patients first: that side is far smaller than the predictions.
    """
    uploads = (
        studies.where(F.col("source_dataset") == "api_upload")
        .select("study_id", "patient_id")
        .join(patients.select("patient_id", F.col("display_name").alias("patient_name")), "patient_id")
    )
    return (
        predictions.join(uploads, "study_id")
        .select(
            "prediction_id", "study_id", "predicted_label", "prob_sana", "prob_neumonia",
            "prob_covid", "inferred_at", "patient_name", "patient_id",
            confidence().alias("confidence"),
        )
        .orderBy(F.col("inferred_at").desc(), F.col("prediction_id").desc())
        .limit(limit)
    )


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Foreign keys without a parent and the number of rows that carry them."""
    used = (
        child.where(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("key"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return used.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def existing_stored(requests: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """``existing`` for a table stored sorted by the key or with a Bloom filter on it: few requests read few row groups."""
    return existing(requests, rows_with(table.select(key), key, requests.select(key)), key)


def existing(requests: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Requests with a flag whether their key exists; ``key`` is unique in the table."""
    keys = table.select(key, F.lit(True).alias("_hit"))
    return requests.join(keys, key, "left").select(
        *requests.columns, F.coalesce("_hit", F.lit(False)).alias("found")
    )
