"""Set-based row changes: each returns the table as it is after the change.

Keys are unique on both sides of every join, so no join here has a hot key. Where a request
or an incoming batch may repeat a key, the caller makes it unique first (``latest_per_key``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardspark.operators.lookup import top_per_key


def latest_per_key(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    return top_per_key(df, [key], order)


def upsert(base: DataFrame, incoming: DataFrame, key: str, update: list[str]) -> DataFrame:
    """Insert new keys; on existing keys change only the listed columns (also to null).

    Columns of the base that the incoming rows lack are null on inserted rows.
    """
    new = incoming.select(
        F.col(key).alias("_key"), F.struct(*[c for c in incoming.columns if c != key]).alias("_new")
    )
    old = base.select(F.col(key), F.struct(*[c for c in base.columns if c != key]).alias("_old"))
    joined = old.join(new, old[key] == new["_key"], "full")

    def value(name: str) -> Column:
        old_value = F.col(f"_old.{name}")
        if name not in incoming.columns:
            return old_value
        new_value = F.col(f"_new.{name}")
        if name in update:
            return F.when(F.col("_new").isNotNull(), new_value).otherwise(old_value)
        return F.when(F.col("_old").isNotNull(), old_value).otherwise(new_value)

    return joined.select(
        *[
            F.coalesce(F.col(key), F.col("_key")).alias(c) if c == key else value(c).alias(c)
            for c in base.columns
        ]
    )


def insert_ignore(base: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Add incoming rows whose key is absent."""
    fresh = incoming.join(base.select(key), key, "left_anti")
    return base.unionByName(fresh, allowMissingColumns=True)


def patch(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Overwrite the fields that are given (not null) in the change row of the same key."""
    fields = [c for c in changes.columns if c != key]
    renamed = changes.select(key, *[F.col(c).alias(f"_{c}") for c in fields])
    return base.join(renamed, key, "left").select(
        *[F.coalesce(f"_{c}", c).alias(c) if c in fields else F.col(c) for c in base.columns]
    )


def set_flag(base: DataFrame, keys: DataFrame, key: str, flag: str) -> DataFrame:
    """Set a boolean column on the rows whose key is listed; ``keys`` may repeat."""
    listed = keys.select(key).distinct().select(key, F.lit(True).alias("_hit"))
    return base.join(listed, key, "left").select(
        *[(F.col(flag) | F.col("_hit").isNotNull()).alias(c) if c == flag else F.col(c)
          for c in base.columns]
    )


def set_null(child: DataFrame, fk: str, deleted: DataFrame, key: str) -> DataFrame:
    """Null a foreign key that points at a deleted row.

    A left join keeps the child rows where they are; a hot parent key is split by adaptive
    skew handling because the deleted side is unique.
    """
    gone = deleted.select(F.col(key).alias(fk)).distinct().withColumn("_gone", F.lit(True))
    return child.join(gone, fk, "left").select(
        *[F.when(F.col("_gone").isNull(), F.col(fk)).alias(c) if c == fk else F.col(c)
          for c in child.columns]
    )


def delete_decisions(requests: DataFrame, patients: DataFrame, studies: DataFrame) -> DataFrame:
    """Outcome of delete requests (patient_id, cascade): deleted, refused or not_found."""
    counted = studies.groupBy("patient_id").agg(F.count(F.lit(1)).alias("study_count"))
    known = patients.select("patient_id", F.lit(True).alias("_known"))
    n = F.coalesce("study_count", F.lit(0)).cast("bigint")
    outcome = (
        F.when(F.col("_known").isNull(), F.lit("not_found"))
        .when((n > 0) & ~F.coalesce("cascade", F.lit(False)), F.lit("refused"))
        .otherwise(F.lit("deleted"))
    )
    return (
        requests.join(known, "patient_id", "left")
        .join(counted, "patient_id", "left")
        .select(
            "patient_id", outcome.alias("outcome"), n.alias("study_count"),
            F.when(outcome == "deleted", n).otherwise(F.lit(0)).cast("bigint").alias("studies_deleted"),
        )
    )


def delete_patients(
    decisions: DataFrame, patients: DataFrame, studies: DataFrame, predictions: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The three tables without deleted patients, their studies and those studies' predictions."""
    gone = decisions.where(F.col("outcome") == "deleted").select("patient_id")
    lost = studies.join(gone, "patient_id", "left_semi").select("study_id")
    return (
        patients.join(gone, "patient_id", "left_anti"),
        studies.join(gone, "patient_id", "left_anti"),
        predictions.join(lost, "study_id", "left_anti"),
    )


def deleted_objects(decisions: DataFrame, studies: DataFrame) -> DataFrame:
    """Stored objects that a cascade leaves without a study: (object_key), each once.

    A key that a remaining study shares stays.
    """
    gone = decisions.where(F.col("outcome") == "deleted").select("patient_id", F.lit(True).alias("_gone"))
    held = studies.where(F.col("object_key").isNotNull()).join(gone, "patient_id", "left")
    use = held.groupBy("object_key").agg(F.bool_and(F.col("_gone").isNotNull()).alias("_all"))
    return use.where("_all").select("object_key")


def purge_demo(
    patients: DataFrame,
    studies: DataFrame,
    predictions: DataFrame,
    demo_sites: tuple[str, ...],
    demo_source: str = "api_upload",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Drop uploaded studies with their predictions, then demo patients.

    A demo patient has a generated name, or has no study left and belongs to a demo site.
    The OR makes it a flag column and not an anti join. Rows whose name, site or source is null stay, as SQL's
    DELETE keeps rows whose condition is unknown.
    """
    uploaded = studies.where(F.col("source_dataset") == demo_source).select("study_id")
    kept_predictions = predictions.join(uploaded, "study_id", "left_anti")
    kept_studies = studies.where(~F.coalesce(F.col("source_dataset") == demo_source, F.lit(False)))
    owners = kept_studies.select("patient_id").distinct().withColumn("_owner", F.lit(True))
    demo = F.col("display_name").like("Paciente %") | (
        F.col("_owner").isNull() & F.col("site_code").isin(*demo_sites)
    )
    kept_patients = patients.join(owners, "patient_id", "left").where(~F.coalesce(demo, F.lit(False))).drop("_owner")
    return kept_patients.select(*patients.columns), kept_studies, kept_predictions


def create_conflicts(requests: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Create requests whose key already exists."""
    return requests.join(table.select(key), key, "left_semi")
