"""Data-quality rules, audits and the alerts derived from them."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from wardspark.schemas import SEVERITIES


def issue_rows(rejected: DataFrame, run_id: Column) -> DataFrame:
    """Quality issue rows of all rejects."""
    return rejected.select(
        run_id.alias("run_id"),
        F.col("reject_reason").alias("issue_type"),
        F.col("file_path").alias("details"),
    )


def threshold_severity(total: Column, threshold: int = 10) -> Column:
    """Null below the threshold, warning below five times the threshold, then critical."""
    return (
        F.when(total < threshold, F.lit(None).cast("string"))
        .when(total < threshold * 5, F.lit("warning"))
        .otherwise(F.lit("critical"))
    )


def quality_alert(counts: DataFrame, threshold: int = 10) -> DataFrame:
    """Alert rows for counts (run_id, corrupt, incomplete, duplicate) at or over the threshold."""
    total = F.col("corrupt") + F.col("incomplete") + F.col("duplicate")
    message = F.concat(
        F.lit("Run "), F.col("run_id"), F.lit(" rejected files: corrupt "), F.col("corrupt"),
        F.lit(", incomplete "), F.col("incomplete"), F.lit(", duplicate "), F.col("duplicate"),
    )
    return counts.where(total >= threshold).select(
        "run_id",
        threshold_severity(total, threshold).alias("severity"),
        F.lit("Too many rejected files").alias("title"),
        message.alias("message"),
    )


def audit_counts(patients: DataFrame, studies: DataFrame, predictions: DataFrame) -> DataFrame:
    """One row: incomplete patients, API studies without object, objects without prediction."""
    bad_patients = patients.select(incomplete_patient().cast("int").alias("n")).select(
        F.lit("bad_patients").alias("k"), "n"
    )
    no_object = studies.select(missing_object().cast("int").alias("n")).select(
        F.lit("no_object").alias("k"), "n"
    )
    unpredicted = unpredicted_studies(studies, predictions).select(
        F.lit("no_prediction").alias("k"), F.lit(1).alias("n")
    )
    rows = bad_patients.unionByName(no_object).unionByName(unpredicted)

    def of(name: str) -> Column:
        value = F.sum(F.when(F.col("k") == name, F.col("n")))
        return F.coalesce(value, F.lit(0)).cast("bigint").alias(name)

    return rows.agg(of("bad_patients"), of("no_object"), of("no_prediction"))


def incomplete_patient() -> Column:
    blank_name = F.coalesce(F.trim("display_name") == "", F.lit(False))
    return blank_name | F.col("age_range").isNull() | (F.col("age_range") == "")


def missing_object() -> Column:
    return (F.col("source_dataset") == "api_upload") & F.col("object_key").isNull()


def unpredicted_studies(studies: DataFrame, predictions: DataFrame) -> DataFrame:
    """Studies with a stored object and no prediction.

    The prediction side is made distinct first: a study with very many predictions becomes
    one row per task before the shuffle.
    """
    stored = studies.where(F.col("object_key").isNotNull())
    return stored.join(predictions.select("study_id").distinct(), "study_id", "left_anti")


def audit_alert(counts: DataFrame) -> DataFrame:
    """One warning that joins the non-zero findings; no row when all are zero."""
    parts = [
        ("bad_patients", " patients lack personal data"),
        ("no_object", " uploaded studies lack their object"),
        ("no_prediction", " stored studies lack a prediction"),
    ]
    findings = F.array_compact(
        F.array(*[F.when(F.col(c) > 0, F.concat(F.col(c), F.lit(text))) for c, text in parts])
    )
    return counts.select(findings.alias("findings")).where(F.size("findings") > 0).select(
        F.lit("warning").alias("severity"),
        F.lit("Incomplete records found").alias("title"),
        F.concat_ws("; ", "findings").alias("message"),
    )


def failed_run_alerts(runs: DataFrame) -> DataFrame:
    return runs.where(F.col("status") == "failed").select(
        "run_id",
        F.lit("critical").alias("severity"),
        F.concat(F.lit("Run failed: "), "run_id").alias("title"),
        F.coalesce(F.nullif("error_message", F.lit("")), F.lit("no details given")).alias("message"),
    )


def task_failure_alerts(failures: DataFrame) -> DataFrame:
    """Alerts for failed tasks (dag_id, task_id, run_id, exception), with defaults for nulls."""
    return failures.select(
        "run_id",
        F.lit("critical").alias("severity"),
        F.concat(
            F.lit("Task failed: "), F.coalesce("dag_id", F.lit("unknown")), F.lit("."),
            F.coalesce("task_id", F.lit("unknown")),
        ).alias("title"),
        F.coalesce("exception", F.lit("no details given")).alias("message"),
    )


def normal_severity(severity: Column) -> Column:
    return F.when(severity.isin(*SEVERITIES), severity).otherwise(F.lit("warning"))


def normalise_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts as stored: known severity, whole texts."""
    return alerts.select(
        "run_id",
        normal_severity(F.col("severity")).alias("severity"),
        "title",
        "message",
    )


def violations(df: DataFrame, table: str, rules: Mapping[str, Column]) -> DataFrame:
    """Rows (table_name, rule, violations), all rules of a table counted in one pass.

    A rule is a condition that must hold; as in SQL, an unknown condition is no violation.
    """
    counted = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    pairs = F.array(
        *[F.struct(F.lit(n).alias("rule"), F.col(n).alias("violations")) for n in rules]
    )
    return counted.select(F.inline(pairs)).select(
        F.lit(table).alias("table_name"), "rule", "violations"
    )


def watched(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, Observation]:
    """The rows, and what will have been seen of the rules when a job has read them all.

    The counts ride on whatever job writes the rows, so checking them costs no scan.
    """
    seen = Observation()
    return df.observe(seen, *[F.count_if(~rule).alias(name) for name, rule in rules.items()]), seen


def seen_violations(spark: SparkSession, table: str, seen: Observation) -> DataFrame:
    """``violations`` from counts that were observed; waits for the job that does so."""
    counts = [(table, rule, n) for rule, n in seen.get.items()]
    return spark.createDataFrame(counts, "table_name string, rule string, violations bigint")


def prediction_rules() -> dict[str, Column]:
    probs = ("prob_sana", "prob_neumonia", "prob_covid")
    total = F.col(probs[0]) + F.col(probs[1]) + F.col(probs[2])
    rules = {f"{p}_range": F.col(p).between(0, 1) for p in probs}
    rules["probs_sum"] = F.abs(total - F.lit(1).cast("decimal(6,5)")) < F.lit("0.0001").cast(
        "decimal(6,5)"
    )
    return rules


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key))
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where(F.col("occurrences") > 1)
    )


def recent_issues(issues: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    since = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"interval {days} days")
    return issues.where(F.col("detected_at") > since)


class Role(NamedTuple):
    """A column of a table that refers to another (``parent`` false) or is referred to, under the link's name."""

    link: str
    column: str
    parent: bool = False


def orphan_counts(tables: list[tuple[DataFrame, list[Role]]]) -> DataFrame:
    """Rows (fk, orphan_rows, orphan_keys) for every link named by the roles.

    Each table is read once, whatever its roles are, and counted per link and key before the one shuffle.
    """
    frames = []
    for df, roles in tables:
        uses = F.array(*[
            F.struct(F.lit(r.link).alias("fk"), F.col(r.column).cast("string").alias("key"),
                     F.lit(int(not r.parent)).cast("bigint").alias("n"), F.lit(r.parent).alias("found"))
            for r in roles
        ])
        frames.append(df.select(F.inline(uses)))
    links = sorted({r.link for _, roles in tables for r in roles})
    # One row per link, so that links of empty tables are reported too.
    frames.append(tables[0][0].sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(x) for x in links])).alias("fk"), F.lit(None).cast("string").alias("key"),
        F.lit(0).cast("bigint").alias("n"), F.lit(True).alias("found")))
    rows = frames[0]
    for frame in frames[1:]:
        rows = rows.unionByName(frame)
    keys = rows.groupBy("fk", "key").agg(F.sum("n").alias("n"), F.bool_or("found").alias("found"))
    lost = ~F.col("found") & F.col("key").isNotNull()
    return keys.groupBy("fk").agg(
        F.coalesce(F.sum(F.when(lost, F.col("n"))), F.lit(0)).cast("bigint").alias("orphan_rows"),
        F.count_if(lost).alias("orphan_keys"),
    )


def health(checks: DataFrame) -> DataFrame:
    """``ok`` when every check (name, ok) is ok, else ``degraded`` with the number failing."""
    all_ok = F.coalesce(F.bool_and("ok"), F.lit(True))
    return checks.agg(
        F.when(all_ok, F.lit("ok")).otherwise(F.lit("degraded")).alias("status"),
        F.count_if(~F.col("ok")).alias("failing"),
        F.count(F.lit(1)).alias("checks"),
    )
