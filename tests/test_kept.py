"""Totals kept per load, checks that ride on writes, and tables that readers skip."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wardspark.catalog.domain import Domain
from wardspark.operators import logs, quality, validate
from wardspark.operators.totals import Partials
from wardspark.plans import dashboard as job
from wardspark.sources import skipping


def rows_scanned(df):
    """Collect, and count the rows that left the scan of the first table."""
    got = df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.getClass().getSimpleName() in ("AdaptiveSparkPlanExec",):
        plan = plan.executedPlan()
    scan = plan.collectLeaves().apply(0)
    return got, scan.metrics().apply("numOutputRows").value()


def test_partials_load_only_new_files(spark, tmp_path):
    source, seen = str(tmp_path / "source"), []
    parts = Partials(spark, str(tmp_path / "parts"), source)

    def build(names):
        seen.append(len(names))
        rows_ = spark.read.parquet(*names)
        return {"sums": rows_.groupBy("k").agg(F.sum("v").alias("v"), F.hll_sketch_agg("v").alias("sketch"))}

    def total():
        merged = parts.read("sums").groupBy("k").agg(F.sum("v").alias("v"), F.hll_union_agg("sketch").alias("s"))
        return rows(merged.select("k", "v", F.hll_sketch_estimate("s")))

    def add(low, high):
        spark.range(low, high).select((F.col("id") % 2).alias("k"), F.col("id").alias("v")).coalesce(1).write.mode("append").parquet(source)

    add(0, 10)
    assert parts.refresh(build) == 1 and parts.refresh(build) == 0
    assert total() == [(0, 20, 5), (1, 25, 5)]
    add(5, 15)
    assert parts.refresh(build) == 1 and seen == [1, 1]
    assert total() == [(0, 20 + 50, 8), (1, 25 + 45, 7)]
    # A file that changed: all is built anew.
    spark.range(2).select(F.lit(0).alias("k"), F.col("id").alias("v")).coalesce(1).write.mode("overwrite").parquet(source)
    assert parts.refresh(build) == 1 and total() == [(0, 1, 2)]


def test_dashboard_job_reads_predictions_once(spark, tmp_path):
    d, tables, out = Domain(spark, "/root/testdata/sf0.001"), str(tmp_path / "tables"), str(tmp_path / "out")
    for name in ("patients", "studies", "predictions", "alerts"):
        getattr(d, name)().write.parquet(f"{tables}/{name}")
    spark.createDataFrame([("R1", "ok"), ("R2", "failed")], "run_id string, status string").write.parquet(f"{tables}/runs")
    job.run(spark, tables, out)
    first = spark.read.json(f"{out}/document").first()
    assert first.metrics.predictions_total == d.predictions().count() and first.health.status == "degraded"
    d.predictions().limit(7).write.mode("append").parquet(f"{tables}/predictions")
    job.run(spark, tables, out)
    again = spark.read.json(f"{out}/document").first()
    assert again.metrics.predictions_total == first.metrics.predictions_total + 7
    assert sum(x.total for x in again.predictions_by_class) == again.metrics.predictions_total


def test_counts_ride_on_the_write(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (-2, "b"), (None, "a")], "v int, k string")
    watched, seen = quality.watched(df, {"positive": F.col("v") > 0, "short": F.length("k") < 5})
    watched.write.parquet(str(tmp_path / "t"))
    assert rows(quality.seen_violations(spark, "t", seen)) == [("t", "positive", 1), ("t", "short", 0)]
    classified = spark.createDataFrame([(None, 3), ("corrupt", 2), ("duplicate", 1)], "reject_reason string, listed long")
    for times, expected in ((None, (3, 1, 2, 1, 0, 1)), (F.col("listed"), (6, 1, 5, 2, 0, 3))):
        watched, seen = validate.watched(classified, times)
        watched.write.mode("overwrite").parquet(str(tmp_path / "c"))
        assert rows(validate.seen_report(spark, seen)) == [expected]
    watched, seen = validate.watched(classified.limit(0))
    watched.write.mode("overwrite").parquet(str(tmp_path / "c"))
    assert rows(validate.seen_report(spark, seen)) == [(0,) * 6]


def test_lookups_read_few_row_groups(spark, tmp_path):
    path = str(tmp_path / "t")
    big = spark.range(60_000).select(F.concat(F.lit("K"), F.md5(F.col("id").cast("string"))).alias("k"), F.col("id").alias("at"))
    skipping.write_sorted(big, path, ["at"], ids=("k",), group_bytes=64 << 10)
    table = spark.read.parquet(path)
    some = big.where("at in (5, 70, 59999)").select("k").unionAll(spark.createDataFrame([(None,), ("none",)], "k string"))
    got, read = rows_scanned(skipping.rows_with(table, "k", some))
    assert sorted(r.at for r in got) == [5, 70, 59999] and read < 30_000
    got, read = rows_scanned(table.where("at between 100 and 110"))
    assert len(got) == 11 and read < 15_000
    many = big.where("at < 3000").select("k")
    assert skipping.rows_with(table, "k", many).count() == 3000
    assert skipping.rows_with(table, "k", many.limit(0)).count() == 0


def test_stored_logs_answer_from_the_newest_hours(spark, tmp_path):
    start = dt.datetime(2026, 1, 1)
    docs = spark.range(5000).select(
        "id", F.col("id").alias("event_id"), (F.lit(start).cast("timestamp_ntz") + F.expr("make_interval(0,0,0,0,0,cast(id as int))")).alias("event_time"),
        F.when(F.col("id") % 3 == 0, "ERROR").otherwise("INFO").alias("level"), F.lit("s").alias("service"), F.lit("r").alias("run_id"))
    docs = docs.unionByName(docs.limit(1).withColumn("event_time", F.lit(None).cast("timestamp_ntz")))
    logs.store_logs(docs, str(tmp_path / "logs"))
    for asked in ({"limit": 10}, {"limit": 500, "level": "error"}, {"limit": 100, "level": "warning"}):
        stored = logs.query_stored(spark, str(tmp_path / "logs"), **asked)
        assert [r.event_id for r in stored.collect()] == [r.event_id for r in logs.query_logs(docs, **asked).collect()]
    for wrong in (0, 501):
        with pytest.raises(ValueError, match="between 1 and 500"):
            logs.query_logs(docs, limit=wrong)
