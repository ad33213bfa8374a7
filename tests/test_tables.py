import datetime as dt

from pyspark.sql import functions as F

from tests.conftest import rows
from wardspark.operators import lookup, mutate, summary
from wardspark.sources import files
from wardspark.sources.sinks import Snapshots


def at(day):
    return dt.datetime(2026, 1, day)


def tables(spark):
    patients = spark.createDataFrame(
        [("P1", "Ana", "F", "18-30", "S1"), ("P2", "Luis", "M", "31-45", "S1"), ("P3", "Paciente 1", "X", "76+", "S9")],
        "patient_id string, display_name string, sex string, age_range string, site_code string")
    studies = spark.createDataFrame(
        [("A", "P1", "k", "xray", at(1)), ("B", "P1", None, "api_upload", at(2)), ("C", "P0", "k", "api_upload", at(3))],
        "study_id string, patient_id string, object_key string, source_dataset string, ingested_at timestamp_ntz")
    predictions = spark.createDataFrame(
        [(1, "A", "sana", 0.7, 0.2, 0.1, at(5)), (2, "A", "covid", 0.1, 0.2, 0.7, at(5)), (3, "B", "sana", 0.9, 0.1, 0.0, at(1))],
        "prediction_id long, study_id string, predicted_label string, prob_sana double, prob_neumonia double, "
        "prob_covid double, inferred_at timestamp_ntz")
    sites = spark.createDataFrame([("S1", "One", True), ("S9", "Nine", False)], "site_code string, site_name string, active boolean")
    return patients, studies, predictions, sites


def test_latest_prediction_ties_and_absence(spark):
    _, studies, predictions, _ = tables(spark)
    got = rows(lookup.studies_with_latest(studies, predictions).select("study_id", "prediction_id", "confidence"))
    assert got == [("A", 2, 0.7), ("B", 3, 0.9), ("C", None, None)]


def test_top_per_key_is_limited_before_the_shuffle(spark):
    plan = lookup.latest_predictions(tables(spark)[2])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_patient_list_keeps_zero(spark):
    patients, studies, _, sites = tables(spark)
    got = rows(lookup.patient_list(patients, sites, studies).select("patient_id", "study_count"))
    assert got == [("P1", 2), ("P2", 0), ("P3", 0)]


def test_recent_lists(spark):
    patients, studies, predictions, _ = tables(spark)
    got = rows(lookup.recent_studies(studies, patients, predictions).select("study_id", "predicted_label", "patient_name"))
    assert got == [("A", "covid", "Ana"), ("C", None, None)]
    assert rows(lookup.recent_predictions(predictions, studies, patients).select("prediction_id")) == [(3,)]


def test_percent_of_nothing(spark):
    predictions = tables(spark)[2]
    assert summary.predictions_percent(predictions.limit(0)).count() == 0
    assert rows(summary.predictions_percent(predictions)) == [("covid", 1, 33.3), ("sana", 2, 66.7)]
    assert tuple(summary.platform_totals(predictions.limit(0), tables(spark)[1], tables(spark)[0]).first()) == (0, 2, 3)


def test_enum_order(spark):
    df = spark.createDataFrame([("covid", "train"), (None, "clinical"), ("sana", "test"), ("sana", "train")], "label string, split string")
    got = [tuple(r)[:2] for r in summary.study_counts_by_label(df).collect()]
    assert got == [("sana", "train"), ("sana", "test"), ("covid", "train"), (None, "clinical")]


def test_upsert_changes_only_listed_columns(spark):
    base = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, n int, t string")
    new = spark.createDataFrame([("b", None, "z"), ("c", 3, "w")], "k string, n int, t string")
    assert rows(mutate.upsert(base, new, "k", ["n"])) == [("a", 1, "x"), ("b", None, "y"), ("c", 3, "w")]
    assert rows(mutate.upsert(base, new.drop("t"), "k", ["n"])) == [("a", 1, "x"), ("b", None, "y"), ("c", 3, None)]
    once = mutate.upsert(base, new, "k", ["n", "t"])
    assert rows(mutate.upsert(once, new, "k", ["n", "t"])) == rows(once)


def test_insert_ignore_patch_flag_null(spark):
    base = spark.createDataFrame([("a", "x", False), ("b", None, True)], "k string, fk string, f boolean")
    extra = spark.createDataFrame([("b", "q", False), ("c", "q", False)], base.schema)
    assert rows(mutate.insert_ignore(base, extra, "k")) == [("a", "x", False), ("b", None, True), ("c", "q", False)]
    change = spark.createDataFrame([("a", None), ("b", "new")], "k string, fk string")
    assert rows(mutate.patch(base, change, "k").select("k", "fk")) == [("a", "x"), ("b", "new")]
    keys = spark.createDataFrame([("a",), ("a",), ("z",)], "k string")
    assert rows(mutate.set_flag(base, keys, "k", "f").select("k", "f")) == [("a", True), ("b", True)]
    gone = spark.createDataFrame([("x",), ("x",)], "id string")
    assert rows(mutate.set_null(base, "fk", gone, "id").select("k", "fk")) == [("a", None), ("b", None)]


def test_delete_rules(spark):
    patients, studies, predictions, _ = tables(spark)
    ask = spark.createDataFrame([("P1", False), ("P2", None), ("P9", True)], "patient_id string, cascade boolean")
    decided = mutate.delete_decisions(ask, patients, studies)
    assert rows(decided) == [("P1", "refused", 2, 0), ("P2", "deleted", 0, 0), ("P9", "not_found", 0, 0)]
    decided = mutate.delete_decisions(ask.withColumn("cascade", F.lit(True)), patients, studies)
    left = mutate.delete_patients(decided, patients, studies, predictions)
    assert [df.count() for df in left] == [1, 1, 0]


def test_purge_demo(spark):
    patients, studies, predictions, _ = tables(spark)
    left = mutate.purge_demo(patients, studies, predictions, ("S1",))
    assert [rows(df.select(df.columns[0])) for df in left] == [[("P1",)], [("A",)], [("A",), ("A",)]]


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([("x",), ("x",), (None,), ("y",)], "fk string")
    parent = spark.createDataFrame([("y",)], "id string")
    assert rows(lookup.orphans(child, "fk", parent, "id")) == [("x", 2)]


def test_purge_keeps_rows_with_unknown_values(spark):
    patients = spark.createDataFrame([("P1", None, "S3"), ("P2", "Ana", None), ("P3", "Paciente 3", "S1"), ("P4", "Eva", "S3")],
                                     "patient_id string, display_name string, site_code string")
    studies = spark.createDataFrame([("s1", "P1", None), ("s2", "P4", "api_upload")], "study_id string, patient_id string, source_dataset string")
    predictions = spark.createDataFrame([("s1",), ("s2",)], "study_id string")
    left = mutate.purge_demo(patients, studies, predictions, ("S3",))
    assert [rows(x.select(x.columns[0])) for x in left] == [[("P1",), ("P2",)], [("s1",)], [("s1",)]]


def test_objects_of_deleted_studies(spark):
    decisions = spark.createDataFrame([("P1", "deleted"), ("P2", "refused")], "patient_id string, outcome string")
    studies = spark.createDataFrame([("P1", "a"), ("P1", "b"), ("P2", "b"), ("P1", None), ("P3", "c")], "patient_id string, object_key string")
    assert rows(mutate.deleted_objects(decisions, studies)) == [("a",)]


def test_versions_are_never_overwritten(spark, tmp_path):
    table = Snapshots(spark, str(tmp_path / "t"))
    assert table.commit(spark.range(1)) == 1
    (tmp_path / "t" / "version=000002").mkdir()  # a write that broke off
    assert table.latest() == 1 and table.commit(spark.range(3)) == 3
    assert table.latest() == 3 and table.read().count() == 3


def test_malformed_csv_lines(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("a,b\n1,2\n1,2,3\n4\n")
    assert rows(files.malformed_csv_lines(spark, str(path))) == [("1,2,3",), ("4",)]
