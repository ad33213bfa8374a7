import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wardspark.functions.clean import patient_problems
from wardspark.operators import quality, studies as st, validate
from wardspark.schemas import RUN_EVENTS_CSV, STUDIES_CSV
from wardspark.sources import files

JPEG = b"\xff\xd8\xff" + b"a" * 600
OTHER = b"\xff\xd8\xff" + b"b" * 600


def manifest(spark):
    data = [
        ("p/1", "train", "NORMAL", "", JPEG), ("p/2", "train", "NORMAL", None, JPEG),
        ("p/0", "test", "COVID19", "covid", JPEG), ("p/4", "train", "ODD", "", JPEG),
        ("p/5", "val", "NORMAL", "sana", JPEG), ("p/6", "train", "NORMAL", "sana", b"no"),
        ("p/7", "train", "NORMAL", "sana", None), ("p/8", "train", "PNEUMONIA", "", OTHER),
        ("p/9", None, "PNEUMONIA", "", OTHER),
    ]
    return spark.createDataFrame(data, "file_path string, split string, folder string, label string, content binary")


def test_classification(spark):
    inspected = validate.inspect_files(manifest(spark))
    got = dict(rows(validate.classify(inspected).select("file_path", "reject_reason")))
    # Invalid rows with the same content take no part in the ranking of copies.
    assert got == {
        "p/0": None, "p/1": "duplicate", "p/2": "duplicate", "p/4": "incomplete", "p/5": "incomplete",
        "p/6": "corrupt", "p/7": "corrupt", "p/8": None, "p/9": "incomplete",
    }
    keys = rows(validate.accepted(validate.classify(inspected)).select("object_key"))
    assert all(k[0].startswith("raw/") and k[0].endswith(".jpg") for k in keys) and len(keys) == 2


def test_report_equals_classification(spark):
    inspected = validate.inspect_files(manifest(spark))
    direct = validate.ingest_report(inspected).first()
    classified = validate.classify(inspected).agg(*validate.report_columns()).first()
    assert direct == classified
    assert tuple(direct) == (9, 2, 7, 2, 3, 2)


def test_report_of_nothing_is_zero(spark):
    assert tuple(validate.ingest_report(validate.inspect_files(manifest(spark).limit(0))).first()) == (0,) * 6


def test_hot_content_is_reduced_before_the_shuffle(spark):
    plan = validate.first_copies(validate.inspect_files(manifest(spark)))._jdf.queryExecution().toString()
    assert "partial_min" in plan


def test_study_rules_with_nulls(spark):
    good = ("S1", "P1", "f1", " TRAIN", "COVID ", "d", "CR", "chest", "2026-01-01T00:00:00Z")
    data = [good] + [
        tuple(None if j == i else (f"S{n}" if j == 0 else v) for j, v in enumerate(good))
        for n, i in enumerate((0, 1, 2, 3, 4, 8), start=2)
    ] + [("S1", "P1", "f0") + good[3:], ("S9",) + good[1:8] + ("bad",)]
    raw = spark.createDataFrame(data, STUDIES_CSV)
    cleaned = st.clean_studies(raw)
    valid, invalid = st.valid_studies(cleaned), st.invalid_studies(cleaned)
    assert rows(valid.select("study_id", "file_path", "label", "split")) == [("S1", "f0", "covid", "train")]
    # A null in any rule column is invalid, and no row is on both sides.
    assert sorted(p[0] for p in invalid.select(F.array_join("problems", ",")).collect()) == sorted(
        ["study_id", "patient_id", "file_path", "split", "label", "captured_at", "captured_at"]
    )
    assert valid.count() + invalid.count() == 8


def test_events(spark):
    data = [("1", "R", "s", "ok", "3", "m" * 2100, "2026-01-01T00:00:00Z"), ("2", "R", "s", "ok", "", None, None),
            ("3", None, "s", "ok", None, "x", "bad")]
    got = st.clean_events(spark.createDataFrame(data, RUN_EVENTS_CSV), "2026-02-02 00:00:00").collect()
    assert [(r.records, len(r.message), str(r.logged_at)) for r in got] == [
        (3, 2100, "2026-01-01 00:00:00"), (0, 0, "2026-02-02 00:00:00"), (0, 1, "2026-02-02 00:00:00")]
    stubs = st.run_stubs(spark.createDataFrame(data, RUN_EVENTS_CSV), "2026-02-02 00:00:00")
    assert [r.run_id for r in stubs.collect()] == ["R"]


def test_required_columns_and_order(spark, tmp_path):
    (tmp_path / "s.csv").write_text(
        "label,study_id,patient_id,file_path,split,source_dataset,modality,body_part,captured_at,extra\n"
        "sana,S,P,f,train,d,CR,chest,2026-01-01,zzz\n"
    )
    row = files.read_csv_text(spark, str(tmp_path / "s.csv"), STUDIES_CSV).first()
    assert row.study_id == "S" and row.label == "sana"
    with pytest.raises(ValueError, match="captured_at"):
        files.require_columns(spark.range(1).toDF("study_id"), ["study_id", "captured_at"])


@pytest.mark.parametrize("total,severity", [(9, None), (10, "warning"), (49, "warning"), (50, "critical")])
def test_quality_thresholds(spark, total, severity):
    counts = spark.createDataFrame([("R", total - 3, 2, 1)], "run_id string, corrupt int, incomplete int, duplicate int")
    got = quality.quality_alert(counts).collect()
    assert [r.severity for r in got] == ([severity] if severity else [])
    if got:
        assert got[0].message == f"Run R rejected files: corrupt {total - 3}, incomplete 2, duplicate 1"


def test_probability_rules(spark):
    data = [("1.00000", "0.00000", "0.00000"), ("0.50000", "0.50009", "0.00000"), ("0.50000", "0.50010", "0.00000"),
            ("-0.10000", "0.60000", "0.50000"), (None, "0.50000", "0.50000")]
    df = spark.createDataFrame(data, "a string, b string, c string").select(
        *[F.col(x).cast("decimal(6,5)").alias(n) for x, n in zip("abc", ("prob_sana", "prob_neumonia", "prob_covid"))])
    got = {r.rule: r.violations for r in quality.violations(df, "t", quality.prediction_rules()).collect()}
    assert got == {"prob_sana_range": 1, "prob_neumonia_range": 0, "prob_covid_range": 0, "probs_sum": 1}


def test_audit_alert_joins_findings(spark):
    counts = spark.createDataFrame([(2, 0, 3)], "bad_patients long, no_object long, no_prediction long")
    assert quality.audit_alert(counts).first().message == (
        "2 patients lack personal data; 3 stored studies lack a prediction")
    assert quality.audit_alert(spark.createDataFrame([(0, 0, 0)], counts.schema)).count() == 0


def test_health_and_severity(spark):
    checks = spark.createDataFrame([("a", True), ("b", False)], "name string, ok boolean")
    assert tuple(quality.health(checks).first()) == ("degraded", 1, 2)
    assert quality.health(checks.where("ok")).first().status == "ok"
    got = quality.normalise_alerts(spark.createDataFrame(
        [("r", "loud", "t" * 200, "m" * 5000), ("r", None, "t", "m")], "run_id string, severity string, title string, message string"))
    assert [(r.severity, len(r.title), len(r.message)) for r in got.collect()] == [("warning", 200, 5000), ("warning", 1, 1)]


def test_patient_problems(spark):
    df = spark.createDataFrame(
        [("PAT-abc123", "Ana", "f", "18-30", "S1"), ("PAT-1", " ", "q", "", None), (None, "a" * 81, None, "x" * 11, "S1")],
        "patient_id string, display_name string, sex string, age_range string, site_code string")
    got = [r[0] for r in df.select(patient_problems(F.col("site_code").isNotNull())).collect()]
    assert got == [[], ["display_name", "patient_id", "sex", "age_range", "site_code"], ["display_name", "patient_id", "age_range"]]


def test_one_content_holding_a_third_of_all_files(spark):
    """Brute force in Python against the operators, with one hot content and many rare ones."""
    data = [(f"p/{i:05d}", "train", "NORMAL", "", JPEG if i % 3 == 0 else JPEG + str(i // 4).encode()) for i in range(3000)]
    df = spark.createDataFrame(data, "file_path string, split string, folder string, label string, content binary")
    first = {}
    for path, *_, body in sorted(data):
        first.setdefault(body, path)
    inspected = validate.inspect_files(df.repartition(8))
    assert rows(validate.accepted(validate.classify(inspected)).select("file_path")) == [(p,) for p in sorted(first.values())]
    report = validate.ingest_report(inspected).first()
    assert (report.valid_unique, report.duplicates_removed) == (len(first), 3000 - len(first))
