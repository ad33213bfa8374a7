import datetime as dt

from pyspark.sql import functions as F

from wardspark.functions import clean, clinical, content, ids, paths
from wardspark.operators.logs import parse_logs
from wardspark.plans.runs import new_run_id


def one(spark, column, **values):
    base = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return base.select(column).first()[0]


def test_hash_ids_equal_published_values(spark):
    assert one(spark, ids.hash_int(F.col("x")), x="PAT-0011223344") == 4226170407
    assert one(spark, ids.sample_id(F.lit("a"), F.lit("b"), F.lit("c"))) == "b0ee04f880c4ff42"
    assert one(spark, ids.display_name_from_id(F.col("x")), x="PAT-0011223344") == "Paciente 223344"
    assert one(spark, ids.upload_object_key(F.lit("STU-1"), F.col("x")), x=".jpeg") == "uploads/STU-1.jpg"
    assert one(spark, ids.upload_object_key(F.lit("STU-1"), F.col("x")), x=".png") == "uploads/STU-1.png"


def test_age_from_range(spark):
    cases = [("18-30", None, 24), ("76+", None, 76), ("x", None, 40), (None, None, 40), ("18-30", 130, 120),
             ("60-", None, 60), ("61-75+", None, 68), ("999", None, 120), ("18-30", -3, 0), ("", None, 40)]
    df = spark.createDataFrame([(r, a) for r, a, _ in cases], "r string, a int")
    got = [x[0] for x in df.select(clean.age_from_range(F.col("r"), F.col("a"))).collect()]
    assert got == [c[2] for c in cases]


def test_sex_symptoms_timestamp_int(spark):
    assert one(spark, clean.normal_sex(F.col("x")), x=" female ") == "F"
    assert one(spark, clean.normal_sex(F.lit(None).cast("string"))) == "X"
    assert one(spark, clean.usable_symptoms(F.col("x")), x=" ab ") is False
    assert one(spark, clean.usable_symptoms(F.lit(None).cast("string"))) is False
    assert str(one(spark, clean.timestamp(F.col("x")), x="2026-04-01T09:00:00Z")) == "2026-04-01 09:00:00"
    assert one(spark, clean.timestamp(F.col("x")), x="soon") is None
    assert one(spark, clean.timestamp(F.col("x")), x="12:30") is None
    assert str(one(spark, clean.timestamp(F.col("x")), x="2026-01-01T00:00:00.5+02:00")) == "2025-12-31 22:00:00.500000"
    assert one(spark, clean.int_or_zero(F.col("x")), x=" ") == 0
    assert one(spark, clean.shorten(F.col("x")), x="a" * 121) == "a" * 120 + "…"
    assert one(spark, clean.shorten(F.col("x")), x="a" * 120) == "a" * 120


def test_routes(spark):
    cases = [("train/NORMAL/a.jpg", "keep"), ("test/COVID19/x/a.JPEG", "keep"), ("a.jpg", "default"),
             ("train/a.jpg", "reject"), ("train/OTHER/a.jpg", "reject"), ("val/NORMAL/a.jpg", "reject"),
             ("train/NORMAL/a.png", "ignore"), (None, "ignore")]
    df = spark.createDataFrame([(p,) for p, _ in cases], "path string")
    assert [r[0] for r in df.select(paths.route(F.col("path"))).collect()] == [c[1] for c in cases]


def test_labels_and_parts(spark):
    assert one(spark, paths.label_or_folder(F.lit(""), F.lit("COVID19"))) == "covid"
    assert one(spark, paths.label_or_folder(F.lit("sana"), F.lit("COVID19"))) == "sana"
    assert one(spark, paths.label_or_folder(F.lit(None).cast("string"), F.lit("NOPE"))) is None
    assert one(spark, paths.key_value_part(F.lit("/l/dag_id=a/run_id=b/x.log"), "run_id")) == "b"
    assert one(spark, paths.key_value_part(F.lit("/l/x.log"), "run_id")) is None
    assert one(spark, paths.base_name(F.lit("c:\\x/y.JPG"))) == "y.JPG"
    assert one(spark, paths.resolve_local(F.lit("data/raw/data/a"), "/srv")) == "/srv/raw/data/a"


def test_content_check_edges(spark):
    jpeg = b"\xff\xd8\xff"
    cases = [(jpeg + b"x" * 496, False), (jpeg + b"x" * 497, True), (jpeg + b"x" * 498, True),
             (b"\x89PNG\r\n\x1a\n" + b"x" * 600, False), (b"", False), (None, False)]
    df = spark.createDataFrame([(c,) for c, _ in cases], "content binary")
    assert [r[0] for r in df.select(content.is_valid_jpeg(F.col("content"))).collect()] == [c[1] for c in cases]


def test_upload_problems(spark):
    jpeg = b"\xff\xd8\xff" + b"x" * 10
    cases = [("a.jpg", ".jpg", jpeg, 64, 64, None), ("..", "", jpeg, 64, 64, "missing_name"),
             ("a..jpg", ".jpg", jpeg, 64, 64, "bad_name"), ("a.gif", ".gif", jpeg, 64, 64, "bad_extension"),
             ("a.jpg", ".jpg", b"", 64, 64, "empty"), ("a.jpg", ".jpg", b"GIF8", 64, 64, "bad_format"),
             ("a.jpg", ".jpg", jpeg, 63, 64, "too_small"), ("a.jpg", ".jpg", jpeg, None, None, "undecodable")]
    df = spark.createDataFrame([c[:5] for c in cases], "n string, e string, c binary, w int, h int")
    got = df.select(content.upload_problem(*[F.col(x) for x in "necwh"])).collect()
    assert [r[0] for r in got] == [c[5] for c in cases]


def test_log_lines(spark):
    lines = [
        ("[2026-05-01 10:00:00] INFO [api] — started", "bracket", "2026-05-01 10:00:00", "INFO", "api", "started"),
        ("[2026-05-01T10:00:00] ERROR [ml] — a — b", "bracket", "2026-05-01 10:00:00", "ERROR", "ml", "a — b"),
        ("[yesterday] INFO [api] — x", "bracket", "None", "INFO", "api", "x"),
        ("[2026-05-01 10:00:00,123] {t.py:1} - done", "task", "2026-05-01 10:00:00.123000", "INFO", "t.py:1", "done"),
        ("[2026-05-01T10:00:00+02:00] INFO [api] — z", "bracket", "2026-05-01 08:00:00", "INFO", "api", "z"),
        ("2026-05-01T10:00:00.250-01:00 | INFO | w | m", "service", "2026-05-01 11:00:00.250000", "INFO", "w", "m"),
        ("2026-05-01T10:00:00 | WARNING | watcher | a | b", "service", "2026-05-01 10:00:00", "WARNING", "watcher", "a | b"),
        ("[2026-05-01 10:00:00] no format", "raw", "None", "INFO", "raw", "[2026-05-01 10:00:00] no format"),
        ("price $1 \\2", "raw", "None", "INFO", "raw", "price $1 \\2"),
    ]
    df = spark.createDataFrame([(x[0], "/l/a.log") for x in lines] + [("   ", "/l/a.log")], "line string, path string")
    got = parse_logs(df).select("format", "event_time", "level", "logger", "message").collect()
    assert [tuple(map(str, r)) for r in got] == [x[1:] for x in lines]


def test_probabilities_and_names(spark):
    top = clinical.top_entries(clinical.probabilities(F.lit('{"b":0.2,"a":0.2,"c":0.6}')), 2)
    assert [tuple(e) for e in one(spark, top)] == [("c", 0.6), ("a", 0.2)]
    assert one(spark, clinical.argmax_label(F.array(F.lit(0.4), F.lit(0.4), F.lit(0.2)), ("x", "y", "z"))) == "x"
    assert one(spark, clinical.diagnosis_name(F.lit("otra_cosa"))) == "otra cosa"
    assert one(spark, clinical.iso_text(F.lit("2026-01-02 03:04:05.000600").cast("timestamp_ntz"))) == "2026-01-02T03:04:05.000600"
    assert one(spark, clinical.iso_text(F.lit("2026-01-02 03:04:05").cast("timestamp_ntz"))) == "2026-01-02T03:04:05"


def test_run_ids_of_driver_and_columns_agree(spark):
    at = dt.datetime(2026, 3, 4, 5, 6, 7)
    row = spark.createDataFrame([(at, "IMG")], "at timestamp_ntz, kind string").select(ids.run_id(F.col("at"), F.col("kind"))).first()
    assert row[0] == new_run_id("IMG", at) == "RUN-20260304-050607-IMG"
