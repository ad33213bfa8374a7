import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wardspark.catalog import streams
from wardspark.operators import arrivals as arr
from wardspark.plans import log_sync
from wardspark.streaming import flows
from wardspark.streaming.log_tail import LogTail, read_range, whole_length

T0 = dt.datetime(2026, 1, 1)


def sec(n):
    return T0 + dt.timedelta(seconds=n)


def arrivals(spark):
    data = [(1, sec(0), "train/NORMAL/a.jpg"), (2, sec(1), "train/NORMAL/a.jpg"), (3, sec(3), "train/NORMAL/a.jpg"),
            (4, sec(10), "train/NORMAL/a.jpg"), (5, sec(0), "b.JPG"), (6, sec(0), "x/y/c.jpg"), (7, sec(0), "d.txt")]
    return spark.createDataFrame(data, "event_id long, ts timestamp, path string")


def test_debounce_batch(spark):
    got = rows(arr.debounce(arrivals(spark).where("path like '%a.jpg'"), "2 seconds").select("last_event", "events"))
    # An event exactly one gap after the last one starts a new burst.
    assert got == [(sec(1), 2), (sec(10), 1), (sec(3), 1)]


def test_name_clash_gets_suffix(spark):
    got = dict(rows(arr.destinations(arr.route_arrivals(arrivals(spark))).select("event_id", "destination")))
    assert got[1] == "train/NORMAL/a.jpg" and got[5] == "train/NORMAL/b.JPG"
    assert got[2] == "train/NORMAL/a_2.jpg"
    assert sorted(got) == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("files", [1, 3])
def test_route_stream_equals_batch_and_restart_adds_nothing(spark, tmp_path, files):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    arrivals(spark).repartition(files).write.parquet(src)
    for _ in range(2):
        flows.route_to_tables(flows.stream_table(spark, src), out, state)
    moved = spark.read.parquet(f"{out}/moved").select("event_id", "destination")
    assert rows(moved) == rows(arr.destinations(arr.route_arrivals(arrivals(spark))).select("event_id", "destination"))
    assert rows(spark.read.parquet(f"{out}/alerts").select("message")) == [("x/y/c.jpg",)]


def test_debounce_stream_closes_by_watermark(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    marker = spark.createDataFrame([(99, sec(99999), "z.jpg")], "event_id long, ts timestamp, path string")
    arrivals(spark).unionByName(marker).write.parquet(src)
    flows.run_to_parquet(flows.debounced(flows.stream_table(spark, src), "2 seconds"), out, state)
    got = spark.read.parquet(out)
    assert rows(got.where("path like '%a.jpg'").select("last_event", "events")) == [(sec(1), 2), (sec(10), 1), (sec(3), 1)]
    assert got.where("path = 'z.jpg' or path = 'd.txt'").count() == 0


def test_unique_contents_across_batches(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    body = b"\xff\xd8\xff" + b"a" * 600
    schema = "file_path string, split string, folder string, label string, content binary"
    for name, data in (("b", body), ("a", body), ("c", body + b"!")):
        spark.createDataFrame([(name, "train", "NORMAL", "", data)], schema).write.mode("append").parquet(src)
        flows.unique_contents(flows.stream_table(spark, src), out, state)
    assert rows(spark.read.parquet(out).select("file_path")) == [("b",), ("c",)]


def test_two_streams_fill_one_table(spark, tmp_path):
    out = str(tmp_path / "out")
    body = b"\xff\xd8\xff" + b"a" * 600
    schema = "file_path string, split string, folder string, label string, content binary"
    for source, names in (("one", "bc"), ("two", "ad")):
        src = str(tmp_path / source)
        spark.createDataFrame([(n, "train", "NORMAL", "", body + (n.encode() if n in "cd" else b"")) for n in names], schema).write.parquet(src)
        for _ in range(2):
            flows.unique_contents(flows.stream_table(spark, src), out, str(tmp_path / f"state-{source}"))
    assert rows(spark.read.parquet(out).select("file_path")) == [("b",), ("c",), ("d",)]


def test_names_stay_unique_over_batches(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    for pair in ((1, 2), (3, 4)):
        data = [(i, sec(0), "train/NORMAL/a.jpg") for i in pair]
        spark.createDataFrame(data, "event_id long, ts timestamp, path string").coalesce(1).write.mode("append").parquet(src)
        flows.route_to_tables(flows.stream_table(spark, src), out, state)
    moved = [r[0] for r in spark.read.parquet(f"{out}/moved").select("destination").collect()]
    assert sorted(moved) == ["train/NORMAL/a.jpg"] + [f"train/NORMAL/a_{i}.jpg" for i in (2, 3, 4)]


def test_new_files_once(spark, tmp_path):
    src, out, state = tmp_path / "src", str(tmp_path / "out"), str(tmp_path / "state")
    src.mkdir()
    for names in (("a.jpg", "n.txt"), ("b.jpg",), ()):
        for name in names:
            (src / name).write_bytes(b"123")
        flows.run_to_parquet(flows.new_files(spark, str(src), "*.jpg"), out, state)
    assert rows(spark.read.parquet(out).select(F.regexp_extract("path", "[^/]+$", 0), "length")) == [("a.jpg", 3), ("b.jpg", 3)]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 7, 100])
def test_ranges_split_a_file_without_loss(tmp_path, size):
    path = tmp_path / "x.log"
    path.write_bytes("uno\n\ndos tres\nñandú\nfin\nnot yet".encode())
    end = whole_length(str(path), 0, path.stat().st_size, size)
    got = [line for low in range(0, end, size) for line in read_range(str(path), 0, low, min(low + size, end), end, 4)]
    assert got == ["uno", "", "dos tres", "ñandú", "fin"]


def test_tail_grows_truncates_and_repeats(spark, tmp_path):
    root = tmp_path / "logs" / "dag_id=d" / "run_id=r"
    root.mkdir(parents=True)
    log = root / "a.log"
    tail = LogTail(spark, str(tmp_path / "logs"), str(tmp_path / "state"), range_bytes=4)
    log.write_text("one\ntwo\n")
    assert rows(tail.run_once().select("line")) == [("one",), ("two",)]
    assert tail.run_once().count() == 0
    with log.open("a") as f:
        f.write("three\n")
    (root / "b.log").write_text("other\n")
    assert rows(tail.run_once().select("line")) == [("other",), ("three",)]
    with log.open("a") as f:
        f.write("tw")
    assert tail.run_once().count() == 0
    with log.open("a") as f:
        f.write("o\n")
    assert rows(tail.run_once().select("line")) == [("two",)]
    log.write_text("new\n")
    assert rows(tail.run_once().select("line")) == [("new",)]


def test_log_sync_job(spark, tmp_path):
    root = tmp_path / "logs" / "dag_id=d" / "run_id=r" / "task_id=t"
    root.mkdir(parents=True)
    (root / "a.log").write_text("[2026-05-01 10:00:00] ERROR [ml] — bad\n\nplain\n")
    log_sync.run(spark, str(tmp_path / "logs"), str(tmp_path / "out"))
    got = spark.read.parquet(str(tmp_path / "out" / "logs"))
    assert rows(got.select("level", "message", "run_id", "task_id")) == [("ERROR", "bad", "r", "t"), ("INFO", "plain", "r", "t")]


def test_late_rows_are_counted(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    schema = "event_id long, ts timestamp, path string"
    dropped = []
    for data in ([(1, sec(1000), "a.jpg")], [(2, sec(2000), "b.jpg")], [(3, sec(1), "late.jpg"), (4, sec(3000), "c.jpg")]):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(src)
        dropped.append(flows.run_to_parquet(flows.debounced(flows.stream_table(spark, src), "2 seconds"), out, state))
    assert dropped == [0, 0, 1]


def test_a_batch_reads_only_the_partitions_it_touches(spark, tmp_path):
    out = str(tmp_path / "out")
    hashes = spark.range(400).select(F.md5(F.col("id").cast("string")).alias("content_hash"))
    flows.write_batch(hashes.withColumn("prefix", flows.hash_prefix(F.col("content_hash"))), out, "s1", 0)
    mine = hashes.limit(2).withColumn("prefix", flows.hash_prefix(F.col("content_hash")))
    stored = flows.stored_before(spark, out, "s2", 0, mine.select("prefix"))
    plan = stored._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "PartitionFilters" in plan and "prefix" in plan.split("PartitionFilters")[1].splitlines()[0]
    assert 2 <= stored.count() < 20
    assert flows.stored_before(spark, out, "s1", 0, mine.select("prefix")).count() == 0  # a repeated batch does not see itself


def test_repeated_batch_replaces_itself(spark, tmp_path):
    out = str(tmp_path / "out")
    one = spark.createDataFrame([("aa", 1), ("bb", 2)], "prefix string, v int")
    for rows_ in (one, one):
        flows.write_batch(rows_, out, "s", 0)
    flows.write_batch(one, out, "s", 1)
    assert spark.read.parquet(out).count() == 4


def test_contents_within_the_watermark(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    schema = "file_path string, split string, folder string, label string, content binary, ts timestamp"
    body = b"\xff\xd8\xff" + b"a" * 600
    for name, at in (("a", 0), ("b", 5), ("c", 1000), ("d", 5000)):
        spark.createDataFrame([(name, "train", "NORMAL", "", body, sec(at))], schema).write.mode("append").parquet(src)
        flows.recent_contents(flows.stream_table(spark, src), out, state, "ts", "60 seconds")
    # The watermark passes the first copy with the batch of c, so d is the first of a new time.
    assert rows(spark.read.parquet(out).select("file_path")) == [("a",), ("d",)]
    assert "RocksDB" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass")


def test_late_rows_are_kept(spark, tmp_path):
    src, out, state, ready = (str(tmp_path / n) for n in ("src", "out", "state", "ready"))
    schema = "event_id long, ts timestamp, path string"
    parts = ([(1, sec(1000), "a.jpg"), (2, None, "n.jpg")], [(3, sec(2000), "b.jpg")],
             [(4, sec(1), "late.jpg"), (5, sec(1999), "b.jpg"), (6, sec(3000), "c.jpg")], [(7, sec(9000), "z.jpg")])
    closes = F.col("ts") + F.expr("interval '2 seconds'")
    for data in parts:
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(src)
        for _ in range(2):
            tables = flows.split_late(flows.stream_table(spark, src), out, state, "ts", "2 seconds", closes)
    late = spark.read.parquet(tables.late)
    assert rows(late.select("event_id", "mark")) == [(2, None), (4, sec(1998))]
    dropped = flows.run_to_parquet(flows.debounced(flows.stream_table(spark, tables.rows).drop("batch"), "2 seconds"), ready, f"{ready}-state")
    assert dropped == 0
    # Closed bursts and late rows together are what a batch over all rows finds, but for the open one.
    everything = spark.createDataFrame([r for part in parts for r in part], schema).where("ts is not null and path <> 'z.jpg'")
    together = rows(spark.read.parquet(ready).select("path", "events").union(
        late.where("ts is not null").groupBy("path").agg(F.count("*"))))
    assert together == rows(arr.debounce(everything, "2 seconds").select("path", "events"))


def test_windowed_alerts_threshold(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    data = [(sec(i), "corrupt") for i in range(9)] + [(sec(100 + i), "duplicate") for i in range(10)] + [(sec(99999), "-")]
    spark.createDataFrame(data, "detected_at timestamp, issue_type string").write.parquet(src)
    stream = flows.windowed_quality_alerts(flows.stream_table(spark, src), "1 minute", "1 second")
    flows.run_to_parquet(stream, out, state)
    assert rows(spark.read.parquet(out).select("duplicate", "severity")) == [(10, "warning")]


def test_arrivals_are_cut_by_paths_alone(spark):
    paths = spark.range(3000).select(F.format_string("%04d", F.col("id") * 7 % 3000).alias("file_path")).repartition(5)
    low, high = streams._path_bounds(paths.unionByName(spark.sql("select cast(null as string) file_path")), 3)
    assert low < high and 850 < int(low) < 1150 and 1850 < int(high) < 2150
    assert streams._path_bounds(paths.limit(0), 3) == []
    assert streams._path_bounds(spark.sql("select 'a' file_path from range(9)"), 3) == ["a"]
