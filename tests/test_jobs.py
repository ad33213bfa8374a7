import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wardspark.operators import images
from wardspark.plans import csv_ingest, feature_build, ingest
from wardspark.plans.runs import RunLog, run_events, run_headers
from wardspark.sources import files, sinks
from wardspark.sources.sinks import Snapshots

JPEG = b"\xff\xd8\xff" + b"a" * 600


def tree(root):
    for name, data in {
        "train/NORMAL/a.jpg": JPEG, "train/NORMAL/b.jpg": JPEG, "train/PNEUMONIA/c.jpg": JPEG + b"!",
        "test/COVID19/d.jpg": b"\x89PNG\r\n\x1a\n" + b"x" * 600, "train/ODD/e.jpg": JPEG,
    }.items():
        path = root / "raw" / "scans" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)


def test_ingest_from_tree(spark, tmp_path):
    tree(tmp_path)
    out = str(tmp_path / "out")
    report = ingest.run(spark, str(tmp_path / "raw"), out, run_id="RUN-1", upload=True).first()
    stored = spark.read.parquet(f"{out}/objects")
    assert rows(stored.select("object_key")) == rows(spark.read.parquet(f"{out}/validated").select("object_key"))
    assert stored.where(F.concat(F.lit("raw/"), F.md5("content"), F.lit(".jpg")) != F.col("object_key")).count() == 0
    assert (report.total_scanned, report.valid_unique, report.rejected) == (4, 2, 2)
    assert (report.invalid_corrupt, report.invalid_incomplete, report.duplicates_removed) == (1, 0, 1)
    assert rows(spark.read.parquet(f"{out}/rejected").select("file_path", "reject_reason")) == [
        ("data/raw/scans/test/COVID19/d.jpg", "corrupt"), ("data/raw/scans/train/NORMAL/b.jpg", "duplicate")]
    header = run_headers(spark, f"{out}/log").first()
    assert (header.status, header.records_in, header.records_out, header.records_failed) == ("ok", 4, 2, 2)
    assert header.finished_at >= header.started_at
    assert {r.event_id for r in run_events(spark, f"{out}/log").collect()} == {"EVT-SCAN01", "EVT-ING01"}
    manifest = files.scan_manifest(spark, str(tmp_path / "raw"), "data/raw/scans")
    assert manifest.count() == 4 and manifest.where("label = 'covid'").count() == 1


def test_ingest_from_manifest(spark, tmp_path):
    tree(tmp_path)
    lines = ["file_path,split,folder,label,filename"]
    for split, folder, name in (("train", "NORMAL", "a.jpg"), ("train", "NORMAL", "a.jpg"), ("train", "PNEUMONIA", "c.jpg"),
                                ("train", "NORMAL", "gone.jpg"), ("train", "ODD", "e.jpg")):
        lines.append(f"data/raw/scans/{split}/{folder}/{name},{split},{folder},,{name}")
    (tmp_path / "manifest.csv").write_text("\n".join(lines) + "\n")
    report = ingest.run(spark, str(tmp_path / "raw"), str(tmp_path / "out"), str(tmp_path / "manifest.csv"), str(tmp_path)).first()
    assert (report.total_scanned, report.valid_unique, report.invalid_corrupt, report.invalid_incomplete,
            report.duplicates_removed) == (5, 2, 1, 1, 1)


def test_failed_run_keeps_counts(spark, tmp_path):
    log = RunLog(spark, str(tmp_path), "R", "job", "stage")

    def job(log):
        log.counts["records_in"] = 7
        raise RuntimeError("broken")

    with pytest.raises(RuntimeError):
        log.run(job)
    header = run_headers(spark, str(tmp_path)).first()
    assert (header.status, header.records_in, header.error_message) == ("failed", 7, "broken")


def test_csv_ingest_twice(spark, tmp_path):
    head = "study_id,patient_id,file_path,split,label,source_dataset,modality,body_part,captured_at\n"
    (tmp_path / "s.csv").write_text(head + "S1,P1,f1,train,sana,d,CR,chest,2026-01-01T00:00:00\n"
                                    "S2,P1,f2,train,odd,d,CR,chest,2026-01-01T00:00:00\n")
    (tmp_path / "e.csv").write_text("event_id,run_id,stage,status,records,message,logged_at\nE1,OLD,s,ok,3,m,2026-01-01T00:00:00Z\n")
    out = str(tmp_path / "out")
    counts = csv_ingest.run(spark, str(tmp_path / "s.csv"), out, "S-1", str(tmp_path / "e.csv"), "RUN-A").first()
    assert tuple(counts) == (2, 1, 1)
    (tmp_path / "s.csv").write_text(head + "S1,P2,f1,test,covid,d,DX,chest,2026-01-02T00:00:00\nS3,P3,f3,val,sana,d,CR,chest,2026-01-01\n")
    csv_ingest.run(spark, str(tmp_path / "s.csv"), out, "S-1", str(tmp_path / "e.csv"), "RUN-B")
    studies = Snapshots(spark, f"{out}/studies")
    assert studies.latest() == 2
    assert rows(studies.read().select("study_id", "patient_id", "split", "label", "modality")) == [
        ("S1", "P2", "test", "covid", "CR"), ("S3", "P3", "val", "sana", "CR")]
    assert rows(Snapshots(spark, f"{out}/patients").read().select("patient_id")) == [("P1",), ("P2",), ("P3",)]
    assert Snapshots(spark, f"{out}/run_events").read().count() == 1
    with pytest.raises(FileNotFoundError):
        csv_ingest.run(spark, str(tmp_path / "none.csv"), out, "S-1")


def test_feature_build(spark, tmp_path):
    listed = []
    for split, label, n in (("train", "sana", 3), ("train", "covid", 2), ("test", "sana", 1)):
        for i in range(n):
            path = tmp_path / "data" / split / label / f"{i}.png"
            listed.append((str(path), f"data/{split}/{label}/{i}.png", label, split, f"{split}{label}{i}"))
    listed.append((str(tmp_path / "data" / "gone.png"), "data/gone.png", "sana", "test", "x"))
    frame = spark.createDataFrame(listed, "fs_path string, file_path string, label string, split string, content_hash string")
    sinks.write_table(frame, str(tmp_path / "manifest" / "validated"))
    out = str(tmp_path / "features")
    counts = feature_build.run(spark, str(tmp_path / "data"), str(tmp_path / "manifest"), out, 16)
    got = {(r.split, r.label, r.augment_type): r.samples for r in counts.collect()}
    assert got[("validation", "sana", "original")] == 1 and got[("train", "sana", "zoom")] == 2
    assert got[("test", "sana", "original")] == 2 and sum(got.values()) == 2 + 8 + 4 + 2


def test_vector_scaling_equals_numpy(spark):
    values = [0.1, 0.5, -0.2, 0.9]
    got = spark.range(1).select(images.vector_normalise(F.array(*[F.lit(v) for v in values]))).first()[0]
    v = np.array(values)
    z = (v - v.mean()) / (v.std() + 1e-6)
    assert got == list(np.floor((z - z.min()) / (z.max() - z.min() + 1e-6) * 255.0).astype(int))


def test_object_store_and_snapshots(spark, tmp_path):
    rows_ = spark.createDataFrame([("raw/a", b"1"), ("raw/b", None)], "object_key string, content binary")
    for _ in range(2):
        sinks.store_objects(rows_, str(tmp_path / "objects"))
    assert spark.read.parquet(str(tmp_path / "objects")).count() == 1
    target = str(tmp_path / "put")
    (tmp_path / "put").mkdir()

    def put(key, data, target=target):
        with open(f"{target}/{key.replace('/', '_')}", "wb") as f:
            f.write(data)

    sent = sinks.upload_objects(rows_, put).agg(F.sum("uploaded")).first()[0]
    assert sent == 1 and (tmp_path / "put" / "raw_a").read_bytes() == b"1"


def test_sources_fall_back(spark, tmp_path):
    frame = spark.createDataFrame([("data/x.jpg", "COVID19", "train")] * 2, "file_path string, folder string, split string")
    sinks.export_csv(frame, str(tmp_path / "csv"), single_file=True)
    got = files.feature_sources(spark, [("parquet", str(tmp_path / "none")), ("csv", str(tmp_path / "csv"))], "/srv").collect()
    assert [tuple(r) for r in got] == [("/srv/x.jpg", "data/x.jpg", "covid", "train", None)]
    with pytest.raises(FileNotFoundError):
        files.read_first(spark, [("parquet", str(tmp_path / "none"))])


def test_run_messages_and_errors_are_kept_whole(spark, tmp_path):
    log, long = RunLog(spark, str(tmp_path), "L", "job", "stage"), "x" * 5000

    def job(own):
        own.event("e", "stage", "ok", 1, long)
        raise ValueError(long)

    with pytest.raises(ValueError):
        log.run(job)
    assert run_events(spark, str(tmp_path)).first().message == long
    assert run_headers(spark, str(tmp_path)).first().error_message == long
