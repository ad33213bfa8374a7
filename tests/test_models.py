import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wardspark.catalog import models
from wardspark.catalog.domain import Domain
from wardspark.operators import evaluation as ev, features, symptoms, text
from wardspark.plans import symptom_training
from wardspark.schemas import MODEL_LABELS
from wardspark.sources import files

GOLDEN = {("covid", "covid"): 105, ("covid", "neumonia"): 7, ("covid", "sana"): 3,
          ("neumonia", "covid"): 2, ("neumonia", "neumonia"): 814, ("neumonia", "sana"): 37,
          ("sana", "covid"): 1, ("sana", "neumonia"): 27, ("sana", "sana"): 289}


def golden(spark):
    cells = spark.createDataFrame([(a, p, n) for (a, p), n in GOLDEN.items()], "actual string, predicted string, n int")
    return cells.select("actual", "predicted", F.explode(F.sequence(F.lit(1), "n"))).drop("col")


def test_golden_metrics(spark):
    cells = ev.confusion_cells(golden(spark), MODEL_LABELS)
    assert {(a, p): n for a, p, n in rows(cells)} == GOLDEN
    got = ev.metrics_summary(ev.class_metrics(cells)).first()
    assert got.n_samples == 1285
    for name, value in (("accuracy", 0.9400778210116731), ("precision_macro", 0.9368491118290395),
                        ("recall_macro", 0.9263314725971395), ("f1_macro", 0.9311749820582941),
                        ("f1_weighted", 0.9403270453256164)):
        assert math.isclose(got[name], value, rel_tol=1e-12)
    assert tuple(ev.critical_errors(cells).first()) == (77, 37)
    matrix = ev.confusion_matrix(cells, MODEL_LABELS).orderBy("actual").collect()
    assert [list(r)[1:] for r in matrix] == [[105, 7, 3], [2, 814, 37], [1, 27, 289]]


def test_absent_class_counts_zero(spark):
    df = spark.createDataFrame([("covid", "covid"), ("sana", "covid")], "actual string, predicted string")
    cells = ev.confusion_cells(df, MODEL_LABELS)
    assert cells.count() == 9
    got = {r.label: (r.precision, r.recall, r.f1) for r in ev.class_metrics(cells).collect()}
    assert got["neumonia"] == (0.0, 0.0, 0.0) and got["sana"] == (0.0, 0.0, 0.0)


def test_golden_ranking(spark):
    models = [("baseline_cnn", 0.8776, 118, 0.8770), ("resnet50", 0.9312, 37, 0.9401),
              ("efficientnetb0", 0.2660, 0, 0.6638), ("densenet121", 0.9339, 72, 0.9323)]
    df = spark.createDataFrame(models, "model_name string, f1_macro double, critical_fn int, accuracy double")
    got = ev.model_ranking(df).orderBy("place").collect()
    assert [r.model_name for r in got] == ["densenet121", "resnet50", "baseline_cnn", "efficientnetb0"]
    assert [r.recommended for r in got] == [True, False, False, False]


def test_weights_checkpoint_curve(spark):
    df = spark.createDataFrame([("a",)] * 1 + [("b",)] * 3, "label string")
    assert rows(ev.class_weights(df, "label")) == [("a", 1, 2.0), ("b", 3, 4 / 6)]
    names = spark.createDataFrame([("m_01_val0.9100.keras",), ("m_02_val0.9400.keras",), ("other.h5",)], "name string")
    assert ev.best_checkpoint(names).first().name == "m_02_val0.9400.keras"
    phases = spark.createDataFrame([("r", 1, e) for e in (1, 2, 3)] + [("r", 2, e) for e in (1, 2)], "run string, phase int, epoch int")
    got = rows(ev.training_curve(phases).select("step", "is_boundary"))
    assert got == [(1, False), (2, False), (3, True), (4, False), (5, True)]


def images(spark, counts, split="train"):
    parts = [spark.range(n).select(F.concat(F.lit(f"{label}/"), "id").alias("file_path"), F.lit(label).alias("label"))
             for label, n in counts.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("split", F.lit(split)).withColumn("content_hash", F.md5("file_path"))


def test_golden_split(spark):
    train = images(spark, {"covid": 459, "neumonia": 3393, "sana": 1262})
    test = images(spark, {"t_covid": 115, "t_neumonia": 853, "t_sana": 317}, "test").withColumn(
        "label", F.replace("label", F.lit("t_"), F.lit("")))
    both = train.unionByName(test)
    split = features.stratified_split(both)
    got = {(r.label, r.ml_split): r["count"] for r in split.groupBy("label", "ml_split").count().collect()}
    assert got == {("covid", "validation"): 68, ("neumonia", "validation"): 508, ("sana", "validation"): 189,
                   ("covid", "train"): 391, ("neumonia", "train"): 2885, ("sana", "train"): 1073,
                   ("covid", "test"): 115, ("neumonia", "test"): 853, ("sana", "test"): 317}
    assert features.feature_index(features.augmentation_plan(split)).count() == 19446
    # The split does not depend on how the rows are laid out.
    again = features.stratified_split(both.repartition(7, "file_path"))
    assert rows(again.select("file_path", "ml_split")) == rows(split.select("file_path", "ml_split"))


def test_small_and_unknown_strata(spark):
    df = images(spark, {"sana": 1, "covid": 6, "neumonia": 7, "odd": 100})
    got = features.stratified_split(df).where("ml_split = 'validation'").groupBy("label").count()
    assert rows(got) == [("covid", 1), ("neumonia", 1), ("odd", 15), ("sana", 1)]


def test_three_way_split(spark):
    df = images(spark, {"sana": 100, "covid": 9})
    split = features.three_way_split(df, "file_path", "label")
    got = {(r.label, r.ml_split): r["count"] for r in split.groupBy("label", "ml_split").count().collect()}
    assert got == {("sana", "train"): 80, ("sana", "validation"): 10, ("sana", "test"): 10, ("covid", "train"): 9}


def test_unlabelled_rows_are_a_stratum(spark):
    df = images(spark, {"sana": 20}).unionByName(images(spark, {"x": 10}).withColumn("label", F.lit(None).cast("string")))
    got = features.stratified_split(df).where("ml_split = 'validation'").groupBy("label").count()
    assert rows(got) == [("sana", 3), (None, 1)]


def test_metrics_count_rows_of_unlisted_labels(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "z"), (None, "a")], "actual string, predicted string")
    cells = ev.confusion_cells(df, ("a", "b"))
    summary = ev.metrics_summary(ev.class_metrics(cells)).first()
    assert summary.n_samples == 3 and math.isclose(summary.accuracy, 1 / 3)
    assert ev.critical_errors(cells, "a", "b").first().misclassified_total == 2


def test_row_positions(spark):
    df = spark.range(1000).select(F.format_string("%05d", F.col("id") * 7 % 1000).alias("k")).repartition(9)
    got = rows(features.row_positions(df, ["k"], 5))
    assert got == [(f"{i:05d}", i) for i in range(1000)]


def test_text_weights_against_the_formula(spark):
    docs = spark.createDataFrame([("d1", "Tos seca, tos a b"), ("d2", "tos Émile"), ("d3", "émile")], "id string, t string")
    tf = text.term_frequencies(docs, "id", "t")
    assert dict(((d, t), n) for d, t, n in rows(tf)) == {
        ("d1", "tos"): 2, ("d1", "seca"): 1, ("d1", "tos seca"): 1, ("d1", "seca tos"): 1,
        ("d2", "tos"): 1, ("d2", "émile"): 1, ("d2", "tos émile"): 1, ("d3", "émile"): 1}
    terms = text.inverse_frequencies(text.vocabulary(tf), docs)
    idf = math.log(4 / 3) + 1
    assert [(r.term, r.corpus_count, r.df, round(r.idf, 12)) for r in terms.orderBy("term").collect()] == [
        ("tos", 3, 2, round(idf, 12)), ("émile", 2, 2, round(idf, 12))]
    weights = {(d, t): w for d, t, w in rows(text.tfidf(tf, terms))}
    assert math.isclose(weights[("d2", "tos")], 1 / math.sqrt(2)) and weights[("d1", "tos")] == 1.0


def test_classifier_on_template_text(spark, tmp_path):
    texts = {"covid": "fiebre tos seca anosmia y ageusia", "asma": "sibilancias y opresion nocturna",
             "gripe": "escalofrios y dolor muscular", "sana": "control anual sin molestias"}
    records = spark.createDataFrame(
        [(f"{name}{i}", f"{text} dia {i % 7}", 20 + i % 50, "MFX"[i % 3], name)
         for name, text in texts.items() for i in range(100)]
        + [("none", "tos", 30, "M", None), ("other", "picor de piel y ronchas", 41, "F", "urticaria")],
        "record_id string, symptoms string, age int, sex string, diagnosis string")
    model = symptom_training.run(spark, records, str(tmp_path), max_iter=30)
    report = files.read_training_report(spark, [str(tmp_path / "none"), str(tmp_path / "report")])
    flat = files.flatten_report(report).where("split = 'test'").select("n_samples", "accuracy", "f1_macro").distinct()
    assert [(r.n_samples, r.accuracy, r.f1_macro) for r in flat.collect()] == [(40, 1.0, 0.8)]
    assert files.report_cells(report).where("split = 'test'").agg(F.sum("n")).first()[0] == 40
    scored = symptoms.score(
        spark.createDataFrame([(1, " fiebre tos seca anosmia y ageusia ", 200, None), (2, "a", 3, "M")],
                              "id int, symptoms string, age int, sex string"), model).collect()
    assert [(r.id, r.age, r.sex, r.predicted_diagnosis) for r in scored] == [(1, 120, "X", "covid")]
    assert math.isclose(sum(scored[0].probabilities.values()), 1.0)
    # The stored model scores as the one in memory did.
    stored = symptoms.SymptomModel.load(spark, f"{tmp_path}/models")
    assert stored.labels == model.labels and symptoms.SymptomModel.load(spark, f"{tmp_path}/models", "v9") is None
    some = records.select("record_id", "symptoms", "age", "sex")
    of = lambda m: {r.record_id: (r.predicted_diagnosis, r.probabilities) for r in symptoms.score(some, m).collect()}
    assert of(stored) == of(model)


def test_broken_report_gives_nulls(spark, tmp_path):
    (tmp_path / "r.json").write_text("{not json")
    assert files.read_training_report(spark, [str(tmp_path / "r.json")]).first().model_version is None
    assert files.read_training_report(spark, [str(tmp_path / "x.json")]) is None


def test_scoring_alone_trains_and_stores_the_model(spark, tmp_path):
    docs = [(i, "cough fever" if i % 2 else "healthy control visit") for i in range(40)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, i % 2, 0) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    model = models._stored_model(Domain(spark, str(tmp_path)))
    assert model.labels == ["neumonia", "sana"] and model.terms.count() == model.width
    # The second call finds the stored one.
    assert rows(models._stored_model(Domain(spark, str(tmp_path))).terms) == rows(model.terms)


def test_terms_are_counted_where_the_texts_lie(spark):
    texts = [("a", "tos seca tos seca"), ("a", "tos y fiebre alta"), ("b", "fiebre alta, tos seca"), ("c", None), ("d", "x"),
             (None, "tos seca"), (None, "solo solo solo")]
    docs = spark.createDataFrame(texts, "id string, t string")
    tokens = text.document_tokens(docs, "id", "t")
    vocab = text.ranked_vocabulary(tokens, max_terms=6, width=8)
    counted = text.counted_terms(text.text_tokens(docs, "t"), vocab)
    assert "Exchange" not in counted._jdf.queryExecution().executedPlan().toString()
    counts = text.terms_by_document(text.stage(text.counted_terms(tokens, vocab), "counts"))
    terms = text.inverse_frequencies(text.document_frequencies(vocab, counts), docs)
    tf = text.term_frequencies(docs, "id", "t")
    plain = text.inverse_frequencies(text.vocabulary(tf, max_terms=6), docs)
    assert rows(terms.select("term", "corpus_count", "df", "idf")) == rows(plain)
    found = text.unit_weights(counts, terms).select("doc", F.inline("terms")).join(terms, "place")
    near = lambda df: {(d, t): round(w, 9) for d, t, w in rows(df)}
    assert near(found.select("doc", "term", "w")) == near(text.tfidf(tf, plain))
