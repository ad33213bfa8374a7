"""Queries of model data: splits, features, text weights, evaluation, scoring."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from wardspark.catalog.domain import Domain
from wardspark.catalog.registry import register
from wardspark.functions import clinical
from wardspark.functions.clean import age_from_range, usable_symptoms
from wardspark.operators import evaluation as ev, features, images, summary, symptoms, text, validate
from wardspark.plans import feature_build
from wardspark.schemas import MODEL_LABELS
from wardspark.session import checkpoint_root, scratch_path, stage
from wardspark.sources import files, sinks

# -- splits and features ---------------------------------------------------------------

_SPLIT = """
split_rows as (
  select * exclude (h, r, n), case when split = 'test' then 'test'
         when r <= greatest(1, floor(n * 0.15)) then 'validation' else 'train' end ml_split
  from (select *, row_number() over (partition by "label", split = 'test' order by h) r,
               count(*) over (partition by "label", split = 'test') n
        from (select *, sha256('42:' || file_path) h from images)))
"""
_IMAGES = """
images as (
  select file_path, "label", split, content_hash from classified where reject_reason is null)
"""


def _images(d: Domain) -> DataFrame:
    """Accepted files with the hash of their content."""
    inspected = stage(validate.inspect_files(d.manifest()), "inspected")
    return validate.accepted(validate.classify(inspected)).select(
        "file_path", "label", "split", "content_hash"
    )


def _study_images(d: Domain) -> DataFrame:
    return d.studies().select(
        "file_path", "label", "split", F.md5("file_path").alias("content_hash")
    )


_STUDY_IMAGES = """
images as (
  select file_path, "label", split, md5(file_path) content_hash from studies)
"""


@register("features_source", tables="studies", sql="""
select distinct '/srv/data/' || regexp_replace(file_path, '^data/', '') fs_path, file_path, "label", split,
       md5(file_path) content_hash
from studies""")
def features_source(d: Domain) -> DataFrame:
    """The stored manifest (Parquet before CSV) as distinct feature sources."""
    folder = scratch_path(d.spark, "manifest")
    rows = _study_images(d)
    sinks.export_csv(rows.unionByName(rows), f"{folder}/validated_csv")
    sinks.write_table(rows.unionByName(rows), f"{folder}/validated")
    return files.feature_sources(
        d.spark,
        [("parquet", f"{folder}/absent"), ("parquet", f"{folder}/validated"), ("csv", f"{folder}/validated_csv")],
        "/srv/data",
    )


@register("stratified_split", tables="studies", sql=f"""
with {_STUDY_IMAGES}, {_SPLIT} select file_path, "label", split, ml_split from split_rows""")
def stratified_split(d: Domain) -> DataFrame:
    return features.stratified_split(_study_images(d)).select(
        "file_path", "label", "split", "ml_split"
    )


@register("stratified_split_80_10_10", tables="clinical_records", sql="""
select record_id, diagnosis, case when r <= floor(n / 10) then 'validation'
         when r <= 2 * floor(n / 10) then 'test' else 'train' end ml_split
from (select *, row_number() over (partition by diagnosis order by sha256('42:' || record_id)) r,
             count(*) over (partition by diagnosis) n from clinical_records)""")
def stratified_split_80_10_10(d: Domain) -> DataFrame:
    rows = d.clinical_records().select("record_id", "diagnosis")
    return features.three_way_split(rows, "record_id", "diagnosis")


@register("augmentation_plan", tables="studies", sql=f"""
with {_STUDY_IMAGES}, {_SPLIT}
select file_path, ml_split, unnest(case when ml_split = 'train' then ['original', 'rotate', 'flip', 'zoom']
                                        else ['original'] end) augment_type
from split_rows""")
def augmentation_plan(d: Domain) -> DataFrame:
    split = features.stratified_split(_study_images(d))
    return features.augmentation_plan(split).select("file_path", "ml_split", "augment_type")


_INDEX = """
index_rows as (
  select substr(sha256(content_hash || ':' || ml_split || ':' || a), 1, 16) sample_id, *
  from (select *, unnest(case when ml_split = 'train' then ['original', 'rotate', 'flip', 'zoom']
                              else ['original'] end) a from split_rows))
"""


@register("feature_index", tables="classified", sql=f"""
with {_IMAGES}, {_SPLIT}, {_INDEX}
select sample_id, file_path source_path,
       'data/processed/features/v1/' || ml_split || '/' || "label" || '/' || sample_id || '_' || a || '.jpg' output_path,
       ml_split split, "label", a augment_type, 224 image_size
from index_rows""")
def feature_index(d: Domain) -> DataFrame:
    """From stored files to the index: validate, drop duplicates, split, plan, name."""
    split = features.stratified_split(stage(_images(d), "images"))
    return features.feature_index(features.augmentation_plan(split))


_FEATURE_COUNTS = f"""
with {_STUDY_IMAGES}, {_SPLIT}, {_INDEX}
select ml_split split, "label", a augment_type, count(*)::bigint samples from index_rows group by all"""


@register("feature_job", tables="studies", sql=_FEATURE_COUNTS)
def feature_job(d: Domain) -> DataFrame:
    """The counts that the feature build reports of the index it has stored, from a stored manifest."""
    folder = scratch_path(d.spark, "feature-job")
    sinks.write_table(_study_images(d), f"{folder}/manifest/validated")
    counts = feature_build.run(d.spark, "/srv/data", f"{folder}/manifest", f"{folder}/out")
    return counts.select("split", "label", "augment_type", "samples")


@register("feature_counts", tables="studies", sql=_FEATURE_COUNTS)
def feature_counts(d: Domain) -> DataFrame:
    split = features.stratified_split(_study_images(d))
    return features.feature_counts(features.feature_index(features.augmentation_plan(split)))


@register("class_distribution", tables="clinical_records", sql="""
select diagnosis, count(*)::bigint n from clinical_records group by 1""")
def class_distribution(d: Domain) -> DataFrame:
    return summary.distribution(d.clinical_records())


@register("vector_normalize", sql="""
select vec_id, list_sum(px)::bigint total, px[1]::int first_px, list_max(px)::int max_px, list_min(px)::int min_px
from (select vec_id, list_transform(z, lambda x: floor((x - lo) / (hi - lo + 1e-6) * 255.0)) px
      from (select *, list_min(z) lo, list_max(z) hi
            from (select vec_id, list_transform(v, lambda x: (x - m) / (sd + 1e-6)) z
                  from (select *, sqrt(list_sum(list_transform(v, lambda x: (x - m) * (x - m))) / len(v)) sd
                        from (select vec_id, v, list_sum(v) / len(v) m
                              from (select vec_id, list_transform(embedding, lambda x: x::double) v from embeddings))))))""")
def vector_normalize(d: Domain) -> DataFrame:
    px = d.raw("embeddings").select("vec_id", images.vector_normalise(F.col("embedding")).alias("px"))
    return px.select(
        "vec_id",
        F.aggregate("px", F.lit(0).cast("bigint"), lambda a, v: a + v).alias("total"),
        F.get("px", F.lit(0)).alias("first_px"),
        F.array_max("px").alias("max_px"), F.array_min("px").alias("min_px"),
    )


@register("batch_scoring", sql="""
with v as (
  select vec_id, case label % 3 when 0 then 'covid' when 1 then 'neumonia' else 'sana' end class,
         unnest(range(1, len(embedding) + 1)) i, embedding from embeddings),
e as (select vec_id, class, i, embedding[i]::double x from v),
m as (select class, i, avg(x) c from e group by all),
s as (select vec_id, m.class, 10 * sum(x * c) z from e join m using (i) group by all),
o as (select vec_id, class, exp(z - max(z) over (partition by vec_id)) o from s),
p as (select vec_id, class, o / sum(o) over (partition by vec_id) p from o)
select vec_id, class predicted_label, round(p, 6) confidence
from (select *, row_number() over (partition by vec_id order by p desc, class) r from p) where r = 1""")
def batch_scoring(d: Domain) -> DataFrame:
    """Vectors scored by a supplied model; here the model is the mean vector of each class."""
    labelled = d.raw("embeddings").withColumn(
        "class", F.element_at(F.array(*[F.lit(v) for v in MODEL_LABELS]), F.col("label") % 3 + 1)
    )
    # The model: one vector per class, as wide as the data. It is one value, looked up as a scalar subquery.
    means = (
        labelled.select("class", F.posexplode("embedding").alias("i", "x"))
        .groupBy("class", "i").agg(F.avg(F.col("x").cast("double")).alias("mean"))
        .groupBy("class").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "mean"))), lambda e: e["mean"]).alias("mean"))
    )
    held = means.agg(F.map_from_entries(F.collect_list(F.struct("class", "mean"))).alias("model")).scalar()
    zero = F.lit(0.0)

    def dot(name: str) -> Column:
        products = F.zip_with("embedding", F.element_at("model", F.lit(name)), lambda x, m: x.cast("double") * m)
        return F.coalesce(F.aggregate(products, zero, lambda total, x: total + F.coalesce(x, zero)), zero) * 10

    scored = labelled.withColumn("model", held).select("vec_id", F.array(*[dot(n) for n in MODEL_LABELS]).alias("scores"))
    odds = scored.select("vec_id", F.transform("scores", lambda z: F.exp(z - F.array_max("scores"))).alias("odds"))
    probs = F.transform("odds", lambda o: o / F.aggregate("odds", zero, lambda total, x: total + x))
    return odds.select("vec_id", probs.alias("probs")).select(
        "vec_id", clinical.argmax_label(F.col("probs"), MODEL_LABELS).alias("predicted_label"),
        F.round(F.array_max("probs"), 6).alias("confidence"),
    )


# -- text ------------------------------------------------------------------------------

_TERMS = r"""
tokens as (select record_id doc, regexp_extract_all(lower(symptoms), '[\p{L}\p{N}_]{2,}') w from clinical_records),
grams as (
  select doc, unnest(w) term from tokens
  union all
  select doc, unnest(list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])) from tokens),
tf as (select doc, term, count(*) tf from grams group by all),
vocab as (
  select term, sum(tf)::bigint corpus_count, count(*)::bigint df from tf group by term having count(*) >= 2
  order by sum(tf) desc, term limit 8000),
idf as (select *, ln((1 + (select count(*) from clinical_records)) / (1 + df)) + 1 idf from vocab)
"""


@register("tfidf_top_terms", tables="clinical_records", sql=f"""
with {_TERMS} select term, corpus_count, df, round(idf, 9) idf from idf""")
def tfidf_top_terms(d: Domain) -> DataFrame:
    """Vocabulary of all whole texts with its inverse document frequencies."""
    records = d.clinical_records(diagnosed=False).select("record_id", "symptoms")
    vocab = text.corpus_vocabulary(records, "symptoms")
    terms = text.inverse_frequencies(vocab, records)
    return terms.withColumn("idf", F.round("idf", 9))


@register("tfidf_weights", tables="clinical_records", sql=f"""
with {_TERMS}, raw as (select doc, term, (1 + ln(tf)) * idf w from tf join idf using (term))
select doc, count(*)::bigint terms, round(sum(weight), 6) weight_sum, round(max(weight), 6) weight_max
from (select doc, term, w / sqrt(sum(w * w) over (partition by doc)) weight from raw) group by doc""")
def tfidf_weights(d: Domain) -> DataFrame:
    records = d.clinical_records(diagnosed=False).select("record_id", "symptoms")
    tokens = text.document_tokens(records, "record_id", "symptoms")
    vocab = text.ranked_vocabulary(tokens)
    counts = text.terms_by_document(stage(text.counted_terms(tokens, vocab), "term-counts"))
    terms = text.inverse_frequencies(text.document_frequencies(vocab, counts), records)
    weight = F.transform("terms", lambda t: t["w"])
    return text.unit_weights(counts.where(F.size("terms") > 0), terms).select(
        "doc", F.size("terms").cast("bigint").alias("terms"),
        F.round(F.aggregate(weight, F.lit(0.0), lambda total, w: total + w), 6).alias("weight_sum"),
        F.round(F.array_max(weight), 6).alias("weight_max"),
    )


@register("age_scaled", tables="clinical_records", sql="""
select record_id, age, round((age - (select avg(age) from clinical_records))
       / (select stddev_pop(age) from clinical_records), 6) age_scaled from clinical_records""")
def age_scaled(d: Domain) -> DataFrame:
    scaled = text.age_scaled(d.clinical_records(diagnosed=False).select("record_id", "age"), "record_id")
    return scaled.withColumn("age_scaled", F.round("age_scaled", 6))


def _trained(d: Domain) -> tuple[DataFrame, symptoms.SymptomModel]:
    """The split records, and the model of their training part: the stored one, trained where there is none.

    A stored model belongs to the state of the tables it was trained on, so it is as good as a new one.
    """
    split = features.three_way_split(
        symptoms.training_set(stage(d.clinical_records(), "records")), "record_id", "diagnosis"
    )
    split = stage(split, "records-split")
    return split, _stored_model(d, lambda: symptoms.train(split.where("ml_split = 'train'")))


def _stored_model(d: Domain, train: Callable[[], symptoms.SymptomModel] | None = None) -> symptoms.SymptomModel:
    path = f"{checkpoint_root(d.spark)}/models/symptoms"
    version = files.fingerprint(d.spark, [d.path("documents"), d.path("labels")])
    model = symptoms.SymptomModel.load(d.spark, path, version)
    if model is None and train is None:
        return _trained(d)[1]  # stored by then, and read from there: to save it again would overwrite what it reads
    if model is None:
        train().save(path, version)
        model = symptoms.SymptomModel.load(d.spark, path, version)
    return model


@register("symptom_person_slots", tables="clinical_records", sql="""
with known as (
  select record_id, age, left(upper(sex), 1) letter, row_number() over (partition by diagnosis order by sha256('42:' || record_id)) r,
         count(*) over (partition by diagnosis) n
  from clinical_records where diagnosis is not null and symptoms is not null),
learnt as (select avg(age) mean, stddev_pop(age) deviation from known where r > 2 * floor(n / 10))
select record_id, round((age - mean) / deviation, 6) age_scaled, (letter = 'M')::int male, (letter = 'F')::int female,
       (letter = 'X')::int other
from known, learnt""")
def symptom_person_slots(d: Domain) -> DataFrame:
    """The features that are not text, of every record with a diagnosis: scaled age, and a slot per sex."""
    split, model = _trained(d)
    age, male, female, other = model.person()
    return split.select(
        "record_id", F.round(age, 6).alias("age_scaled"),
        *[c.cast("int").alias(n) for c, n in ((male, "male"), (female, "female"), (other, "other"))],
    )


@register("symptom_fit", tables="clinical_records", sql="""
with learnt as (
  select * from (select diagnosis, row_number() over (partition by diagnosis order by sha256('42:' || record_id)) r,
                        count(*) over (partition by diagnosis) n, symptoms
                 from clinical_records where diagnosis is not null and symptoms is not null)
  where r > 2 * floor(n / 10) and length(trim(symptoms)) >= 3)
select diagnosis, count(*)::bigint n, round(1.0::double / (select count(distinct diagnosis) from learnt), 2) share
from learnt group by diagnosis""")
def symptom_fit(d: Domain) -> DataFrame:
    """Weighted mean probability of each class over the training rows: at the optimum it is the weighted share of its rows.

    That is the condition that the likelihood's slope by the class's intercept is zero; with balanced weights every
    share is one over the number of classes. A fit that stopped early, wrong weights or mixed up labels break it.
    """
    split, model = _trained(d)
    learnt = split.where("ml_split = 'train'")
    weights = ev.class_weights(learnt, "diagnosis").select("diagnosis", "weight")
    # As trained: the letter of the sex, not the form in which requests are scored.
    scored = symptoms.probabilities_of(learnt.where(usable_symptoms(F.col("symptoms"))), model)
    held = stage(scored.select("diagnosis", "probabilities").join(F.broadcast(weights), "diagnosis"), "fit")
    total = held.agg(F.sum("weight")).first()[0]
    each = held.select("weight", F.explode("probabilities").alias("diagnosis", "p"))
    share = each.groupBy("diagnosis").agg(F.round(F.sum(F.col("weight") * F.col("p")) / F.lit(total), 2).alias("share"))
    return held.groupBy("diagnosis").agg(F.count(F.lit(1)).alias("n")).join(share, "diagnosis")


@register("symptom_separable", sql="""
select doc_id, case lang when 'en' then 'sana' when 'de' then 'asma' when 'fr' then 'gripe' else 'covid' end predicted
from documents""")
def symptom_separable(d: Domain) -> DataFrame:
    """Reports whose words tell their class, half of them learnt: every one of the others must be told right."""
    reports = d.raw("documents").selectExpr(
        "doc_id record_id", "concat('signs ', case lang when 'en' then 'control visit' when 'de' then 'wheezing' "
        "when 'fr' then 'chills' else 'anosmia' end, ' day', cast(doc_id % 7 as string)) symptoms",
        "cast(doc_id % 90 as int) age", "'M' sex",
        "case lang when 'en' then 'sana' when 'de' then 'asma' when 'fr' then 'gripe' else 'covid' end diagnosis",
    )
    model = symptoms.train(reports.where("record_id % 2 = 0"), max_iter=50)
    return symptoms.score(reports.drop("diagnosis"), model).selectExpr("record_id doc_id", "predicted_diagnosis predicted")


@register("symptom_classifier", tables="clinical_records", sql="""
select ml_split, count(*)::bigint n_samples, true measured
from (select case when r <= floor(n / 10) then 'validation' when r <= 2 * floor(n / 10) then 'test' else 'train' end ml_split
      from (select row_number() over (partition by diagnosis order by sha256('42:' || record_id)) r,
                   count(*) over (partition by diagnosis) n, symptoms
            from clinical_records where diagnosis is not null and symptoms is not null)
      where length(trim(symptoms)) >= 3) group by 1""")
def symptom_classifier(d: Domain) -> DataFrame:
    """Train on 80 %, measure each split: samples, and whether all metrics are proper shares."""
    split, model = _trained(d)
    truth = split.select("record_id", F.col("diagnosis").alias("actual"), "ml_split")
    scored = symptoms.score(split.drop("ml_split", "diagnosis"), model).select(
        "record_id", F.col("predicted_diagnosis").alias("predicted")
    )
    labels = tuple(model.labels)
    cells = ev.confusion_cells(scored.join(truth, "record_id"), labels, ("ml_split",))
    measured = ev.metrics_summary(ev.class_metrics(cells, ("ml_split",)), ("ml_split",))
    shares = ("accuracy", "precision_macro", "recall_macro", "f1_macro", "f1_weighted")
    proper = F.forall(F.array(*shares), lambda x: (x > 0) & (x <= 1))
    return measured.select("ml_split", "n_samples", proper.alias("measured"))


@register("symptom_scoring", tables="clinical_predictions patients", sql="""
select prediction_id, c.patient_id, cast(case age_range when '18-30' then 24 when '31-45' then 38 when '46-60' then 53
       when '61-75' then 68 when '76+' then 76 else 40 end as int) age, coalesce(sex, 'X') sex, true known_label,
       1.0::double probability, 'symptoms_logreg' model_name, 'v1' model_version
from clinical_predictions c left join patients using (patient_id) where length(trim(symptoms)) >= 3""")
def symptom_scoring(d: Domain) -> DataFrame:
    """Score all reports by the stored model, append them to a table and read them from there.

    Labels and probabilities depend on the fit; the columns are those that do not.
    """
    model = _stored_model(d)
    reports = d.clinical_predictions().join(d.patients().select("patient_id", "sex", "age_range"), "patient_id", "left")
    people = reports.select(
        "prediction_id", "patient_id", "symptoms", "sex",
        age_from_range(F.col("age_range"), F.lit(None).cast("int")).alias("age"),
    )
    path = scratch_path(d.spark, "symptom-predictions")
    symptoms.append_predictions(symptoms.score(people, model), path)
    probabilities = F.map_values(F.from_json("prob_json", "map<string,double>"))
    return d.spark.read.parquet(path).select(
        "prediction_id", "patient_id", "age", "sex",
        F.col("predicted_diagnosis").isin(*model.labels).alias("known_label"),
        F.round(F.aggregate(probabilities, F.lit(0.0), lambda total, x: total + x), 6).alias("probability"),
        "model_name", "model_version",
    )


# -- evaluation ------------------------------------------------------------------------

_CELLS = """
labels(l) as (values ('covid'), ('neumonia'), ('sana')),
keys as (select distinct {keys} from evaluated),
cells as (
  select {outer_keys} a.l actual, p.l predicted,
         (select count(*) from evaluated e where e.actual = a.l and e.predicted = p.l {match})::bigint n
  from {source} labels a cross join labels p),
per_class as (
  select {group} l "label", sum(n) filter (where actual = l)::bigint support,
         sum(n) filter (where predicted = l)::bigint claimed,
         sum(n) filter (where actual = l and predicted = l)::bigint correct
  from cells, labels group by all),
classes as (
  select *, case when claimed = 0 then 0 else correct::double / claimed end "precision",
         case when support = 0 then 0 else correct::double / support end recall,
         case when claimed + support = 0 then 0 else 2.0::double * correct / (claimed + support) end f1
  from per_class)
"""
_PLAIN_CELLS = _CELLS.format(keys="1 one", outer_keys="", match="", source="", group="")


def _keyed_cells(key: str) -> str:
    return _CELLS.format(
        keys=key, outer_keys=f"k.{key},", match=f"and e.{key} = k.{key}", source="keys k cross join",
        group=f"{key},",
    )


_SUMMARY = """sum(support)::bigint n_samples,
       round(sum(correct)::double / sum(support), 6) accuracy, round(avg("precision"), 6) precision_macro,
       round(avg(recall), 6) recall_macro, round(avg(f1), 6) f1_macro,
       round(sum(f1 * support) / sum(support), 6) f1_weighted"""


def _evaluated(d: Domain) -> DataFrame:
    truth = d.studies().where("label is not null").select(
        "study_id", F.col("label").alias("actual"), "split"
    )
    return d.predictions().select(
        "study_id", F.col("predicted_label").alias("predicted"), "model_name"
    ).join(truth, "study_id")


def _rounded(df: DataFrame, names: tuple[str, ...]) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if c in names else F.col(c) for c in df.columns])


_SUMMARY_COLUMNS = ("n_samples", "accuracy", "precision_macro", "recall_macro", "f1_macro", "f1_weighted")


@register("confusion_matrix", tables="evaluated", sql=f"""
with {_PLAIN_CELLS}
select actual, sum(n) filter (where predicted = 'covid')::bigint pred_covid,
       sum(n) filter (where predicted = 'neumonia')::bigint pred_neumonia,
       sum(n) filter (where predicted = 'sana')::bigint pred_sana from cells group by actual""")
def confusion_matrix(d: Domain) -> DataFrame:
    return ev.confusion_matrix(ev.confusion_cells(_evaluated(d), MODEL_LABELS), MODEL_LABELS)


@register("class_metrics", tables="evaluated", sql=f"""
with {_PLAIN_CELLS}
select "label", support, round("precision", 6) "precision", round(recall, 6) recall, round(f1, 6) f1 from classes""")
def class_metrics(d: Domain) -> DataFrame:
    classes = ev.class_metrics(ev.confusion_cells(_evaluated(d), MODEL_LABELS)).drop("correct")
    return _rounded(classes, ("precision", "recall", "f1"))


@register("metrics_summary", tables="evaluated", sql=f"with {_PLAIN_CELLS} select {_SUMMARY} from classes")
def metrics_summary(d: Domain) -> DataFrame:
    classes = ev.class_metrics(ev.confusion_cells(_evaluated(d), MODEL_LABELS))
    return _rounded(ev.metrics_summary(classes), _SUMMARY_COLUMNS).select(*_SUMMARY_COLUMNS)


@register("metrics_unlisted", tables="evaluated", sql="""
select count(*)::bigint n_samples,
       round(count(*) filter (where actual = predicted and actual <> 'sana')::double / count(*), 6) accuracy
from evaluated""")
def metrics_unlisted(d: Domain) -> DataFrame:
    """Two of the three labels are listed; rows of the third count as samples and as errors."""
    cells = ev.confusion_cells(_evaluated(d), ("covid", "neumonia"))
    summary_row = ev.metrics_summary(ev.class_metrics(cells))
    return _rounded(summary_row, ("accuracy",)).select("n_samples", "accuracy")


@register("metrics_by_split", tables="evaluated", sql=f"""
with {_keyed_cells('split')} select split, {_SUMMARY} from classes group by split""")
def metrics_by_split(d: Domain) -> DataFrame:
    keys = ("split",)
    classes = ev.class_metrics(ev.confusion_cells(_evaluated(d), MODEL_LABELS, keys), keys)
    return _rounded(ev.metrics_summary(classes, keys), _SUMMARY_COLUMNS).select("split", *_SUMMARY_COLUMNS)


@register("critical_errors", tables="evaluated", sql="""
select split, count(*) filter (where actual <> predicted)::bigint misclassified_total,
       count(*) filter (where actual = 'neumonia' and predicted = 'sana')::bigint fn_neumonia_to_sana
from evaluated group by split""")
def critical_errors(d: Domain) -> DataFrame:
    keys = ("split",)
    return ev.critical_errors(ev.confusion_cells(_evaluated(d), MODEL_LABELS, keys), keys=keys)


@register("class_weights", tables="studies", sql="""
select "label", n::bigint n, round((select count(*) from studies where "label" is not null)::double
       / ((select count(distinct "label") from studies) * n), 9) weight
from (select "label", count(*) n from studies where "label" is not null group by 1)""")
def class_weights(d: Domain) -> DataFrame:
    rows = ev.class_weights(d.studies().where("label is not null"), "label")
    return rows.withColumn("weight", F.round("weight", 9))


@register("model_ranking", tables="evaluated", sql=f"""
with {_keyed_cells('model_name')},
reports as (
  select model_name, {_SUMMARY},
         (select sum(n) from cells c where c.model_name = classes.model_name and actual = 'neumonia'
            and predicted = 'sana')::bigint critical_fn
  from classes group by model_name)
select model_name, f1_macro, accuracy, critical_fn, place::int place, place = 1 recommended
from (select *, row_number() over (order by f1_macro desc, critical_fn, accuracy desc, model_name) place from reports)""")
def model_ranking(d: Domain) -> DataFrame:
    keys = ("model_name",)
    cells = ev.confusion_cells(_evaluated(d), MODEL_LABELS, keys)
    metrics = _rounded(ev.metrics_summary(ev.class_metrics(cells, keys), keys), ("f1_macro", "accuracy"))
    errors = ev.critical_errors(cells, keys=keys).select(
        "model_name", F.col("fn_neumonia_to_sana").alias("critical_fn")
    )
    reports = metrics.join(errors, "model_name").select("model_name", "f1_macro", "accuracy", "critical_fn")
    return ev.model_ranking(reports)


@register("report_json_flatten", tables="evaluated", sql=f"""
with {_keyed_cells('split')}
select 'v1' model_version, split, "label", support, sum(support) over (partition by split)::bigint n_samples,
       round("precision", 6) "precision", round(recall, 6) recall, round(f1, 6) f1 from classes""")
def report_json_flatten(d: Domain) -> DataFrame:
    """Metrics written as a nested JSON report, read with the report schema and flattened."""
    keys = ("split",)
    cells = ev.confusion_cells(_evaluated(d), MODEL_LABELS, keys)
    report = ev.evaluation_report(cells, "v1")
    path = scratch_path(d.spark, "report")
    sinks.write_report(report, path)
    read = files.read_training_report(d.spark, [f"{path}-absent", path])
    flat = files.flatten_report(read).select(
        "model_version", "split", "label", "support", "n_samples", "precision", "recall", "f1"
    )
    return _rounded(flat, ("precision", "recall", "f1"))


@register("best_checkpoint", tables="predictions", sql="""
select name, score from (
  select 'model_' || study_id || '_val' || rpad(cast(max(prob_sana) as varchar), 7, '0') || '.keras' "name",
         max(prob_sana)::double score from predictions group by study_id)
order by score desc, name limit 1""")
def best_checkpoint(d: Domain) -> DataFrame:
    """One file name per study with the score inside the name; the best is found by parsing."""
    named = d.predictions().groupBy("study_id").agg(F.max("prob_sana").alias("s")).select(
        F.concat(F.lit("model_"), "study_id", F.lit("_val"), F.col("s").cast("string"), F.lit(".keras")).alias("name")
    )
    return ev.best_checkpoint(named)


@register("training_curve", sql="""
select conv_id run, phase, turn epoch, step::bigint step, step = max(step) over (partition by conv_id, phase) is_boundary
from (select *, row_number() over (partition by conv_id order by phase, turn) step
      from (select conv_id, turn, case when turn < 3 then 1 else 2 end phase from conversations))""")
def training_curve(d: Domain) -> DataFrame:
    """Turns of a conversation as epochs of two phases on one axis."""
    phases = d.raw("conversations").selectExpr(
        "conv_id run", "case when turn < 3 then 1 else 2 end phase", "turn epoch"
    )
    return ev.training_curve(phases)
