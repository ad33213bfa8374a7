"""Queries over patients, studies and predictions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from wardspark.catalog.domain import Domain
from wardspark.catalog.registry import register
from wardspark.functions import clinical, ids
from wardspark.operators import lookup, summary
from wardspark.operators.mutate import create_conflicts
from wardspark.session import scratch_path
from wardspark.sources import skipping

_LATEST = """
latest as (
  select * from (select *, row_number() over (partition by study_id
                   order by inferred_at desc, prediction_id desc) r from predictions) where r = 1)
"""


@register("sites_active", tables="sites", sql="""
select site_code, site_name from sites where active order by site_name""")
def sites_active(d: Domain) -> DataFrame:
    return d.sites().where("active").select("site_code", "site_name").orderBy("site_name")


@register("patient_list", tables="patients sites studies", sql="""
select p.patient_id, p.display_name, p.sex, p.age_range, p.site_code, si.site_name,
       count(s.study_id)::bigint study_count
from patients p join sites si on si.site_code = p.site_code
left join studies s on s.patient_id = p.patient_id
group by all order by p.display_name, p.patient_id""")
def patient_list(d: Domain) -> DataFrame:
    listed = lookup.patient_list(d.patients(), d.sites(), d.studies())
    return listed.orderBy("display_name", "patient_id")


@register("latest_prediction", tables="predictions", sql=f"""
with {_LATEST}
select study_id, prediction_id, predicted_label, inferred_at,
       greatest(prob_covid, prob_neumonia, prob_sana)::double confidence from latest""")
def latest_prediction(d: Domain) -> DataFrame:
    return lookup.latest_predictions(d.predictions()).select(
        "study_id", "prediction_id", "predicted_label", "inferred_at",
        lookup.confidence().cast("double").alias("confidence"),
    )


@register("recent_predictions", tables="predictions studies patients", sql="""
select p.prediction_id, p.study_id, p.predicted_label, p.prob_sana::double prob_sana,
       p.prob_neumonia::double prob_neumonia, p.prob_covid::double prob_covid, p.inferred_at,
       pt.display_name patient_name, pt.patient_id,
       greatest(p.prob_covid, p.prob_neumonia, p.prob_sana)::double confidence
from predictions p join studies s on s.study_id = p.study_id
join patients pt on pt.patient_id = s.patient_id
where s.source_dataset = 'api_upload'
order by p.inferred_at desc, p.prediction_id desc limit 100""")
def recent_predictions(d: Domain) -> DataFrame:
    rows = lookup.recent_predictions(d.predictions(), d.studies(), d.patients())
    numbers = ("prob_sana", "prob_neumonia", "prob_covid", "confidence")
    return rows.select(
        *[F.col(c).cast("double").alias(c) if c in numbers else F.col(c) for c in rows.columns]
    )


_RECENT_STUDIES = """
select s.study_id, s.source_dataset, s.ingested_at, s.object_key, p.predicted_label,
       greatest(p.prob_covid, p.prob_neumonia, p.prob_sana)::double confidence,
       pt.display_name patient_name
from studies s left join latest p on p.study_id = s.study_id
left join patients pt on pt.patient_id = s.patient_id
where s.object_key is not null order by s.ingested_at desc, s.study_id limit 24"""


@register("recent_studies", tables="studies patients predictions", sql=f"with {_LATEST} {_RECENT_STUDIES}")
def recent_studies(d: Domain) -> DataFrame:
    rows = lookup.recent_studies(d.studies(), d.patients(), d.predictions())
    return rows.withColumn("confidence", F.col("confidence").cast("double"))


@register("patient_detail", tables="studies patients sites predictions", sql=f"""
with {_LATEST}
select pt.patient_id, pt.display_name, si.site_name, s.study_id, s."label", s.source_dataset,
       s.captured_at, s.ingested_at, s.object_key, p.predicted_label, p.prediction_id, p.inferred_at,
       greatest(p.prob_covid, p.prob_neumonia, p.prob_sana)::double confidence
from patients pt join sites si on si.site_code = pt.site_code
left join studies s on s.patient_id = pt.patient_id
left join latest p on p.study_id = s.study_id""")
def patient_detail(d: Domain) -> DataFrame:
    """One row per patient and study: a list per patient would have no bound."""
    studies = lookup.studies_with_latest(d.studies(), d.predictions()).select(
        "patient_id", "study_id", "label", "source_dataset", "captured_at", "ingested_at",
        "object_key", "predicted_label", "prediction_id", "inferred_at",
        F.col("confidence").cast("double").alias("confidence"),
    )
    people = d.patients().join(d.sites(), "site_code").select(
        "patient_id", "display_name", "site_name"
    )
    # A patient may have very many studies: the studies lead, and adaptive execution can split them.
    # Patients without studies come from an anti join against distinct ids.
    found = studies.join(people, "patient_id")
    without = people.join(d.studies().select("patient_id").distinct(), "patient_id", "left_anti")
    return found.unionByName(without, allowMissingColumns=True).select(*people.columns, *studies.drop("patient_id").columns)


@register("patient_totals", tables="patients studies clinical_predictions", sql="""
select patient_id, coalesce(a.n, 0)::bigint study_count,
       coalesce(b.n, 0)::bigint clinical_report_count
from patients left join (select patient_id, count(*) n from studies group by 1) a using (patient_id)
left join (select patient_id, count(*) n from clinical_predictions group by 1) b using (patient_id)""")
def patient_totals(d: Domain) -> DataFrame:
    """Studies and reports per patient."""
    studies = d.studies().groupBy("patient_id").agg(F.count(F.lit(1)).alias("a"))
    reports = d.clinical_predictions().groupBy("patient_id").agg(F.count(F.lit(1)).alias("b"))
    return (
        d.patients().select("patient_id")
        .join(studies, "patient_id", "left").join(reports, "patient_id", "left")
        .select(
            "patient_id",
            F.coalesce("a", F.lit(0)).cast("bigint").alias("study_count"),
            F.coalesce("b", F.lit(0)).cast("bigint").alias("clinical_report_count"),
        )
    )


@register("patient_reports", tables="clinical_predictions patients", sql="""
select c.patient_id, prediction_id, predicted_diagnosis, inferred_at, symptoms, prob_json, model_name,
       model_version, sex, cast(case age_range when '18-30' then 24 when '31-45' then 38 when '46-60' then 53
       when '61-75' then 68 when '76+' then 76 else 40 end as int) age
from clinical_predictions c left join patients p using (patient_id)""")
def patient_reports(d: Domain) -> DataFrame:
    """All reports with whole texts; ``recent_reports`` is the list shown per patient."""
    return _reports(d)


REPORTS_SHOWN = 50  # reports per patient on a page


@register("recent_reports", tables="clinical_predictions", sql=f"""
select patient_id, prediction_id, inferred_at
from (select *, row_number() over (partition by patient_id order by inferred_at desc, prediction_id desc) r
      from clinical_predictions) where r <= {REPORTS_SHOWN}""")
def recent_reports(d: Domain) -> DataFrame:
    """The newest REPORTS_SHOWN reports of each patient."""
    order = [F.col("inferred_at").desc(), F.col("prediction_id").desc()]
    newest = lookup.top_per_key(d.clinical_predictions(), ["patient_id"], order, REPORTS_SHOWN)
    return newest.select("patient_id", "prediction_id", "inferred_at")


def _reports(d: Domain) -> DataFrame:
    from wardspark.functions.clean import age_from_range

    people = d.patients().select(
        "patient_id", "sex", age_from_range(F.col("age_range"), F.lit(None).cast("int")).alias("age")
    )
    return d.clinical_predictions().join(people, "patient_id", "left").select(
        "patient_id", "prediction_id", "predicted_diagnosis", "inferred_at", "symptoms", "prob_json",
        "model_name", "model_version", "sex", F.coalesce("age", F.lit(40)).alias("age"),
    )


_EXISTING = """
select kind, key, found from (
  select distinct 'site' kind, p.site_code key,
         p.site_code in (select site_code from sites where active) found from patients p
  union all
  select distinct 'patient', 'PAT-' || lpad(cast(doc_id as varchar), 12, '0'),
         'PAT-' || lpad(cast(doc_id as varchar), 12, '0') in (select patient_id from patients)
  from documents
  union all
  select distinct 'study', 'STU-' || event_id, 'STU-' || event_id in (select study_id from studies)
  from events)"""


@register("fk_exists", tables="studies patients sites", sql=_EXISTING)
def fk_exists(d: Domain) -> DataFrame:
    """Existence of the active sites, patients and studies that other tables ask for."""
    return _existing(d, lambda asked, table, key: lookup.existing(asked, table, key))


@register("fk_exists_stored", tables="studies patients sites", sql=_EXISTING)
def fk_exists_stored(d: Domain) -> DataFrame:
    """The same from tables stored sorted by their keys: few requests read few row groups, many are joined."""
    def stored(asked: DataFrame, table: DataFrame, key: str) -> DataFrame:
        path = scratch_path(d.spark, "sorted")
        skipping.write_sorted(table, path, [key], ids=(key,))
        return lookup.existing_stored(asked, d.spark.read.schema(table.schema).parquet(path), key)

    return _existing(d, stored)


def _existing(d: Domain, find: Callable[[DataFrame, DataFrame, str], DataFrame]) -> DataFrame:
    wanted = d.patients().select("site_code").distinct()
    site = find(wanted, d.sites().where("active"), "site_code")
    people = d.raw("documents").selectExpr(
        "concat('PAT-', lpad(cast(doc_id as string), 12, '0')) patient_id"
    ).distinct()
    person = find(people, d.patients(), "patient_id")
    shots = d.raw("events").selectExpr("concat('STU-', event_id) study_id").distinct()
    study = find(shots, d.studies(), "study_id")
    parts = [("site", site, "site_code"), ("patient", person, "patient_id"), ("study", study, "study_id")]
    frames = [df.select(F.lit(kind).alias("kind"), F.col(key).alias("key"), "found") for kind, df, key in parts]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@register("create_conflicts", tables="patients", sql="""
select 'PAT-' || lpad(cast(s_suppkey as varchar), 12, '0') patient_id, s_name display_name from supplier
where 'PAT-' || lpad(cast(s_suppkey as varchar), 12, '0') in (select patient_id from patients)""")
def create_conflict_rows(d: Domain) -> DataFrame:
    requests = d.raw("supplier").selectExpr(
        "concat('PAT-', lpad(cast(s_suppkey as string), 12, '0')) patient_id", "s_name display_name"
    )
    return create_conflicts(requests, d.patients(), "patient_id")


@register("platform_totals", tables="predictions studies patients", sql="""
select (select count(*) from predictions)::bigint predictions_total,
       (select count(*) from studies where source_dataset = 'api_upload')::bigint api_uploads,
       (select count(*) from patients)::bigint patients_total""")
def platform_totals(d: Domain) -> DataFrame:
    return summary.platform_totals(d.predictions(), d.studies(), d.patients())


@register("predictions_by_label", tables="predictions", sql="""
select predicted_label, count(*)::bigint total from predictions group by 1 order by 2 desc, 1""")
def predictions_by_label(d: Domain) -> DataFrame:
    return summary.predictions_by_label(d.predictions()).orderBy(
        F.col("total").desc(), "predicted_label"
    )


@register("predictions_percent", tables="predictions", sql="""
select predicted_label, count(*)::bigint total,
       round(count(*) * 100::decimal(9,0) / (select count(*) from predictions), 1)::double percent
from predictions group by 1""")
def predictions_percent(d: Domain) -> DataFrame:
    return summary.predictions_percent(d.predictions())


@register("study_counts_by_label", tables="studies", sql="""
select "label", split, count(*)::bigint study_count from studies group by 1, 2""")
def study_counts_by_label(d: Domain) -> DataFrame:
    return summary.study_counts_by_label(d.studies())


@register("prediction_summary", tables="predictions", sql="""
select predicted_label, count(*)::bigint total,
       round(sum(prob_sana)::decimal(38,9) / count(*), 4)::double avg_prob_sana,
       round(sum(prob_neumonia)::decimal(38,9) / count(*), 4)::double avg_prob_neumonia,
       round(sum(prob_covid)::decimal(38,9) / count(*), 4)::double avg_prob_covid
from predictions group by 1""")
def prediction_summary(d: Domain) -> DataFrame:
    return summary.prediction_summary(d.predictions())


@register("table_counts", tables="patients studies run_events predictions", sql="""
select *, n > 0 filled from (
  select 'patients' name, count(*)::bigint n from patients
  union all select 'studies', count(*) from studies
  union all select 'runs_ok', count(*) from run_events where status = 'ok'
  union all select 'predictions', count(*) from predictions)""")
def table_counts(d: Domain) -> DataFrame:
    return summary.table_counts(
        {
            "patients": d.patients(), "studies": d.studies(),
            "runs_ok": d.run_events().where("status = 'ok'"), "predictions": d.predictions(),
        }
    )


@register("json_probs", tables="clinical_predictions", sql="""
select prediction_id, 3::bigint entries, round(p1, 4)::double p_predicted,
       round(p1 + p2 + 0.02, 4)::double p_sum from clinical_predictions""")
def json_probs(d: Domain) -> DataFrame:
    """Probability documents parsed to maps, written back to JSON and read again."""
    back = F.to_json(clinical.probabilities(F.col("prob_json")))
    rows = d.clinical_predictions().withColumn("m", clinical.probabilities(back))
    values = F.map_values("m")
    return rows.select(
        "prediction_id", F.size("m").cast("bigint").alias("entries"),
        F.round(F.element_at("m", F.col("predicted_diagnosis")), 4).alias("p_predicted"),
        F.round(F.aggregate(values, F.lit(0.0), lambda a, v: a + v), 4).alias("p_sum"),
    )


@register("top_probabilities", tables="clinical_predictions", sql="""
select prediction_id, unnest([1, 2, 3])::int place,
       case when p2 >= 0.02 then unnest([d1, case when p2 = 0.02 then least(d2, d3) else d2 end,
                                         case when p2 = 0.02 then greatest(d2, d3) else d3 end])
            else unnest([d1, d3, d2]) end "label",
       case when p2 >= 0.02 then unnest([p1, p2, 0.02]) else unnest([p1, 0.02, p2]) end::double probability
from clinical_predictions""")
def top_probabilities(d: Domain) -> DataFrame:
    top = clinical.top_entries(clinical.probabilities(F.col("prob_json")))
    return d.clinical_predictions().select("prediction_id", F.posexplode(top).alias("p", "e")).select(
        "prediction_id", (F.col("p") + 1).alias("place"), "e.label", "e.probability"
    )


@register("diagnosis_display", tables="clinical_predictions", sql="""
select case predicted_diagnosis when 'sana' then 'Sin patología destacada' when 'neumonia' then 'Neumonía'
         when 'covid' then 'COVID-19' when 'gripe' then 'Gripe' when 'asma' then 'Asma'
         when 'bronquitis' then 'Bronquitis' when 'epoc' then 'EPOC' else 'Rinitis alérgica' end shown,
       count(*)::bigint n from clinical_predictions group by 1""")
def diagnosis_display(d: Domain) -> DataFrame:
    shown = clinical.diagnosis_name(F.col("predicted_diagnosis")).alias("shown")
    return d.clinical_predictions().groupBy(shown).agg(F.count(F.lit(1)).alias("n"))


@register("argmax_label", tables="predictions", sql="""
select "label", count(*)::bigint n, sum(c)::double confidence_sum from (
  select case when prob_covid >= prob_neumonia and prob_covid >= prob_sana then 'covid'
              when prob_neumonia >= prob_sana then 'neumonia' else 'sana' end "label",
         greatest(prob_covid, prob_neumonia, prob_sana) c from predictions) group by 1""")
def argmax_label(d: Domain) -> DataFrame:
    """Label of the largest entry of the probability vector, first in model order on a tie."""
    from wardspark.schemas import MODEL_LABELS

    vector = F.array(*[F.col(f"prob_{name}") for name in MODEL_LABELS])
    return d.predictions().groupBy(clinical.argmax_label(vector, MODEL_LABELS).alias("label")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(lookup.confidence()).cast("double").alias("confidence_sum"),
    )


@register("iso_format", tables="run_events", sql="""
select event_id, strftime(logged_at, '%Y-%m-%dT%H:%M:%S') ||
       case when microsecond(logged_at) % 1000000 = 0 then ''
            else '.' || lpad(cast(microsecond(logged_at) % 1000000 as varchar), 6, '0') end logged_iso
from run_events""")
def iso_format(d: Domain) -> DataFrame:
    return d.run_events().select(
        "event_id", clinical.iso_text(F.col("logged_at")).alias("logged_iso")
    )


@register("sample_ids", tables="studies", sql="""
select study_id, variant, substr(sha256(md5(study_id) || ':' || split || ':' || variant), 1, 16) sample_id
from studies, (values ('original'), ('rotate'), ('flip'), ('zoom')) v(variant)""")
def sample_ids(d: Domain) -> DataFrame:
    from wardspark.schemas import TRAIN_VARIANTS

    variants = F.explode(F.array(*[F.lit(v) for v in TRAIN_VARIANTS])).alias("variant")
    rows = d.studies().select("study_id", "split", variants)
    return rows.select(
        "study_id", "variant",
        ids.sample_id(F.md5("study_id"), F.col("split"), F.col("variant")).alias("sample_id"),
    )
