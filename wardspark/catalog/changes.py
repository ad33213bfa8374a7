"""Row changes on tables, each as the state after the change."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardspark.catalog.clinic import _LATEST
from wardspark.catalog.domain import Domain
from wardspark.catalog.ingest import _CAPTURED, _derived_studies
from wardspark.catalog.operations import _RUNS, _runs
from wardspark.catalog.registry import register
from wardspark.functions import ids
from wardspark.operators import lookup, mutate, studies as st
from wardspark.session import scratch_path, stage
from wardspark.sources.keyed import KeyedTable
from wardspark.sources.sinks import Snapshots

_STUDY_UPDATE = ["patient_id", "file_path", "split", "label", "source_dataset", "captured_at"]


def _pid(column: str) -> str:
    return f"concat('PAT-', lpad(cast({column} as string), 12, '0')) patient_id"


@register("upsert_patients", tables="patients studies manifest", sql="""
with incoming as (
  select patient_id, 'Paciente ' || right(replace(patient_id, 'PAT-', ''), 6) display_name,
         case h % 3 when 0 then 'M' when 1 then 'F' else 'X' end sex,
         case h % 5 when 0 then '18-30' when 1 then '31-45' when 2 then '46-60' when 3 then '61-75'
              else '76+' end age_range, 'S1' site_code
  from (select distinct patient_id, ('0x' || substr(md5(patient_id), 1, 8))::bigint h
        from (select patient_id from studies
              union all select 'PAT-' || substr(sha256(file_path), 1, 10) from manifest)))
select * from incoming
union all
select patient_id, display_name, sex, age_range, site_code from patients
where patient_id not in (select patient_id from incoming)""")
def upsert_patients(d: Domain) -> DataFrame:
    """Patients merged with those derived from known studies and from all files."""
    seen = d.studies().select("patient_id").unionByName(
        d.manifest().select(ids.patient_id_from_path(F.col("file_path")).alias("patient_id"))
    )
    incoming = st.derive_patients(seen, "S1")
    update = ["display_name", "sex", "age_range", "site_code"]
    return mutate.upsert(d.patients(), incoming, "patient_id", update)


_UPSERT_STUDIES = f"""
with {_LATEST},
incoming as (
  select study_id, patient_id, file_path, split, "label", source_dataset, captured_at, modality, body_part
  from ({_CAPTURED})
  union all
  select s.study_id, s.patient_id, s.file_path, 'train', p.predicted_label, 'relabelled', p.inferred_at, 'DX', 'chest'
  from studies s join latest p using (study_id))
select study_id, coalesce(n.patient_id, o.patient_id) patient_id, coalesce(n.file_path, o.file_path) file_path,
       o.object_key, coalesce(n.split, o.split) split,
       case when n.study_id is not null then n."label" else o."label" end "label",
       coalesce(n.source_dataset, o.source_dataset) source_dataset,
       coalesce(o.modality, n.modality) modality, coalesce(o.body_part, n.body_part) body_part,
       coalesce(n.captured_at, o.captured_at) captured_at, o.ingested_at
from studies o full join incoming n using (study_id)"""


def _study_batch(d: Domain, known: DataFrame) -> DataFrame:
    """A batch of new studies and of relabelled known ones."""
    latest = lookup.latest_predictions(d.predictions())
    again = known.select("study_id", "patient_id", "file_path").join(latest, "study_id").select(
        "study_id", "patient_id", "file_path", F.lit("train").alias("split"),
        F.col("predicted_label").alias("label"), F.lit("relabelled").alias("source_dataset"),
        F.lit("DX").alias("modality"), F.lit("chest").alias("body_part"),
        F.col("inferred_at").alias("captured_at"),
    )
    return _derived_studies(d).unionByName(again)


@register("upsert_studies", tables="studies manifest predictions", sql=_UPSERT_STUDIES)
def upsert_studies(d: Domain) -> DataFrame:
    """Studies merged with a batch of new ones and of relabelled known ones.

    Only the listed columns change on known studies: modality and object key stay.
    """
    return mutate.upsert(d.studies(), _study_batch(d, d.studies()), "study_id", _STUDY_UPDATE)


@register("upsert_stored_studies", tables="studies manifest predictions", sql=_UPSERT_STUDIES)
def upsert_stored_studies(d: Domain) -> DataFrame:
    """The same merge into a stored table, in place: known studies first, then the batch, in the partitions it touches."""
    table = KeyedTable.create(d.studies(), scratch_path(d.spark, "studies"), "study_id")
    table.upsert(_study_batch(d, table.read()), _STUDY_UPDATE)
    return table.detached()


@register("upsert_uploads", tables="studies predictions uploads", sql="""
with incoming as (
  select study_id, 'uploads/' || study_id || '.jpg' object_key, max(inferred_at) ingested_at
  from predictions group by study_id
  union all
  select 'STU-' || upper(substr(md5(content), 1, 12)), 'uploads/STU-' || upper(substr(md5(content), 1, 12)) || '.jpg',
         timestamp '2026-04-01 08:00:00' from uploads group by content)
select study_id, coalesce(n.object_key, o.object_key) object_key, coalesce(n.ingested_at, o.ingested_at) ingested_at,
       o.split, o."label"
from (select study_id, object_key, ingested_at, split, "label" from studies) o full join incoming n using (study_id)""")
def upsert_uploads(d: Domain) -> DataFrame:
    """Upload merge: on known studies only the object key and the ingest time change."""
    known = d.predictions().groupBy("study_id").agg(F.max("inferred_at").alias("ingested_at"))
    new = d.uploads().select(ids.study_id_from_content(F.col("content")).alias("study_id")).distinct()
    both = known.unionByName(
        new.withColumn("ingested_at", F.lit("2026-04-01 08:00:00").cast("timestamp_ntz"))
    )
    incoming = both.withColumn("object_key", ids.upload_object_key(F.col("study_id"), F.lit(".jpg")))
    base = d.studies().select("study_id", "object_key", "ingested_at", "split", "label")
    return mutate.upsert(base, incoming, "study_id", ["object_key", "ingested_at"])


@register("insert_ignore_runs", tables="run_events", sql=f"""
with {_RUNS}, stubs as (select distinct 'RUN-' || doc_id run_id from documents)
select run_id, stage, status, started_at from headers
union all
select run_id, 'ingesta_csv', 'ok', timestamp '2026-04-01 09:00:00' from stubs
where run_id not in (select run_id from headers)""")
def insert_ignore_runs(d: Domain) -> DataFrame:
    named = d.raw("documents").selectExpr("concat('RUN-', cast(doc_id as string)) run_id")
    stubs = st.run_stubs(named, "2026-04-01 09:00:00").select("run_id", "stage", "status", "started_at")
    base = _runs(d).select("run_id", "stage", "status", "started_at")
    return mutate.insert_ignore(base, stubs, "run_id")


@register("patch_patients", tables="patients", sql="""
select p.patient_id, coalesce(case when s.s_suppkey % 2 = 0 then s.s_name end, p.display_name) display_name,
       p.sex, p.age_range, coalesce('S' || s.s_nationkey, p.site_code) site_code
from patients p left join supplier s on p.patient_id = 'PAT-' || lpad(cast(s.s_suppkey as varchar), 12, '0')""")
def patch_patients(d: Domain) -> DataFrame:
    changes = d.raw("supplier").selectExpr(
        _pid("s_suppkey"), "case when s_suppkey % 2 = 0 then s_name end display_name",
        "concat('S', cast(s_nationkey as string)) site_code",
    )
    return mutate.patch(d.patients(), changes, "patient_id")


@register("alerts_ack", tables="alerts", sql="""
select alert_id, acknowledged or alert_id in (select doc_id from labels where toxic = 0) acknowledged
from alerts""")
def alerts_ack(d: Domain) -> DataFrame:
    seen = d.raw("labels").where("toxic = 0").selectExpr("doc_id alert_id")
    return mutate.set_flag(d.alerts(), seen, "alert_id", "acknowledged").select("alert_id", "acknowledged")


@register("delete_set_null", tables="alerts", sql="""
select alert_id, case when run_id not in (select 'RUN-' || conv_id from conversations) then run_id end run_id,
       severity from alerts""")
def delete_set_null(d: Domain) -> DataFrame:
    gone = d.raw("conversations").selectExpr("concat('RUN-', cast(conv_id as string)) run_id")
    return mutate.set_null(d.alerts(), "run_id", gone, "run_id").select("alert_id", "run_id", "severity")


def _delete_requests(d: Domain) -> DataFrame:
    suppliers = d.raw("supplier").selectExpr(_pid("s_suppkey"), "s_acctbal > 4000 cascade")
    files = d.raw("documents").selectExpr(_pid("doc_id + 1000"), "false cascade")
    return suppliers.unionByName(files)


_DECIDED = """
requests as (
  select 'PAT-' || lpad(cast(s_suppkey as varchar), 12, '0') patient_id, s_acctbal > 4000 cascade from supplier
  union all select 'PAT-' || lpad(cast(doc_id + 1000 as varchar), 12, '0'), false from documents),
decided as (
  select patient_id, case when p.known is null then 'not_found' when n > 0 and not cascade then 'refused'
                          else 'deleted' end outcome, coalesce(n, 0)::bigint study_count
  from requests left join (select patient_id, true known from patients) p using (patient_id)
  left join (select patient_id, count(*) n from studies group by 1) s using (patient_id))
"""


@register("delete_decisions", tables="patients studies", sql=f"""
with {_DECIDED}
select *, case when outcome = 'deleted' then study_count else 0 end studies_deleted from decided""")
def delete_decisions(d: Domain) -> DataFrame:
    return mutate.delete_decisions(_delete_requests(d), d.patients(), d.studies())


_CASCADE = f"""
with {_DECIDED}, gone as (select patient_id from decided where outcome = 'deleted'),
lost as (select study_id from studies where patient_id in (select patient_id from gone))
select 'patients' table_name, count(*)::bigint n, min(patient_id) first_key
from patients where patient_id not in (select patient_id from gone)
union all select 'studies', count(*), min(study_id) from studies where patient_id not in (select patient_id from gone)
union all select 'predictions', count(*), min(study_id) from predictions
where study_id not in (select study_id from lost)"""


@register("delete_patients_cascade", tables="patients studies predictions", sql=_CASCADE)
def delete_patients_cascade(d: Domain) -> DataFrame:
    """What is left of the three tables after the accepted deletes."""
    decided = mutate.delete_decisions(_delete_requests(d), d.patients(), d.studies())
    decided = stage(decided, "delete-decisions")
    left = mutate.delete_patients(decided, d.patients(), d.studies(), d.predictions())
    return _remaining(*left)


@register("delete_stored_cascade", tables="patients studies predictions", sql=_CASCADE)
def delete_stored_cascade(d: Domain) -> DataFrame:
    """The same deletes from three stored tables, in place. Studies are stored by patient and predictions by study, so that
    each cascade is a delete by the key of its table."""
    tables = [
        KeyedTable.create(df, scratch_path(d.spark, "stored"), key)
        for df, key in ((d.patients(), "patient_id"), (d.studies(), "patient_id"), (d.predictions(), "study_id"))
    ]
    patients, studies, predictions = tables
    decided = stage(mutate.delete_decisions(_delete_requests(d), patients.read(), studies.read()), "delete-decisions")
    gone = decided.where("outcome = 'deleted'").select("patient_id")
    lost = stage(studies.read(studies.touched(gone)).join(gone, "patient_id", "left_semi").select("study_id"), "lost-studies")
    predictions.delete(lost)
    studies.delete(gone)
    patients.delete(gone)
    return _remaining(*[t.detached() for t in tables])


@register("delete_objects", tables="patients studies", sql=f"""
with {_DECIDED}
select object_key from studies left join (select patient_id, true gone from decided where outcome = 'deleted') using (patient_id)
where object_key is not null group by object_key having bool_and(coalesce(gone, false))""")
def delete_objects(d: Domain) -> DataFrame:
    """Objects to remove from the store after the accepted deletes."""
    decided = mutate.delete_decisions(_delete_requests(d), d.patients(), d.studies())
    return mutate.deleted_objects(decided, d.studies())


def _remaining(patients: DataFrame, studies: DataFrame, predictions: DataFrame) -> DataFrame:
    parts = [("patients", patients, "patient_id"), ("studies", studies, "study_id"),
             ("predictions", predictions, "study_id")]
    frames = [
        df.agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first_key"))
        .select(F.lit(name).alias("table_name"), "n", "first_key")
        for name, df, key in parts
    ]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


_PURGE = """
held_patients as (
  select patient_id, case when hash5 % 5 <> 0 then display_name end display_name, sex, age_range,
         case when hash5 % 7 <> 0 then site_code end site_code
  from (select *, ('0x' || substr(md5(patient_id), 1, 8))::bigint hash5 from patients)),
held_studies as (
  select study_id, patient_id, case when ('0x' || substr(md5(study_id), 1, 8))::bigint % 5 <> 0 then source_dataset end source_dataset
  from studies),
kept_studies as (select * from held_studies where coalesce(source_dataset <> 'api_upload', true)),
kept_patients as (
  select * from held_patients p where not coalesce(display_name like 'Paciente %'
    or (not exists (select 1 from kept_studies s where s.patient_id = p.patient_id)
        and site_code in ('S3', 'S4')), false))
"""


def _purged(d: Domain) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The purge over tables in which some names, sites and sources are null."""
    number = "cast(conv(substring(md5({0}), 1, 8), 16, 10) as bigint)"
    patients = d.patients().selectExpr(
        "patient_id", f"case when {number.format('patient_id')} % 5 <> 0 then display_name end display_name", "sex", "age_range",
        f"case when {number.format('patient_id')} % 7 <> 0 then site_code end site_code",
    )
    studies = d.studies().selectExpr(
        "study_id", "patient_id", f"case when {number.format('study_id')} % 5 <> 0 then source_dataset end source_dataset"
    )
    return mutate.purge_demo(patients, studies, d.predictions(), ("S3", "S4"))


@register("purge_demo_patients", tables="patients studies", sql=f"""
with {_PURGE} select * from kept_patients""")
def purge_demo_patients(d: Domain) -> DataFrame:
    return _purged(d)[0]


@register("purge_demo_predictions", tables="patients studies predictions", sql=f"""
with {_PURGE}
select 'patients' table_name, count(*)::bigint n, min(patient_id) first_key from kept_patients
union all select 'studies', count(*), min(study_id) from kept_studies
union all select 'predictions', count(*), min(study_id) from predictions
where study_id not in (select study_id from held_studies where source_dataset = 'api_upload')""")
def purge_demo_predictions(d: Domain) -> DataFrame:
    return _remaining(*_purged(d))


@register("snapshot_merge", tables="patients studies", sql="""
with incoming as (
  select distinct patient_id, 'Paciente ' || right(replace(patient_id, 'PAT-', ''), 6) display_name from studies)
select site_code, count(*)::bigint n,
       count(*) filter (where coalesce(i.display_name, p.display_name) like 'Paciente %')::bigint renamed
from patients p left join incoming i using (patient_id) group by site_code""")
def snapshot_merge(d: Domain) -> DataFrame:
    """A merge committed as version 2 of a stored table and read back from there."""
    table = Snapshots(d.spark, scratch_path(d.spark, "patients"))
    table.commit(d.patients())
    incoming = st.derive_patients(d.studies().select("patient_id"), "S1").select("patient_id", "display_name")
    table.commit(mutate.upsert(table.read(), incoming, "patient_id", ["display_name"]))
    return table.read().groupBy("site_code").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("display_name").like("Paciente %")).alias("renamed"),
    )
