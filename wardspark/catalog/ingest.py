"""Queries of the file ingest: sources, validation, duplicates, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardspark.catalog.domain import Domain
from wardspark.catalog.registry import register
from wardspark.functions import clean, content as fc, ids, paths
from wardspark.operators import features, quality, studies as st, validate
from wardspark.plans.ingest import first_accepted
from wardspark.schemas import RUN_EVENTS_CSV, STUDIES_CSV
from wardspark.session import scratch_path, stage
from wardspark.sources import files, sinks

AS_OF = "2024-01-31 00:00:00"
RUN_TIME = "2026-04-01 09:00:00"


def _studies_as_text(d: Domain) -> DataFrame:
    """Studies as a source system would send them: text, with blanks, gaps and repeats."""
    key = F.regexp_extract("study_id", "([0-9]+)$", 1).cast("bigint")
    sent = d.studies().select(
        F.when(key % 101 != 0, F.col("study_id")).alias("study_id"),
        F.when(key % 103 != 0, F.col("patient_id")).alias("patient_id"),
        "file_path",
        F.concat(F.lit(" "), F.upper("split")).alias("split"),
        F.concat(F.upper("label"), F.lit(" ")).alias("label"),
        "source_dataset", "modality", "body_part",
        F.when(key % 97 == 0, F.lit("not a time")).otherwise(
            F.date_format("captured_at", "yyyy-MM-dd'T'HH:mm:ss'Z'")
        ).alias("captured_at"),
    )
    again = sent.where("study_id is not null and label like 'COVID%'").withColumn(
        "file_path", F.concat(F.lit("data/again/"), "study_id")
    )
    return sent.unionByName(again)


_STUDIES_TEXT = """
sent as (
  select case when k % 101 <> 0 then study_id end study_id,
         case when k % 103 <> 0 then patient_id end patient_id,
         file_path, ' ' || upper(split) split, upper("label") || ' ' "label", source_dataset,
         modality, body_part,
         case when k % 97 = 0 then 'not a time'
              else strftime(captured_at, '%Y-%m-%dT%H:%M:%SZ') end captured_at
  from (select *, cast(substr(study_id, 5) as bigint) k from studies)),
resent as (
  select * from sent
  union all
  select study_id, patient_id, 'data/again/' || study_id, split, "label", source_dataset, modality,
         body_part, captured_at
  from sent where study_id is not null and "label" like 'COVID%'),
cleaned as (
  select study_id, patient_id, file_path, lower(trim(split)) split, lower(trim("label")) "label",
         source_dataset, try_cast(replace(captured_at, 'Z', '') as timestamp) captured_at
  from (select *, row_number() over (partition by study_id order by patient_id nulls last,
               file_path nulls last, split nulls last, "label" nulls last) r from resent)
  where r = 1 or study_id is null),
flagged as (
  select *, concat_ws(',', case when study_id is null then 'study_id' end,
       case when patient_id is null then 'patient_id' end,
       case when file_path is null then 'file_path' end,
       case when not coalesce("label" in ('sana', 'neumonia', 'covid'), false) then 'label' end,
       case when not coalesce(split in ('train', 'val', 'test', 'clinical'), false) then 'split' end,
       case when captured_at is null then 'captured_at' end) problems
  from cleaned)
"""


def _inspected(d: Domain) -> DataFrame:
    return validate.inspect_files(d.manifest())


def _classified(d: Domain) -> DataFrame:
    """Classified files. The narrow result of the inspection is staged, since classifying uses
    it twice: contents are read and hashed once."""
    return validate.classify(stage(_inspected(d), "inspected"))


_REPORT = """
select count(*)::bigint total_scanned,
       count(*) filter (where reject_reason is null)::bigint valid_unique,
       count(*) filter (where reject_reason is not null)::bigint rejected,
       count(*) filter (where reject_reason = 'corrupt')::bigint invalid_corrupt,
       count(*) filter (where reject_reason = 'incomplete')::bigint invalid_incomplete,
       count(*) filter (where reject_reason = 'duplicate')::bigint duplicates_removed
from classified"""


@register("ingest_report", tables="classified", sql=_REPORT)
def ingest_report(d: Domain) -> DataFrame:
    """Scan, validate, hash and count all files in one pass."""
    return validate.ingest_report(_inspected(d))


@register("ingest_report_on_write", tables="classified", sql=_REPORT)
def ingest_report_on_write(d: Domain) -> DataFrame:
    """The same report from the job that stores the classified files, which counts them as it writes."""
    watched, seen = validate.watched(_classified(d))
    sinks.write_table(watched, scratch_path(d.spark, "classified"))
    return validate.seen_report(d.spark, seen)


@register("scan_csv_studies", tables="studies", sql=f"""
with {_STUDIES_TEXT}
select study_id, patient_id, file_path, split, "label", source_dataset, modality, body_part, captured_at
from resent""")
def scan_csv_studies(d: Domain) -> DataFrame:
    """Studies written as CSV with header and scanned back as text."""
    path = scratch_path(d.spark, "studies-csv")
    sinks.export_csv(_studies_as_text(d), path)
    return files.read_csv_text(d.spark, path, STUDIES_CSV)


@register("schema_required_columns", tables="studies", sql=f"""
with {_STUDIES_TEXT}
select column_name, count(*) filter (where filled)::bigint filled, count(*)::bigint total_rows
from (select unnest([
        {{'column_name': 'study_id', 'filled': study_id is not null}},
        {{'column_name': 'patient_id', 'filled': patient_id is not null}},
        {{'column_name': 'file_path', 'filled': file_path is not null}},
        {{'column_name': 'split', 'filled': split is not null}},
        {{'column_name': 'label', 'filled': "label" is not null}},
        {{'column_name': 'source_dataset', 'filled': source_dataset is not null}},
        {{'column_name': 'modality', 'filled': modality is not null}},
        {{'column_name': 'body_part', 'filled': body_part is not null}},
        {{'column_name': 'captured_at', 'filled': captured_at is not null}}], recursive := true)
      from resent)
group by column_name""")
def schema_required_columns(d: Domain) -> DataFrame:
    """Required columns are present, and how many of their cells are filled, in one pass."""
    names = STUDIES_CSV.fieldNames()
    rows = files.require_columns(_studies_as_text(d), names)
    counted = rows.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in names])
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in names])
    return counted.select(F.inline(cells), F.col("_n").alias("total_rows")).select(
        "column_name", "filled", "total_rows"
    )


@register("manifest_from_paths", tables="manifest", sql="""
select file_path, split_part(file_path, '/', 4) split, split_part(file_path, '/', 5) folder,
       split_part(file_path, '/', 6) filename,
       case split_part(file_path, '/', 5) when 'NORMAL' then 'sana' when 'PNEUMONIA' then 'neumonia'
            else 'covid' end "label"
from manifest where split_part(file_path, '/', 5) in ('NORMAL', 'PNEUMONIA', 'COVID19')""")
def manifest_from_paths(d: Domain) -> DataFrame:
    path = F.col("file_path")
    rows = d.manifest().select(
        path, paths.path_part(path, -3).alias("split"), paths.path_part(path, -2).alias("folder"),
        paths.path_part(path, -1).alias("filename"),
    )
    return rows.withColumn("label", paths.folder_label(F.col("folder"))).where("label is not null")


@register("binary_profile", tables="manifest", sql="""
select doc_id, octet_length(content)::bigint size_bytes, hex(content[1:3]) head, md5(content) content_md5
from manifest""")
def binary_profile(d: Domain) -> DataFrame:
    return d.manifest().select(
        "doc_id",
        F.octet_length("content").cast("bigint").alias("size_bytes"),
        F.hex(F.substring("content", 1, 3)).alias("head"),
        F.md5("content").alias("content_md5"),
    )


@register("path_resolve", tables="manifest", sql="""
select file_path, '/srv/data/' || regexp_replace(file_path, '^data/', '') fs_path from manifest""")
def path_resolve(d: Domain) -> DataFrame:
    return d.manifest().select(
        "file_path", paths.resolve_local(F.col("file_path"), "/srv/data").alias("fs_path")
    )


@register("label_map", tables="inspected", sql="""
select coalesce("label", 'none') "label", folder, count(*)::bigint n from inspected group by all""")
def label_map(d: Domain) -> DataFrame:
    label = F.coalesce(paths.label_or_folder(F.col("label"), F.col("folder")), F.lit("none"))
    return d.manifest().groupBy(label.alias("label"), "folder").agg(F.count(F.lit(1)).alias("n"))


@register("magic_validate", tables="inspected", sql="""
select file_path, file_size::bigint file_size, is_valid_jpg, path_ok, content_hash from inspected""")
def magic_validate(d: Domain) -> DataFrame:
    return _inspected(d).select("file_path", "file_size", "is_valid_jpg", "path_ok", "content_hash")


@register("validate_split", tables="inspected", sql="""
select case when is_valid_jpg and path_ok then 'valid' else 'invalid' end side, split,
       count(*)::bigint files, sum(file_size)::bigint total_bytes
from inspected group by all""")
def validate_split(d: Domain) -> DataFrame:
    rows = _inspected(d)
    valid = rows.where(validate.usable()).withColumn("side", F.lit("valid"))
    invalid = rows.where(~validate.usable()).withColumn("side", F.lit("invalid"))
    return valid.unionByName(invalid).groupBy("side", "split").agg(
        F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("total_bytes")
    )


@register("dedup_content", tables="classified", sql="""
select file_path, content_hash, 'raw/' || content_hash || '.jpg' object_key
from classified where reject_reason is null""")
def dedup_content(d: Domain) -> DataFrame:
    kept = validate.first_copies(_inspected(d))
    return kept.select(
        "file_path", "content_hash", ids.raw_object_key(F.col("content_hash")).alias("object_key")
    )


@register("object_keys", tables="classified", sql="""
select 'raw/' || content_hash || '.jpg' object_key, count(*)::bigint copies,
       min(file_path) file_path
from classified where content_hash is not null and path_ok group by content_hash""")
def object_keys(d: Domain) -> DataFrame:
    """Content-addressed keys and how many files share each."""
    return (
        _inspected(d).where(validate.usable()).groupBy("content_hash")
        .agg(F.count(F.lit(1)).alias("copies"), F.min("file_path").alias("file_path"))
        .select(ids.raw_object_key(F.col("content_hash")).alias("object_key"), "copies", "file_path")
    )


@register("reject_reasons", tables="classified", sql="""
select file_path, content_hash, reject_reason, file_size::bigint file_size, "label", split
from classified where reject_reason is not null""")
def reject_reasons(d: Domain) -> DataFrame:
    return validate.rejected(_classified(d))


@register("quality_issues", tables="classified", sql="""
select 'RUN-1' run_id, reject_reason issue_type, file_path details
from classified where reject_reason is not null""")
def quality_issue_rows(d: Domain) -> DataFrame:
    return quality.issue_rows(validate.rejected(_classified(d)), F.lit("RUN-1"))


@register("quality_alert", tables="classified", sql="""
select 'RUN-1' run_id, case when n < 50 then 'warning' else 'critical' end severity,
       'Too many rejected files' title,
       'Run RUN-1 rejected files: corrupt ' || c || ', incomplete ' || i || ', duplicate ' || d message
from (select count(*) filter (where reject_reason = 'corrupt') c,
             count(*) filter (where reject_reason = 'incomplete') i,
             count(*) filter (where reject_reason = 'duplicate') d,
             count(*) filter (where reject_reason is not null) n from classified)
where n >= 10""")
def quality_alert(d: Domain) -> DataFrame:
    counts = validate.ingest_report(_inspected(d)).select(
        F.lit("RUN-1").alias("run_id"),
        F.col("invalid_corrupt").alias("corrupt"),
        F.col("invalid_incomplete").alias("incomplete"),
        F.col("duplicates_removed").alias("duplicate"),
    )
    return quality.quality_alert(counts)


@register("format_audit", tables="manifest", sql="""
select case when hex(content[1:3]) = 'FFD8FF' then 'skipped_jpeg'
            when hex(content[1:8]) = '89504E470D0A1A0A' then 'to_convert' else 'failed' end outcome,
       count(*)::bigint files
from manifest group by all""")
def format_audit(d: Domain) -> DataFrame:
    return validate.format_audit(d.manifest())


@register("manifest_missing_files", tables="manifest studies", sql="""
select file_path, study_id from studies
where file_path not in (select 'data/raw/scans/' || filename from manifest)""")
def manifest_missing_files(d: Domain) -> DataFrame:
    """Studies whose file is not among the stored files."""
    listing = d.manifest().select(
        F.concat(F.lit("data/raw/scans/"), "filename").alias("file_path")
    )
    return validate.missing_files(d.studies().select("file_path", "study_id"), listing)


@register("upload_validate", tables="uploads", sql=r"""
select page_id, filename, ext,
       case when filename in ('', '.', '..') then 'missing_name' when contains(filename, '..') then 'bad_name'
            when ext not in ('.jpg', '.jpeg', '.png') then 'bad_extension' when size = 0 then 'empty'
            when size > 10485760 then 'too_large'
            when hex(content[1:3]) <> 'FFD8FF' and hex(content[1:8]) <> '89504E470D0A1A0A' then 'bad_format'
            when made_up_width < 64 or made_up_height < 64 then 'too_small' else 'ok' end outcome,
       'uploads/STU-' || upper(substr(md5(content), 1, 12)) ||
           case when ext = '.png' then '.png' else '.jpg' end object_key
from (select *, octet_length(content) size,
             lower(regexp_extract(filename, '(\.[^.]*)$', 1)) ext
      from (select *, list_last(string_split(replace(path, '\', '/'), '/')) filename from uploads))""")
def upload_validate(d: Domain) -> DataFrame:
    named = d.uploads().withColumn("filename", paths.base_name(F.col("path")))
    named = named.withColumn("ext", paths.extension(F.col("filename")))
    problem = fc.upload_problem(*[F.col(c) for c in ("filename", "ext", "content", "made_up_width", "made_up_height")])
    study = ids.study_id_from_content(F.col("content"))
    return named.select(
        "page_id", "filename", "ext", F.coalesce(problem, F.lit("ok")).alias("outcome"),
        ids.upload_object_key(study, F.col("ext")).alias("object_key"),
    )


@register("derive_ids", tables="manifest", sql="""
select file_path, 'PAT-' || substr(sha256(file_path), 1, 10) patient_id,
       'STU-' || substr(md5(file_path), 1, 12) study_id,
       'STU-' || upper(substr(md5(content), 1, 12)) upload_study_id
from manifest""")
def derive_ids(d: Domain) -> DataFrame:
    path = F.col("file_path")
    return d.manifest().select(
        path, ids.patient_id_from_path(path).alias("patient_id"),
        ids.study_id_from_path(path).alias("study_id"),
        ids.study_id_from_content(F.col("content")).alias("upload_study_id"),
    )


_CAPTURED = """
select 'STU-' || substr(md5(file_path), 1, 12) study_id,
       'PAT-' || substr(sha256(file_path), 1, 10) patient_id, file_path, split, "label",
       'xray_archive' source_dataset, 'CR' modality, 'chest' body_part,
       timestamp '2026-04-01 08:00:00' + to_hours(cast((row_number() over (order by file_path) - 1) % 720 as int)) captured_at
from (select *, case folder when 'NORMAL' then 'sana' when 'PNEUMONIA' then 'neumonia'
                     when 'COVID19' then 'covid' end "label" from (select * exclude ("label") from manifest))
where "label" is not null"""


def _derived_studies(d: Domain) -> DataFrame:
    images = d.manifest().select(
        "file_path", "split", paths.folder_label(F.col("folder")).alias("label")
    ).where("label is not null")
    placed = features.row_positions(images, ["file_path"])
    return st.derive_studies(
        placed, features.hourly_capture_time("2026-04-01 08:00:00"), "xray_archive"
    )


@register("derive_studies", tables="manifest", sql=_CAPTURED)
def derive_studies(d: Domain) -> DataFrame:
    return _derived_studies(d)


@register("derive_run_events", tables="manifest", sql="""
with f as (select coalesce(nullif("label", ''), case folder when 'NORMAL' then 'sana' when 'PNEUMONIA' then 'neumonia'
                    when 'COVID19' then 'covid' end) l from manifest),
c as (select count(*)::bigint n, count(distinct l) k, string_agg(distinct l, ', ' order by l) names from f where l is not null)
select 'EVT-001' event_id, 'RUN-1' run_id, 'ingesta' stage, 'ok' status, n records, 'manifest built' message,
       timestamp '2026-04-01 09:00:00' logged_at from c
union all select 'EVT-002', 'RUN-1', 'validacion', 'ok', n, n || ' images in ' || k || ' classes: ' || names,
       timestamp '2026-04-01 09:05:00' from c""")
def derive_run_events(d: Domain) -> DataFrame:
    """Run events of the manifest build."""
    labelled = d.manifest().select(paths.label_or_folder(F.col("label"), F.col("folder")).alias("label"))
    return st.manifest_events(labelled.where("label is not null"), "RUN-1", "2026-04-01 09:00:00")


@register("captured_at_sequence", tables="manifest", sql="""
select file_path, (row_number() over (order by file_path) - 1)::bigint "position",
       timestamp '2026-04-01 08:00:00'
         + to_hours(cast((row_number() over (order by file_path) - 1) % 720 as int)) captured_at
from manifest""")
def captured_at_sequence(d: Domain) -> DataFrame:
    placed = features.row_positions(d.manifest().select("file_path"), ["file_path"])
    return placed.withColumn("captured_at", features.hourly_capture_time("2026-04-01 08:00:00"))


@register("studies_clean", tables="studies", sql=f"""
with {_STUDIES_TEXT}
select study_id, patient_id, file_path, split, "label", captured_at, problems from flagged""")
def studies_clean(d: Domain) -> DataFrame:
    return st.clean_studies(_studies_as_text(d)).select(
        "study_id", "patient_id", "file_path", "split", "label", "captured_at",
        F.array_join("problems", ",").alias("problems"),
    )


@register("studies_invalid", tables="studies", sql=f"""
with {_STUDIES_TEXT}
select 'incomplete' issue_type, coalesce(study_id, file_path, 'unknown') details, problems
from flagged where problems <> ''""")
def studies_invalid(d: Domain) -> DataFrame:
    return st.invalid_studies(st.clean_studies(_studies_as_text(d))).select(
        F.lit("incomplete").alias("issue_type"),
        F.coalesce("study_id", "file_path", F.lit("unknown")).alias("details"),
        F.array_join("problems", ",").alias("problems"),
    )


@register("studies_valid", tables="studies", sql=f"""
with {_STUDIES_TEXT}
select study_id, patient_id, file_path, split, "label", captured_at from flagged where problems = ''""")
def studies_valid(d: Domain) -> DataFrame:
    return st.valid_studies(st.clean_studies(_studies_as_text(d))).select(
        "study_id", "patient_id", "file_path", "split", "label", "captured_at"
    )


@register("patients_derived", tables="studies", sql="""
select patient_id, 'Paciente ' || right(replace(patient_id, 'PAT-', ''), 6) display_name,
       case h % 3 when 0 then 'M' when 1 then 'F' else 'X' end sex,
       case h % 5 when 0 then '18-30' when 1 then '31-45' when 2 then '46-60' when 3 then '61-75'
            else '76+' end age_range, 'S1' site_code
from (select distinct patient_id, ('0x' || substr(md5(patient_id), 1, 8))::bigint h from studies)""")
def patients_derived(d: Domain) -> DataFrame:
    return st.derive_patients(d.studies().select("patient_id"), "S1")


def _events_as_text(d: Domain) -> DataFrame:
    return d.run_events().select(
        F.col("event_id").cast("string").alias("event_id"), "run_id", "stage", "status",
        F.when(F.col("records") % 7 != 0, F.col("records").cast("string")).otherwise(F.lit(" "))
        .alias("records"),
        F.concat("message", F.repeat(F.lit("x"), F.col("records") * 10)).alias("message"),
        F.when(F.col("stage") == "signup", F.lit("soon")).otherwise(
            F.date_format("logged_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        ).alias("logged_at"),
    )


@register("events_clean", tables="run_events", sql="""
select cast(event_id as varchar) event_id, run_id, stage, status,
       cast(case when records % 7 = 0 then 0 else records end as int) records,
       message || repeat('x', records * 10) message,
       case when stage = 'signup' then timestamp '2026-04-01 09:00:00' else logged_at end logged_at
from run_events""")
def events_clean(d: Domain) -> DataFrame:
    return st.clean_events(_events_as_text(d), RUN_TIME)


@register("scan_csv_events", tables="run_events", sql="""
select stage, count(*)::bigint n, sum(case when records % 7 = 0 then 0 else records end)::bigint records
from run_events group by stage""")
def scan_csv_events(d: Domain) -> DataFrame:
    """Run events written as CSV, scanned back and cleaned."""
    path = scratch_path(d.spark, "events-csv")
    sinks.export_csv(_events_as_text(d), path)
    cleaned = st.clean_events(files.read_csv_text(d.spark, path, RUN_EVENTS_CSV), RUN_TIME)
    return cleaned.groupBy("stage").agg(
        F.count(F.lit(1)).alias("n"), F.sum("records").cast("bigint").alias("records")
    )


@register("patient_validate", tables="patients sites uploads", sql="""
select patient_id, concat_ws(',',
    case when trim(display_name) = '' or length(trim(display_name)) > 80 then 'display_name' end,
    case when length(trim(patient_id)) > 16
           or not regexp_matches(trim(patient_id), '^PAT-[A-Za-z0-9]{6,12}$') then 'patient_id' end,
    case when upper(trim(sex)) not in ('M', 'F', 'X') then 'sex' end,
    case when trim(age_range) = '' or length(trim(age_range)) > 10 then 'age_range' end,
    case when trim(c.site_code) = '' or length(trim(c.site_code)) > 16 or s.site_code is null
         then 'site_code' end) problems
from (select patient_id, display_name, lower(sex) sex, age_range, site_code from patients
      union all
      select replace(patient_id, 'PAT-', 'P-'), repeat(path, 1 + page_id % 8), 'Z', path, 'S0' from uploads) c
left join (select site_code from sites where active) s on s.site_code = c.site_code""")
def patient_validate(d: Domain) -> DataFrame:
    """Patient records as sent by forms, with the names of the rules they break."""
    sent = d.patients().withColumn("sex", F.lower("sex")).unionByName(
        d.uploads().select(
            F.replace("patient_id", F.lit("PAT-"), F.lit("P-")).alias("patient_id"),
            F.repeat("path", (F.col("page_id") % 8 + 1).cast("int")).alias("display_name"),
            F.lit("Z").alias("sex"), F.col("path").alias("age_range"), F.lit("S0").alias("site_code"),
        )
    )
    active = d.sites().where("active").select("site_code", F.lit(True).alias("_active"))
    checked = sent.join(active, "site_code", "left")
    problems = clean.patient_problems(F.col("_active").isNotNull())
    return checked.select("patient_id", F.array_join(problems, ",").alias("problems"))


@register("age_from_range", tables="patients clinical_records", sql="""
select who, sex, age, count(*)::bigint n from (
  select 'patient' who, sex,
         cast(case age_range when '18-30' then 24 when '31-45' then 38 when '46-60' then 53
              when '61-75' then 68 else 76 end as int) age from patients
  union all
  select 'record', case when upper(trim(sex)) in ('M', 'F', 'X') then upper(trim(sex)) else 'X' end,
         cast(greatest(0, least(120, age)) as int) from clinical_records) group by all""")
def age_from_range(d: Domain) -> DataFrame:
    patients = d.patients().select(
        F.lit("patient").alias("who"), clean.normal_sex(F.col("sex")).alias("sex"),
        clean.age_from_range(F.col("age_range"), F.lit(None).cast("int")).alias("age"),
    )
    records = d.clinical_records().select(
        F.lit("record").alias("who"), clean.normal_sex(F.col("sex")).alias("sex"),
        clean.age_from_range(F.lit(None).cast("string"), F.col("age")).alias("age"),
    )
    return patients.unionByName(records).groupBy("who", "sex", "age").agg(
        F.count(F.lit(1)).alias("n")
    )


@register("symptom_filter", tables="clinical_predictions clinical_records", sql="""
select source, usable, count(*)::bigint n from (
  select 'record' source, length(trim(symptoms)) >= 3 usable from clinical_records
  union all select 'report', length(trim(symptoms)) >= 3 from clinical_predictions) group by all""")
def symptom_filter(d: Domain) -> DataFrame:
    rows = d.clinical_records(diagnosed=False).select(F.lit("record").alias("source"), "symptoms").unionByName(
        d.clinical_predictions().select(F.lit("report").alias("source"), "symptoms")
    )
    return rows.groupBy(
        "source", clean.usable_symptoms(F.col("symptoms")).alias("usable")
    ).agg(F.count(F.lit(1)).alias("n"))


@register("clinical_training_set", tables="clinical_records", sql="""
select record_id, symptoms, age, substr(upper(sex), 1, 1) sex, diagnosis
from clinical_records where symptoms is not null and diagnosis is not null""")
def clinical_training_set(d: Domain) -> DataFrame:
    from wardspark.operators.symptoms import training_set

    return training_set(d.clinical_records())


@register("parquet_sinks", tables="classified", sql="""
select split, coalesce(reject_reason, 'kept') outcome, count(*)::bigint files,
       sum(file_size)::bigint total_bytes
from classified group by all""")
def parquet_sinks(d: Domain) -> DataFrame:
    """Accepted and rejected files written as partitioned tables and read back."""
    path = scratch_path(d.spark, "classified")
    sinks.write_table(_classified(d), path, ("split",))
    return d.spark.read.parquet(path).groupBy(
        "split", F.coalesce("reject_reason", F.lit("kept")).alias("outcome")
    ).agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("total_bytes"))


@register("object_store", tables="classified", sql="""
select 'raw/' || content_hash || '.jpg' object_key, any_value(file_size)::bigint size_bytes
from classified where reject_reason is null group by content_hash""")
def object_store(d: Domain) -> DataFrame:
    """Contents stored under their hash; storing the same files again adds nothing."""
    path = scratch_path(d.spark, "objects")
    # The first file of each content is found among narrow rows; contents are only read for those.
    first = stage(
        validate.inspect_files(d.manifest()).where(validate.usable()).groupBy("content_hash")
        .agg(F.min("file_path").alias("file_path")).select(
            "file_path", ids.raw_object_key(F.col("content_hash")).alias("object_key")),
        "first-files",
    )
    contents = d.manifest().select("file_path", "content")
    for _ in range(2):
        sinks.store_objects(first, path, contents, "file_path")
    return d.spark.read.parquet(path).select(
        "object_key", F.octet_length("content").cast("bigint").alias("size_bytes")
    )


OBJECTS_FIRST = 50  # cap of a store run


@register("object_store_first", tables="classified", sql=f"""
select 'raw/' || content_hash || '.jpg' object_key, file_size::bigint size_bytes
from classified where reject_reason is null order by file_path limit {OBJECTS_FIRST}""")
def object_store_first(d: Domain) -> DataFrame:
    """A store run with a cap: the contents of the first accepted files by path."""
    path = scratch_path(d.spark, "objects")
    keyed = validate.accepted(_classified(d)).select("file_path", "object_key")
    sinks.store_objects(first_accepted(keyed, OBJECTS_FIRST), path, d.manifest().select("file_path", "content"), "file_path")
    return d.spark.read.parquet(path).select("object_key", F.octet_length("content").cast("bigint").alias("size_bytes"))
