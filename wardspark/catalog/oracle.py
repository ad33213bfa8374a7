"""DuckDB text of the domain tables, and a helper that puts the needed ones before a query."""

from __future__ import annotations

HEX = "('0x' || substr(md5({0}), 1, 8))::BIGINT"
PID = "'PAT-' || lpad(cast({0} as varchar), 12, '0')"
PH = HEX.format(PID.format("c_custkey"))
DOC_PATH = "'data/raw/scans/' || split || '/' || folder || '/' || doc_id || '.jpg'"

# Row hash of order lines: two polynomial hashes of the row's integers, 31 bits each.
_LINE_NUMBERS = (
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cast(round(l_quantity) as bigint)",
    "cast(round(l_extendedprice * 100) as bigint)", "cast(round(l_discount * 100) as bigint)",
    "cast(round(l_tax * 100) as bigint)", "{day}",
)


def line_hash(day: str) -> str:
    """SQL of the row hash, the same text in both engines but for the day number."""
    halves = []
    for step in (1000003, 998244):
        code = "cast(7 as bigint)"
        for number in _LINE_NUMBERS:
            code = f"(({code} * {step} + {number.format(day=day)}) % 2147483647)"
        halves.append(code)
    return f"{halves[0]} * 2147483648 + {halves[1]}"


# name -> (tables it needs, SQL)
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "sites": ((), """
        select 'S' || n_nationkey site_code, n_name site_name, n_nationkey % 5 <> 0 active
        from nation"""),
    "patients": ((), f"""
        select {PID.format('c_custkey')} patient_id,
               case when c_acctbal < -900 then ''
                    when c_acctbal < -500 then 'Paciente ' || right({PID.format('c_custkey')}, 6)
                    else c_name end display_name,
               case {PH} % 3 when 0 then 'M' when 1 then 'F' else 'X' end sex,
               case {PH} % 5 when 0 then '18-30' when 1 then '31-45' when 2 then '46-60'
                    when 3 then '61-75' else '76+' end age_range,
               'S' || c_nationkey site_code
        from customer"""),
    "studies": ((), f"""
        select 'STU-' || o_orderkey study_id, {PID.format('o_custkey')} patient_id,
               'data/raw/scans/' || o_orderkey || '.jpg' file_path,
               case when o_orderkey % 11 = 0 then null
                    else 'raw/' || md5(cast(o_orderkey as varchar)) || '.jpg' end object_key,
               case o_orderkey % 7 when 0 then 'clinical' when 1 then 'test' when 2 then 'val'
                    else 'train' end split,
               case when o_orderkey % 7 = 0 then null when o_orderstatus = 'O' then 'sana'
                    when o_orderstatus = 'F' then 'neumonia' else 'covid' end "label",
               case when o_orderkey % 7 = 0 then 'api_upload' else 'xray_archive' end source_dataset,
               'CR' modality, 'chest' body_part, o_orderdate captured_at,
               o_orderdate + to_hours(cast(o_orderkey % 48 as int)) ingested_at
        from orders"""),
    "predictions": ((), f"""
        select {line_hash("date_diff('day', date '1970-01-01', cast(l_shipdate as date))")} prediction_id,
               'STU-' || l_orderkey study_id,
               case when ps >= pn and ps >= pc then 'sana' when pn >= pc then 'neumonia'
                    else 'covid' end predicted_label,
               cast(cast(ps as decimal(11,0)) * cast(0.00001 as decimal(6,5)) as decimal(6,5)) prob_sana,
               cast(cast(pn as decimal(11,0)) * cast(0.00001 as decimal(6,5)) as decimal(6,5)) prob_neumonia,
               cast(cast(pc as decimal(11,0)) * cast(0.00001 as decimal(6,5)) as decimal(6,5)) prob_covid,
               case l_returnflag when 'A' then 'resnet50' when 'N' then 'densenet121'
                    else 'baseline_cnn' end model_name,
               'v1' model_version, l_shipdate inferred_at
        from (select *, 100000 - ps - pn pc
              from (select *, wa * 100000 // (wa + wb + wg) ps, wb * 100000 // (wa + wb + wg) pn
                    from (select *, cast(l_quantity as bigint) wa, l_partkey % 40 + 1 wb,
                                 l_suppkey % 30 + 1 wg from lineitem)))"""),
    "run_events": ((), """
        select event_id, 'RUN-' || user_id run_id, event_type stage,
               case event_type when 'purchase' then 'ok' when 'error' then 'failed'
                    when 'signup' then 'pending' else 'running' end status,
               cast(floor("value") as int) records, props message, ts logged_at
        from events"""),
    "quality_issues": ((), """
        select event_id issue_id, 'RUN-' || user_id run_id, 'STU-' || event_id study_id,
               case when "value" < 10 then 'incomplete' when "value" < 40 then 'duplicate'
                    when "value" < 100 then 'corrupt' when "value" < 200 then 'invalid_label'
                    else 'other' end issue_type, props details, ts detected_at
        from events where event_type = 'error'"""),
    "alerts": ((), """
        select event_id alert_id, 'RUN-' || user_id run_id,
               case when "value" < 20 then 'info' when "value" < 60 then 'warning'
                    else 'critical' end severity,
               'Run ' || user_id title, props message, event_id % 3 = 0 acknowledged, ts created_at
        from events where event_type = 'error'"""),
    "manifest": ((), f"""
        select doc_id, {DOC_PATH} file_path, doc_id || '.jpg' filename, split, folder,
               case when lang = 'en' then 'sana' when lang = 'es' then 'unknown' else '' end "label",
               (case source when 'src4' then unhex('89504E470D0A1A0A') when 'src5' then unhex('')
                     else unhex('FFD8FF') end) || encode(text) content
        from (select *, case when source in ('src0', 'src1', 'src2') then 'test'
                             when source = 'src3' then 'holdout' else 'train' end split,
                     case lang when 'en' then 'NORMAL' when 'fr' then 'PNEUMONIA'
                          when 'de' then 'COVID19' else 'OTHER' end folder
              from documents)"""),
    # One row per file with the checks applied, as every ingest query needs them.
    "inspected": (("manifest",), """
        select doc_id, file_path, filename, split, folder, lbl "label", octet_length(content) file_size,
               okj is_valid_jpg,
               split in ('train', 'test') and coalesce(lbl in ('sana', 'neumonia', 'covid'), false) path_ok,
               case when okj then md5(content) end content_hash
        from (select *, octet_length(content) >= 500 and hex(content[1:3]) = 'FFD8FF' okj,
                     coalesce(nullif("label", ''), case folder when 'NORMAL' then 'sana'
                        when 'PNEUMONIA' then 'neumonia' when 'COVID19' then 'covid' end) lbl
              from manifest)"""),
    "classified": (("inspected",), """
        select i.*, case when not is_valid_jpg then 'corrupt' when not path_ok then 'incomplete'
                         when rnk > 1 then 'duplicate' end reject_reason
        from (select *, case when is_valid_jpg and path_ok then row_number() over (
                     partition by content_hash, is_valid_jpg and path_ok order by file_path, doc_id) end rnk
              from inspected) i"""),
    "uploads": ((), f"""
        select page_id, case when h % 17 = 0 then '..'
                             else 'C:\\scans/' || 'img' || page_id || ext end path,
               (case when h % 5 = 0 then unhex('') when ext = '.png' then unhex('89504E470D0A1A0A')
                     else unhex('FFD8FF') end) || encode(html) content,
               cast(h % 300 as int) made_up_width, cast(h % 200 as int) + 30 made_up_height,
               {PID.format('page_id')} patient_id
        from (select *, case when url like '%.html' then '.JPEG' when url like '%#top' then '.png'
                             when url like '%/' then '.gif' when url like '%=%' then '.jpg'
                             else '' end ext, {HEX.format('url')} h from pages)"""),
    "clinical_records": ((), f"""
        select 'CR-' || substr(md5(k), 1, 12) record_id, 'CREF-' || substr(md5(k), 13, 10) patient_ref,
               cast({HEX.format('k')} % 121 as int) age,
               case {HEX.format('k')} % 4 when 0 then 'm' when 1 then ' F ' when 2 then 'X'
                    else 'unknown' end sex,
               text symptoms,
               case when quality is null then null when quality = 1 and toxic = 0 then 'sana' when quality = 1 then 'gripe'
                    when toxic = 0 then 'neumonia' else 'covid' end diagnosis,
               timestamp '2025-01-01 08:00:00' + to_minutes(3 * doc_id) recorded_at
        from (select *, cast(doc_id as varchar) k from documents left join labels using (doc_id))"""),
    "clinical_predictions": ((), f"""
        select conv_id * 1000 + turn prediction_id, {PID.format('conv_id')} patient_id,
               text symptoms, d1 predicted_diagnosis,
               '{{"' || d1 || '":0.' || (h % 30 + 60) || ',"' || d2 || '":0.0' || (h % 9 + 1)
                   || ',"' || d3 || '":0.02}}' prob_json,
               d1, d2, d3, (h % 30 + 60) / 100.0 p1, (h % 9 + 1) / 100.0 p2,
               'symptoms_logreg' model_name, 'v1' model_version,
               timestamp '2026-04-01 08:00:00' + to_minutes(turn // 3) inferred_at
        from (select *, names[h % 8 + 1] d1, names[(h + 3) % 8 + 1] d2, names[(h + 6) % 8 + 1] d3
              from (select *, {HEX.format('text')} h,
                           ['sana','neumonia','covid','gripe','asma','bronquitis','epoc','rinitis_alergica'] names
                    from conversations where role = 'user'))"""),
    "arrivals": ((), """
        select event_id, ts, case event_type when 'view' then 'train/NORMAL/' || user_id || '.jpg'
                 when 'click' then user_id || '.JPG' when 'error' then 'train/OTHER/' || user_id || '.jpg'
                 when 'purchase' then 'test/COVID19/' || user_id || '.jpeg'
                 else 'test/PNEUMONIA/' || user_id || '.txt' end path
        from events"""),
    "parsed_logs": ((), """
        select event_id, 'RUN-' || user_id run_id, event_type task_id,
               case event_type when 'click' then 'bracket' when 'error' then 'bracket' when 'view' then 'task'
                    when 'signup' then 'service' else 'raw' end format,
               case event_type when 'purchase' then null when 'view' then date_trunc('second', ts) + interval 179 milliseconds
                    when 'signup' then date_trunc('second', ts) - interval 2 hour else date_trunc('second', ts) end event_time,
               case event_type when 'error' then 'ERROR' when 'signup' then 'WARNING' else 'INFO' end level,
               case event_type when 'click' then 'api' when 'error' then 'ml' when 'view' then 'task.py'
                    when 'signup' then 'watcher' else 'raw' end logger,
               case when event_type = 'purchase' then 'raw ' || props else props end message
        from events where not (event_type = 'purchase' and "value" < 5)"""),
    "evaluated": (("studies", "predictions"), """
        select s."label" actual, p.predicted_label predicted, s.split, p.model_name
        from predictions p join studies s using (study_id) where s."label" is not null"""),
}


def with_tables(names: str, body: str) -> str:
    """Put the named domain tables (and what they need) in front of a query."""
    order: list[str] = []

    def add(name: str) -> None:
        for needed in TABLES[name][0]:
            add(needed)
        if name not in order:
            order.append(name)

    for name in names.split():
        add(name)
    defs = ",\n".join(f"{n} as ({TABLES[n][1]})" for n in order)
    body = body.strip()
    if body.lower().startswith("with "):
        return f"with {defs},\n{body[5:]}"
    return f"with {defs}\n{body}"
