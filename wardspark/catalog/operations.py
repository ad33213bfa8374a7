"""Queries over runs, issues, alerts, logs and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardspark.catalog.domain import Domain
from wardspark.catalog.registry import ORACLES, register
from wardspark.functions import ids
from wardspark.functions.logs import is_blank
from wardspark.functions.paths import key_value_part
from wardspark.operators import arrivals as arr, logs as log_ops, lookup, quality, summary
from wardspark.schemas import DIAGNOSES, SEXES
from wardspark.session import scratch_path, stage
from wardspark.sources import files, sinks

_RUNS = """
runs as (
  select run_id, arg_max(stage, o) stage, arg_max(status, o) status, sum(records)::bigint records_in,
         coalesce(sum(records) filter (where status = 'ok'), 0)::bigint records_out,
         coalesce(sum(records) filter (where status = 'failed'), 0)::bigint records_failed,
         arg_max(message, o) filter (where status = 'failed') last_error,
         min(logged_at) started_at, max(logged_at) filter (where status in ('ok', 'failed')) last_end
  from (select *, {'t': logged_at, 'e': event_id} o from run_events) group by run_id),
headers as (
  select run_id, stage, status, records_in, records_out, records_failed,
         case when status = 'failed' then last_error end error_message, started_at,
         case when status in ('ok', 'failed') then last_end end finished_at from runs)
"""


def _runs(d: Domain) -> DataFrame:
    headers = summary.run_headers(d.run_events())
    failed = F.when(F.col("status") == "failed", F.col("error_message"))
    return headers.withColumn("error_message", failed)


@register("run_status", tables="run_events", sql=f"with {_RUNS} select * from headers")
def run_status(d: Domain) -> DataFrame:
    return _runs(d)


@register("run_ids", sql="""
select event_id, 'RUN-' || strftime(ts, '%Y%m%d-%H%M%S') || '-' || upper(event_type) run_id from events""")
def run_ids(d: Domain) -> DataFrame:
    """Names of runs that start with the events."""
    return d.raw("events").select("event_id", ids.run_id(F.col("ts"), F.upper("event_type")).alias("run_id"))


@register("run_status_counts", tables="run_events", sql=f"""
with {_RUNS}
select count(*) filter (where status = 'ok')::bigint ok,
       count(*) filter (where status = 'running')::bigint running,
       count(*) filter (where status = 'failed')::bigint failed from headers""")
def run_status_counts(d: Domain) -> DataFrame:
    return summary.status_counts(_runs(d))


@register("failed_run_alerts", tables="run_events", sql=f"""
with {_RUNS}
select run_id, 'critical' severity, 'Run failed: ' || run_id title,
       coalesce(nullif(error_message, ''), 'no details given') message
from headers where status = 'failed'""")
def failed_run_alerts(d: Domain) -> DataFrame:
    return quality.failed_run_alerts(_runs(d))


ISSUES_SHOWN = 200  # issues per kind in the sampling report
_QUALITY_SAMPLE = f"""
select issue_type, issue_id, details from (
  select *, row_number() over (partition by issue_type order by detected_at, issue_id) r
  from quality_issues) where r <= {ISSUES_SHOWN}"""


@register("quality_issue_sample", tables="quality_issues", sql=_QUALITY_SAMPLE)
def quality_issue_sample(d: Domain) -> DataFrame:
    """The oldest ISSUES_SHOWN issues of every kind: a sampling report; ``quality_issues`` is complete."""
    order = [F.col("detected_at"), F.col("issue_id")]
    return lookup.top_per_key(d.quality_issues(), ["issue_type"], order, ISSUES_SHOWN).select(
        "issue_type", "issue_id", "details"
    )


@register("issues_last_7d", tables="quality_issues", sql="""
select issue_type, count(*)::bigint n from quality_issues
where detected_at > timestamp '2024-01-31 00:00:00' - interval 7 day group by 1""")
def issues_last_7d(d: Domain) -> DataFrame:
    from wardspark.catalog.ingest import AS_OF

    return quality.recent_issues(d.quality_issues(), AS_OF).groupBy("issue_type").agg(
        F.count(F.lit(1)).alias("n")
    )


@register("audit_patients", tables="patients", sql="""
select patient_id, site_code from patients
where trim(display_name) = '' or age_range is null or age_range = ''""")
def audit_patients(d: Domain) -> DataFrame:
    return d.patients().where(quality.incomplete_patient()).select("patient_id", "site_code")


@register("audit_missing_objects", tables="studies", sql="""
select study_id, patient_id from studies where source_dataset = 'api_upload' and object_key is null""")
def audit_missing_objects(d: Domain) -> DataFrame:
    return d.studies().where(quality.missing_object()).select("study_id", "patient_id")


@register("audit_unpredicted", tables="studies predictions", sql="""
select study_id, split from studies s where object_key is not null
and not exists (select 1 from predictions p where p.study_id = s.study_id)""")
def audit_unpredicted(d: Domain) -> DataFrame:
    return quality.unpredicted_studies(d.studies(), d.predictions()).select("study_id", "split")


@register("audit_alert", tables="patients studies predictions", sql="""
with n as (
  select (select count(*) from patients where trim(display_name) = '' or age_range is null or age_range = '') a,
         (select count(*) from studies where source_dataset = 'api_upload' and object_key is null) b,
         (select count(*) from studies s where object_key is not null
            and not exists (select 1 from predictions p where p.study_id = s.study_id)) c)
select 'warning' severity, 'Incomplete records found' title,
       concat_ws('; ', case when a > 0 then a || ' patients lack personal data' end,
                 case when b > 0 then b || ' uploaded studies lack their object' end,
                 case when c > 0 then c || ' stored studies lack a prediction' end) message
from n where a + b + c > 0""")
def audit_alert(d: Domain) -> DataFrame:
    return quality.audit_alert(quality.audit_counts(d.patients(), d.studies(), d.predictions()))


ALERTS_SHOWN = 50  # alerts in a list


@register("alerts_recent", tables="alerts", sql=f"""
select * from alerts order by created_at desc, alert_id desc limit {ALERTS_SHOWN}""")
def alerts_recent(d: Domain) -> DataFrame:
    return d.alerts().orderBy(F.col("created_at").desc(), F.col("alert_id").desc()).limit(ALERTS_SHOWN)


@register("alerts_open", tables="alerts", sql=f"""
select * from alerts where not acknowledged order by created_at desc, alert_id desc limit {ALERTS_SHOWN}""")
def alerts_open(d: Domain) -> DataFrame:
    open_only = d.alerts().where(~F.col("acknowledged"))
    return open_only.orderBy(F.col("created_at").desc(), F.col("alert_id").desc()).limit(ALERTS_SHOWN)


@register("alerts_from_rules", tables="run_events", sql="""
select * from (
  select run_id, 'critical' severity, 'Task failed: ' || coalesce(dag, 'unknown') || '.' || stage title,
         coalesce(err, 'no details given') message
  from (select *, case when records % 2 = 0 then 'ingest' end dag,
               case when records % 3 <> 0 then message end err from run_events where status = 'failed')
  union all
  select run_id, case when stage in ('info', 'warning', 'critical') then stage else 'warning' end,
         repeat(message, 20), repeat(message, records + 1)
  from run_events where status <> 'failed')""")
def alerts_from_rules(d: Domain) -> DataFrame:
    """Alerts of failed tasks, and alerts as sent by others brought to their stored form."""
    events = d.run_events()
    failures = events.where("status = 'failed'").select(
        F.when(F.col("records") % 2 == 0, F.lit("ingest")).alias("dag_id"),
        F.col("stage").alias("task_id"), "run_id",
        F.when(F.col("records") % 3 != 0, F.col("message")).alias("exception"),
    )
    sent = events.where("status <> 'failed'").select(
        "run_id", F.col("stage").alias("severity"),
        F.repeat("message", F.lit(20)).alias("title"),
        F.repeat("message", F.col("records") + 1).alias("message"),
    )
    return quality.task_failure_alerts(failures).unionByName(quality.normalise_alerts(sent))


@register("constraint_violations", tables="predictions run_events clinical_records", sql=f"""
with {_RUNS}
select 'predictions' table_name, 'prob_sana_range' rule,
       count(*) filter (where not prob_sana between 0 and 1)::bigint violations from predictions
union all select 'predictions', 'prob_neumonia_range',
       count(*) filter (where not prob_neumonia between 0 and 1) from predictions
union all select 'predictions', 'prob_covid_range',
       count(*) filter (where not prob_covid between 0 and 1) from predictions
union all select 'predictions', 'probs_sum',
       count(*) filter (where not abs(prob_sana + prob_neumonia + prob_covid - 1) < 0.0001) from predictions
union all select 'runs', 'records_in', count(*) filter (where not records_in >= 0) from headers
union all select 'runs', 'records_out', count(*) filter (where not records_out >= 0) from headers
union all select 'runs', 'records_failed', count(*) filter (where not records_failed >= 0) from headers
union all select 'runs', 'finished_after_start',
       count(*) filter (where not (finished_at is null or finished_at >= started_at)) from headers
union all select 'runs', 'status_known',
       count(*) filter (where not status in ('pending', 'running', 'ok', 'failed')) from headers
union all select 'clinical_records', 'age', count(*) filter (where not age between 0 and 120) from clinical_records
union all select 'clinical_records', 'sex',
       count(*) filter (where not sex in ('M', 'F', 'X')) from clinical_records
union all select 'clinical_records', 'diagnosis',
       count(*) filter (where not diagnosis in ('sana', 'neumonia', 'covid', 'gripe', 'asma', 'bronquitis',
                                                'epoc', 'rinitis_alergica')) from clinical_records""")
def constraint_violations(d: Domain) -> DataFrame:
    frames = [quality.violations(df, table, rules) for table, df, rules in _ruled(d)]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def _ruled(d: Domain) -> list[tuple[str, DataFrame, dict[str, Column]]]:
    """Tables with the conditions their rows must meet."""
    record_rules = {
        "age": F.col("age").between(0, 120),
        "sex": F.col("sex").isin(*SEXES),
        "diagnosis": F.col("diagnosis").isin(*DIAGNOSES),
    }
    return [
        ("predictions", d.predictions(), quality.prediction_rules()),
        ("runs", _runs(d), summary.run_rules()),
        ("clinical_records", d.clinical_records(), record_rules),
    ]


@register("constraints_on_write", sql=ORACLES["constraint_violations"])
def constraints_on_write(d: Domain) -> DataFrame:
    """The same counts from the jobs that store the tables, without a scan of their own."""
    frames = []
    for table, df, rules in _ruled(d):
        watched, seen = quality.watched(df, rules)
        sinks.write_table(watched, scratch_path(d.spark, table))
        frames.append(quality.seen_violations(d.spark, table, seen))
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@register("unique_violations", tables="studies patients", sql="""
select key_name, keys::bigint keys, total_rows::bigint total_rows from (
select 'studies.file_path' key_name, count(*) keys, coalesce(sum(n), 0) total_rows
from (select file_path, count(*) n from studies group by 1 having count(*) > 1)
union all
select 'lineitem.order_line', count(*), coalesce(sum(n), 0)
from (select l_orderkey, l_linenumber, count(*) n from lineitem group by all having count(*) > 1)
union all
select 'patients.patient_id', count(*), coalesce(sum(n), 0)
from (select patient_id, count(*) n from patients group by 1 having count(*) > 1))""")
def unique_violations(d: Domain) -> DataFrame:
    lines = d.raw("lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_line"))
    parts = [
        ("studies.file_path", d.studies(), "file_path"),
        ("lineitem.order_line", lines, "order_line"),
        ("patients.patient_id", d.patients(), "patient_id"),
    ]
    out = None
    for name, df, key in parts:
        row = quality.duplicate_keys(df, key).agg(
            F.count(F.lit(1)).alias("keys"),
            F.coalesce(F.sum("occurrences"), F.lit(0)).cast("bigint").alias("total_rows"),
        ).select(F.lit(name).alias("key_name"), "keys", "total_rows")
        out = row if out is None else out.unionByName(row)
    return out


@register("fk_orphans", tables="patients sites studies predictions run_events quality_issues uploads", sql="""
select fk, orphan_rows::bigint orphan_rows, orphan_keys::bigint orphan_keys from (
select 'patients.site_code' fk, coalesce(sum(n), 0) orphan_rows, count(*) orphan_keys
from (select site_code k, count(*) n from patients where site_code not in (select site_code from sites) group by 1)
union all select 'studies.patient_id', coalesce(sum(n), 0), count(*)
from (select patient_id k, count(*) n from studies where patient_id not in (select patient_id from patients) group by 1)
union all select 'predictions.study_id', coalesce(sum(n), 0), count(*)
from (select study_id k, count(*) n from predictions where study_id not in (select study_id from studies) group by 1)
union all select 'issues.study_id', coalesce(sum(n), 0), count(*)
from (select study_id k, count(*) n from quality_issues where study_id not in
        (select study_id from studies) group by 1)
union all select 'issues.run_id', coalesce(sum(n), 0), count(*)
from (select run_id k, count(*) n from quality_issues where run_id not in
        (select run_id from run_events) group by 1))""")
def fk_orphans(d: Domain) -> DataFrame:
    role = quality.Role
    return quality.orphan_counts([
        (d.patients(), [role("patients.site_code", "site_code"), role("studies.patient_id", "patient_id", True)]),
        (d.sites(), [role("patients.site_code", "site_code", True)]),
        (d.studies(), [role("studies.patient_id", "patient_id"), role("predictions.study_id", "study_id", True),
                       role("issues.study_id", "study_id", True)]),
        (d.predictions(), [role("predictions.study_id", "study_id")]),
        (d.quality_issues(), [role("issues.study_id", "study_id"), role("issues.run_id", "run_id")]),
        (d.run_events(), [role("issues.run_id", "run_id", True)]),
    ])


@register("integration_check", tables="classified run_events quality_issues", sql="""
select 'report' name, count(*) filter (where reject_reason is null)::bigint n,
       count(*) filter (where reject_reason is null) > 0 ok from classified
union all select 'runs_ok', count(*), count(*) > 0 from run_events where status = 'ok'
union all select 'events', count(*), true from run_events
union all select 'issues', count(*), true from quality_issues
union all select 'objects', count(distinct content_hash), count(distinct content_hash) > 0
from classified where reject_reason is null""")
def integration_check(d: Domain) -> DataFrame:
    """State of the platform after an ingest: counts, and whether each is acceptable."""
    return _checks(d)


def _checks(d: Domain) -> DataFrame:
    from wardspark.operators import validate

    inspected = stage(validate.inspect_files(d.manifest()), "inspected")
    report = validate.ingest_report(inspected).select(F.col("valid_unique").alias("n"))
    objects = validate.first_copies(inspected).agg(F.count(F.lit(1)).alias("n"))
    events = d.run_events()
    counted = [
        ("report", report, True),
        ("runs_ok", events.where("status = 'ok'").agg(F.count(F.lit(1)).alias("n")), True),
        ("events", events.agg(F.count(F.lit(1)).alias("n")), False),
        ("issues", d.quality_issues().agg(F.count(F.lit(1)).alias("n")), False),
        ("objects", objects, True),
    ]
    out = None
    for name, df, required in counted:
        row = df.select(
            F.lit(name).alias("name"), "n",
            ((F.col("n") > 0) | F.lit(not required)).alias("ok"),
        )
        out = row if out is None else out.unionByName(row)
    return out


@register("health_rollup", tables="alerts", sql="""
select case when bool_and(ok) then 'ok' else 'degraded' end status,
       count(*) filter (where not ok)::bigint failing, count(*)::bigint checks
from (select run_id, count(*) filter (where severity = 'critical' and not acknowledged) = 0 ok
      from alerts group by 1)""")
def health_rollup(d: Domain) -> DataFrame:
    """A run is healthy without open critical alerts; the platform when all runs are."""
    return quality.health(run_checks(d))


def run_checks(d: Domain) -> DataFrame:
    open_critical = (F.col("severity") == "critical") & ~F.col("acknowledged")
    return d.alerts().groupBy(F.col("run_id").alias("name")).agg(
        (F.count_if(open_critical) == 0).alias("ok")
    )


@register("log_path_meta", tables="parsed_logs", sql="""
select run_id, task_id, 'ingest' dag_id, count(*)::bigint n
from (select 'RUN-' || user_id run_id, event_type task_id from events) group by all""")
def log_path_meta(d: Domain) -> DataFrame:
    path = F.col("path")
    return d.log_lines().groupBy(
        key_value_part(path, "run_id").alias("run_id"),
        key_value_part(path, "task_id").alias("task_id"),
        key_value_part(path, "dag_id").alias("dag_id"),
    ).agg(F.count(F.lit(1)).alias("n"))


@register("log_parse", tables="parsed_logs", sql="""
select event_id, format, event_time, level, logger, message, run_id, task_id from parsed_logs""")
def log_parse(d: Domain) -> DataFrame:
    return log_ops.parse_logs(d.log_lines()).select(
        "event_id", "format", "event_time", "level", "logger", "message", "run_id", "task_id"
    )


@register("log_query", tables="parsed_logs", sql="""
select event_id, event_time, level, logger, message from parsed_logs
where level = 'ERROR' order by event_time desc nulls last, event_id limit 500""")
def log_query(d: Domain) -> DataFrame:
    """Newest errors, as many as one answer may hold."""
    parsed = log_ops.parse_logs(d.log_lines())
    return log_ops.query_logs(parsed, service="log_sync", level="error", limit=log_ops.MOST_LOGS).select(
        "event_id", "event_time", "level", "logger", "message"
    )


@register("log_query_stored", tables="parsed_logs", sql="""
select event_id, event_time, level, logger, message from parsed_logs
where level = 'ERROR' order by event_time desc nulls last, event_id limit 500""")
def log_query_stored(d: Domain) -> DataFrame:
    """The same from a stored log sorted by time, of which only the newest hours are read."""
    folder = scratch_path(d.spark, "stored-logs")
    log_ops.store_logs(log_ops.parse_logs(d.log_lines()), folder)
    found = log_ops.query_stored(d.spark, folder, service="log_sync", level="error", limit=log_ops.MOST_LOGS)
    return found.select("event_id", "event_time", "level", "logger", "message")


@register("log_scan", tables="parsed_logs", sql="""
select format, level, count(*)::bigint n from parsed_logs group by all""")
def log_scan(d: Domain) -> DataFrame:
    """Log lines written as text files, scanned back and parsed."""
    folder = scratch_path(d.spark, "logs")
    d.log_lines().select(F.col("line").alias("value")).write.text(folder)
    lines = files.read_log_lines(d.spark, folder, "*.txt")
    return log_ops.parse_logs(lines).groupBy("format", "level").agg(F.count(F.lit(1)).alias("n"))


@register("log_append", tables="parsed_logs", sql="""
select level, cast(event_time as date) "day", count(*)::bigint n
from parsed_logs where event_time is not null group by all""")
def log_append(d: Domain) -> DataFrame:
    """Log documents appended to the day-partitioned store and counted from it."""
    folder = scratch_path(d.spark, "log-store")
    stamped = log_ops.parse_logs(d.log_lines()).withColumn(
        "ingested_at", F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    )
    sinks.append_log(stamped, folder)
    stored = d.spark.read.parquet(folder).where("event_time is not null")
    return stored.groupBy("level", F.to_date("event_time").alias("day")).agg(
        F.count(F.lit(1)).alias("n")
    )


_ROUTED = """
routed as (
  select *, case when not regexp_matches(lower(path), '\\.jpe?g$') then 'ignore'
                 when path like 'train/NORMAL/%' or path like 'test/COVID19/%' then 'keep'
                 when path not like '%/%' then 'default' else 'reject' end decision
  from arrivals),
moved as (
  select *, case when r = 1 then folder || '/' || name
                 else folder || '/' || regexp_replace(name, '\\.[^.]*$', '') || '_' || event_id
                      || regexp_extract(name, '(\\.[^.]*)$', 1) end destination
  from (select *, row_number() over (partition by folder, name order by ts, event_id) r
        from (select *, case when decision = 'default' then 'train/NORMAL'
                             else split_part(path, '/', 1) || '/' || split_part(path, '/', 2) end folder,
                     list_last(string_split(path, '/')) "name"
              from routed where decision in ('keep', 'default'))))
"""


@register("route_paths", tables="arrivals", sql=f"""
with {_ROUTED}
select r.event_id, r.decision, m.destination from routed r left join moved m using (event_id)""")
def route_paths(d: Domain) -> DataFrame:
    routed = arr.route_arrivals(d.arrivals())
    moved = arr.destinations(routed).select("event_id", "decision", "destination")
    others = routed.where(~F.coalesce(F.col("decision").isin("keep", "default"), F.lit(False)))
    return moved.unionByName(
        others.select("event_id", "decision", F.lit(None).cast("string").alias("destination"))
    )


@register("route_alerts", tables="arrivals", sql=f"""
with {_ROUTED}
select 'warning' severity, 'Arrival outside the known folders' title, path message
from routed where decision = 'reject'""")
def route_alert_rows(d: Domain) -> DataFrame:
    return arr.route_alerts(arr.route_arrivals(d.arrivals()))


@register("watcher_events", tables="arrivals", sql=f"""
with {_ROUTED}
select ts, 'image_moved' event, 'raw/scans/' || destination path,
       split_part(folder, '/', 1) split, split_part(folder, '/', 2) folder from moved""")
def watcher_events(d: Domain) -> DataFrame:
    """Events of moved files, appended as JSON lines and read back with their schema."""
    moved = arr.destinations(arr.route_arrivals(d.arrivals()))
    path = scratch_path(d.spark, "watcher-events")
    sinks.append_events(arr.watcher_events(moved), path)
    read = files.read_watcher_events(d.spark, path)
    return read.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


_SESSIONS = r"""
bursts as (
  select path, min(ts) first_event, max(ts) last_event, max(ts) + interval 6 hour ready_at, count(*)::bigint events
  from (select *, sum(new) over (partition by path order by ts, event_id) s
        from (select *, case when ts >= lag(ts) over (partition by path order by ts, event_id) + interval 6 hour
                             then 1 else 0 end new
              from arrivals where regexp_matches(lower(path), '\.jpe?g$')))
  group by path, s)
"""


@register("debounce_paths", tables="arrivals", sql=f"with {_SESSIONS} select * from bursts")
def debounce_paths(d: Domain) -> DataFrame:
    """Bursts of events per path at a gap of six hours."""
    from wardspark.functions.paths import is_jpeg_name

    named = d.arrivals().where(is_jpeg_name(F.col("path"))).withColumn("ts", F.col("ts").cast("timestamp"))
    out = arr.debounce(named, "6 hours")
    times = ("first_event", "last_event", "ready_at")
    return out.select(
        *[F.col(c).cast("timestamp_ntz").alias(c) if c in times else F.col(c) for c in out.columns]
    )
