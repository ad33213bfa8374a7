"""Streaming queries: the given tables arrive as streams and the sinks are read back.

Each run uses fresh folders for state and output, and closes open windows with one marker row
far in the future, which is left out of the result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardspark.catalog.domain import Domain
from wardspark.catalog.operations import _ROUTED, _SESSIONS
from wardspark.catalog.registry import register
from wardspark.operators import logs as log_ops
from wardspark.session import scratch_path, stage
from wardspark.streaming import flows
from wardspark.streaming.log_tail import LogTail

_MARKER = "(end of input)"
ARRIVALS = 3  # batches in which files come
RANGES = 32  # ranges of paths looked at for each of these batches


class Streamed(Domain):
    """The domain with every table read as a stream."""

    def raw(self, name: str) -> DataFrame:
        return flows.stream_table(self.spark, self.path(name))


def _streamed(d: Domain) -> Streamed:
    return Streamed(d.spark, d.folder)


def _with_marker(d: Domain, stream: DataFrame, time: str, **values: str) -> DataFrame:
    """The stream and one row ten years after its last event, from a table written for it."""
    path = scratch_path(d.spark, "marker")
    last = d.raw("events").agg(F.max("ts").alias("t"))
    late = F.col("t").cast("timestamp") + F.expr("interval '10' year")
    last.select(
        late.alias(time), *[F.lit(v).alias(k) for k, v in values.items()]
    ).write.parquet(path)
    marker = flows.stream_table(d.spark, path)
    return stream.select(time, *values).unionByName(marker.select(time, *values))


@register("stream_debounce", tables="arrivals", sql=f"with {_SESSIONS} select * from bursts")
def stream_debounce(d: Domain) -> DataFrame:
    out, state = scratch_path(d.spark, "debounced"), scratch_path(d.spark, "state")
    seen = _streamed(d).arrivals().withColumn("ts", F.col("ts").cast("timestamp"))
    stream = _with_marker(d, seen, "ts", path=_MARKER + ".jpg")
    flows.run_to_parquet(flows.debounced(stream, "6 hours"), out, state)
    rows = d.spark.read.parquet(out).where(~F.col("path").startswith(_MARKER))
    times = ("first_event", "last_event", "ready_at")
    return rows.select(
        *[F.col(c).cast("timestamp_ntz").alias(c) if c in times else F.col(c) for c in rows.columns]
    )


@register("stream_route", tables="arrivals", sql=f"""
with {_ROUTED}
select decision, destination from moved
union all select 'reject', path from routed where decision = 'reject'""")
def stream_route(d: Domain) -> DataFrame:
    """Arrivals routed batch by batch into moved files and alerts."""
    out, state = scratch_path(d.spark, "routed"), scratch_path(d.spark, "state")
    flows.route_to_tables(_streamed(d).arrivals(), out, state)
    moved = d.spark.read.parquet(f"{out}/moved").select("decision", "destination")
    alerts = d.spark.read.parquet(f"{out}/alerts").select(
        F.lit("reject").alias("decision"), F.col("message").alias("destination")
    )
    return moved.unionByName(alerts)


@register("stream_ingest", tables="inspected", sql="""
select is_valid_jpg, path_ok, count(*)::bigint files, sum(file_size)::bigint total_bytes
from inspected group by all""")
def stream_ingest(d: Domain) -> DataFrame:
    """Files inspected as they arrive; the second pass finds nothing new and adds nothing."""
    out, state = scratch_path(d.spark, "inspected"), scratch_path(d.spark, "state")
    for _ in range(2):
        flows.inspect_to_table(_streamed(d).manifest(), out, state)
    return d.spark.read.parquet(out).groupBy("is_valid_jpg", "path_ok").agg(
        F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("total_bytes")
    )


def _path_bounds(paths: DataFrame, parts: int) -> list[str]:
    """Paths that cut the table into ``parts`` of about as many rows; only paths are moved, into many small ranges.

    The last path of every range, with its rows, is all that reaches the driver.
    """
    ranged = paths.repartitionByRange(parts * RANGES, "file_path").withColumn("_range", F.spark_partition_id())
    ends = ranged.groupBy("_range").agg(F.max("file_path").alias("last"), F.count(F.lit(1)).alias("n"))
    found = [r for r in ends.orderBy("_range").collect() if r["last"] is not None]
    total, upto, bounds = sum(r["n"] for r in found), 0, []
    for r in found:
        upto += r["n"]
        if len(bounds) < parts - 1 and upto * parts >= total * (len(bounds) + 1):
            bounds.append(r["last"])
    return bounds


@register("stream_dedup", tables="classified", sql="""
select file_path, content_hash from classified where reject_reason is null""")
def stream_dedup(d: Domain) -> DataFrame:
    """First file of every content, arriving in three batches in the order of paths.

    A second stream, with a checkpoint of its own, finds all stored.
    """
    out, source, state = (scratch_path(d.spark, name) for name in ("contents", "arriving", "state"))
    arriving = scratch_path(d.spark, "arriving-parts")
    bounds = _path_bounds(d.manifest().select("file_path"), ARRIVALS)
    part = sum((F.coalesce(F.col("file_path") > b, F.lit(False)).cast("int") for b in bounds), F.lit(0))
    placed = d.manifest().withColumn("_part", part)
    placed.write.partitionBy("_part").parquet(arriving)
    parts = d.spark.read.schema(placed.schema).parquet(arriving)
    for number in range(ARRIVALS):
        parts.where(F.col("_part") == number).drop("_part").write.mode("append").parquet(source)
        flows.unique_contents(flows.stream_table(d.spark, source), out, state)
    flows.unique_contents(_streamed(d).manifest(), out, scratch_path(d.spark, "state-of-another"))
    return d.spark.read.parquet(out).select("file_path", "content_hash")


# Issues arrive in the order of their times, but every fifth a quarter of the span after it: later than its
# window closes, unless the stream ends first.
_ARRIVED = """
spans as (select *, least(3, floor((epoch(detected_at) - low) * 4 / greatest(high - low, 1)))::int + (issue_id % 5 = 0)::int part
          from (select *, min(epoch(detected_at)) over () low, max(epoch(detected_at)) over () high from quality_issues)),
marks as (select part, max(t) over (order by part rows between unbounded preceding and 1 preceding) - interval 1 hour mark
          from (select part, max(detected_at) t from spans group by part)),
placed as (select s.*, time_bucket(interval 1 day, detected_at, timestamp '2024-01-01') window_start, mark
           from spans s join marks using (part)),
judged as (select *, coalesce(window_start + interval 1 day <= mark, false) late from placed)
"""


@register("stream_late_issues", tables="quality_issues", sql=f"""
with {_ARRIVED}
select window_start, issue_type, count(*) filter (where not late)::bigint counted, count(*) filter (where late)::bigint late
from judged group by all""")
def stream_late_issues(d: Domain) -> DataFrame:
    """Issues per day and kind from closed windows, beside those that came after their window had closed.

    Both together are all issues; which of them are late depends on the order in which they arrive.
    """
    source, out, closed = (scratch_path(d.spark, name) for name in ("issues", "split", "closed"))
    issues = d.quality_issues().withColumn("detected_at", F.col("detected_at").cast("timestamp"))
    seconds = F.unix_micros("detected_at") / F.lit(1_000_000)
    span = issues.agg(F.struct(F.min(seconds).alias("low"), F.max(seconds).alias("high"))).scalar()
    share = F.floor((seconds - span["low"]) * 4 / F.greatest(span["high"] - span["low"], F.lit(1.0)))
    part = F.least(F.lit(3), share).cast("int") + (F.col("issue_id") % 5 == 0).cast("int")
    parts = stage(issues.withColumn("_part", part), "issues")
    day = F.window("detected_at", "1 day")["end"]
    for number in range(5):
        parts.where(F.col("_part") == number).drop("_part").coalesce(1).write.mode("append").parquet(source)
        tables = flows.split_late(flows.stream_table(d.spark, source), out, f"{out}/state", "detected_at", "1 hour", day)
    rows = flows.stream_table(d.spark, tables.rows).select("detected_at", "issue_type")
    counted = _with_marker(d, rows, "detected_at", issue_type=_MARKER).withWatermark("detected_at", "1 hour").groupBy(
        F.window("detected_at", "1 day").alias("w"), "issue_type").agg(F.count(F.lit(1)).alias("counted"))
    flows.run_to_parquet(counted.select(F.col("w.start").alias("window_start"), "issue_type", "counted"), closed, f"{closed}-state")
    late = d.spark.read.parquet(tables.late).groupBy(
        F.window("detected_at", "1 day")["start"].alias("window_start"), "issue_type").agg(F.count(F.lit(1)).alias("late"))
    both = d.spark.read.parquet(closed).where(F.col("issue_type") != _MARKER).join(late, ["window_start", "issue_type"], "full")
    return both.select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"), "issue_type",
        F.coalesce("counted", F.lit(0)).alias("counted"), F.coalesce("late", F.lit(0)).alias("late"),
    )


@register("stream_quality_alert", tables="quality_issues", sql="""
select window_start, corrupt, incomplete, duplicate,
       case when corrupt + incomplete + duplicate < 50 then 'warning' else 'critical' end severity
from (select time_bucket(interval 1 day, detected_at, timestamp '2024-01-01') window_start,
             count(*) filter (where issue_type = 'corrupt')::bigint corrupt,
             count(*) filter (where issue_type = 'incomplete')::bigint incomplete,
             count(*) filter (where issue_type = 'duplicate')::bigint duplicate
      from quality_issues group by 1)
where corrupt + incomplete + duplicate >= 10""")
def stream_quality_alert(d: Domain) -> DataFrame:
    out, state = scratch_path(d.spark, "alerts"), scratch_path(d.spark, "state")
    issues = _streamed(d).quality_issues().withColumn("detected_at", F.col("detected_at").cast("timestamp"))
    stream = _with_marker(d, issues, "detected_at", issue_type=_MARKER)
    flows.run_to_parquet(flows.windowed_quality_alerts(stream, "1 day", "1 hour"), out, state)
    return d.spark.read.parquet(out).withColumn(
        "window_start", F.col("window_start").cast("timestamp_ntz")
    )


@register("stream_log_tail", tables="parsed_logs", sql="""
select format, level, logger, message, count(*)::bigint n from parsed_logs group by all""")
def stream_log_tail(d: Domain) -> DataFrame:
    """Log files read by byte offset; the second pass finds no new bytes."""
    logs, state = scratch_path(d.spark, "logs"), scratch_path(d.spark, "tail")
    d.log_lines().select(F.col("line").alias("value")).write.text(logs)
    tail = LogTail(d.spark, logs, state, glob="*.txt", range_bytes=1 << 20)
    tail.run_once()
    tail.run_once()
    lines = d.spark.read.schema("path string, line string").parquet(f"{state}/lines/pass=000001",
                                                                    f"{state}/lines/pass=000002")
    return log_ops.parse_logs(lines).groupBy("format", "level", "logger", "message").agg(
        F.count(F.lit(1)).alias("n")
    )
