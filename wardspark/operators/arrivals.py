"""Files arriving in the incoming folder: routing and debouncing."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wardspark.functions import paths


def route_arrivals(arrivals: DataFrame) -> DataFrame:
    """Add decision, split, folder and file name to arrivals (path relative to incoming)."""
    path = F.col("path")
    decided = arrivals.withColumn("decision", paths.route(path))
    return decided.select(
        *arrivals.columns,
        "decision",
        paths.routed_split(path, F.col("decision")).alias("split"),
        paths.routed_folder(path, F.col("decision")).alias("folder"),
        F.element_at(F.split(path, "/"), -1).alias("filename"),
    )


def destinations(
    routed: DataFrame, key: str = "event_id", time: str = "ts", taken: DataFrame | None = None
) -> DataFrame:
    """Destination of kept files; a taken name gets the arrival's unique id as suffix.

    The first arrival per destination is a minimum per destination, joined back on the unique
    key, so a name that arrives very often does not collect in one task. ``taken`` lists destinations given
    away before; no arrival is first for them.
    """
    target = F.concat_ws("/", "split", "folder", "filename")
    kept = routed.where(F.col("decision").isin("keep", "default")).withColumn("_dest", target)
    first = kept.groupBy("_dest").agg(F.min(F.struct(time, key)).alias("f"))
    if taken is not None:
        first = first.join(taken.select(F.col("destination").alias("_dest")).distinct(), "_dest", "left_anti")
    first = first.select(F.col(f"f.{key}").alias(key), F.lit(True).alias("_first"))
    stem = F.regexp_extract("filename", r"^(.*?)(\.[^.]*)?$", 1)
    suffix = F.regexp_extract("filename", r"(\.[^.]*)$", 1)
    renamed = F.concat_ws("/", "split", "folder", F.concat(stem, F.lit("_"), F.col(key).cast("string"), suffix))
    return kept.join(first, key, "left").select(
        *routed.columns,
        F.when(F.col("_first"), F.col("_dest")).otherwise(renamed).alias("destination"),
    )


def route_alerts(routed: DataFrame) -> DataFrame:
    """One warning per rejected arrival."""
    return routed.where(F.col("decision") == "reject").select(
        F.lit("warning").alias("severity"),
        F.lit("Arrival outside the known folders").alias("title"),
        F.col("path").alias("message"),
    )


def watcher_events(destined: DataFrame) -> DataFrame:
    """Event rows of moved files, as appended to the event log."""
    return destined.select(
        "ts",
        F.lit("image_moved").alias("event"),
        F.concat(F.lit("raw/scans/"), "destination").alias("path"),
        "split",
        "folder",
    )


def debounce(arrivals: DataFrame, gap: str, time: str = "ts") -> DataFrame:
    """Bursts per path: a path is ready when no event came for ``gap`` after its last one.

    Works on a batch and, below a watermark, on a stream. ``build_session`` has sessions merged on the map side
    first, so a path with very many events ships few rows. Spark joins sessions that touch, but an event exactly
    one gap later belongs to a new burst, hence the microsecond.
    """
    window = F.session_window(time, f"{gap} -1 microseconds").alias("w")
    bursts = arrivals.groupBy("path", window).agg(
        F.count(F.lit(1)).alias("events"), F.max(time).alias("last_event")
    )
    ready = F.col("last_event") + F.expr(f"interval '{gap}'")
    return bursts.select(
        "path", F.col("w.start").alias("first_event"), "last_event", ready.alias("ready_at"), "events"
    )
