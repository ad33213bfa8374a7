"""Mixing sources to target weights with hash-threshold histograms (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardspark.llm.common import WORD, hash60, numbered, packed, text_of
from wardspark.session import stage

BITS = 60
STEP = 12  # bits per histogram level: at most 4096 rows per source and level


def _measured(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
        _place(id_col, text_col).alias("h"),
    )


def _place(id_col: str, text_col: str) -> Column:
    """Where a row stands in the order in which a source is used up: only rows equal in id and text share a place."""
    return hash60(F.col(id_col), F.md5(text_of(text_col)))


def _level(sources: DataFrame, total: int, cap: int) -> float:
    """Words per unit of weight once no target is above ``cap`` times its source's size.

    Each pass is one aggregate over the table of sources: those above their cap are fixed at it and the
    rest is shared again by weight, until no further source is above.
    """
    fixed, free, above = 0, None, -1
    while True:
        level = 0.0 if free == 0 else (total - fixed) / free if free else None
        over = F.lit(False) if level is None else F.lit(level) * F.col("weight") > cap * F.col("source_size")
        row = sources.agg(
            F.coalesce(F.sum(F.when(over, cap * F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)),
            F.coalesce(F.sum(over.cast("int")), F.lit(0)),
        ).first()
        if row[2] == above:
            return level or 0.0
        fixed, free, above = row


def budgets(measured: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """One row per source: its size, target, whole repeats and the hash bound of one more copy.

    Sources are ordered by code point, null last, and weigh ``weights`` in turn. A target is the sum of
    nested budgets: ``repeats`` whole passes over the source and a rest. The rest's bound is found
    in histograms of words by hash prefix: the prefix in which the running sum passes the rest is the only
    one whose rows are counted again, by the next bits, until it holds one hash value. That last value
    is taken if that brings the sum nearer to the rest. No rows are sorted, and each bound is exact.

    ``measured`` has source, size and h (below 2^60). An empty input gives no rows; sources without
    words get target 0.
    """
    first = stage(
        measured.groupBy("source", F.shiftright("h", BITS - STEP).alias("bucket")).agg(
            F.sum("size").alias("words"), F.min("h").alias("low"), F.max("h").alias("high")
        ),
        "mix-buckets",
    )
    sizes = first.groupBy("source").agg(F.sum("words").alias("source_size"))
    picks = F.array(*[F.lit(w) for w in weights])
    sources = stage(
        numbered(sizes, [F.col("source").asc_nulls_last()], "place").withColumn(
            "weight", F.get(picks, (F.col("place") % len(weights)).cast("int"))
        ),
        "mix-sources",
    )
    total = sources.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level = _level(sources, total, cap)
    size = F.col("source_size")
    goals = sources.withColumn(
        "target", F.least(F.lit(level) * F.col("weight"), (cap * size).cast("double"))
    ).withColumn("repeats", F.when(size > 0, F.floor(F.col("target") / size)).otherwise(0).cast("long"))
    goals = goals.withColumn("rest", F.col("target") - F.col("repeats") * size).select(
        "source", "source_size", "target", "repeats", "rest"
    )
    # The bucket in which each source's running sum passes its rest, refined while it holds several hashes.
    at = _boundary(first.withColumn("below", F.lit(0).cast("long")), goals)
    shift = BITS - STEP
    while shift > 0:
        at = stage(at, "mix-boundary")
        if not at.where("low < high").take(1):
            break
        shift -= STEP
        inside = (
            measured.join(
                at.where("low < high").select(
                    F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), F.col("below")
                ),
                F.col("source").eqNullSafe(F.col("_source"))
                & (F.shiftright("h", shift + STEP) == F.col("_bucket")),
            )
            .groupBy("source", F.shiftright("h", shift).alias("bucket"))
            .agg(F.sum("size").alias("words"), F.min("h").alias("low"), F.max("h").alias("high"),
                 F.max("below").alias("below"))
        )
        at = at.where("low >= high").unionByName(_boundary(inside, goals))
    taken = F.when(
        F.col("below") + F.col("words") - F.col("rest") < F.col("rest") - F.col("below"), F.col("low") + 1
    ).otherwise(F.col("low"))
    bounds = at.select(F.col("source").alias("_source"), taken.alias("_bound"))
    return stage(
        goals.join(bounds, F.col("source").eqNullSafe(F.col("_source")), "left").select(
            "source", "source_size", "target", "repeats", F.coalesce("_bound", F.lit(0)).alias("bound")
        ),
        "mix-budgets",
    )


def _boundary(buckets: DataFrame, goals: DataFrame) -> DataFrame:
    """Per source, the first bucket whose running sum passes the rest. At most 2^STEP rows per source."""
    order = Window.partitionBy("source").orderBy("bucket")
    running = buckets.withColumn("to", F.col("below") + F.sum("words").over(order))
    goal = goals.select(F.col("source").alias("_source"), "rest")
    return (
        running.join(goal, F.col("source").eqNullSafe(F.col("_source")))
        .where((F.col("rest") > 0) & (F.col("to") > F.col("rest")) & (F.col("to") - F.col("words") <= F.col("rest")) & (F.col("words") > 0))
        .select("source", "bucket", "low", "high", "words", (F.col("to") - F.col("words")).alias("below"), "rest")
    )


def _copies(h: Column) -> Column:
    return F.col("repeats") + (h < F.col("bound")).cast("long")


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """How many words the mix takes of each document, as whole copies of it.

    Returns doc_id, source, size, source_size, target, copies and taken, one row per input row. Null and
    empty texts have size 0 and take nothing; a null source is a source of its own; rows that are
    equal in doc_id and text share a hash, so they are taken or left together; an empty table gives no rows.
    """
    measured = stage(_measured(docs, id_col, text_col, source_col), "mix-measured")
    goals = budgets(measured, weights, cap).withColumnRenamed("source", "_source")
    joined = measured.join(goals, F.col("source").eqNullSafe(F.col("_source")))
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", _copies(F.col("h")).alias("copies"),
        (F.col("size") * _copies(F.col("h"))).alias("taken"),
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), cap: int = 3) -> DataFrame:
    """The mixed corpus itself: each row as often as the mix takes it, with the columns of ``docs``."""
    measured = stage(_measured(docs, "doc_id", "text", "source"), "mix-measured")
    goals = budgets(measured, weights, cap).select(
        F.col("source").alias("_source"), F.col("repeats").alias("_repeats"), F.col("bound").alias("_bound")
    )
    rows = docs.select(packed(docs), F.col("source").alias("_own"), _place("doc_id", "text").alias("_h"))
    copies = F.col("_repeats") + (F.col("_h") < F.col("_bound")).cast("long")
    return (
        rows.join(goals, F.col("_own").eqNullSafe(F.col("_source")))
        .select("_row", F.explode(F.array_repeat(F.lit(1), copies.cast("int"))).alias("_copy"))
        .select("_row.*")
    )
