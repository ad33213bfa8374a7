"""Helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wardspark.operators.sieve import Sieve as Sieve
from wardspark.session import stage

#: A word is a run of anything but space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
_LOCAL = 33  # monotonically_increasing_id() keeps the place inside a partition in its lower 33 bits


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def packed(docs: DataFrame) -> Column:
    """The whole row as one struct column, ``_row``: its columns can't clash with those of a step; ``_row.*`` restores them."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")


def hash60(*columns: Column) -> Column:
    """A uniform number below 2^60 that SQL engines compute alike: the first 15 hex digits of an md5."""
    joined = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("bigint")


def numbered(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Add each row's place (from 0) in the total order, without bringing the rows into one task.

    Rows are range-partitioned and sorted, written once with their place inside the partition, and
    shifted by the number of rows in earlier partitions. Only those counts, one per partition, meet
    in one task and are broadcast. Rows equal in ``order`` get distinct places in no fixed order.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = stage(ranged.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    counts = kept.groupBy(F.shiftright("_at", _LOCAL).alias("_part")).agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    local = F.col("_at").bitwiseAND(F.lit((1 << _LOCAL) - 1))
    return (
        kept.withColumn("_part", F.shiftright("_at", _LOCAL))
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + local)
        .drop("_at", "_part", "_start")
    )
