"""Keyed tables that change in place: Parquet in partitions and buckets of the key.

A change reads and rewrites only the partitions its keys fall into. Inside them the rows are bucketed by the key, so the
stored side of a join needs no shuffle; only the changes are moved. A partition is a set of buckets, so a table has one file
for each bucket (or one for each partition, where there are more of these), not one for each pair of both. There are no
versions and no log: the files of a partition are replaced when the job commits, and a change that is repeated gives the same
rows. As with any folder of Parquet files, one writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from wardspark.operators import mutate
from wardspark.session import stage
from wardspark.sources.files import remove

PARTITION = "key_part"
PARTS = 32  # partitions; a change of few keys rewrites few of them
_PROBED = 1000  # rows of an opened folder whose partitions are compared with its numbers


class KeyedTable:
    """A bucketed table over a folder, under a name of this session's catalogue.

    ``key`` may repeat (rows of one parent); ``upsert`` needs it unique. A table has at least as many buckets as the session
    has shuffle partitions: with fewer, Spark would move the stored side for the sake of parallelism.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, schema: StructType, buckets: int, parts: int):
        self.spark, self.path, self.key, self.buckets, self.parts = spark, path.rstrip("/"), key, buckets, parts
        self.name = f"keyed_{uuid.uuid4().hex}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"create table {self.name} ({columns}, {PARTITION} int) using parquet partitioned by ({PARTITION}) "
            f"clustered by (`{key}`) sorted by (`{key}`) into {buckets} buckets location '{self.path}'"
        )
        self.columns = [f.name for f in spark.table(self.name).schema if f.name != PARTITION]
        self.key_type = spark.table(self.name).select(key).schema[0].dataType

    @classmethod
    def create(cls, df: DataFrame, path: str, key: str, buckets: int | None = None, parts: int = PARTS) -> KeyedTable:
        """A new table with the rows of ``df``; the only time that all rows are moved."""
        spark = df.sparkSession
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        table = cls(spark, path, key, df.schema, max(buckets or least, least), parts)
        table._write(df.repartition(max(buckets or least, least), key))
        return table

    @classmethod
    def open(cls, spark: SparkSession, path: str, key: str, buckets: int, parts: int = PARTS) -> KeyedTable:
        """An existing folder, with the numbers it was created with (``buckets`` and ``parts`` of the table); with others, or
        if its partitions were numbered in another way, changes would miss rows, so that is an error."""
        schema = spark.read.parquet(path).drop(PARTITION).schema
        table = cls(spark, path, key, schema, buckets, parts)
        spark.sql(f"msck repair table {table.name}")
        some = spark.table(table.name).select(key, PARTITION).limit(_PROBED)
        if not some.where(table.part(F.col(key)) != F.col(PARTITION)).isEmpty():
            table.drop_name()
            raise ValueError(f"{path} was not written with {buckets} buckets and {parts} partitions of this layout")
        return table

    def part(self, key: Column) -> Column:
        """Partition of a key, from the hash that also gives its bucket: whole buckets share a partition, and only where there
        are fewer buckets than partitions is a bucket cut."""
        units = self.buckets * -(-self.parts // self.buckets)
        return F.pmod(F.pmod(F.hash(key.try_cast(self.key_type)), F.lit(units)), F.lit(self.parts))

    def read(self, parts: list[int] | None = None) -> DataFrame:
        rows = self.spark.table(self.name)
        return rows.drop(PARTITION) if parts is None else rows.where(F.col(PARTITION).isin(parts)).drop(PARTITION)

    def touched(self, keys: DataFrame, key: str | None = None) -> list[int]:
        """Partitions that hold the keys: ``parts`` numbers at most."""
        return sorted(r[0] for r in keys.select(self.part(F.col(key or self.key)).alias("p")).distinct().collect())

    def upsert(self, incoming: DataFrame, update: list[str]) -> list[int]:
        """Insert new keys and change the ``update`` columns of known ones; returns the rewritten partitions."""
        changes = stage(incoming, "changes")
        parts = self.touched(changes)
        if parts:
            self._write(mutate.upsert(self.read(parts), changes, self.key, update))
        return parts

    def delete(self, keys: DataFrame) -> list[int]:
        """Delete all rows of the listed keys; returns the rewritten partitions.

        A partition that loses all its rows has none to be replaced by, so it is dropped by name.
        """
        gone = stage(keys.select(self.key).distinct(), "deleted")
        parts = self.touched(gone)
        if parts:
            left = self.read(parts).join(gone, self.key, "left_anti")
            kept = set(self.touched(left))
            self._write(left)
            for number in set(parts) - kept:
                self.spark.sql(f"alter table {self.name} drop if exists partition ({PARTITION} = {number})")
                remove(self.spark, f"{self.path}/{PARTITION}={number}")
        return parts

    def drop_name(self) -> None:
        """Forget the name; the files stay."""
        self.spark.sql(f"drop table if exists {self.name}")

    def detached(self) -> DataFrame:
        """The rows as a plain folder, without the name."""
        schema = self.read().schema
        self.drop_name()
        return self.spark.read.schema(schema).parquet(self.path).select(*self.columns)

    def _write(self, rows: DataFrame) -> None:
        # Rows come in the buckets' order, so a task writes one file per partition.
        setting = "spark.sql.sources.partitionOverwriteMode"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, "dynamic")
        try:
            rows.select(*self.columns, self.part(F.col(self.key)).alias(PARTITION)).write.mode("overwrite").insertInto(self.name)
        finally:
            self.spark.conf.set(setting, before)

