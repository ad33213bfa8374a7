"""Shards in Hilbert-curve order of several metadata dimensions, for file pruning in each of them."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from wardspark.llm.common import numbered, text_of
from wardspark.session import ship_package, stage

SHARDS = 8
BITS = 5  # cells per dimension: 2^BITS


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (rows by dimensions, values below 2^bits).

    From the highest bit down, the axes below a set bit are mirrored and those below a clear one swapped
    with the first axis; what remains, in Gray code, holds the index's bits, one per axis and level.
    """
    x = np.array(cells, dtype=np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        mask = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & mask)
            x[0] ^= np.where(high, mask, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    index = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            index = (index << 1) | ((x[i] >> level) & 1)
    return index


def _magnitude(value: Column, bits: int) -> Column:
    """Cell of a number: half-octaves of its value from 1 on, null and less in cell 0."""
    level = F.floor(2 * F.log2(F.greatest(value.cast("double"), F.lit(1.0))))
    return F.coalesce(F.least(level, F.lit((1 << bits) - 1)), F.lit(0)).cast("int")


def _with_cells(rows: DataFrame, columns: list[str], bits: int) -> DataFrame:
    """``rows`` with one cell column, ``_cell_<k>``, per dimension."""
    for k, name in enumerate(columns):
        if isinstance(rows.schema[name].dataType, NumericType):
            rows = rows.withColumn(f"_cell_{k}", _magnitude(F.col(name), bits))
            continue
        values = rows.groupBy(name).agg(F.count("*").alias("_rows")).drop("_rows")
        places = stage(numbered(values, [F.col(name).asc_nulls_first()], "_place"), "dimension")
        many = places.count()
        cells = stage(
            places.select(
                F.col(name).alias("_value"),
                F.floor(F.col("_place") * (1 << bits) / F.lit(max(many, 1 << bits))).cast("int").alias(f"_cell_{k}"),
            ),
            "cells",
        )
        rows = rows.join(cells, F.col(name).eqNullSafe(F.col("_value"))).drop("_value")
    return rows


def _curve(rows: DataFrame, dimensions: list[str], bits: int) -> DataFrame:
    """``rows`` with their place on the curve, ``curve``."""
    ship_package(rows.sparkSession)

    @F.pandas_udf("long")
    def place(cells: pd.DataFrame) -> pd.Series:
        return pd.Series(hilbert_index(cells.to_numpy(), bits))

    names = [f"_cell_{k}" for k in range(len(dimensions))]
    return _with_cells(rows, dimensions, bits).withColumn("curve", place(F.struct(*names))).drop(*names)


def assign(
    docs: DataFrame, shards: int = SHARDS, dimensions: tuple[str, ...] = ("source", "lang", "size"),
    bits: int = BITS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Put every row into a shard: equal runs of the rows in curve order (law ``rows``).

    Returns doc_id, size (UTF-8 bytes of the text plus 1; null: 1), text_crc32, law, shard, slot (place in
    the shard), grown_shard (null: the law promises nothing about other shard counts) and curve. Row counts of
    shards differ by one at most, however rows are distributed over the dimensions, as a hot cell is cut like any
    run. Ties on the curve go by doc_id (nulls first), size and checksum; rows equal in all of these are alike
    in the result. An empty table gives no rows. ``dimensions`` may name size or columns of ``docs``.
    """
    text = text_of(text_col)
    size = F.octet_length(text).cast("long") + 1
    other = [d for d in dimensions if d != "size"]
    rows = docs.select(
        F.col(id_col).alias("doc_id"), size.alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        *[F.col(d).alias(f"_d_{d}") for d in other],
    )
    placed = _curve(rows, ["size" if d == "size" else f"_d_{d}" for d in dimensions], bits).select(
        "doc_id", "size", "text_crc32", "curve"
    )
    order = [F.col(c).asc_nulls_first() for c in ("curve", "doc_id", "size", "text_crc32")]
    ranked = stage(numbered(placed, order, "place"), "shards")
    total = F.lit(ranked.count())
    first = F.ceil(F.col("shard") * total / shards)  # the least place whose shard this is
    return (
        ranked.withColumn("shard", F.floor(F.col("place") * shards / total).cast("int"))
        .select(
            "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
            (F.col("place") - first).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve",
        )
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, dimensions: tuple[str, ...] = ("source", "lang", "n_chars"), bits: int = BITS) -> None:
    """Write ``docs`` as Parquet, one folder per shard, rows in curve order inside, so that readers skip row groups."""
    columns = docs.columns
    curved = _curve(docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"), *[F.col(d) for d in dimensions]), list(dimensions), bits)
    ranked = stage(numbered(curved.select("_row", "curve"), [F.col("curve"), F.xxhash64("_row")], "_place"), "shard-rows")
    total = ranked.count()
    shard = F.floor(F.col("_place") * shards / F.lit(max(total, 1))).cast("int")
    ranked.withColumn("shard", shard).repartitionByRange("shard", "_place").sortWithinPartitions("shard", "_place").select(
        "_row.*", F.col("shard").alias("_shard")
    ).write.partitionBy("_shard").parquet(path)
