"""Tables laid out so that readers skip most of them: sorted by the filtered column, with Bloom filters on ids.

Sorting gives every file and row group a narrow range of the column, so Parquet's own statistics exclude the rest; a
Bloom filter excludes row groups for ids, which are spread over all of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

KEYS_PUSHED = 1000  # keys that go into the scan as a filter; more are joined
_IN_LIST = 10       # values of one list that Parquet compares one by one; longer lists become a range


def write_sorted(
    df: DataFrame, path: str, order: list[str], ids: tuple[str, ...] = (), mode: str = "overwrite", group_bytes: int = 16 << 20,
) -> None:
    """Write a table sorted by ``order`` throughout, with a Bloom filter for each of ``ids`` in every row group."""
    options = {"parquet.block.size": str(group_bytes), "parquet.bloom.filter.adaptive.enabled": "true"}
    options |= {f"parquet.bloom.filter.enabled#{c}": "true" for c in ids}
    # Few values in a dictionary would make the filter needless; ids have many.
    options |= {f"parquet.enable.dictionary#{c}": "false" for c in ids}
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).options(**options).parquet(path)


def rows_with(table: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows whose ``column`` is among the first column of ``keys``; null keys find nothing.

    Up to KEYS_PUSHED distinct keys are handed to the scan, which then reads only the row groups that may hold them;
    more, which are counted first, are a semi join.
    """
    wanted = keys.select(F.col(keys.columns[0]).alias("_wanted")).where(F.col("_wanted").isNotNull()).distinct()
    some = [r[0] for r in wanted.limit(KEYS_PUSHED + 1).collect()]
    if len(some) > KEYS_PUSHED:
        return table.join(wanted, F.col(column) == F.col("_wanted"), "left_semi")
    lists = [F.col(column).isin(sorted(some)[at:at + _IN_LIST]) for at in range(0, len(some), _IN_LIST)]
    return table.where(reduce(lambda a, b: a | b, lists, F.lit(False)))
