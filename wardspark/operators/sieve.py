"""A bounded filter that goes before an exact join, so that only rows which may match are moved."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardspark.session import stage


_PAGE = 15           # bits of a bitmap page, as bitmap_construct_agg makes them: 2^15 bits, 4 KB
SIEVE_BITS = 27      # at most 2^27 bits, 16 MB: the bound of what is broadcast
BITS_A_KEY = 16


class Sieve:
    """A bitmap of 64-bit keys that passes all of them and few others; at most 16 MB whatever their number.

    It has BITS_A_KEY bits for each key up to its bound. Beyond about 10^7 keys it passes ever more of the
    others, so that an exact join must follow in any case; then only its saving shrinks.
    """

    def __init__(self, keys: DataFrame, key: str, name: str):
        keys = stage(keys.select(F.col(key).alias("_key")).where("_key is not null"), f"{name}-keys")
        need = max(1, keys.count() * BITS_A_KEY)
        self.bits = min(SIEVE_BITS, max(_PAGE, (need - 1).bit_length()))
        spot = self._spot(F.col("_key"))
        pages = keys.select(F.shiftright(spot, _PAGE).alias("_page"), spot.bitwiseAND(F.lit((1 << _PAGE) - 1)).alias("_bit"))
        self.pages = stage(pages.groupBy("_page").agg(F.bitmap_construct_agg("_bit").alias("_map")), f"{name}-sieve")

    def _spot(self, key: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(key), 64 - self.bits)

    def mark(self, df: DataFrame, key: Column, name: str = "_maybe") -> DataFrame:
        """``df`` with a boolean column that is true for every row whose key was put in."""
        spot = self._spot(key)
        bit = spot.bitwiseAND(F.lit((1 << _PAGE) - 1))
        byte = F.substring("_map", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))
        held = F.getbit(F.conv(F.hex(byte), 16, 10).cast("long"), bit.bitwiseAND(F.lit(7)).cast("int")) == 1
        found = df.withColumn("_page", F.shiftright(spot, _PAGE)).join(F.broadcast(self.pages), "_page", "left")
        return found.withColumn(name, F.coalesce(key.isNotNull() & held, F.lit(False))).drop("_page", "_map")
