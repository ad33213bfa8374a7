"""Exact deduplication with static binary-fuse filters over immutable snapshots.

Texts are known by a digest, the first bits of a sha-256. The digests of stored texts form snapshots that never
change: a table in digest buckets, and for each bucket a binary-fuse filter of 16-bit fingerprints. A batch is first
grouped by digest, so that its own duplicates are one row. Its digests are screened by the filters of their
bucket; those that pass are looked up in the exact buckets. Only texts whose digest occurs again, there or in
the batch, are compared byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardspark.llm.common import Sieve
from wardspark.session import ship_package, stage

BATCHES = 3              # the query takes the table as so many arrivals; each becomes a snapshot
DIGEST_BITS = 64
BUCKET_KEYS = 1 << 17    # digests in a bucket, about
LEAST_BUCKETS = 256
SPACE = r"[\x20\x09-\x0D]+"


# ---- binary-fuse filter -------------------------------------------------------------------------------------

def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = keys + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


class BinaryFuse(NamedTuple):
    """Three neighbouring segments hold one slot each of a key; the exclusive or of the slots is its fingerprint."""

    seed: int
    segment: int          # slots in a segment, a power of two
    slots: np.ndarray     # uint16

    @staticmethod
    def places(keys: np.ndarray, seed: int, segment: int, starts: int) -> tuple[np.ndarray, np.ndarray]:
        """(3 x n slots, n fingerprints): a first segment by the upper bits, then one slot in it and in the next two."""
        h = _mixed(keys, seed)
        first = ((h >> np.uint64(32)) * np.uint64(starts)) >> np.uint64(32)
        mask = np.uint64(segment - 1)
        own = np.stack([h & mask, (h >> np.uint64(13)) & mask, _mixed(h, 7) & mask])
        at = (first + np.arange(3, dtype=np.uint64)[:, None]) * np.uint64(segment) + own
        return at.astype(np.int64), (_mixed(h, 11) & np.uint64(0xFFFF)).astype(np.uint16)

    @classmethod
    def build(cls, keys: np.ndarray) -> BinaryFuse:
        """Filter of distinct uint64 keys. Slots with one key are peeled, all of a round at once; a seed that leaves
        keys over is replaced by the next, and every eighth by more room."""
        n = len(keys)
        segment = 1 << min(16, max(2, int(np.log(max(n, 2)) / np.log(3.33) + 2.25)))
        room = 1.0
        for seed in range(1, 1000):
            factor = max(1.125, 0.875 + 0.25 * np.log(1e6) / np.log(max(n, 3))) * room
            starts = max(1, -(-int(n * factor) // segment) - 2)
            at, prints = cls.places(keys, seed, segment, starts)
            order = _peel(at, (starts + 2) * segment)
            if order is not None:
                slots = np.zeros((starts + 2) * segment, dtype=np.uint16)
                for rows, own in reversed(order):
                    rest = prints[rows] ^ slots[at[0, rows]] ^ slots[at[1, rows]] ^ slots[at[2, rows]]
                    slots[own] = rest
                return cls(seed, segment, slots)
            if seed % 8 == 0:
                room *= 1.1
        raise ValueError("keys of a filter are not distinct")

    def has(self, keys: np.ndarray) -> np.ndarray:
        """True for every key of the filter, and for one in 65,536 others."""
        at, prints = self.places(keys, self.seed, self.segment, len(self.slots) // self.segment - 2)
        return (self.slots[at[0]] ^ self.slots[at[1]] ^ self.slots[at[2]]) == prints


def _peel(at: np.ndarray, size: int) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Rounds of (keys, the slot each key alone holds), or None where keys are left over."""
    n = at.shape[1]
    count = np.bincount(at.ravel(), minlength=size)
    index = np.zeros(size, dtype=np.int64)  # exclusive or of the keys of a slot
    for k in range(3):
        np.bitwise_xor.at(index, at[k], np.arange(n))
    rounds, left = [], n
    single = np.flatnonzero(count == 1)
    while len(single):
        # A key that is alone in several slots is peeled by the first.
        rows, first = np.unique(index[single], return_index=True)
        rounds.append((rows, single[first]))
        left -= len(rows)
        touched = at[:, rows]
        np.subtract.at(count, touched.ravel(), 1)
        for k in range(3):
            np.bitwise_xor.at(index, touched[k], rows)
        near = np.unique(touched)
        single = near[count[near] == 1]
    return rounds if left == 0 else None


# ---- snapshots ----------------------------------------------------------------------------------------------

class Snapshot(NamedTuple):
    digests: DataFrame   # bucket, digest: one row per digest, written once
    filters: DataFrame   # bucket, seed, segment, slots


def _fused(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(batches)
    made = BinaryFuse.build(table["digest"].to_numpy().view(np.uint64))
    yield pa.RecordBatch.from_pydict({
        "bucket": pa.array([table["bucket"][0].as_py()], pa.int32()), "seed": pa.array([made.seed], pa.int32()),
        "segment": pa.array([made.segment], pa.int32()), "slots": pa.array([made.slots.tobytes()], pa.binary()),
    })


def snapshot(digests: DataFrame) -> Snapshot:
    """Write distinct digests (bucket, digest) and the filters of their buckets.

    A bucket holds about BUCKET_KEYS digests, as they are uniform and distinct; it is one task's group.
    """
    kept = stage(digests.select("bucket", "digest"), "dedup-snapshot")
    filters = kept.groupBy("bucket").applyInArrow(_fused, "bucket int, seed int, segment int, slots binary")
    return Snapshot(kept, stage(filters, "dedup-filters"))


def _screened(left: pa.Table, right: pa.Table) -> pa.Table:
    digests = left["digest"].to_numpy()
    hit = np.zeros(len(digests), dtype=bool)
    for seed, segment, slots in zip(right["seed"].to_pylist(), right["segment"].to_pylist(), right["slots"], strict=True):
        hit |= BinaryFuse(seed, segment, np.frombuffer(slots.as_py(), dtype=np.uint16)).has(digests.view(np.uint64))
    return left.select(["bucket", "digest"]).filter(pa.array(hit))


def screen(digests: DataFrame, snapshots: list[Snapshot]) -> DataFrame:
    """Digests (bucket, digest; distinct) that the filters of their bucket let pass: all that are stored, few others."""
    filters = snapshots[0].filters
    for other in snapshots[1:]:
        filters = filters.unionAll(other.filters)
    return digests.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(_screened, "bucket int, digest bigint")


def stored(digests: DataFrame, snapshots: list[Snapshot]) -> DataFrame:
    """Digests that are in a snapshot: screened, then looked up in the exact buckets."""
    passed = stage(screen(digests, snapshots), "dedup-passed")
    found = None
    for one in snapshots:
        hit = one.digests.join(passed, ["bucket", "digest"], "left_semi")
        found = hit if found is None else found.unionAll(hit)
    return found.distinct()


# ---- the operator -------------------------------------------------------------------------------------------

def normalised(text: Column) -> Column:
    """The text with each run of white space replaced by one space; null counts as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _digest(sha: Column, bits: int) -> Column:
    head = F.conv(F.substring(sha, 1, 16), 16, -10).cast("long")
    return F.shiftrightunsigned(head, 64 - bits) if bits < 64 else head


def classes(docs: DataFrame, batches: int, bits: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, groups): every row's place, id and sha; and of texts that occur more than once sha, keep_id, keep_row
    and size."""
    spark = docs.sparkSession
    ship_package(spark)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = stage(
        base.select("doc_id", F.sha2(normalised(F.col("text")), 256).alias("sha")).select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "sha", _digest(F.col("sha"), bits).alias("digest"),
            F.pmod(F.xxhash64("doc_id", F.lit("arrival")), F.lit(batches)).cast("int").alias("batch"),
        ),
        "dedup-rows",
    )
    grouped = stage(rows.groupBy("batch", "digest").agg(F.count("*").alias("n")), "dedup-digests")
    total = grouped.count()
    buckets = 1 << max(LEAST_BUCKETS.bit_length() - 1, (total // BUCKET_KEYS).bit_length())
    grouped = grouped.withColumn("bucket", F.pmod(F.xxhash64("digest"), F.lit(buckets)).cast("int"))
    snapshots: list[Snapshot] = []
    again = grouped.where("n > 1").select("digest")  # a batch's own duplicates need no filter
    for number in range(batches):
        batch = grouped.where(F.col("batch") == number).select("bucket", "digest")
        new = batch
        if snapshots:
            known = stage(stored(batch, snapshots), "dedup-stored")
            again = again.unionAll(known.select("digest"))
            new = batch.join(known, ["bucket", "digest"], "left_anti")
        if number < batches - 1:
            snapshots.append(snapshot(new))
    repeated = Sieve(again.distinct(), "digest", "dedup-repeated")
    # Byte checks: a group is one whole text, and copies are counted before they are moved.
    texts = base.select(normalised(F.col("text")).alias("text"))
    suspects = repeated.mark(texts.withColumn("sha", F.sha2("text", 256)), _digest(F.col("sha"), bits)).where("_maybe")
    same = suspects.groupBy("sha", "text").agg(F.count("*").alias("n"))
    same = stage(same.where("n > 1").select("sha", "n"), "dedup-same")
    per_sha = same.groupBy("sha").agg(F.count("*").alias("texts"), F.max("n").alias("size"))
    verified = stage(
        per_sha.select("sha", F.when(F.col("texts") == 1, F.col("size")).otherwise(
            F.raise_error(F.lit("different texts have one sha-256"))).alias("size")),
        "dedup-verified",
    )
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    least = repeated.mark(rows, F.col("digest")).where("_maybe").groupBy("sha").agg(F.min(order).alias("first"))
    groups = verified.join(least, "sha").select(
        "sha", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"), "size"
    )
    return rows, stage(groups, "dedup-groups")


def dedup(
    docs: DataFrame, batches: int = BATCHES, bits: int = DIGEST_BITS, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept and text_sha256.

    Texts are equal when they agree after each run of white space became one space; null counts as empty. Of equal
    texts the row of smallest doc_id stays, of rows equal in both any one; null ids come last, and where all are
    null keep_id is null. Whole texts of any length are compared. Extra columns are not looked at. An empty table gives no
    rows. ``batches``: arrivals that the rows are dealt to by their id; all but the last become snapshots. The result depends
    neither on it nor on ``bits``, the size of a digest.
    """
    rows, groups = classes(docs, batches, bits, id_col, text_col)
    size = F.coalesce("size", F.lit(1)).cast("long")
    return rows.join(groups, "sha", "left").select(
        "doc_id", F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        size.alias("group_size"), F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
