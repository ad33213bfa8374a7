"""Centroid clustering of integer vectors with scalar lookup tables.

In every round a block of vectors tabulates, for each dimension, the squared difference of each occurring value from
each centroid. A distance is then the sum of one table entry per dimension, gathered by NumPy. Tasks send
sums and counts per cluster, which Spark adds up; the driver holds one row per centroid and dimension.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wardspark.session import ship_package, stage

WIDTH = 64
CLUSTERS = 8
ROUNDS = 10
SEED = 3
SCALE = 1024
BLOCK = 4096          # vectors whose tables are made together
_SAFE = 1 << 27       # components below it in size have distances and block sums within 64 bits
_MOST = (1 << 62)     # larger integers count as this


def usable(vector: Column, width: int = WIDTH) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & (F.size(vector) == width) & finite, F.lit(False))


def quantised(vector: Column) -> Column:
    """floor(SCALE * x) of every component, kept within plus and minus _MOST."""
    whole = lambda x: F.floor(F.greatest(F.least(F.lit(float(SCALE)) * x, F.lit(float(_MOST))), F.lit(-float(_MOST))))
    return F.transform(vector, lambda x: whole(x).cast("long"))


def distances(block: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances (vectors x centroids) as sums of table entries, exactly.

    Where values could leave 64 bits, the tables hold Python integers.
    """
    if max(np.abs(block).max(initial=0), max((abs(int(c)) for c in centroids.ravel()), default=0)) > _SAFE:
        block, centroids = block.astype(object), centroids.astype(object)
    total = np.zeros((len(block), len(centroids)), dtype=block.dtype)
    for k in range(block.shape[1]):
        values, place = np.unique(block[:, k], return_inverse=True)
        table = (values[:, None] - centroids[:, k]) ** 2
        total += table[place]
    return total


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for at in range(0, batch.num_rows, BLOCK):
        part = batch.slice(at, BLOCK)
        yield part, part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


def _sums(vectors: DataFrame, centroids: list[list[int]]) -> list:
    """Count and componentwise sum of each cluster's vectors: one row per cluster and dimension."""
    fixed = np.array(centroids, dtype=object if max(abs(c) for x in centroids for c in x) > _MOST else np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(fixed), dtype=np.int64)
        sums = np.zeros(fixed.shape, dtype=object)
        for batch in batches:
            for _, block in _blocks(batch):
                own = distances(block, fixed).argmin(axis=1)
                large = np.abs(block).max(initial=0) > _SAFE
                for c in np.unique(own):
                    rows = block[own == c]
                    counts[c] += len(rows)
                    sums[c] += (rows.astype(object) if large else rows).sum(axis=0)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(counts[held]), pa.array([[str(x) for x in sums[c]] for c in held], pa.list_(pa.string()))],
            names=["cluster", "n", "sums"],
        )

    parts = vectors.select("v").mapInArrow(run, "cluster int, n bigint, sums array<string>")
    each = parts.select("cluster", "n", F.posexplode("sums").alias("place", "part"))
    return each.groupBy("cluster", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")
    ).collect()


def _assigned(vectors: DataFrame, centroids: list[list[int]]) -> DataFrame:
    fixed = np.array(centroids, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block in _blocks(batch):
                away = distances(block, fixed)
                own = away.argmin(axis=1)
                least = np.array([min(int(x), (1 << 63) - 1) for x in away[np.arange(len(own)), own]], dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(own, pa.int32()), pa.array(least)], names=["vec_id", "cluster", "distance"]
                )

    return vectors.mapInArrow(run, "vec_id bigint, cluster int, distance bigint")


def cluster(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, seed: int = SEED, width: int = WIDTH,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every kept vector.

    Vectors that are null, of another width, or hold null or non-finite components are left out; zero vectors stay. The first
    centroids are the vectors of smallest sha-256 of ``seed:id``; rows of equal id are taken by their components, rows
    without an id after all others. With fewer vectors than ``clusters`` there are as many centroids as vectors. Ties go to the
    smaller number; empty clusters keep their centroid. Repeated rows each count. An empty table gives no rows.
    Arithmetic is exact for components up to 2^62 after scaling; sizes beyond count as that, and a distance beyond 64 bits is
    returned as the largest long. Extra columns are not looked at.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    kept = stage(base.where(usable(F.col("v"), width)).select("vec_id", quantised(F.col("v")).alias("v")), "centroid-vectors")
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    first = kept.select("v").orderBy(name.asc_nulls_last(), "v").limit(clusters).collect()
    schema = "vec_id bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    if not first:
        return spark.createDataFrame([], schema)
    centroids = [list(r.v) for r in first]
    for _ in range(rounds):
        for r in _sums(kept, centroids):
            centroids[r.cluster][r.place] = int(r.total) // r.n
    done = stage(_assigned(kept, centroids), "centroid-assigned")
    most = (1 << 63) - 1
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = {r.cluster: int(r.s) for r in done.groupBy("cluster").agg(total.alias("s")).collect()}
    facts = spark.createDataFrame(
        [(c, min(s, most), min(sum(inertia.values()), most), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
         for c, s in inertia.items()],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    # At most one row per centroid.
    return done.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
