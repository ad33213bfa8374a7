"""Approximate largest inner products: stable projections to few dimensions, kd-trees, a chi-square stop.

Vectors get one more component that makes all norms equal, so the largest inner product is the least distance.
A few Gaussian projections then estimate distances: a projected squared distance over the true one is
chi-square distributed. The projected space is cut into cells by a kd-tree; each cell is an index of its own whose
kd-tree yields its vectors one after another in the order of their projected distance. They are verified exactly, until
a vector as near as the worst of the best found would be that far away in projection only with a small
probability. A query visits the cell it lies in first, and then, with the distance reached there, only cells that
the same test leaves open.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from wardspark.session import ship_package, stage

PROJECTIONS = 16
CONFIDENCE = 0.85     # probability with which a neighbour at the distance of the worst found isn't passed over
LEAF = 64             # vectors in a leaf of a cell's kd-tree
OPEN = 16             # leaves opened first; then twice as many each time
BATCH = 32            # vectors verified before the first stopping test; the batches double
MOST = 512            # up to this
BLOCK = 16_384        # vectors indexed together; a cell with more is cut by a hash of the id
CELLS = 4_096         # cells, at most
SAMPLE = 8_192        # vectors from which the cells' borders are taken, at most; all vectors are indexed
QUERY_BLOCK = 1_024   # queries that meet a block in one task
_SEED = 20240911


def chi_square_quantile(p: float, m: int) -> float:
    """Wilson and Hilferty's approximation, good to a few parts in a thousand."""
    low, high = -8.0, 8.0
    for _ in range(60):
        z = (low + high) / 2
        low, high = (z, high) if 0.5 * (1 + math.erf(z / math.sqrt(2))) < p else (low, z)
    return m * (1 - 2 / (9 * m) + low * math.sqrt(2 / (9 * m))) ** 3


def kd_leaves(points: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Row numbers of the leaves of a kd-tree that halves the widest dimension."""
    todo, leaves = [np.arange(len(points))], []
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            leaves.append(rows)
            continue
        part = points[rows]
        axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
        half = len(rows) // 2
        order = np.argpartition(part[:, axis], half)
        todo += [rows[order[:half]], rows[order[half:]]]
    return leaves


class Projection:
    """Vectors, made equal in norm, and queries in PROJECTIONS dimensions."""

    def __init__(self, width: int, bound: float):
        """``bound``: the greatest squared norm of all vectors of the table."""
        self.bound = bound
        self.directions = np.random.default_rng(_SEED).standard_normal((width + 1, PROJECTIONS))
        self.stop = chi_square_quantile(CONFIDENCE, PROJECTIONS)

    def vectors(self, vectors: np.ndarray) -> np.ndarray:
        extra = np.sqrt(np.maximum(self.bound - (vectors * vectors).sum(axis=1), 0))
        return vectors @ self.directions[:-1] + extra[:, None] * self.directions[-1]

    def queries(self, queries: np.ndarray) -> np.ndarray:
        return queries @ self.directions[:-1]

    def reach(self, norm: float, worst: float) -> float:
        """Projected squared distance beyond which a score of ``worst`` or more is unlikely; ``norm`` is the query's, squared."""
        return self.stop * max(norm + self.bound - 2 * worst, 0.0)


def box_distance(low: np.ndarray, high: np.ndarray, point: np.ndarray) -> np.ndarray:
    away = np.maximum(np.maximum(low - point, point - high), 0)
    return (away * away).sum(axis=1)


class Cells:
    """Borders of a kd-tree over a sample: inner node k has children 2k + 1 and 2k + 2, and the leaves are the cells."""

    def __init__(self, points: np.ndarray, levels: int):
        self.levels = levels
        self.axes, self.cuts = np.zeros((1 << levels) - 1, dtype=np.int64), np.zeros((1 << levels) - 1)
        held = {0: points}
        for node in range(len(self.axes)):
            part = held.pop(node)
            if len(part):
                self.axes[node] = axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
                self.cuts[node] = np.median(part[:, axis])
            right = part[:, self.axes[node]] >= self.cuts[node]
            held[2 * node + 1], held[2 * node + 2] = part[~right], part[right]

    def of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), dtype=np.int64)
        for _ in range(self.levels):
            node = 2 * node + 1 + (points[np.arange(len(points)), self.axes[node]] >= self.cuts[node])
        return node - ((1 << self.levels) - 1)


class Index:
    """The vectors of one block; ``verified`` counts the exact products that its searches took."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projection: Projection):
        self.projection, self.verified = projection, 0
        points = projection.vectors(vectors)
        leaves = kd_leaves(points, LEAF)
        order = np.concatenate(leaves)
        self.starts = np.concatenate(([0], np.cumsum([len(x) for x in leaves])))
        self.low = np.stack([points[x].min(axis=0) for x in leaves])
        self.high = np.stack([points[x].max(axis=0) for x in leaves])
        self.ids, self.vectors, self.points = ids[order], vectors[order], points[order]

    def neighbours(self, point: np.ndarray, reach: Callable[[], float] = lambda: np.inf) -> Iterator[tuple[float, np.ndarray]]:
        """Batches of rows in the order of their projected squared distance, each with the least of it.

        ``reach`` is the distance beyond which rows are no longer asked for; it never grows.
        """
        away = box_distance(self.low, self.high, point)
        order = np.argsort(away, kind="stable")
        held, rows, at, size, leaves = np.empty(0), np.empty(0, dtype=np.int64), 0, BATCH, OPEN
        while at < len(order) or len(held):
            edge = away[order[at]] if at < len(order) else np.inf
            if not len(held) and edge < np.inf and edge > reach():
                return
            ready = held <= edge
            if at < len(order) and np.count_nonzero(ready) < size:
                new = np.concatenate([np.arange(self.starts[k], self.starts[k + 1]) for k in order[at:at + leaves]])
                gap = self.points.take(new, axis=0) - point
                distances = np.einsum("ij,ij->i", gap, gap)
                wanted = distances <= reach()
                held, rows = np.concatenate((held, distances[wanted])), np.concatenate((rows, new[wanted]))
                at, leaves = at + leaves, 2 * leaves
                continue
            near, near_rows = held[ready], rows[ready]
            held, rows = held[~ready], rows[~ready]
            sort = np.argsort(near, kind="stable")
            first = 0
            while first < len(sort):
                part = sort[first:first + size]
                yield float(near[part[0]]), near_rows[part]
                first, size = first + size, min(2 * size, MOST)

    def search(self, own: int, query: np.ndarray, k: int, worst: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """The k best found: ids and scores, best first, equal scores by id; only those that reach ``worst``."""
        norm = float(query @ query)
        held, scores = np.empty(0, dtype=np.int64), np.empty(0)
        for distance, rows in self.neighbours(
            self.projection.queries(query[None])[0], lambda: self.projection.reach(norm, worst)
        ):
            if distance > self.projection.reach(norm, worst):
                break
            self.verified += len(rows)
            found = self.vectors.take(rows, axis=0) @ query
            # What may still be among the best, with room for rounding in equal scores.
            new = (found >= worst - 1e-9) & (self.ids[rows] != own)
            if not new.any():
                continue
            held, scores = np.concatenate((held, rows[new])), np.concatenate((scores, found[new]))
            if len(scores) >= k:
                worst = max(worst, float(np.partition(scores, -k)[-k]))
                near = scores >= worst - 1e-9
                held, scores = held[near], scores[near]
        if not len(held):
            return np.empty(0, np.int64), np.empty(0)
        exact = (self.vectors[held] * query).sum(axis=1)
        best = np.lexsort((self.ids[held], -exact))[:k]
        return self.ids[held][best], exact[best]


def usable(vector: Column) -> Column:
    """Not null, not zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


_FOUND = "query_id bigint, vec_id bigint, score double"


def _meet(placed: DataFrame, asking: DataFrame, sizes: dict[int, int], projection: Projection, k: int) -> DataFrame:
    """Matches of ``asking`` (query_id, v, worst, cell), each query searching its cell in ``placed`` (vec_id, v, cell).

    A cell is cut into parts of about BLOCK vectors and its queries into turns of about QUERY_BLOCK, so a hot
    cell is many tasks. ``sizes``: vectors by cell, CELLS at most.
    """
    spark = placed.sparkSession
    asked = {r["cell"]: r["count"] for r in asking.groupBy("cell").count().collect()}
    rows = [(c, -(-n // BLOCK), -(-asked[c] // QUERY_BLOCK)) for c, n in sizes.items() if c in asked]
    layout = F.broadcast(spark.createDataFrame(rows, "cell int, parts int, turns int"))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    stored = placed.join(layout, "cell").select(
        "vec_id", "v", "cell", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int").alias("part"), every("turns").alias("turn"))
    queries = asking.join(layout, "cell").select(
        "query_id", "v", "worst", "cell", F.pmod(F.xxhash64("query_id"), F.col("turns")).cast("int").alias("turn"), every("parts").alias("part"))

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": np.empty(0, np.int64), "vec_id": np.empty(0, np.int64), "score": np.empty(0)})]
        if len(left) and len(right):
            left = left.sort_values("vec_id")
            index = Index(left["vec_id"].to_numpy(), np.stack(left["v"].to_list()), projection)
            for own, query, worst in zip(right["query_id"], right["v"], right["worst"], strict=True):
                ids, scores = index.search(own, np.asarray(query), k, worst)
                out.append(pd.DataFrame({"query_id": np.full(len(ids), own), "vec_id": ids, "score": scores}))
        return pd.concat(out)

    keys = ("cell", "part", "turn")
    return stored.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(run, _FOUND)


def nearest(
    vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """The k nearest rows found for every row whose id is divisible by ``every``, by inner product.

    Returns query_id, rank (from 1), vec_id and score (in double precision), best first, ties to the smaller id;
    all candidates where there are fewer than k. Rows without an id, with an unusable vector or with another number
    of components than most usable rows take no part. Of rows equal in vector only the k + 1 of least id
    can be among the k best of any query, so no more are searched. A query id that repeats is asked once,
    with its least vector. Every other row is indexed. An empty table gives no rows.

    The cells' borders come from SAMPLE vectors of least id hash. This is a stated query set against all rows.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    clean = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    clean = stage(clean.where(F.col("vec_id").isNotNull() & usable(F.col("v"))), "vectors")
    width = clean.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if width is None:
        return spark.createDataFrame([], _FOUND).select("query_id", F.lit(0).alias("rank"), "vec_id", "score")
    clean = clean.where(F.size("v") == width["d"])
    alike = Window.partitionBy("v").orderBy("vec_id")
    kept = stage(clean.withColumn("_r", F.row_number().over(alike)).where(F.col("_r") <= k + 1).drop("_r"), "candidates")
    asked = clean.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("v").alias("v"))
    norm = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    many, bound = kept.agg(F.count("*"), F.max(norm)).first()
    projection = Projection(width["d"], bound)
    levels = min(max(0, math.ceil(math.log2(many / BLOCK))), CELLS.bit_length() - 1)
    sample = [r["v"] for r in kept.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()] if levels else []
    cells = Cells(projection.vectors(np.array(sample).reshape(-1, width["d"])), levels)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            points = projection.vectors(np.stack(frame["v"].to_list())) if len(frame) else np.empty((0, PROJECTIONS))
            yield frame.assign(p=list(points), cell=cells.of(points))

    placed = stage(kept.mapInPandas(place, "vec_id bigint, v array<double>, p array<double>, cell int"), "placed")
    ends = [f(F.get("p", F.lit(i))) for f in (F.min, F.max) for i in range(PROJECTIONS)]
    boxes = {r[0]: r for r in placed.groupBy("cell").agg(F.count("*"), *ends).collect()}
    names = np.array(sorted(boxes))
    low = np.array([boxes[c][2:2 + PROJECTIONS] for c in names])
    high = np.array([boxes[c][2 + PROJECTIONS:] for c in names])
    sizes = {c: r[1] for c, r in boxes.items()}
    placed = placed.drop("p")

    def home(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            points = [projection.queries(np.asarray(v)[None])[0] for v in frame["v"]]
            yield frame.assign(worst=-np.inf, cell=[names[np.argmin(box_distance(low, high, p))] for p in points])

    def others(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            open_ = []
            for v, worst, own in zip(frame["v"], frame["worst"], frame["cell"], strict=True):
                query = np.asarray(v)
                away = box_distance(low, high, projection.queries(query[None])[0])
                open_.append(names[(away <= projection.reach(float(query @ query), worst)) & (names != own)])
            yield frame.assign(cell=open_).explode("cell").dropna(subset="cell").astype({"cell": "int32"})

    schema = "query_id bigint, v array<double>, worst double, cell int"
    first = stage(asked.mapInPandas(home, schema), "queries")
    met = stage(_meet(placed, first, sizes, projection, k), "first-cell")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    if len(names) > 1:
        reached = ranked.where(F.col("rank") == k).select("query_id", F.col("score").alias("reached"))
        again = first.join(reached, "query_id", "left").select(
            "query_id", "v", F.coalesce("reached", "worst").alias("worst"), "cell")
        more = _meet(placed, stage(again.mapInPandas(others, schema), "open-cells"), sizes, projection, k)
        ranked = ranked.drop("rank").unionByName(more).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
