"""N-gram Jaccard join: a MinHash LSH forest proposes, exact verification decides.

Texts are sets of runs of WIDTH words. Each of TREES tries is the texts' DEPTH minimum hashes in sorted order: one
range-partitioned sort holds all tries, and the prefix a text shares with its neighbours in that order is its matched
prefix. Every text's prefixes are first shortened to the depth at which the tries together find a pair at the threshold
with probability RECALL. For texts that then have no candidate they are shortened level by level, until they have one or
until that probability is FULL. A trie node proposes its members by links to one of them, in a number of rows
linear in the members; inside a group of linked texts all pairs are then compared exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from wardspark.llm.common import Sieve, packed
from wardspark.llm.components import components
from wardspark.session import ship_package, stage

WIDTH = 5
THRESHOLD = 0.8
TREES = 32
DEPTH = 8
RECALL = 0.999    # of a pair at the threshold, for every text
FULL = 0.99999    # and for texts that would have no candidate otherwise
CELL = 512        # members of a group that are compared in one block; larger groups are a grid of blocks
PACK = 1500       # members of small groups handled together
PACK_BYTES = 24 << 20  # and their bytes of text; also those of a block's members
_CHUNK = 1 << 10  # shingles whose hashes are computed at once
_LEVEL = 2        # bytes of a minimum hash in a trie's key
_KEY = 1 + DEPTH * _LEVEL  # bytes of a key: the tree, then its hashes
_FIRST, _LAST = -1, -2     # marks of a sorted partition's first and last row
_RARE = 6         # shingles of up to so many texts of a block are counted pair by pair
_COLUMNS = 4096   # shingles in one product of matrices


def depth_for(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix at which one of ``trees`` tries holds a pair at ``threshold`` with probability ``recall``."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of ``width`` words; shorter texts are one run; none without words."""
    words = text.split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = pd.util.hash_array(np.array(words, dtype=object), categorize=False)
    width = min(width, len(words))
    with np.errstate(over="ignore"):
        runs = np.zeros(len(words) - width + 1, dtype=np.uint64)
        for k in range(width):
            runs = (runs ^ hashes[k:k + len(runs)]) * np.uint64(0x9E3779B97F4A7C15)
            runs ^= runs >> np.uint64(29)
    return np.unique(runs)


class Forest:
    def __init__(self, trees: int = TREES, depth: int = DEPTH):
        draw = np.random.default_rng(20240607)
        self.trees, self.depth = trees, depth
        self.factors = draw.integers(1, 1 << 63, trees * depth, dtype=np.uint64) | np.uint64(1)

    def keys(self, runs: np.ndarray) -> np.ndarray:
        """The set's place in every trie, one row of bytes each: the tree, then ``depth`` minimum hashes of two bytes."""
        least = np.full(len(self.factors), np.iinfo(np.uint64).max)
        small = runs ^ (runs >> np.uint64(31))
        with np.errstate(over="ignore"):
            for at in range(0, len(runs), _CHUNK):
                np.minimum(least, (self.factors[:, None] * small[None, at:at + _CHUNK]).min(axis=1), out=least)
            # A minimum is a small number; a product spreads it before it is cut to two bytes.
            short = ((least >> np.uint64(32)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
        out = np.empty((self.trees, 1 + self.depth * _LEVEL), dtype=np.uint8)
        out[:, 0] = np.arange(self.trees)
        out[:, 1:] = short.astype(">u2").view(np.uint8).reshape(self.trees, -1)
        return out


def _keys(docs: DataFrame) -> DataFrame:
    """doc_id, text hash, bytes and the keys in all tries end to end (null for texts without words) of every row."""
    source = docs.select("text", "doc_id", F.md5("text").alias("hash"), F.octet_length("text").cast("long").alias("bytes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            keys = []
            for text in batch.column(0):
                runs = shingles(text.as_py() or "")
                keys.append(forest.keys(runs).tobytes() if len(runs) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), batch.column(3), pa.array(keys, pa.binary())],
                names=["doc_id", "hash", "bytes", "keys"],
            )

    return source.mapInArrow(run, "doc_id bigint, hash string, bytes bigint, keys binary")


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    """A column of binary values of one width as rows of bytes."""
    fixed = column.cast(pa.binary(width))
    held = np.frombuffer(fixed.buffers()[1], dtype=np.uint8)
    return held[fixed.offset * width:(fixed.offset + len(fixed)) * width].reshape(-1, width)


def _walk(batches: Iterator[pa.RecordBatch], depth: int, shortest: int) -> Iterator[pa.RecordBatch]:
    """Links between neighbours of one sorted partition of (key, vertex), by the length of their common prefix.

    Rows that agree in ``depth`` levels are linked to the least vertex of their run inside a batch, and runs that go on
    in the next batch by one link. Neighbours that agree in fewer levels, but ``shortest`` or more, are linked, with
    the later one's key. The partition's first and last row are given with their keys, to meet those of the
    partitions beside it.
    """
    place = TaskContext.get().partitionId()

    def out(a: pa.Array, b: pa.Array, levels: pa.Array, node: pa.Array) -> pa.RecordBatch:
        parts = pa.array(np.full(len(a), place, dtype=np.int32))
        return pa.RecordBatch.from_arrays([a, b, levels.cast(pa.int32()), node, parts], names=["a", "b", "depth", "node", "part"])

    def border(vertex: bytes, key: bytes, mark: int) -> pa.RecordBatch:
        return out(pa.array([vertex]), pa.array([None], pa.binary()), pa.array([mark]), pa.array([key]))

    key = vertex = lead = None  # of the last row, and the least vertex of its run
    for batch in batches:
        if not batch.num_rows:
            continue
        held, vertices = batch.column(0), batch.column(1)
        keys, ids = _bytes(held, _KEY), _bytes(vertices, 16)
        if vertex is None:
            yield border(vertices[0].as_py(), held[0].as_py(), _FIRST)
        same = keys == np.vstack([keys[:1] if vertex is None else key, keys[:-1]])
        levels = np.column_stack([same[:, 0], *[same[:, k:k + _LEVEL].all(axis=1) for k in range(1, _KEY, _LEVEL)]])
        common = np.logical_and.accumulate(levels, axis=1).sum(axis=1) - 1
        if vertex is None:
            common[0] = -1
        near = common >= depth
        run = np.cumsum(~near)
        run -= run[0]
        order = np.lexsort((np.ascontiguousarray(ids[:, :8]).view(">u8")[:, 0].astype(np.uint64), run))
        leads = order[np.r_[True, run[order][1:] != run[order][:-1]]]
        linked = np.flatnonzero(leads[run] != np.arange(len(run)))
        yield out(
            vertices.take(pa.array(linked)), vertices.take(pa.array(leads[run[linked]])),
            pa.array(np.full(len(linked), depth)), pa.nulls(len(linked), pa.binary()),
        )
        if near[0]:
            yield out(vertices.take(pa.array(leads[:1])), pa.array([lead]), pa.array([depth]), pa.nulls(1, pa.binary()))
        short = np.flatnonzero((common >= shortest) & ~near)
        earlier = pa.concat_arrays([pa.array([vertex], vertices.type), vertices.slice(0, len(run) - 1)])
        yield out(vertices.take(pa.array(short)), earlier.take(pa.array(short)), pa.array(common[short]), held.take(pa.array(short)))
        if run[-1] or not near[0]:
            lead = vertices[int(leads[-1])].as_py()
        key, vertex = keys[-1:].copy(), vertices[-1].as_py()
    if vertex is not None:
        yield border(vertex, key.tobytes(), _LAST)


def _proposals(texts: DataFrame) -> DataFrame:
    """Links (a, b) of text hashes that connect the members of the trie nodes which propose candidates."""
    depth, shortest = depth_for(), depth_for(recall=FULL)
    places = texts.where("keys is not null").select(
        F.unhex("hash").alias("vertex"), "keys", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree")
    ).select(F.substring("keys", F.col("tree") * _KEY + 1, F.lit(_KEY)).alias("key"), "vertex")
    # The vertex is part of the order, so that a node of any size is spread over partitions.
    ordered = places.repartitionByRange("key", "vertex").sortWithinPartitions("key", "vertex")
    links = stage(
        ordered.mapInArrow(
            lambda batches: _walk(batches, depth, shortest), "a binary, b binary, depth int, node binary, part int"
        ),
        "jaccard-prefixes",
    )
    # Two rows per partition meet in one task: the last row of one and the first of the next.
    beside = Window.orderBy("part", F.desc("depth"))
    prefix = lambda column, level: F.substring(column, 1, 1 + level * _LEVEL)
    common = sum(
        (prefix("node", level) == prefix("other", level)).cast("int") for level in range(1, DEPTH + 1)
    )
    borders = links.where(F.col("depth") < 0).select(
        "a", F.lag("a").over(beside).alias("b"), "depth", "node", F.lag("node").over(beside).alias("other")
    ).where((F.col("depth") == _FIRST) & F.col("b").isNotNull()).select("a", "b", common.alias("depth"), "node")
    links = links.where(F.col("depth") >= shortest).select("a", "b", "depth", "node").union(borders)
    kept = stage(links.where(F.col("depth") >= depth).select("a", "b").distinct(), "jaccard-star")
    for level in range(depth - 1, shortest - 1, -1):
        here = links.where((F.col("depth") >= level) & (F.col("depth") < depth)).withColumn("node", prefix("node", level))
        ends = here.select("node", F.col("a").alias("vertex")).union(here.select("node", F.col("b").alias("vertex")))
        matched = kept.select(F.col("a").alias("vertex")).union(kept.select("b")).distinct()
        # Nodes that hold a text without a candidate propose all their members.
        wanted = ends.join(matched, "vertex", "left_anti").select("node").distinct()
        kept = stage(kept.union(here.join(wanted, "node", "left_semi").select("a", "b")).distinct(), "jaccard-star")
    return kept.select(F.lower(F.hex("a")).alias("a"), F.lower(F.hex("b")).alias("b"))


def _shared(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of common shingles of every set of ``left`` with every set of ``right``, exactly.

    Shingles of many sets are counted by products of 0/1 matrices, the others pair by pair of their holders.
    """
    n, shared = len(sets), np.zeros((len(sets), len(sets)), dtype=np.int64)
    held = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(held, kind="stable")
    held, owner = held[order], owner[order]
    starts = np.flatnonzero(np.r_[True, held[1:] != held[:-1]])
    sizes = np.diff(np.r_[starts, len(held)])
    many = np.flatnonzero(sizes > _RARE)
    for at in range(0, len(many), _COLUMNS):
        part = many[at:at + _COLUMNS]
        places = np.concatenate([np.arange(a, a + k) for a, k in zip(starts[part].tolist(), sizes[part].tolist())])
        has = np.zeros((n, len(part)), dtype=np.float32)
        has[owner[places], np.repeat(np.arange(len(part)), sizes[part])] = 1
        shared[np.ix_(left, right)] += (has[left] @ has[right].T).astype(np.int64)
    for k in range(2, _RARE + 1):
        first = starts[sizes == k]
        for i in range(k):
            for j in range(i):
                # Holders of a shingle come in order, as the sort is stable.
                for at in range(0, len(first), 1 << 20):
                    own = first[at:at + (1 << 20)]
                    pairs = np.bincount(owner[own + j] * n + owner[own + i], minlength=n * n).reshape(n, n)
                    shared += pairs + pairs.T
    return shared[np.ix_(left, right)]


def _verify(group: pd.DataFrame) -> Iterator[tuple[str, int, str]]:
    """Links of one block of a group: (text hash, linked rows, a linked text of lower place) per member.

    All pairs of the block are compared, whether they share a node or not.
    """
    group = group.drop_duplicates("hash").sort_values("hash", ignore_index=True)
    n = len(group)
    sets = [shingles(t) for t in group["text"]]
    copies, names = group["copies"].to_numpy(), group["hash"].tolist()
    left = right = np.arange(n)
    if group["split"].iloc[0]:  # off the grid's diagonal only pairs across the two sides
        side = group["side"].to_numpy()
        left, right = np.flatnonzero(side == side[0]), np.flatnonzero(side != side[0])
    lengths = np.array([len(s) for s in sets])
    shared = _shared(sets, left, right)
    near = np.zeros((n, n), dtype=bool)
    near[np.ix_(left, right)] = shared >= THRESHOLD * (lengths[left][:, None] + lengths[right] - shared) - 1e-9
    near |= near.T
    np.fill_diagonal(near, False)
    linked, least = near @ copies, np.full(n, -1)
    for i in range(n):
        if least[i] >= 0:
            continue
        least[i], todo = i, np.array([i])
        while len(todo):
            todo = np.flatnonzero(near[todo].any(axis=0) & (least < 0))
            least[todo] = i
    for i, name in enumerate(names):
        yield name, int(linked[i]), names[least[i]]


def _blocks(frame: pd.DataFrame) -> pd.DataFrame:
    out = [row for _, block in frame.groupby("block", sort=False) for row in _verify(block)]
    return pd.DataFrame(out, columns=["hash", "links", "other"])


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, texts): each row's doc_id and text hash, and each distinct text's class and number of linked rows.

    Rows equal in text are one text. Texts with words are compared as above; texts without words are linked
    only to equal texts, and null texts to nothing. A class is a connected component of links of
    similarity THRESHOLD or more; class_id is its least doc_id.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = stage(_keys(docs), "jaccard-rows")
    texts = stage(
        rows.where("hash is not null").groupBy("hash").agg(
            F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), F.first("bytes").alias("bytes"),
            F.first("keys").alias("keys"),
        ),
        "jaccard-texts",
    )
    groups = components(_proposals(texts))
    held = groups.join(texts.drop("keys").withColumnRenamed("hash", "vertex"), "vertex")
    sizes = groups.join(texts.select(F.col("hash").alias("vertex"), "bytes"), "vertex").groupBy("root").agg(
        F.count("*").alias("size"), F.sum("bytes").alias("group_bytes")
    )
    members = stage(held.join(stage(sizes, "jaccard-sizes"), "root"), "jaccard-members")
    total, weight = members.agg(F.count("*"), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    # Blocks: small groups are one block; a larger one is cut into parts, and each two parts are one block.
    parts = F.greatest(F.ceil(F.col("size") / CELL), F.ceil(F.col("group_bytes") / PACK_BYTES)).cast("int")
    part = F.pmod(F.xxhash64("vertex"), parts).cast("int")
    grid = F.when(parts <= 1, F.array(F.struct(F.lit(0).alias("low"), F.lit(0).alias("high")))).otherwise(
        F.transform(
            F.sequence(F.lit(0), parts - 1),
            lambda other: F.struct(F.least(other, part).alias("low"), F.greatest(other, part).alias("high")),
        )
    )
    wanted = members.select(
        "vertex", "first_id", "copies", "root", (parts > 1).alias("grid"), part.alias("side"), grid.alias("cells")
    )
    # Only texts of members take part in the join by which they meet their group.
    rows_of = docs.select("doc_id", "text").withColumn("vertex", F.md5("text"))
    rows_of = Sieve(wanted, "vertex", "jaccard-members").mark(rows_of, F.col("vertex")).where("_maybe").drop("_maybe")
    with_text = rows_of.join(
        wanted.withColumnRenamed("vertex", "_vertex"),
        (F.col("vertex") == F.col("_vertex")) & F.col("doc_id").eqNullSafe(F.col("first_id")),
    )
    packs = max(1, -(-total // PACK), -(-weight // PACK_BYTES))
    cells = with_text.select(
        F.col("vertex").alias("hash"), "text", "copies", "root", "grid", "side", F.explode("cells").alias("cell")
    ).select(
        "hash", "text", "copies", "side",
        (F.col("grid") & (F.col("cell.low") != F.col("cell.high"))).alias("split"),
        F.concat_ws(":", "root", "cell.low", "cell.high").alias("block"),
        F.when(F.col("grid"), F.xxhash64("root", "cell.low", "cell.high"))
        .otherwise(F.pmod(F.xxhash64("root"), F.lit(packs))).alias("pack"),
    )
    found = stage(
        cells.groupBy("pack").applyInPandas(_blocks, "hash string, links bigint, other string"), "jaccard-links"
    )
    joined = components(found.select(F.col("hash").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy("hash").agg(F.sum("links").alias("links"))
    per_text = texts.select("hash", "first_id", "copies").join(counts, "hash", "left").join(
        joined.withColumnRenamed("vertex", "hash"), "hash", "left"
    ).select("hash", "first_id", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "hash").alias("root"))
    named = stage(per_text, "jaccard-classes")
    least = named.groupBy("root").agg(F.min("first_id").alias("class_id"))
    return rows, stage(named.join(stage(least, "jaccard-least"), "root"), "jaccard-labels")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Class and number of links of every row: doc_id, class_id, copy_of, n_links.

    copy_of is the least doc_id of the rows with the same text, class_id that of all texts linked directly or
    through others, n_links the number of other rows whose text is equal or has similarity THRESHOLD or
    more. Null texts are their own class and have no links; a null doc_id stays null, also as a class when
    its texts have no other id; repeated rows count as copies; an empty table gives no rows.
    """
    rows, texts = classes(docs)
    joined = rows.select("doc_id", "hash").join(texts, "hash", "left")
    return joined.select(
        "doc_id",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("first_id")).alias("copy_of"),
        F.coalesce(F.col("copies") - 1 + F.col("links"), F.lit(0)).alias("n_links"),
    )


def distinct_documents(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` per class, the one of least doc_id; rows with null text all stay.

    Rows are matched by doc_id and text hash, which also tells rows of the same id apart; of rows equal in both, any
    one stays.
    """
    _, texts = classes(docs)
    first = F.min(F.struct(F.col("first_id").isNull().alias("none"), "first_id", "hash")).alias("first")
    several = texts.groupBy("root").agg(first, F.sum("copies").alias("rows")).where("rows > 1")
    # Of these texts one row stays per class; all other rows are alone and stay as they are.
    judged = stage(
        texts.join(stage(several, "jaccard-several"), "root").select(
            F.col("hash").alias("_hash"), (F.col("hash") == F.col("first.hash")).alias("_leads"), F.col("first.first_id").alias("_first"),
        ),
        "jaccard-judged",
    )
    keyed = docs.select(packed(docs), F.col("doc_id").alias("_id"), F.md5("text").alias("_text_hash"))
    marked = Sieve(judged, "_hash", "jaccard-judged").mark(keyed, F.col("_text_hash"))
    met = marked.where("_maybe").join(judged, F.col("_text_hash") == F.col("_hash"), "left")
    alone = marked.where("not _maybe").select("_row").union(met.where("_hash is null").select("_row"))
    kept = met.where(F.col("_leads") & F.col("_id").eqNullSafe(F.col("_first"))).dropDuplicates(["_hash"])
    return alone.union(kept.select("_row")).select("_row.*")
