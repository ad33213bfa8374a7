"""Phrase collocations by direct-address tiling of word pairs.

Words get ids by falling frequency. A pair of ids is a cell of a matrix: its upper corner, the frequent words, is cut into
tiles that are counted in dense arrays by their address; the wide rest is dealt into parts and counted as sorted
coordinate lists. Frequent pairs are ranked as ids of their own, written over the text in place of the words, and
counted by the same step: two overlapping pairs are a triple, two side by side a run of four.

Texts are coded once, in blocks; what moves between tasks are ids, and cells counted per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from wardspark.llm.common import Sieve, numbered, text_of
from wardspark.session import ship_package, stage

LEAST = 30                # occurrences of a candidate
TOP = 2000
COVERED = 80              # per cent of a phrase's occurrences that a longer one explains
SCALE = 2_000_000         # of a score
BLOCK_BYTES = 4 << 20     # text of one language that is coded together, about
HELD_BYTES = 32 << 20     # of all languages that wait in a task
TILE = 1024               # ids on a side of a dense tile, at most
GRID = 16                 # dense tiles on a side of the matrix
PART_PAIRS = 1 << 21      # occurrences in a part of the sparse rest, about
LEAST_PARTS = 64
FILTER_BITS = 27          # at most 16 MB of bitmap
_FOLD = bytes.maketrans(
    bytes(range(65, 91)) + b".,;:!?\n\x0b\x0c\r\t", bytes(range(97, 123)) + b"\xff" * 10 + b" "
)  # the byte 255 is in no UTF-8 text


# ---- blocks of coded texts ----------------------------------------------------------------------------------

def _coded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all words in order, -1 between pieces; the words by id; their counts."""
    words = b"\xff".join(texts).translate(_FOLD).replace(b"\xff", b" \xff ").split()
    codes, names = pd.factorize(np.array([b"\xff", *words], dtype=object))
    return codes[1:].astype(np.int32) - 1, names[1:], np.bincount(codes, minlength=len(names))[1:]


def blocks(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """block, lang, n (words), ids (int32, squeezed), words and counts. A text is never divided."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, waiting, sizes, total = TaskContext.get().partitionId() << 33, {}, {}, 0

        def flush(lang: str) -> pa.RecordBatch:
            nonlocal number, total
            ids, names, counts = _coded(waiting.pop(lang))
            total -= sizes.pop(lang)
            number += 1
            return pa.RecordBatch.from_arrays([
                pa.array([number]), pa.array([lang]), pa.array([int(counts.sum())]), pa.array([_squeezed(ids)], pa.binary()),
                pa.array([list(names)], pa.list_(pa.binary())).cast(pa.list_(pa.string())), pa.array([counts.tolist()], pa.list_(pa.int32())),
            ], names=["block", "lang", "n", "ids", "words", "counts"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                whole = text.as_py()
                waiting.setdefault(lang, []).append(whole)
                sizes[lang] = sizes.get(lang, 0) + len(whole) + 1
                total += len(whole) + 1
                if sizes[lang] >= BLOCK_BYTES:
                    yield flush(lang)
                elif total >= HELD_BYTES:
                    yield flush(max(sizes, key=sizes.get))
        for lang in list(waiting):
            yield flush(lang)

    source = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), text_of(text_col).alias("text"))
    return source.mapInArrow(run, "block bigint, lang string, n bigint, ids binary, words array<string>, counts array<int>")


def _squeezed(values: np.ndarray) -> bytes:
    """Integers by byte planes, which compress well where most are small."""
    planes = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), -1).T) if len(values) else values
    raw = planes.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _expanded(data: bytes, kind: type) -> np.ndarray:
    raw = pa.decompress(data[8:], decompressed_size=int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, -1).T).ravel().view(kind)


def word_sequences(held: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """block, seq: every block's words as ids of ``vocabulary`` (id, lang, phrase), -1 for all others.

    A block asks once for each of its distinct words that may be in the vocabulary; its answers meet in one task, as
    many as it has words at most.
    """
    known = vocabulary.select("id", F.col("lang").alias("_lang"), F.col("phrase").alias("_word"), F.xxhash64("lang", "phrase").alias("h"))
    asked = held.select("block", "lang", F.posexplode("words").alias("key", "word"))
    asked = Sieve(known, "h", "phrase-words").mark(asked, F.xxhash64("lang", "word")).where("_maybe")
    found = asked.join(known, (F.col("lang") == F.col("_lang")) & (F.col("word") == F.col("_word")))
    answers = found.groupBy("block").agg(F.collect_list(F.struct("key", "id")).alias("answers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, codes, answer in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                old, new = answer.values.field("key").to_numpy(), answer.values.field("id").to_numpy()
                codes = _expanded(codes.as_py(), np.int32)
                names = np.full(codes.max(initial=0) + 2, -1, dtype=np.int32)  # the last place stands for a break
                names[old] = new
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number.as_py()]), pa.array([_squeezed(names[codes])], pa.binary())], names=["block", "seq"]
                )

    return held.select("block", "ids").join(answers, "block").select("block", "ids", "answers").mapInArrow(run, "block bigint, seq binary")


def _pairs(seq: np.ndarray, step: int = 1) -> np.ndarray:
    """The key of each position's pair with the one ``step`` on, both ids in one number; -1 where one of them or of
    those between has no id."""
    wide = seq.astype(np.int64)
    key = np.full(len(wide), -1, dtype=np.int64)
    left, right = wide[:-step], wide[step:]
    whole = (left >= 0) & (right >= 0)
    if step == 2:
        whole &= wide[1:-1] >= 0
    key[:len(left)][whole] = (left[whole] << 32) | right[whole]
    return key


# ---- pairs as ids -------------------------------------------------------------------------------------------

def _spread(keys: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(29))


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    return ((_spread(keys) >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)


def _bitmap(keys: DataFrame, bits: int) -> bytes:
    """2^bits bits, of which those of all keys are set: at most 2^FILTER_BITS, 16 MB, on the driver and in tasks."""

    def spots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spot = (_spread(batch.column(0).to_numpy()) >> np.uint64(64 - bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(spot >> 15), pa.array(spot & 0x7FFF)], names=["page", "bit"])

    pages = keys.select("key").mapInArrow(spots, "page bigint, bit bigint").groupBy("page").agg(F.bitmap_construct_agg("bit").alias("map"))
    whole = bytearray((1 << bits) // 8)
    for row in pages.toLocalIterator():
        whole[row.page << 12:(row.page + 1) << 12] = row.map
    return bytes(whole)


def pair_sequences(seqs: DataFrame, pairs: DataFrame, many: int) -> DataFrame:
    """block, seq: every position under the id of its pair with the next, -1 where the pair has none in ``pairs`` (key, id).

    A block asks for its distinct pairs that a bitmap lets pass, in one row per part of the key space. The rows of a part are
    sorted behind the part's own pairs and answered one after another, so a task holds one part's pairs and one
    block's question, whatever number of blocks asks.
    """
    bits = min(FILTER_BITS, max(15, (many * 16).bit_length()))
    parts = max(LEAST_PARTS, many // PART_PAIRS)
    held = seqs.sparkSession.sparkContext.broadcast(_bitmap(pairs, bits))

    def asked(seq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct keys that may be known, and the number of them in each part, by part."""
        keys = np.unique(_pairs(seq))
        keys = keys[np.searchsorted(keys, 0):]
        spot = (_spread(keys) >> np.uint64(64 - bits)).astype(np.int64)
        keys = keys[(np.frombuffer(held.value, np.uint8)[spot >> 3] >> (spot & 7)) & 1 == 1]
        part = _part(keys, parts)
        return keys[np.argsort(part, kind="stable")], np.bincount(part, minlength=parts)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, seq in zip(batch.column(0), batch.column(1), strict=True):
                keys, sizes = asked(_expanded(seq.as_py(), np.int32))
                at = np.flatnonzero(sizes)
                own = np.split(keys, np.cumsum(sizes[at])[:-1]) if len(at) else []
                yield _lines(at, 1, number.as_py(), [_squeezed(np.diff(k, prepend=0)) for k in own], [b""] * len(at))

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = pa.array(_part(batch.column(0).to_numpy(), parts))
            yield pa.RecordBatch.from_arrays([part, *batch.columns], names=["part", "key", "id"])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        keys, ids = table["key"].to_numpy(), table["id"].to_numpy()
        order = np.argsort(keys)
        yield _lines(np.array([table["part"][0].as_py()]), 0, -1, [_squeezed(keys[order])], [_squeezed(ids[order])])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, keys, ids = -1, None, None
        for batch in batches:
            out = []
            for one, kind, block, cell, names in zip(*batch.columns, strict=True):
                if kind.as_py() == 0:
                    part, keys, ids = one.as_py(), _expanded(cell.as_py(), np.int64), _expanded(names.as_py(), np.int64)
                elif part == one.as_py():  # no answer where a part has no pairs
                    question = np.cumsum(_expanded(cell.as_py(), np.int64))
                    at = np.minimum(np.searchsorted(keys, question), len(keys) - 1)
                    out.append((block.as_py(), part, _squeezed(np.where(keys[at] == question, ids[at], -1).astype(np.int32))))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.binary())],
                names=["block", "part", "ids"],
            )

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, seq, answers in zip(batch.column(0), batch.column(1), batch.column(2), strict=True):
                seq = _expanded(seq.as_py(), np.int32)
                keys, sizes = asked(seq)
                ends = np.cumsum(sizes)
                ids = np.full(len(keys) + 1, -1, dtype=np.int32)
                for x in answers.as_py():
                    ids[ends[x["part"]] - sizes[x["part"]]:ends[x["part"]]] = _expanded(x["ids"], np.int32)
                order = np.argsort(keys)
                keys, ids = np.append(keys[order], np.iinfo(np.int64).max), np.append(ids[order], np.int32(-1))
                own = _pairs(seq)
                at = np.searchsorted(keys, own)
                fresh = np.where(keys[at] == own, ids[at], np.int32(-1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array([number.as_py()]), pa.array([_squeezed(fresh)], pa.binary())], names=["block", "seq"])

    lines = "part bigint, kind int, block bigint, cells binary, ids binary"
    known = pairs.select("key", "id").mapInArrow(dealt, "part bigint, key bigint, id bigint")
    rows = known.groupBy("part").applyInArrow(gathered, lines).unionAll(seqs.select("block", "seq").mapInArrow(ask, lines))
    answered = rows.repartition("part").sortWithinPartitions("part", "kind").mapInArrow(answer, "block bigint, part bigint, ids binary")
    per_block = answered.groupBy("block").agg(F.collect_list(F.struct("part", "ids")).alias("answers"))
    return seqs.join(per_block, "block").select("block", "seq", "answers").mapInArrow(rewrite, "block bigint, seq binary")


def _lines(parts: np.ndarray, kind: int, block: int, cells: list[bytes], ids: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array(parts, pa.int64()), pa.array(np.full(len(parts), kind), pa.int32()), pa.array(np.full(len(parts), block), pa.int64()),
        pa.array(cells, pa.binary()), pa.array(ids, pa.binary()),
    ], names=["part", "kind", "block", "cells", "ids"])


# ---- counting by tiles --------------------------------------------------------------------------------------

class Tiles:
    """Which tile counts a pair, and how: GRID x GRID dense tiles by address, ``parts`` sparse ones by a hash."""

    def __init__(self, ids: int, pairs: int):
        self.side = min(TILE, max(64, 1 << (max(1, ids) // GRID).bit_length()))
        self.parts = max(LEAST_PARTS, pairs // PART_PAIRS)

    def of(self, keys: np.ndarray) -> np.ndarray:
        left, right = (keys >> 32) // self.side, (keys & 0xFFFFFFFF) // self.side
        return np.where((left < GRID) & (right < GRID), left * GRID + right, GRID * GRID + _part(keys, self.parts))

    def address(self, keys: np.ndarray) -> np.ndarray:
        """The place of keys inside their dense tile."""
        return ((keys >> 32) % self.side) * self.side + (keys & 0xFFFFFFFF) % self.side

    def key(self, tile: int, address: np.ndarray) -> np.ndarray:
        left = (tile // GRID) * self.side + address // self.side
        return (left << 32) | ((tile % GRID) * self.side + address % self.side)

    def counted(self, keys: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(tile, cells, counts) of one block: full tiles as dense arrays, all others as one sorted list."""
        tile = self.of(keys)
        full = np.flatnonzero(np.bincount(tile, minlength=GRID * GRID)[:GRID * GRID] >= self.side * self.side // 4)
        for one in full.tolist():
            here = tile == one
            table = np.bincount(self.address(keys[here]), minlength=self.side * self.side)
            cells = np.flatnonzero(table)
            yield one, cells, table[cells]
            keys, tile = keys[~here], tile[~here]
        cells, counts = np.unique(keys, return_counts=True)
        tile = self.of(cells)
        order = np.argsort(tile, kind="stable")
        ends = np.flatnonzero(np.diff(tile[order], append=-1)) + 1
        for rows in np.split(order, ends[:-1]):
            if len(rows):
                one = int(tile[rows[0]])
                yield one, (self.address(cells[rows]) if one < GRID * GRID else cells[rows]), counts[rows]


def _summed(cells: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sorted coordinates with their counts added up."""
    key, number = np.concatenate(cells), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, number = key[order], number[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    return [key[starts]], [np.add.reduceat(number, starts)]


def frequent_pairs(seqs: DataFrame, tiles: Tiles, least: int, steps: tuple[int, ...] = (1,)) -> DataFrame:
    """step, key, a: pairs of ids ``step`` apart with at least ``least`` occurrences.

    Each block sends one row per tile it touches, with a cell no more than once. A dense tile needs one array, whatever
    number of blocks it adds; a sparse part holds its own distinct pairs.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for seq in batch.column(0):
                seq = _expanded(seq.as_py(), np.int32)
                for step in steps:
                    keys = _pairs(seq, step)
                    found = list(tiles.counted(keys[keys >= 0]))
                    # Cells as differences; where all counts are one they are left out.
                    cells = [_squeezed(np.diff(c, prepend=0)) for _, c, _ in found]
                    counts = [_squeezed(n.astype(np.uint32)) if n.max() > 1 else b"" for _, _, n in found]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([step] * len(found), pa.int32()), pa.array([t for t, _, _ in found], pa.int64()),
                         pa.array(cells, pa.binary()), pa.array(counts, pa.binary())],
                        names=["step", "tile", "cells", "counts"],
                    )

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, tile, table, held, sums, size = 0, -1, None, [], [], 0
        for batch in batches:
            for apart, one, cell, count in zip(*batch.columns, strict=True):
                step, tile = apart.as_py(), one.as_py()
                cells = np.cumsum(_expanded(cell.as_py(), np.int64))
                counts = _expanded(count.as_py(), np.uint32).astype(np.int64) if count.as_py() else np.ones(len(cells), np.int64)
                if tile < GRID * GRID:
                    table = np.zeros(tiles.side * tiles.side, dtype=np.int64) if table is None else table
                    table[cells] += counts
                    continue
                held.append(cells)
                sums.append(counts)
                size += len(cells)
                if size > max(PART_PAIRS, 2 * len(held[0])):
                    held, sums = _summed(held, sums)
                    size = len(held[0])
        if table is not None:
            at = np.flatnonzero(table >= least)
            keys, totals = tiles.key(tile, at), table[at]
        else:
            held, sums = _summed(held, sums)
            keys, totals = held[0][sums[0] >= least], sums[0][sums[0] >= least]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(keys), step), pa.int32()), pa.array(keys, pa.int64()), pa.array(totals, pa.int64())], names=["step", "key", "a"]
        )

    cells = seqs.select("seq").mapInArrow(count, "step int, tile bigint, cells binary, counts binary")
    return cells.groupBy("step", "tile").applyInArrow(merge, "step int, key bigint, a bigint")


# ---- phrases ------------------------------------------------------------------------------------------------

def _sides(pairs: DataFrame) -> DataFrame:
    return pairs.select("key", "a", F.shiftright("key", 32).alias("l"), F.col("key").bitwiseAND(F.lit(0xFFFFFFFF)).alias("r"))


def _named(level: DataFrame, prefix: str) -> DataFrame:
    return level.select(*[F.col(c).alias(f"{prefix}_{c}") for c in level.columns])


def _of(left: Column, right: Column) -> Column:
    return F.shiftleft(left, 32).bitwiseOR(right)


def _cut(k: int, left: str, right: str) -> Column:
    """Score of cutting after k words, with the cut and its counts, to compare by score, then by k."""
    score = F.expr(f"{SCALE}BD * cast(a as decimal(20,0)) div (cast({left} as decimal(20,0)) + cast({right} as decimal(20,0)))")
    return F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(left).alias("l"), F.col(right).alias("r"))


def ranked_pairs(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Frequent pairs of words, as ids of their own by falling frequency."""
    both = _sides(pairs).join(_named(words, "l"), F.col("l") == F.col("l_id")).join(_named(words, "r"), F.col("r") == F.col("r_id")).select(
        "key", "l", "r", F.col("l_lang").alias("lang"), F.concat_ws(" ", "l_phrase", "r_phrase").alias("phrase"), "a",
        F.col("l_a").alias("first_a"), F.col("r_a").alias("last_a"), F.col("r_phrase").alias("last"),
    )
    return numbered(stage(both, "phrases"), [F.desc("a"), F.asc("l"), F.asc("r")], "id")


def _triples(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """A triple is a pair and the pair that overlaps it by a word."""
    joined = _sides(found).join(_named(pairs, "l"), F.col("l") == F.col("l_id")).join(_named(pairs, "r"), F.col("r") == F.col("r_id"))
    return joined.select(
        "key", "l", "r", F.col("l_lang").alias("lang"), F.concat_ws(" ", "l_phrase", "r_last").alias("phrase"), "a",
        F.col("l_first_a").alias("first_a"), F.col("r_a").alias("right_a"), F.col("l_a").alias("left_a"), F.col("r_last_a").alias("last_a"),
    )


def _quads(found: DataFrame, pairs: DataFrame, triples: DataFrame) -> DataFrame:
    """Four words are two pairs side by side; the pair between them leads to the two triples inside."""
    joined = _sides(found).join(_named(pairs, "l"), F.col("l") == F.col("l_id")).join(_named(pairs, "r"), F.col("r") == F.col("r_id"))
    middle = pairs.select(F.col("key").alias("m_key"), F.col("id").alias("m_id"))
    joined = joined.join(middle, _of(F.col("l_r"), F.col("r_l")) == F.col("m_key"))
    first = triples.select(F.col("key").alias("f_key"), F.col("a").alias("f_a"))
    second = triples.select(F.col("key").alias("s_key"), F.col("a").alias("s_a"))
    joined = joined.join(first, _of(F.col("l"), F.col("m_id")) == F.col("f_key")).join(second, _of(F.col("m_id"), F.col("r")) == F.col("s_key"))
    return joined.select(
        "f_key", "s_key", F.col("l_lang").alias("lang"), F.concat_ws(" ", "l_phrase", "r_phrase").alias("phrase"), "a",
        F.col("l_first_a").alias("first_a"), F.col("s_a").alias("right_a"), F.col("l_a").alias("head_a"), F.col("r_a").alias("tail_a"),
        F.col("f_a").alias("left_a"), F.col("r_last_a").alias("last_a"),
    )


def _uncovered(level: DataFrame, own: str, longer: DataFrame, ends: tuple[str, str]) -> DataFrame:
    """Phrases that no phrase one word longer explains. Where a still longer one does, so does the one of next
    length inside it, as that is at least as frequent."""
    above = longer.select(F.col(ends[0]).alias("_part"), "a").unionAll(longer.select(F.col(ends[1]).alias("_part"), "a"))
    most = above.groupBy("_part").agg(F.max("a").alias("_above"))
    return level.join(most, F.col(own) == F.col("_part"), "left").where(F.coalesce(100 * F.col("_above") < COVERED * F.col("a"), F.lit(True)))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The ``top`` phrases of two to four words of each language: lang, rank, phrase, a, l, r, n, score.

    Null texts count as empty, a null lang as ``und``. Repeated rows count again. Texts of any length are read
    whole; a language without a candidate, and an empty table, give no rows. Ties go to the more frequent phrase, then to the lesser in
    byte order. Extra columns are not looked at.
    """
    ship_package(docs.sparkSession)
    held = stage(blocks(docs, text_col, lang_col), "phrase-blocks")
    totals = held.groupBy("lang").agg(F.sum("n").alias("n"))
    occurrences = held.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    each = held.select("lang", F.inline(F.arrays_zip(F.col("words").alias("phrase"), F.col("counts").alias("c"))))
    counted = stage(each.groupBy("lang", "phrase").agg(F.sum("c").alias("a")).where(F.col("a") >= least), "phrase-words")
    words = stage(numbered(counted, [F.desc("a"), F.asc("lang"), F.asc("phrase")], "id"), "phrase-vocabulary")
    seqs = stage(word_sequences(held, words), "phrase-seqs")
    found = stage(frequent_pairs(seqs, Tiles(words.count(), occurrences), least), "phrase-pairs")
    pairs = stage(ranked_pairs(found, words), "phrase-ranked")
    many = pairs.count()
    # Pairs one apart overlap in a word and are triples, pairs two apart are runs of four.
    longer = stage(frequent_pairs(stage(pair_sequences(seqs, pairs, many), "phrase-seqs"), Tiles(many, occurrences), least, (1, 2)), "phrase-longer")
    triples = stage(_triples(longer.where("step = 1"), pairs), "phrase-triples")
    quads = stage(_quads(longer.where("step = 2"), pairs, triples), "phrase-quads")
    cuts = (
        (_uncovered(pairs, "id", triples, ("l", "r")), [("first_a", "last_a")]),
        (_uncovered(triples, "key", quads, ("f_key", "s_key")), [("first_a", "right_a"), ("left_a", "last_a")]),
        (quads, [("first_a", "right_a"), ("head_a", "tail_a"), ("left_a", "last_a")]),
    )
    kept = None
    for level, sides in cuts:
        cut = F.array_min(F.array(*[_cut(k + 1, l, r) for k, (l, r) in enumerate(sides)]))
        scored = level.select("lang", "phrase", "a", cut.alias("cut"))
        kept = scored if kept is None else kept.unionAll(scored)
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), F.asc("phrase"))
    best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n",
        F.col("cut.score").cast("long").alias("score"),
    )

