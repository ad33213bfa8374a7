"""Byte-level BPE by merge replay over a corpus block, and decoding.

The words of a block of texts are kept once each. An index leads from token pair to the places where the
pair stands in any word; merges are applied in the order of their ranks to all those places at once, and only the
touched neighbours are looked up again. Blocks are parts of a Spark partition, so that nothing is shuffled
and memory is bounded by the block; words already merged in earlier blocks of the partition are remembered.
"""

from __future__ import annotations

import base64
import functools
import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from wardspark.llm.common import text_of
from wardspark.session import ship_package

BLOCK_BYTES = 6 << 20    # bytes of text whose words are merged together
KEPT_WORDS = 250_000     # words remembered between blocks of a partition
LONG_TEXT = 4 << 20      # longer texts are cut into words in pieces of PIECE_WORDS words
PIECE_WORDS = 1 << 18
NONE = np.int32((1 << 31) - 1)  # rank of a pair that no merge joins


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class Merges:
    """All pairs of tokens whose bytes together are a token, as a sorted table from pair to rank."""

    def __init__(self, ranks: dict[bytes, int], in_order: bool | None = None):
        self.ranks = ranks
        self.width = max(ranks.values()) + 1
        found: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    found[left * self.width + right] = rank
        self.pairs = np.array(sorted(found), dtype=np.int64)
        self.joined = np.array([found[k] for k in self.pairs.tolist()], dtype=np.int32)
        self.bytes = np.array([ranks.get(bytes([b]), -1) for b in range(256)], dtype=np.int32)
        if (self.bytes < 0).any():
            raise ValueError("the vocabulary lacks single bytes")
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.in_order = self._in_order() if in_order is None else in_order

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, or NONE."""
        if not len(self.pairs):
            return np.full(len(left), NONE, dtype=np.int32)
        keys = left.astype(np.int64) * self.width + right
        at = np.minimum(np.searchsorted(self.pairs, keys), len(self.pairs) - 1)
        return np.where(self.pairs[at] == keys, self.joined[at], NONE)

    def _in_order(self) -> bool:
        """Whether a merge can never make a pair of lower rank.

        True if every token is reached from its bytes by merges of lower rank. Then all places of a pair may be
        merged at once; otherwise one per word and round, as the ranks demand.
        """
        longer = [t for t in self.ranks if len(t) > 1]
        self.in_order = False
        flat, starts = replay(longer, self)
        return bool((np.diff(starts) == 1).all()) and all(
            self.ranks[token] == piece for token, piece in zip(longer, flat[starts[:-1]].tolist(), strict=True)
        ) and self._below(longer)

    def _below(self, tokens: list[bytes]) -> bool:
        """Whether no step towards a token has a higher rank than the token."""
        for token in tokens:
            parts = [bytes([b]) for b in token]
            while len(parts) > 1:
                options = [(self.ranks.get(a + b, NONE), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
                rank, i = min(options)
                if rank > self.ranks[token]:
                    return False
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
        return True


def _grouped(ranks: np.ndarray, places: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(ranks, kind="stable")
    ranks, places = ranks[order], places[order]
    cuts = np.flatnonzero(np.diff(ranks)) + 1
    firsts = ranks[np.concatenate(([0], cuts))].tolist() if len(ranks) else []
    yield from zip(firsts, np.split(places, cuts), strict=False)


def replay(words: list[bytes], merges: Merges) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all words, one after another, and where each word's ids start (one more at the end)."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    starts = np.concatenate(([0], np.cumsum(lengths)))
    token = merges.bytes[np.frombuffer(b"".join(words), dtype=np.uint8)]
    size = len(token)
    if not size:
        return token, starts
    after = np.arange(1, size + 1, dtype=np.int32)
    after[starts[1:][lengths > 0] - 1] = -1
    before = np.arange(-1, size - 1, dtype=np.int32)
    before[starts[:-1][lengths > 0]] = -1
    word = None if merges.in_order else np.repeat(np.arange(len(words)), lengths)
    pair = np.full(size, NONE, dtype=np.int32)
    first = np.flatnonzero(after >= 0).astype(np.int32)
    pair[first] = merges.rank(token[first], token[first + 1])
    index: dict[int, list[np.ndarray]] = defaultdict(list)
    first = first[pair[first] != NONE]
    for rank, places in _grouped(pair[first], first):
        index[rank].append(places)
    queue = list(index)
    heapq.heapify(queue)
    while queue:
        rank = heapq.heappop(queue)
        lists = index.pop(rank, None)
        if lists is None:
            continue
        places = lists[0] if len(lists) == 1 else np.sort(np.concatenate(lists))
        places = places[pair[places] == rank]
        if not len(places):
            continue
        if word is not None:
            # One place per word; the others wait for the next round.
            lead = np.concatenate(([True], np.diff(word[places]) != 0))
            if not lead.all():
                index[rank].append(places[~lead])
                heapq.heappush(queue, rank)
            places = places[lead]
        elif len(places) > 1:
            # Of places that overlap in a chain, every second one, from the left.
            chained = np.concatenate(([False], after[places[:-1]] == places[1:]))
            if chained.any():
                run = np.arange(len(places))
                head = np.maximum.accumulate(np.where(chained, 0, run))
                places = places[(run - head) % 2 == 0]
        gone = after[places]
        follow = after[gone]
        token[places] = rank
        token[gone] = -1
        pair[gone] = NONE
        after[places] = follow
        behind = follow >= 0
        before[follow[behind]] = places[behind]
        pair[places] = NONE
        left = before[places]
        touched = np.concatenate((places[after[places] >= 0], left[left >= 0]))
        if len(touched) > 1:
            touched = np.unique(touched)
        new = merges.rank(token[touched], token[after[touched]])
        pair[touched] = new
        hit = new != NONE
        if hit.any():
            touched, new = touched[hit], new[hit]
            for low, at in _grouped(new, touched):
                if low not in index:
                    heapq.heappush(queue, low)
                index[low].append(at)
    alive = token >= 0
    ends = np.concatenate(([0], np.cumsum(alive)))
    return token[alive], ends[starts]


class Encoder:
    """Encodes texts block by block; keeps the ids of words it has met."""

    def __init__(self, ranks_path: str, pattern: str, in_order: bool | None = None):
        self.merges = _merges(ranks_path, in_order)
        self.find = regex.compile(pattern)
        self.forget()

    def forget(self) -> None:
        self.codes: dict[str, int] = defaultdict(count().__next__)
        self.ids: list[bytes] = []

    def learn(self) -> None:
        """Merge the words that have a code but no ids yet."""
        fresh = [w.encode() for w in islice(self.codes, len(self.ids), None)]
        if not fresh:
            return
        whole = [self.merges.ranks.get(w) for w in fresh]
        flat, starts = replay([b"" if r is not None else w for w, r in zip(fresh, whole, strict=True)], self.merges)
        packed = flat.astype("<u4").tobytes()
        cuts = (starts * 4).tolist()
        for k, rank in enumerate(whole):
            # A word that is itself a token needs no merges.
            self.ids.append(packed[cuts[k]:cuts[k + 1]] if rank is None else rank.to_bytes(4, "little"))

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.ids) > KEPT_WORDS:
            self.forget()
        code = self.codes.__getitem__
        coded = [np.fromiter(map(code, self.find.findall(t)), dtype=np.int32) if t else () for t in texts]
        self.learn()
        ids = self.ids.__getitem__
        return [b"".join(map(ids, c.tolist())) if len(c) else b"" for c in coded]

    def encode_long(self, text: str) -> bytes:
        parts, matches = [], self.find.finditer(text)
        while words := [m.group() for m in islice(matches, PIECE_WORDS)]:
            if len(self.ids) > KEPT_WORDS:
                self.forget()
            coded = [self.codes[w] for w in words]
            self.learn()
            parts.append(b"".join(map(self.ids.__getitem__, coded)))
        return b"".join(parts)


@functools.lru_cache(maxsize=2)
def _merges(path: str, in_order: bool | None = None) -> Merges:
    return Merges(read_ranks(path), in_order)


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in order, in runs of about BLOCK_BYTES of text or one longer text; views, not copies."""
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(0)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + BLOCK_BYTES, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",), decoded: bool = False,
) -> DataFrame:
    """Encode every whole text; each match of ``pattern`` is merged by itself, without special tokens.

    Returns the ``keep`` columns, n_tokens (long) and ids (binary: unsigned 32-bit integers, little-endian);
    with ``decoded`` also the bytes that the ids stand for, decoded in the same process.
    Null and empty texts have no ids; repeated rows give repeated rows; an empty table gives no rows.
    ``ranks_path`` is a file of base64 tokens and ranks on every machine (it comes with an installed package).
    """
    ship_package(docs.sparkSession)
    source = docs.select(text_of(text_col).alias("_text"), *[F.col(c) for c in keep])
    schema = StructType([docs.schema[c] for c in keep] + [StructField("n_tokens", LongType()), StructField("ids", BinaryType())])
    if decoded:
        schema.add("decoded", BinaryType())
    in_order = _merges(ranks_path).in_order  # found once, on the driver

    def run(batches):
        encoder = Encoder(ranks_path, pattern, in_order)
        for block in _blocks(batches):
            texts = block.column(0).to_pylist()
            short = encoder.encode([t if len(t) <= LONG_TEXT else "" for t in texts])
            ids = [encoder.encode_long(t) if len(t) > LONG_TEXT else s for t, s in zip(texts, short, strict=True)]
            columns = [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            if decoded:
                columns.append(pa.array([_decoded(x, encoder.merges.tokens) for x in ids], pa.binary()))
            yield pa.RecordBatch.from_arrays([*block.columns[1:], *columns], names=schema.names)

    return source.mapInArrow(run, schema)


def _decoded(ids: bytes, tokens: dict[int, bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The bytes of each row's ids: the ``keep`` columns and decoded (binary). Null ids give null, no ids give b""."""
    ship_package(encoded.sparkSession)
    source = encoded.select(F.col(ids_col).alias("_ids"), *[F.col(c) for c in keep])
    schema = StructType([encoded.schema[c] for c in keep] + [StructField("decoded", BinaryType())])

    def run(batches):
        tokens = {rank: token for token, rank in read_ranks(ranks_path).items()}
        for batch in _blocks(batches):
            texts = [None if x is None else _decoded(x, tokens) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(texts, pa.binary())], names=schema.names)

    return source.mapInArrow(run, schema)


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row: encode, then decode the ids."""
    both = encode(docs, ranks_path, pattern, decoded=True)
    return both.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )
