"""Centroid clusters, collocations and exact copies against plain versions."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.cases import SCHEMA, documents, empty, prose
from wardspark.llm import collocations as C, dedup as D
from wardspark.llm.centroids import cluster, distances
from wardspark.llm.common import Sieve
from pyspark.sql import functions as F

VECTORS = "vec_id long, embedding array<float>, cluster string, distance double, v string"


# ---- clusters -----------------------------------------------------------------------------------------------

def plain_clusters(rows, k, rounds, width):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)]
    name = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() if r[0] is not None else "", r[1])
    centroids = [v for _, v in sorted(kept, key=name)[:k]]
    away = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c, strict=True))
    nearest = lambda v: min(range(len(centroids)), key=lambda c: (away(v, centroids[c]), c))
    for _ in range(rounds):
        held = defaultdict(list)
        for _, v in kept:
            held[nearest(v)].append(v)
        for c, members in held.items():
            centroids[c] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    final = [(i, nearest(v), away(v, centroids[nearest(v)])) for i, v in kept]
    inertia = Counter()
    for _, c, d in final:
        inertia[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), sha[c]) for i, c, d in final), key=repr)


def awkward_vectors(width):
    draw = random.Random(5)
    some = lambda: [float(np.float32(draw.uniform(-1, 1))) for _ in range(width)]
    rows = [(i, some()) for i in range(40)] + [(100, [0.0] * width), (101, None), (102, []), (103, [1.0] * (width - 1))]
    rows += [(104, [float("nan")] * width), (105, [float("inf")] * width), (106, [None] * width), (None, some())]
    twin = some()
    return rows + [(7, twin), (7, twin), (8, some()), (200, [3e5] * width), (201, [-3e5] * width)]


@pytest.mark.parametrize("width,k", [(4, 3), (64, 8), (3, 200)])
def test_clusters(spark, width, k):
    rows = awkward_vectors(width)
    df = spark.createDataFrame([(i, v, "x", 1.0, "y") for i, v in rows], VECTORS).repartition(3)
    got = sorted((tuple(r) for r in cluster(df, clusters=k, rounds=3, width=width).collect()), key=repr)
    assert got == plain_clusters(rows, k, 3, width)


def test_clusters_of_nothing_and_of_one(spark):
    assert cluster(spark.createDataFrame([], VECTORS)).count() == 0
    one = spark.createDataFrame([(None, [0.5] * 64, "x", 1.0, "y")] * 2, VECTORS)
    assert [tuple(r)[:3] for r in cluster(one).collect()] == [(None, 0, 0)] * 2


def test_tables_beyond_64_bits():
    block = np.array([[1 << 40, -(1 << 40)], [0, 0]])
    assert distances(block, np.array([[0, 0]])).ravel().tolist() == [2 << 80, 0]


# ---- phrases ------------------------------------------------------------------------------------------------

def plain_phrases(rows, least, top):
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    n, f = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(fold)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 5):
                f[lang].update(tuple(words[i:i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, counts in f.items():
        phrases = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        best = []
        for p, a in phrases.items():
            if any(100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in phrases.items() if len(q) > len(p)):
                continue
            score, k = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, at + 1, p.decode(), -a, l, r, n[lang], -s) for at, (s, a, p, l, r) in enumerate(sorted(best)[:top])]
    return sorted(out)


def phrase_rows(count=120, size=60):
    draw = random.Random(9)
    fixed = ["salt and pepper", "New York City hall", "a b a b a b", "öl Über", "é🙂 日本 é🙂"]
    rows = [("".join(draw.choice([draw.choice("pqrstuvwxyz"), *fixed]) + draw.choice([" ", " ", "  ", "\t", ". ", "\n", ", ", "\x0b"])
                     for _ in range(size)), draw.choice(["en", "de", None, "und"])) for _ in range(count)]
    return rows + [(None, "en"), ("", None), (" \n\t ", "fr"), ("x " * 3000, "fr"), ("y y y", "it"), rows[0], rows[0]]


@pytest.mark.parametrize("block,side", [(4 << 20, 1024), (300, 2)])
def test_phrases(spark, monkeypatch, block, side):
    monkeypatch.setattr(C, "TILE", side)
    monkeypatch.setattr(C, "BLOCK_BYTES", block)
    rows = phrase_rows()
    df = spark.createDataFrame([(i, t, lang, "s", 1, 1, "k", "p", "t") for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)
    got = sorted(tuple(r) for r in C.collocations(df, least=12, top=40).collect())
    assert got == plain_phrases(rows, 12, 40) and got


def test_phrases_of_awkward_and_empty_tables(spark):
    assert C.collocations(empty(spark)).count() == 0
    docs = documents(spark)
    rows = [(r.text, r.lang) for r in docs.collect()]
    assert sorted(tuple(r) for r in C.collocations(docs).collect()) == plain_phrases(rows, 30, 2000)


def test_scores_pass_64_bits(spark):
    big = 5_000_000_000_000_000
    row = spark.createDataFrame([(big, big, 2 * big)], "a long, left_a long, right_a long").select(C._cut(1, "left_a", "right_a").alias("c")).first().c
    assert (row.score, row.k) == (2_000_000 * big // (3 * big), 1)


def test_dense_and_sparse_tiles_agree():
    draw = np.random.default_rng(4)
    tiles = C.Tiles(2000, 10)
    tiles.side = 16
    for spread in (20, 3000):  # most pairs in full tiles; most in the sparse rest
        keys = (draw.integers(0, spread, 5000) << 32) | draw.integers(0, spread, 5000)
        got = Counter()
        for tile, cells, counts in tiles.counted(keys):
            whole = tiles.key(tile, cells) if tile < C.GRID**2 else cells
            assert (tiles.of(whole) == tile).all()
            got.update(dict(zip(whole.tolist(), counts.tolist(), strict=True)))
        assert got == Counter(keys.tolist())


# ---- copies -------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 2, 3, 17, 500, 20_000])
def test_filter_has_its_keys_and_few_others(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 64, n, dtype=np.uint64))
    made = D.BinaryFuse.build(keys)
    assert made.has(keys).all()
    others = np.random.default_rng(n + 1).integers(0, 1 << 64, 100_000, dtype=np.uint64)
    assert made.has(others).mean() < 2e-3
    assert len(made.slots) <= max(64, 1.6 * n)


def plain_copies(rows):
    texts = defaultdict(list)
    for i, t in rows:
        texts[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for text, ids in texts.items():
        known = sorted(i for i in ids if i is not None)
        order = known + [None] * (len(ids) - len(known))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, order[0], len(ids), at == 0, sha) for at, i in enumerate(order)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("batches,bits", [(1, 64), (3, 64), (4, 6)])
def test_copies(spark, batches, bits):
    rows = [(r.doc_id, r.text) for r in documents(spark).collect()]
    rows += [(20, "a  b\tc"), (19, "a b\n\nc"), (21, "a b c "), (None, "x"), (None, None), (30, " "), (31, "\r\n"), (40, prose(8, 30_000))]
    rows += [(i, "one text that many rows hold") for i in range(100, 400)] + [(41, prose(8, 30_000))]
    df = spark.createDataFrame([(i, t, "en", "s", 1, 1, "k", "p", "t") for i, t in rows], SCHEMA).repartition(5)
    got = sorted((tuple(r) for r in D.dedup(df, batches=batches, bits=bits).collect()), key=repr)
    assert got == plain_copies(rows)
    assert D.dedup(empty(spark), batches=batches).count() == 0


def test_screen_passes_what_is_stored(spark):
    known = spark.range(5000).select(F.lit(3).alias("bucket"), F.xxhash64("id").alias("digest"))
    other = spark.range(5000, 9000).select(F.lit(3).alias("bucket"), F.xxhash64("id").alias("digest"))
    held = [D.snapshot(known.where("digest > 0")), D.snapshot(known.where("digest <= 0"))]
    passed = D.screen(known.unionAll(other), held)
    assert passed.count() < 5010 and passed.intersect(known).count() == 5000
    assert D.stored(known.unionAll(other), held).count() == 5000


def test_sieve_passes_its_keys_and_few_others(spark):
    sieve = Sieve(spark.range(3000).withColumn("k", F.col("id") * 7), "k", "test")
    marked = sieve.mark(spark.range(21_000), F.col("id"))
    assert marked.where("id % 7 = 0 and _maybe").count() == 3000
    assert marked.where("id % 7 <> 0 and _maybe").count() < 3000
    assert Sieve(spark.range(0), "id", "test").mark(spark.range(9), F.col("id")).where("_maybe").count() == 0
