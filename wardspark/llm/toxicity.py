"""Toxicity by non-negative positive-unlabelled learning: confirmed toxic texts against unlabelled ones.

A logistic classifier over words is trained in numpy on a bounded sample. Its risk counts unlabelled texts as
clean and takes back the share of toxic ones among them by the class prior; where the corrected clean risk falls
below zero, the step goes the other way.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wardspark.llm.common import hash60, text_of
from wardspark.session import ship_package, stage

FOLDS = 5
POSITIVES = 2_000    # confirmed toxic texts to train on, at most
UNLABELLED = 6_000   # unlabelled texts to train on, at most
VOCABULARY = 20_000  # words in the model, at most
LEAST_TEXTS = 5      # texts of the sample that a word of the model is in
STEPS = 400
RATE = 0.05
DECAY = 3e-4
SEPARATION = 3.5     # standard errors by which a word's share must differ between the two samples
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


class Model:
    """Word weights and a bias; the probability that a text is toxic."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias

    def score(self, text: str) -> float:
        get = self.weights.get
        total = self.bias + sum(get(w, 0.0) for w in words(text))
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def clean_risk(logits: np.ndarray, n: int, prior: float) -> float:
    """Risk of clean texts: that of all unlabelled ones (from place ``n`` on) as clean, less the toxic share among them."""
    return float(np.mean(np.logaddexp(0, logits[n:])) - prior * np.mean(np.logaddexp(0, logits[:n])))


def slopes(logits: np.ndarray, n: int, prior: float) -> np.ndarray:
    """Gradient by the logits of what a step descends: the whole risk, or less the clean risk where that is below zero."""
    p = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
    slope = np.empty(len(logits))
    if clean_risk(logits, n, prior) >= 0:
        slope[:n] = prior * (p[:n] - 1) / n - prior * p[:n] / n
        slope[n:] = p[n:] / (len(logits) - n)
    else:
        slope[:n] = prior * p[:n] / n
        slope[n:] = -p[n:] / (len(logits) - n)
    return slope


def train(toxic: list[str], unlabelled: list[str], prior: float) -> Model:
    """Fit by full-batch steps of Adam on the non-negative risk with the logistic loss.

    Words are in the model if their share of texts differs between the samples by SEPARATION standard
    errors, which leaves out the many words that only few texts have. Without toxic texts the score is the
    prior everywhere.
    """
    prior = min(max(prior, 1e-3), 0.5)
    if not toxic or not unlabelled:
        return Model({}, float(np.log(prior / (1 - prior))))
    codes: dict[str, int] = defaultdict(count().__next__)
    texts = [np.fromiter((codes[w] for w in words(t)), dtype=np.int32) for t in (*toxic, *unlabelled)]
    n, m = len(toxic), len(texts)
    seen = [np.bincount(np.concatenate(group), minlength=len(codes)) for group in (texts[:n], texts[n:])]
    share = (seen[0] + seen[1]) / m
    error = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n + 1 / (m - n)))
    gap = np.abs(seen[0] / n - seen[1] / (m - n)) / error
    known = (seen[0] + seen[1] >= LEAST_TEXTS) & (gap >= SEPARATION)
    names = list(codes)
    chosen = sorted(np.flatnonzero(known).tolist(), key=lambda k: (-gap[k], names[k]))[:VOCABULARY]
    place = np.full(len(codes), -1)
    place[chosen] = np.arange(len(chosen))
    found = [place[t][place[t] >= 0] for t in texts]
    rows = np.repeat(np.arange(m), [len(f) for f in found])
    cols = np.concatenate(found)
    weights, bias = np.zeros(len(chosen)), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(len(chosen) + 1), np.zeros(len(chosen) + 1)
    for step in range(1, STEPS + 1):
        logits = bias + np.bincount(rows, weights[cols], minlength=m)
        slope = slopes(logits, n, prior)
        grad = np.append(np.bincount(cols, slope[rows], minlength=len(chosen)) + DECAY * weights, slope.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = weights - move[:-1], bias - move[-1]
    return Model(dict(zip([names[k] for k in chosen], weights.tolist(), strict=True)), float(bias))


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Train on the texts of least id hash outside the held-out fold, and on no label of that fold.

    ``positives`` and ``unlabelled`` bound the texts of either kind that the driver trains on; all rows are candidates.
    The prior is the share of toxic texts among the labelled ones there. Conflicting labels of one id count as
    toxic; null labels, and labels without an id, as none. Other columns of ``labels`` are not read.
    """
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    row = marked.agg(F.avg((F.col("toxic") == 1).cast("double"))).first()
    prior = row[0] or 0.0
    texts = docs.where(~held_out()).select(
        "doc_id", text_of("text").alias("text"), hash60(F.col("doc_id"), F.md5(text_of("text"))).alias("h")
    )
    narrow = texts.select("doc_id", "h").distinct()
    confirmed = narrow.join(marked.where("toxic = 1"), "doc_id")
    return train(_sample(texts, confirmed, positives), _sample(texts, narrow, unlabelled), prior)


def _sample(texts: DataFrame, among: DataFrame, most: int) -> list[str]:
    """The texts of least hash: chosen among narrow rows first, so that no task sends more than those.

    The chosen hashes are ``most`` rows at most and are broadcast.
    """
    chosen = stage(among.select("h").distinct().orderBy("h").limit(most), "toxicity-sample")
    found = texts.join(F.broadcast(chosen), "h").groupBy("h").agg(F.first("text").alias("text"))
    return [r["text"] for r in sorted(found.collect(), key=lambda r: r["h"])]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text.

    Null and empty texts get the score of a text without known words; repeated rows get equal scores; an empty
    table gives no rows. A text is its set of words, so a very long one weighs each of them once.
    """
    ship_package(docs.sparkSession)
    source = docs.select(text_of("text").alias("text"), "doc_id", held_out().alias("held_out"))
    weights, bias = model.weights, model.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(weights, bias)
        for batch in batches:
            scores = pa.array([own.score(t) for t in batch.column(0).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), scores], names=["doc_id", "held_out", "score"])

    scored = source.mapInArrow(run, "doc_id bigint, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
