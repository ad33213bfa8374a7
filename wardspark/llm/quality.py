"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

DataFrame functions only. A rule is right with its own unknown probability; the posterior probability of
good quality replaces the demand that all rules pass.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from wardspark.llm.common import WORD, packed, text_of
from wardspark.session import stage


class Rule(NamedTuple):
    """Votes good (1) up to ``good``, bad (-1) from ``bad`` on, and abstains (0) in between."""

    name: str
    value: str
    good: float
    bad: float


#: Ratios over the columns of ``measure``; each rises as a text gets worse.
RULES = (
    Rule("symbols", "n_symbols / n_words", 0.02, 0.10),
    Rule("repeated_lines", "n_dup_lines / greatest(n_lines, 1)", 0.05, 0.30),
    Rule("repeated_words", "n_repeat_words / n_words", 0.10, 0.30),
    Rule("capitals", "n_capitals / greatest(word_chars, 1)", 0.15, 0.40),
    Rule("marks", "n_marks / n_words", 0.30, 0.80),
    Rule("digits", "n_digits / greatest(word_chars, 1)", 0.05, 0.20),
    Rule("word_length", "abs(word_chars / n_words - 5.5)", 2.0, 5.0),
    Rule("few_words", "100 / n_words", 1.5, 2.5),
)
VOTES = (-1, 0, 1)
ROUNDS = 25
PRIOR = 0.8  # share of good texts before the first round
#: Before the first round: probability of each vote on bad (0) and good (1) texts.
FIRST = {0: {-1: 0.3, 0: 0.2, 1: 0.5}, 1: {-1: 0.05, 0: 0.15, 1: 0.8}}
SMOOTH = 0.5
SETTLED = 1e-6  # the rounds end when no probability moves further
LEAST_WORDS = 50
MOST_REPEATED = 50  # per cent


def _kept(text: Column, unwanted: str) -> Column:
    """Number of characters left when those of the class are removed."""
    return F.length(F.regexp_replace(text, unwanted, "")).cast("long")


def _windows(words: Column) -> Column:
    """Hashes of 64 bits of all windows of three words, in order."""
    last = F.size(words) - 3
    hashes = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.when(last >= 1, hashes).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: Column, ranked: Column) -> Column:
    """Words inside windows that occur at least twice.

    ``ranked`` holds the windows with their places, sorted; those equal to a neighbour repeat. In the order
    of their places, each adds its three words less those that the one before it covers.
    """
    repeats = F.filter(
        ranked,
        lambda x, k: (k > 0) & F.coalesce(x["h"] == F.get(ranked, k - 1)["h"], F.lit(False))
        | F.coalesce(x["h"] == F.get(ranked, k + 1)["h"], F.lit(False)),
    )
    places = F.sort_array(F.transform(repeats, lambda x: x["i"]))
    total = F.aggregate(
        places,
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("at")),
        lambda acc, p: F.struct(
            (acc["n"] + F.least(p - acc["at"], F.lit(3))).alias("n"), p.alias("at")
        ),
        lambda acc: acc["n"],
    )
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), total).otherwise(0).cast("long")


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the counts that the rules read in one struct column, ``_m``.

    Null texts count as empty. n_dup_lines: lines with a word that equal an earlier line. n_repeat_words:
    words in three-word windows that occur twice or more in the text, in time n log n.
    """
    text, words, rest = F.col("_text"), F.col("_words"), F.col("_rest")
    step = (
        docs.withColumn("_text", text_of(text_col))
        .withColumn("_words", F.regexp_extract_all(text, F.lit(WORD), F.lit(0)))
        .withColumn("_lines", F.filter(F.split(text, "\n", -1), lambda x: x.rlike(WORD)))
        .withColumn("_rest", F.regexp_replace(text, r"[a-z\x20\x09-\x0D]+", ""))
        .withColumn("_windows", _windows(words))
    )
    ranked = F.sort_array(F.transform(F.col("_windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    repeating = F.size(F.array_distinct("_windows")) < F.size("_windows")
    step = step.withColumn("_ranked", F.when(repeating, ranked))
    counts = F.struct(
        F.size(words).cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        _kept(rest, r"[^#*$%&|<>]+").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _covered(F.col("_windows"), F.col("_ranked")).alias("n_repeat_words"),
        _kept(rest, r"[^\p{Lu}]+").alias("n_capitals"),
        _kept(rest, r"[\p{L}\p{N}]+").alias("n_marks"),
        _kept(rest, r"[^0-9]+").alias("n_digits"),
    )
    # A generator of one row: filters on the counts stay above it instead of repeating the work below.
    kept = [F.col(f"`{c}`") for c in docs.columns]
    return step.select(*kept, F.explode(F.array(counts)).alias("_m"))


def _votes() -> list[Column]:
    """One column per rule; texts that fail the base rules don't vote."""
    votes = []
    for rule in RULES:
        value = F.expr(rule.value)
        votes.append(
            F.when(value <= rule.good, 1).when(value >= rule.bad, -1).otherwise(0).cast("int").alias(rule.name)
        )
    return votes


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def posterior(model: dict) -> Column:
    """Probability of good quality given the votes, under ``fit``'s vote probabilities.

    The weights are one array value, so the rounds of ``fit`` share their compiled code.
    """
    weights = [math.log(model["prior"]) - math.log(1 - model["prior"])]
    for rule in RULES:
        weights += [math.log(model[rule.name, v, 1]) - math.log(model[rule.name, v, 0]) for v in VOTES]
    held = F.array(*[F.lit(w) for w in weights])
    odds = F.get(held, F.lit(0))
    for k, rule in enumerate(RULES):
        odds = odds + F.get(held, F.col(rule.name) + F.lit(3 * k + 2))
    return 1 / (1 + F.exp(-odds))


def _first_guess() -> dict:
    model = {"prior": PRIOR}
    for rule in RULES:
        model |= {(rule.name, v, y): FIRST[y][v] for v in VOTES for y in (0, 1)}
    return model


def fit(patterns: DataFrame, rounds: int = ROUNDS) -> dict:
    """Expectation-maximisation over the vote patterns and their numbers of texts, ``n``.

    Gives the share of good texts, "prior", and for every rule, vote and class (1 good, 0 bad) the
    probability of that vote: what a vote is worth in either direction. There are at most 3^8 patterns however
    large the corpus is; each round is one aggregate over them and brings back one row, rounded to 9 places
    so that the order of summation can't show. ``SMOOTH`` texts are added to each count. A rule
    votes bad at least as often on bad texts as on good ones, so the classes can't swap. Without patterns
    the first guesses stay.
    """
    model = _first_guess()
    for _ in range(rounds):
        scored = patterns.withColumn("p", posterior(model))
        sums = [F.sum(F.col("n") * F.col("p")).alias("good"), F.sum("n").alias("all")]
        for rule in RULES:
            for v in VOTES:
                cast = F.when(F.col(rule.name) == v, F.col("n")).otherwise(0)
                sums += [F.sum(cast * F.col("p")).alias(f"{rule.name}{v}"), F.sum(cast).alias(f"{rule.name}{v}n")]
        row = scored.agg(*sums).first()
        if not row["all"]:
            return model
        good, bad = row["good"], row["all"] - row["good"]
        new = {"prior": min(max(round(good / row["all"], 9), 0.05), 0.95)}
        for rule in RULES:
            for v in VOTES:
                of_good = row[f"{rule.name}{v}"]
                of_bad = row[f"{rule.name}{v}n"] - of_good
                new[rule.name, v, 1] = round((of_good + SMOOTH) / (good + 3 * SMOOTH), 9)
                new[rule.name, v, 0] = round((of_bad + SMOOTH) / (bad + 3 * SMOOTH), 9)
            if new[rule.name, -1, 0] < new[rule.name, -1, 1]:
                for v in VOTES:
                    new[rule.name, v, 0] = new[rule.name, v, 1]
        moved = max(abs(new[k] - model[k]) for k in new)
        model = new
        if moved < SETTLED:
            break
    return model


def patterns(measured: DataFrame) -> DataFrame:
    """Vote patterns of the texts that pass the base rules, with their numbers of texts."""
    votes = measured.select("_m.*").where(~base_failed()).select(*_votes())
    return votes.groupBy(*[rule.name for rule in RULES]).agg(F.count("*").alias("n"))


def judge(docs: DataFrame, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """Counts, votes, posterior probability and verdict of every text.

    Returns doc_id, the counts of ``measure``, base_failed, the votes, quality (the posterior; null where the
    base rules fail) and kept. Null and empty texts fail the base rules; repeated rows are judged alike and
    each counts in the estimate; an empty table gives no rows.
    """
    measured = stage(measure(docs.select("doc_id", F.col(text_col).alias("text"))).select("doc_id", "_m"), "quality")
    model = fit(stage(patterns(measured), "quality-patterns"))
    return _verdicts(measured.select("doc_id", "_m.*"), model, least)


def _verdicts(counted: DataFrame, model: dict, least: float) -> DataFrame:
    names = counted.columns
    failed = counted.withColumn("base_failed", base_failed())
    votes = failed.select(*names, "base_failed", *[F.when(~F.col("base_failed"), v).alias(r.name) for r, v in zip(RULES, _votes(), strict=True)])
    return votes.withColumn("quality", F.when(~F.col("base_failed"), posterior(model))).withColumn(
        "kept", F.coalesce(F.col("quality") >= least, F.lit(False))
    )


def good_documents(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose text is judged good, with all their columns.

    The texts are read twice, once for the estimate and once to judge, rather than stored a second time.
    """
    model = fit(stage(patterns(measure(docs.select("text"))), "quality-patterns"))
    measured = measure(docs.select(packed(docs), "text")).select("_row", "_m.*")
    judged = _verdicts(measured, model, least)
    return judged.where("kept").select("_row.*")
