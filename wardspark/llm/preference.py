"""Preference formatting of chosen and rejected conversations (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wardspark.llm.common import numbered


def _turns(side: str) -> Column:
    """Turns in order; the numbers serve the order only."""
    items = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    return F.transform(items, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias(side)


def conversations(turns: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row per conversation: its id and its turns, ordered by turn, then role and text.

    Null roles count as "user", null texts as empty. A conversation is one training example, so it must
    fit into a row. Turns without a conversation id belong to none and are left out.
    """
    clean = turns.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("conv_id"), "turn", F.coalesce("role", F.lit("user")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    return clean.groupBy("conv_id").agg(_turns("turns"))


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("<|"), t["role"], F.lit("|>\n"), t["text"], F.lit("<|end|>\n"))), "")


def _mask(turns: Column) -> Column:
    """Spans of the completion that are trained on, "begin:end" in characters: texts and ends of assistant turns."""
    lengths = F.transform(turns, lambda t: F.struct(
        (F.length(t["role"]) + 5).alias("head"), (F.length(t["text"]) + 8).alias("body"), (t["role"] == "assistant").alias("own"),
    ))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.aggregate(
        lengths, start,
        lambda acc, t: F.struct(
            (acc["at"] + t["head"] + t["body"]).alias("at"),
            F.when(t["own"], F.array_append(acc["spans"], F.concat_ws(":", acc["at"] + t["head"], acc["at"] + t["head"] + t["body"] - 1)))
            .otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: F.array_join(acc["spans"], ","),
    )


def format_pairs(pairs: DataFrame) -> DataFrame:
    """Format pairs with columns pair_id, chosen and rejected (arrays of role and text).

    The longest common prefix of turns, equal in role and text, is rendered once as ``prompt``; what follows on
    each side is a completion with the spans a loss applies to: assistant turns up to their end mark; line
    breaks after it, headers and other roles are masked. Returns pair_id, prompt_turns, prompt, chosen,
    chosen_mask, rejected, rejected_mask and differs (false where nothing is left to prefer). A
    null side counts as empty. Repeated pairs give repeated rows; an empty table gives no rows.
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    sides = pairs.select("pair_id", F.coalesce("chosen", none).alias("c"), F.coalesce("rejected", none).alias("r"))
    shorter = F.least(F.size("c"), F.size("r"))
    # Place of the first pair of turns that differ; a further entry past the shorter side always differs.
    differs = F.transform(
        F.sequence(F.lit(0), shorter),
        lambda i: (i < shorter) & F.coalesce(F.get(F.col("c"), i) == F.get(F.col("r"), i), F.lit(False)),
    )
    split = sides.withColumn("k", F.array_position(differs, F.lit(False)).cast("int") - 1)
    left = F.slice("c", F.col("k") + 1, F.greatest(F.size("c"), F.lit(1)))
    right = F.slice("r", F.col("k") + 1, F.greatest(F.size("r"), F.lit(1)))
    cut = split.select("pair_id", "k", F.slice("c", F.lit(1), F.col("k")).alias("p"), left.alias("c"), right.alias("r"))
    return cut.select(
        "pair_id", F.col("k").alias("prompt_turns"), _rendered(F.col("p")).alias("prompt"),
        _rendered(F.col("c")).alias("chosen"), _mask(F.col("c")).alias("chosen_mask"),
        _rendered(F.col("r")).alias("rejected"), _mask(F.col("r")).alias("rejected_mask"),
        ((F.size("c") > 0) | (F.size("r") > 0)).alias("differs"),
    )


def against_next_answer(turns: DataFrame) -> DataFrame:
    """Preference pairs from plain conversations: each is preferred to itself with a foreign answer in place of its last.

    The rejected answer is that of the least greater id among the conversations that have an assistant turn, whatever
    gaps the ids have; only the last of them has none. Turns after the last answer are in ``after``, of which
    nothing is trained on, with their number in ``after_turns``; prompt, chosen and after are the whole conversation.
    """
    last = F.array_max(F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i).otherwise(-1)))
    held = conversations(turns).withColumn("at", last)
    answered = held.where("at >= 0").select("conv_id", F.get("turns", F.col("at")).alias("answer"))
    placed = numbered(answered, [F.col("conv_id")], "place")
    other = placed.select("conv_id", "place").join(placed.select((F.col("place") - 1).alias("place"), "answer"), "place").drop("place")
    none = F.array().cast("array<struct<role:string,text:string>>")
    ends = F.when(F.col("at") >= 0, F.col("at") + 1).otherwise(F.size("turns"))
    after = F.slice("turns", ends + 1, F.size("turns"))
    before = F.when(F.col("at") >= 0, F.slice("turns", F.lit(1), F.col("at"))).otherwise(F.col("turns"))
    foreign = F.when(F.col("answer").isNotNull(), F.array("answer")).otherwise(none)
    pairs = held.join(other, "conv_id", "left").select(
        F.struct("conv_id", F.size(after).alias("after_turns"), _rendered(after).alias("after")).alias("pair_id"),
        F.slice("turns", F.lit(1), ends).alias("chosen"), F.concat(before, foreign).alias("rejected"),
    )
    formatted = format_pairs(pairs)
    return formatted.select(
        F.col("pair_id.conv_id").alias("pair_id"), *[c for c in formatted.columns if c != "pair_id"],
        "pair_id.after_turns", "pair_id.after",
    )
