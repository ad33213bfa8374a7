"""Secret scans weighed by corpus-wide ownership (DataFrame functions only).

Every candidate's value is hashed and counted over the whole corpus by distinct repositories and owners. Values
that many owners carry, or many repositories of whatever owners, are copied examples; values of few owners in few
repositories that look like keys are live credentials.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from wardspark.llm.common import packed, text_of
from wardspark.session import stage


class Kind(NamedTuple):
    name: str
    pattern: str
    group: int   # the group that holds the value
    least: int   # shortest value that counts
    base: bool   # base spans are always reported


KINDS = (
    Kind("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    # Runs that are too short fail as a whole, so asking for the length in the pattern finds the same matches.
    Kind("access", r"AKIA[A-Z0-9]{14,}", 0, 18, True),
    Kind("hex", r"[0-9a-f]{16,}", 0, 16, True),
    # Reported only where the corpus says that they are live.
    Kind("prefixed", r"gh[pousr]_[A-Za-z0-9]{20,}|xox[abeprs]-[A-Za-z0-9-]{16,}|[rs]k_live_[A-Za-z0-9]{16,}"
         r"|AIza[A-Za-z0-9_-]{30,}|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"
         r"|-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 16, False),
    Kind("mixed", r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}+", 0, 24, False),
)
WIDE_OWNERS = 3          # values of so many owners are copied examples,
WIDE_REPOSITORIES = 25   # and so are those in so many repositories, be it of one owner
LEAST_DISTINCT = 8   # different characters of a live-looking value
PLACEHOLDER = r"(?i)example|sample|dummy|placeholder|changeme|your|xxxx|\*\*\*\*|(.)\1{5}"
MASK = "[SECRET]"


def _runs_of(text: Column, number: int, kind: Kind) -> Column:
    pattern = F.lit(kind.pattern)
    found = F.transform(
        F.arrays_zip(
            F.regexp_extract_all(text, pattern, F.lit(0)).alias("whole"),
            F.regexp_extract_all(text, pattern, F.lit(kind.group)).alias("value"),
            F.split(text, kind.pattern, -1).alias("between"),
        ),
        lambda x, i: F.struct(
            F.lit(number).alias("kind"), i.alias("place"), F.length(x["between"]).alias("gap"),
            F.length(x["whole"]).alias("length"), x["value"].alias("value"),
        ),
    )
    # The piece after the last match has no match of its own.
    return F.when(text.rlike(kind.pattern), F.filter(found, lambda x: x["length"].isNotNull()))


def _runs(text: Column) -> Column:
    """All matches of all kinds: kind, place in order, characters before it since the last match, length, value."""
    parts = [_runs_of(text, number, kind) for number, kind in enumerate(KINDS)]
    empty = F.array().cast("array<struct<kind:int,place:int,gap:int,length:int,value:string>>")
    return F.concat(*[F.coalesce(p, empty) for p in parts])


def _live_looking(value: Column) -> Column:
    distinct = F.size(F.array_distinct(F.split(value, "")))
    return (distinct >= LEAST_DISTINCT) & value.rlike("[A-Za-z]") & ~value.rlike(PLACEHOLDER)


def _candidates(found: DataFrame, key: list[str]) -> DataFrame:
    """One row per candidate of ``found`` (key, owner, repository, runs): kind, begin, end, value hash."""
    each = found.where(F.size("runs") > 0).select(*key, "owner", "repository", F.inline("runs"))
    before = Window.partitionBy(*key, "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(before))
    least = F.get(F.array(*[F.lit(k.least) for k in KINDS]), F.col("kind"))
    mixed = F.col("value").rlike("[0-9]") & F.col("value").rlike("[a-z]") & F.col("value").rlike("[A-Z]")
    kept = placed.where((F.length("value") >= least) & ((F.col("kind") != len(KINDS) - 1) | mixed))
    return kept.select(
        *key, "owner", "repository", "kind", (F.col("end") - F.col("length")).alias("begin"), "end",
        F.md5("value").alias("value_hash"), _live_looking(F.col("value")).alias("live_looking"),
    )


def ownership(candidates: DataFrame) -> DataFrame:
    """Distinct owners and repositories of each value.

    Three sums that each combine before they shuffle, so a value that a third of all rows holds is spread by its
    repositories, then by its owners.
    """
    return (
        candidates.groupBy("value_hash", "owner", "repository").agg(F.count("*").alias("n"))
        .groupBy("value_hash", "owner").agg(F.count("*").alias("repositories"))
        .groupBy("value_hash").agg(F.count("*").alias("n_owners"), F.sum("repositories").alias("n_repositories"))
    )


def _judged(candidates: DataFrame) -> DataFrame:
    held = stage(candidates, "secret-candidates")
    wide = stage(ownership(held), "secret-owners")
    counted = held.join(wide, "value_hash").withColumn(
        "copied", (F.col("n_owners") >= WIDE_OWNERS) | (F.col("n_repositories") >= WIDE_REPOSITORIES))
    return counted.withColumn("live", F.col("live_looking") & ~F.col("copied"))


def _is_base(kind: Column) -> Column:
    return F.get(F.array(*[F.lit(k.base) for k in KINDS]), kind)


def _number_of(kind: int) -> Column:
    return F.size(F.filter("all", lambda x: x["kind"] == kind)).cast("long")


def _shown(spans: Column) -> Column:
    names = F.array(*[F.lit(k.name) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["begin"], x["end"])), ",")


def scan(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source",
    repository_col: str = "doc_id",
) -> DataFrame:
    """Spans of secrets in every whole text, with the corpus's verdict on them.

    Returns doc_id, n_assign, n_access, n_hex, base_sha256, spans (base and added ones), n_live and n_example
    (spans judged live; and those whose value WIDE_OWNERS owners or WIDE_REPOSITORIES repositories hold), n_owners and n_repositories
    (of the most widely held value among the spans), one row per input row. Null and empty texts have no
    spans. A null owner or repository counts as one of its own. Repeated rows share owner and
    repository, so they don't make a value look copied. An empty table gives no rows.
    """
    found = stage(
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
            F.col(owner_col).alias("owner"), F.col(repository_col).alias("repository"),
            _runs(text_of(text_col)).alias("runs"),
        ),
        "secret-runs",
    )
    judged = _judged(_candidates(found, ["row"])).where(_is_base(F.col("kind")) | F.col("live"))
    per_row = judged.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("begin", "kind", "end"))).alias("all"),
        F.sum(F.col("live").cast("long")).alias("live"),
        F.sum(F.col("copied").cast("long")).alias("wide"),
        F.max("n_owners").alias("owners"), F.max("n_repositories").alias("repositories"),
    )
    spans = F.coalesce("all", F.array().cast("array<struct<begin:bigint,kind:int,end:bigint>>"))
    joined = found.select("row", "doc_id").join(per_row, "row", "left").withColumn("all", spans)
    base = F.filter("all", lambda x: _is_base(x["kind"]))
    counts = [
        _number_of(k).alias(f"n_{kind.name}") for k, kind in enumerate(KINDS) if kind.base
    ]
    return joined.select(
        "doc_id", *counts, F.sha2(_shown(base), 256).alias("base_sha256"), _shown(F.col("all")).alias("spans"),
        F.coalesce("live", F.lit(0)).alias("n_live"), F.coalesce("wide", F.lit(0)).alias("n_example"),
        F.coalesce("owners", F.lit(0)).alias("n_owners"), F.coalesce("repositories", F.lit(0)).alias("n_repositories"),
    )


def redacted_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with live secrets replaced by MASK; copied examples and everything else stay.

    Rows are found again by doc_id, owner and text hash, so rows without an id or with a repeated one are
    treated by their own text. n_chars, where there is such a column, is counted anew for changed texts.
    """
    key = ["_id", "_hash"]
    named = docs.select(
        F.col("doc_id").alias("_id"), F.md5("text").alias("_hash"), F.col("source").alias("owner"),
        F.col("doc_id").alias("repository"), _runs(text_of("text")).alias("runs"),
    ).where(F.size("runs") > 0)
    found = stage(named, "secret-runs").dropDuplicates([*key, "owner"])
    live = _judged(_candidates(found.withColumn("part", F.col("owner")), [*key, "part"]))
    per_text = stage(
        live.where("live").groupBy("_id", "_hash", "part")
        .agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("_spans")),
        "secret-spans",
    )
    rows = docs.select(packed(docs), F.col("doc_id").alias("_own_id"), F.col("source").alias("_own_part"), F.col("text").alias("_text"))
    hit = rows.join(
        per_text,
        F.col("_own_id").eqNullSafe(F.col("_id")) & (F.md5("_text") == F.col("_hash"))
        & F.col("_own_part").eqNullSafe(F.col("part")),
        "left",
    )
    text = F.col("_text")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    masked = F.aggregate(
        "_spans", start,
        lambda acc, x: F.when(x["begin"] >= acc["at"], F.struct(
            F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (x["begin"] - acc["at"]).cast("int")), F.lit(MASK)).alias("out"),
            x["end"].alias("at"),
        )).otherwise(F.struct(acc["out"].alias("out"), F.greatest(acc["at"], x["end"]).alias("at"))),
        lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text))),
    )
    row = hit.select("_row", masked.alias("_masked"))
    changed = F.col("_row").withField("text", F.col("_masked"))
    if "n_chars" in docs.columns:
        changed = changed.withField("n_chars", F.length("_masked").cast(docs.schema["n_chars"].dataType))
    kept = F.when(F.col("_masked").isNull(), F.col("_row")).otherwise(changed)
    return row.select(kept.alias("_row")).select("_row.*")
