"""One registered query per operator, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from wardspark.llm import (
    bpe, centroids, collocations, dedup, jaccard, main_text, mixing, neighbours, preference, quality, secret_scan, sharding,
    toxicity,
)
from wardspark.llm.common import table
from wardspark.llm.oracles import COLLOCATION_SQL, DEDUP_SQL, cluster_sql

RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.round_trip(
        table(spark, folder, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    )


def op2_hilbert_shards(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.assign(table(spark, folder, "documents"))


def op3_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op5_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.main_texts(table(spark, folder, "pages"))


def op6_preference_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return preference.against_next_answer(table(spark, folder, "conversations"))


def op7_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"))


def op8_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"))


def op9_quality_votes(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("quality", 6).alias("quality"),
    )


def op10_secret_ownership(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan(table(spark, folder, "documents"))


def op11_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(table(spark, folder, "embeddings"))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))


def op13_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.dedup(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_byte_bpe, op2_hilbert_shards, op3_source_mixing, op4_toxicity, op5_main_text, op6_preference_pairs,
        op7_ngram_jaccard, op8_nearest_vectors, op9_quality_votes, op10_secret_ownership,
        op11_centroid_clusters, op12_collocations, op13_exact_dedup,
    )
}
#: The mix as running sums over all rows of a source in hash order, which the histograms avoid.
MIX_SQL = r"""
with d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint size,
         ('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || md5(coalesce(text, ''))), 1, 15))::bigint h
  from documents),
s as (
  select *, case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end w
  from (select source, sum(size)::bigint source_size from d group by source)),
f as (
  select *, coalesce(sum(3 * source_size) over before, 0)::bigint fixed, coalesce(sum(w) over before, 0)::bigint gone,
         sum(source_size) over ()::bigint total, sum(w) over ()::bigint weight
  from s window before as (order by source_size / w, source nulls last rows between unbounded preceding and 1 preceding)),
l as (
  select coalesce(max((total - fixed) / (weight - gone)), 0) level
  from f where (total - fixed) / (weight - gone) * w <= 3 * source_size),
t as (select *, least(level * w, 3.0::double * source_size) target from s, l),
r as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end repeats from t),
q as (select *, target - repeats * source_size rest from r),
g as (
  select *, sum(size) over (partition by source order by h)::bigint upto
  from (select source, h, sum(size)::bigint size from d group by source, h)),
b as (
  select g.source, h, min(rest) rest, min(upto) upto, min(g.size) size,
         row_number() over (partition by g.source order by h) place
  from g join q on g.source is not distinct from q.source
  where upto > rest and rest > 0 and g.size > 0 group by g.source, h),
k as (
  select source, case when upto - rest < rest - (upto - size) then h + 1 else h end bound from b where place = 1)
select doc_id, d.size, source_size, target, (d.size * (repeats + (h < coalesce(bound, 0))::int))::bigint taken
from d join q on d.source is not distinct from q.source left join k on d.source is not distinct from k.source"""

PREFERENCE_SQL = """
with t as (
  select conv_id, list({'role': role, 'text': text} order by turn, role, text) turns
  from (select conv_id, turn, coalesce(role, 'user') role, coalesce(text, '') text from conversations where conv_id is not null)
  group by conv_id),
a as (
  select *, coalesce(list_max(list_transform(range(1, len(turns) + 1), lambda i: case when turns[i].role = 'assistant' then i else 0 end)), 0) last_turn
  from t),
o as (select conv_id, lead(turns[last_turn].text) over (order by conv_id) other, lead(true) over (order by conv_id) has_other
      from a where last_turn > 0),
p as (
  select a.conv_id pair_id, case when last_turn > 0 then turns[1:last_turn] else turns end c,
         case when last_turn > 0 then turns[last_turn + 1:] else [] end rest, last_turn, other, coalesce(has_other, false) has_other
  from a left join o using (conv_id)),
k as (
  select *, case when last_turn > 0 and not coalesce(has_other and other = c[last_turn].text, false) then last_turn - 1 else len(c) end k from p)
select pair_id, k::int prompt_turns,
       coalesce(list_aggregate(list_transform(c[1:k], lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), 'string_agg', ''), '') prompt,
       case when k < len(c) then '<|assistant|>' || chr(10) || c[last_turn].text || '<|end|>' || chr(10) else '' end chosen,
       case when k < len(c) then '14:' || (14 + length(c[last_turn].text) + 7) else '' end chosen_mask,
       case when k < len(c) and has_other then '<|assistant|>' || chr(10) || other || '<|end|>' || chr(10) else '' end rejected,
       case when k < len(c) and has_other then '14:' || (14 + length(other) + 7) else '' end rejected_mask,
       k < len(c) differs, len(rest)::int after_turns,
       coalesce(list_aggregate(list_transform(rest, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), 'string_agg', ''), '') "after"
from k"""

ORACLES: dict[str, str] = {
    "op3_source_mixing": MIX_SQL, "op6_preference_pairs": PREFERENCE_SQL, "op11_centroid_clusters": cluster_sql(),
    "op12_collocations": COLLOCATION_SQL, "op13_exact_dedup": DEDUP_SQL,
}
