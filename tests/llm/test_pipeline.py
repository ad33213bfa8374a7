"""The five stages on a small corpus, each against its plain meaning."""

import numpy as np
import public_tokenizers as P
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.cases import documents, empty, prose
from wardspark.llm import bpe
from wardspark.llm.queries import RANKS

SECRET = "token = 'zyxWVU987654tsrQPO'"


def corpus(spark):
    clean = [(i, prose(i + 2, 80 + i), "en", f"s{i % 3}") for i in range(40)]
    copies = [(100 + i, prose(i + 2, 80 + i), "en", "s1") for i in range(5)]
    junk = [(200 + i, " ".join(w + "%%" for w in prose(i + 50, 80).split()), "en", "s0") for i in range(12)]
    secret = [(300, prose(77, 90) + " " + SECRET, "en", "s2"), (301, None, "en", "s2"), (302, "", "en", None)]
    return spark.createDataFrame([(*r, len(r[1] or "")) for r in clean + copies + junk + secret],
                                 "doc_id long, text string, lang string, source string, n_chars long")


def test_stages(spark):
    docs, seen = corpus(spark), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        seen[name] = out.collect()
        docs = spark.createDataFrame(seen[name], out.schema)
    good = {r.doc_id for r in seen["quality_rules"]}
    assert good == {*range(40), *range(100, 105), 300}
    assert {r.doc_id for r in seen["jaccard_join"]} == good - set(range(100, 105))
    texts = {r.doc_id: r.text for r in seen["secret_scans"]}
    assert SECRET not in texts[300] and texts[300].startswith(prose(77, 90)) and all(texts[i] == prose(i + 2, 80 + i) for i in range(40))
    encode = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path(RANKS)), special_tokens={}).encode_ordinary
    assert len(seen["byte_bpe"]) == len(seen["source_mixing"])
    for r in seen["byte_bpe"]:
        assert np.frombuffer(r.ids, "<u4").tolist() == encode(texts[r.doc_id])


def test_stages_on_awkward_and_empty_tables(spark):
    for docs in (documents(spark), empty(spark)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            assert stage(spark, docs, "").columns == docs.columns
            stage(spark, docs, "").agg(F.count("*")).first()


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").columns == ["doc_id", "source", "n_tokens", "ids"]
