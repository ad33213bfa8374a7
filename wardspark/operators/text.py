"""Word and word-pair weights of the symptom classifier's text features."""

from __future__ import annotations

from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, Window, functions as F

from wardspark.session import spread_small, stage

# Runs of at least two word characters, and the vocabulary limits.
WORD = r"[\p{L}\p{N}_]{2,}+"
MAX_TERMS = 8000
MIN_DOCUMENTS = 2
SKETCH_WIDTH = 1 << 20
SKETCH_DEPTH = 2


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def pairs_of(tokens: Column) -> Column:
    """All pairs of neighbouring words."""
    return F.zip_with(
        F.slice(tokens, F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(0))),
        F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )


def with_pairs(tokens: Column) -> Column:
    """The words followed by all pairs of neighbouring words."""
    return F.concat(tokens, pairs_of(tokens))


def term_frequencies(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows (doc, term, tf) over whole texts.

    Texts are spread by document once; the count per (document, term) then needs no further
    shuffle, because its key contains the document. A task holds all terms of its texts: for whole tables
    ``counted_terms`` counts those of a vocabulary where each text lies.
    """
    spread = docs.select(F.col(doc_id).alias("doc"), F.col(text).alias("body")).repartition("doc")
    tokens = spread.select("doc", words(F.col("body")).alias("words"))
    return (
        tokens.select("doc", F.explode(with_pairs(F.col("words"))).alias("term"))
        .groupBy("doc", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )


def text_tokens(docs: DataFrame, text: str) -> DataFrame:
    """The rows without their text, with its ``words`` and a ``number`` of their own; stored, as all counts read them.

    Words have no blanks, so they are stored as one string, which costs far less than a list to write and to read.
    """
    joined = F.array_join(words(F.col(text)), " ")
    numbered = spread_small(docs).withColumns({"number": F.monotonically_increasing_id(), "words": joined})
    return stage(numbered.drop(text), "tokens").withColumn("words", F.when(F.col("words") != "", F.split("words", " ")))


def document_tokens(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``text_tokens`` in which all texts of one ``doc`` have the same number and are marked ``repeated``."""
    rows = text_tokens(docs.select(F.col(doc_id).alias("doc"), text), text)
    counted = rows.groupBy(F.col("doc").alias("_doc")).agg(F.min("number").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # Stored, so that its size is known before the texts would be moved for the join.
    again = stage(counted.where(F.col("_n") > 1).drop("_n"), "repeated-documents")
    return rows.join(again, F.col("doc").eqNullSafe(F.col("_doc")), "left").select(
        "doc", F.coalesce("_first", "number").alias("number"), F.col("_first").isNotNull().alias("repeated"), "words")


def _counted(occurrences: DataFrame, min_documents: int) -> DataFrame:
    """The count of every term that is in enough documents, from rows (number, term).

    Two documents are told by their smallest and largest number, without a row per term and document.
    """
    enough = F.min("number") < F.max("number") if min_documents == 2 else F.count_distinct("number") >= min_documents
    counts = occurrences.groupBy("term").agg(F.count(F.lit(1)).alias("corpus_count"), enough.alias("_enough"))
    return counts.where("_enough").drop("_enough")


def corpus_vocabulary(
    docs: DataFrame, text: str, max_terms: int = MAX_TERMS, min_documents: int = MIN_DOCUMENTS,
    width: int = SKETCH_WIDTH, depth: int = SKETCH_DEPTH,
) -> DataFrame:
    """``vocabulary`` without the counts per document, each text being a document."""
    tokens = text_tokens(docs.select(text), text)
    ranked = ranked_vocabulary(tokens, max_terms, min_documents, width, depth)
    return document_frequencies(ranked, stage(counted_terms(tokens, ranked), "term-counts")).drop("place")


def ranked_vocabulary(
    tokens: DataFrame, max_terms: int = MAX_TERMS, min_documents: int = MIN_DOCUMENTS,
    width: int = SKETCH_WIDTH, depth: int = SKETCH_DEPTH,
) -> DataFrame:
    """The terms of ``vocabulary`` (term, corpus_count, place), exact, and without moving rare pairs.

    Words, of which there are far fewer kinds than pairs, are counted first. The count of the last word that would fit into the
    vocabulary is the cut: no term below it can be in. Pairs go into a count-min sketch, ``depth`` rows of ``width``
    sums, whose least sum bounds a pair's count from above; only pairs whose bound reaches the cut are
    counted by name. The sketch is a table of depth * width numbers at most, so it is broadcast.
    """
    if not 0 < width * depth <= 1 << 23:
        raise ValueError("a sketch of more than 2^23 sums is not broadcast")
    single = stage(_counted(tokens.select("number", F.explode("words").alias("term")), min_documents), "words")
    top = single.select("corpus_count").orderBy(F.desc("corpus_count")).limit(max_terms)
    last = top.agg(F.count(F.lit(1)).alias("n"), F.min("corpus_count").alias("least")).first()
    cut = last["least"] if last["n"] == max_terms else 1
    pairs = tokens.select("number", F.explode(pairs_of(F.col("words"))).alias("term"))
    sums = (
        pairs.select(F.explode(_cells(width, depth)).alias("cell"))
        .groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= cut).select("cell")
    )
    heavy = stage(sums, "heavy-cells")
    rows = pairs
    for row in range(depth):
        cell = F.element_at(_cells(width, depth), row + 1)
        rows = rows.withColumn("cell", cell).join(F.broadcast(heavy), "cell", "left_semi").drop("cell")
    both = single.unionByName(_counted(rows, min_documents))
    chosen = both.orderBy(F.col("corpus_count").desc(), "term").limit(max_terms)
    order = Window.orderBy(F.col("corpus_count").desc(), "term")  # over max_terms rows at most
    return stage(chosen.withColumn("place", (F.row_number().over(order) - 1).cast("int")), "vocabulary")


def counted_terms(tokens: DataFrame, terms: DataFrame) -> DataFrame:
    """The rows with the places and counts of their known terms instead of ``words``: ``terms``, array<struct<place, tf>>.

    Each text is counted where it lies. The names, at most ``MAX_TERMS``, go to the tasks with the counter.
    """
    names = [r["term"] for r in terms.select("term", "place").orderBy("place").collect()]
    counter = CountVectorizerModel.from_vocabulary(names or [""], inputCol="_all", outputCol="_counts")
    given = F.coalesce(with_pairs(F.col("words")), F.array().cast("array<string>"))
    counted = counter.transform(tokens.withColumn("_all", given)).withColumn("_counts", F.unwrap_udt("_counts"))
    places = F.zip_with("_counts.indices", "_counts.values", lambda i, n: F.struct(i.alias("place"), n.alias("tf")))
    return counted.withColumn("terms", places).drop("words", "_all", "_counts")


def terms_by_document(counted: DataFrame) -> DataFrame:
    """Rows (doc, terms) from stored ``counted_terms`` of ``document_tokens``: counts of a document's texts are summed up."""
    sums = counted.where("repeated").select("doc", F.inline("terms")).groupBy("doc", "place").agg(F.sum("tf").alias("tf"))
    merged = sums.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("place", "tf"))).alias("terms"))
    return counted.where("not repeated").select("doc", "terms").unionByName(merged)


def document_frequencies(terms: DataFrame, counted: DataFrame) -> DataFrame:
    """Add ``df``, the number of rows of ``counted``, which is stored, that have the term."""
    df = counted.select(F.explode("terms.place").alias("place")).groupBy("place").agg(F.count(F.lit(1)).alias("df"))
    return terms.join(F.broadcast(df), "place").select("term", "corpus_count", "df", "place")


def unit_weights(counted: DataFrame, terms: DataFrame) -> DataFrame:
    """``tfidf`` inside each row: ``terms`` becomes array<struct<place, w>> of unit length.

    The inverse frequencies are one array, looked up as a scalar subquery.
    """
    held = F.transform(F.array_sort(F.collect_list(F.struct("place", "idf"))), lambda e: e["idf"])
    idf = terms.agg(held.alias("idf")).scalar()
    raw = F.transform("terms", lambda t: F.struct(t["place"].alias("place"), ((F.log(t["tf"]) + 1) * F.get("_idf", t["place"])).alias("w")))
    norm = F.sqrt(F.aggregate("terms", F.lit(0.0), lambda total, t: total + t["w"] * t["w"]))
    # The norm is bound beside the list: as a column it would be inlined and computed for each entry.
    bound = F.array(F.struct("terms", norm.alias("norm")))
    unit = F.transform(bound, lambda b: F.transform(
        b["terms"], lambda t: F.struct(t["place"].alias("place"), (t["w"] / b["norm"]).alias("w"))))
    weighted = counted.withColumn("_idf", idf).withColumn("terms", raw).drop("_idf")
    return weighted.withColumn("terms", F.get(unit, F.lit(0)))


def _cells(width: int, depth: int) -> Column:
    """The cells of ``term`` in every row of the sketch, numbered throughout."""
    return F.array(*[
        (F.pmod(F.xxhash64(F.lit(row), F.col("term")), F.lit(width)) + row * width).cast("int") for row in range(depth)
    ])


def vocabulary(
    frequencies: DataFrame, max_terms: int = MAX_TERMS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """The most frequent terms (term, corpus_count, df); ties in alphabetic order."""
    return (
        frequencies.groupBy("term")
        .agg(F.sum("tf").cast("bigint").alias("corpus_count"), F.count(F.lit(1)).alias("df"))
        .where(F.col("df") >= min_documents)
        .orderBy(F.col("corpus_count").desc(), "term")
        .limit(max_terms)
    )


def inverse_frequencies(vocab: DataFrame, documents: DataFrame) -> DataFrame:
    """Add the smoothed ``idf = ln((1 + N) / (1 + df)) + 1`` with N the number of documents."""
    n = documents.agg(F.count(F.lit(1)).alias("n")).scalar()
    idf = F.log((n + 1) / (F.col("df") + 1)) + 1
    return vocab.withColumn("idf", idf)


def tfidf(frequencies: DataFrame, terms: DataFrame) -> DataFrame:
    """Rows (doc, term, weight): (1 + ln tf) * idf, scaled to unit length per document.

    ``terms`` has at most ``MAX_TERMS`` rows, so it is broadcast. The norm is a window over
    the terms of one document, which the same limit bounds.
    """
    raw = frequencies.join(F.broadcast(terms.select("term", "idf")), "term").select(
        "doc", "term", ((F.log("tf") + 1) * F.col("idf")).alias("w")
    )
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc")))
    return raw.select("doc", "term", (F.col("w") / norm).alias("weight"))


def age_scaled(records: DataFrame, key: str, age: str = "age") -> DataFrame:
    """Age minus its mean, over its population deviation (1 when that is 0)."""
    moments = F.struct(F.avg(age).alias("mean"), F.stddev_pop(age).alias("sd"))
    stats = records.agg(moments).scalar()
    scale = F.when(stats["sd"] == 0, F.lit(1.0)).otherwise(stats["sd"])
    return records.select(key, age, ((F.col(age) - stats["mean"]) / scale).alias("age_scaled"))
