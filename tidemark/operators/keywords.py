"""Keyword events, top keywords and TF-IDF."""

from __future__ import annotations

from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark import settings as S
from tidemark.functions import text


def keyword_events(posts: DataFrame, keep: tuple[str, ...] = ("timestamp", "source")) -> DataFrame:
    """One row per keyword occurrence of English posts with raw text.

    Explodes the words first and filters rows afterwards: the filter is compiled, unlike a
    lambda over the array, and only the kept columns travel with each word.
    """
    english = posts.filter(F.col("lang").isNull() | (F.col("lang") == "en"))
    words = english.select(F.explode(text.words(F.col("text"))).alias("keyword"), *keep)
    return words.filter(text.is_token(F.col("keyword")))


def token_events(processed: DataFrame, keep: tuple[str, ...] = ("timestamp", "source")) -> DataFrame:
    """The same from processed posts, whose tokens are already filtered."""
    words = processed.select(F.explode("tokens").alias("keyword"), *keep)
    return words.filter(F.col("keyword").isNotNull() & (F.col("keyword") != ""))


def filter_keywords(events: DataFrame, min_length: int = S.MIN_TOKEN_LENGTH) -> DataFrame:
    return events.filter(text.is_keyword(F.col("keyword"), min_length))


def top_keywords(events: DataFrame, n: int = S.TOP_KEYWORDS) -> DataFrame:
    """The n most frequent keywords; equal counts in keyword order."""
    counts = events.groupBy("keyword").agg(F.count("*").alias("frequency"))
    return counts.orderBy(F.desc("frequency"), "keyword").limit(n)


def term_counts(tokens: Column) -> Column:
    """Array of (keyword, tf) of a sorted token array: one entry per run of equal tokens.

    `tokens` must be a stored column, not an expression, or each entry would compute it anew.
    """
    size = F.size(tokens)
    starts = F.filter(
        F.sequence(F.lit(1), size),
        lambda i: (i == 1) | (F.get(tokens, i - 1) != F.get(tokens, i - 2)),
    )
    ends = F.concat(F.slice(starts, 2, size), F.array(size + 1))
    runs = F.zip_with(
        starts,
        ends,
        lambda start, end: F.struct(
            F.get(tokens, start - 1).alias("keyword"), (end - start).cast("bigint").alias("tf")
        ),
    )
    return F.when(size > 0, runs)


def score_terms(terms: DataFrame, n_docs: Column, min_doc_freq: int = S.MIN_DOC_FREQ) -> DataFrame:
    """TF-IDF per keyword from (keyword, tf) rows, one per document and keyword."""
    sums = terms.groupBy("keyword").agg(
        F.count("*").alias("df"),
        F.sum("tf").alias("tf"),
        F.sum(F.col("tf") * F.col("tf")).alias("tf2"),
    )
    idf = F.when(
        F.col("df") >= min_doc_freq, F.log((n_docs + 1) / (F.col("df") + 1).cast("double"))
    ).otherwise(F.lit(0.0))
    return sums.select(
        "keyword", (F.col("tf2") * idf / F.col("tf")).alias("avg_tfidf_score"), F.col("tf").alias("frequency")
    )


def tfidf_keywords(processed: DataFrame, min_doc_freq: int = S.MIN_DOC_FREQ) -> DataFrame:
    """Mean TF-IDF per keyword of processed posts (`tokens`), unordered."""
    return _scored_terms(processed, min_doc_freq).drop("frequency")


def _scored_terms(processed: DataFrame, min_doc_freq: int) -> DataFrame:
    """(keyword, avg_tfidf_score, frequency) of every token.

    Terms are counted inside each row, so documents are never shuffled: the one exchange carries
    per-keyword sums that were already combined in each map task.
    """
    ordered = processed.select(F.sort_array("tokens").alias("tokens"))
    terms = ordered.select(F.inline(term_counts(F.col("tokens"))))
    n_docs = processed.select(F.count("*").alias("n")).scalar()
    return score_terms(terms, n_docs, min_doc_freq)


def ranked_tfidf(processed: DataFrame, min_doc_freq: int = S.MIN_DOC_FREQ) -> DataFrame:
    return tfidf_keywords(processed, min_doc_freq).orderBy(F.desc("avg_tfidf_score"), "keyword")


def keyword_table(
    processed: DataFrame, n: int = S.TOP_KEYWORDS, min_doc_freq: int = S.MIN_DOC_FREQ
) -> DataFrame:
    """Top keywords with their mean TF-IDF; counts and scores come from the same pass."""
    scored = filter_keywords(_scored_terms(processed, min_doc_freq))
    return scored.orderBy(F.desc("frequency"), "keyword").limit(n).select(*schemas.names(schemas.KEYWORD_TABLE))


def hashed_tfidf(
    processed: DataFrame,
    dimensions: int = S.TFIDF_DIMENSIONS,
    min_doc_freq: int = S.MIN_DOC_FREQ,
) -> DataFrame:
    """Hashed TF-IDF vector per document."""
    counts = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=dimensions).transform(
        processed.select("id", "tokens")
    )
    model = IDF(inputCol="tf", outputCol="tfidf", minDocFreq=min_doc_freq).fit(counts.select("tf"))
    return model.transform(counts).select("id", "tfidf")


def term_bucket(keyword: Column, dimensions: int) -> Column:
    """The bucket of a keyword: the first 32 bits of its MD5, modulo. Any engine can tell it."""
    return F.pmod(F.conv(F.substring(F.md5(keyword.cast("binary")), 1, 8), 16, 10).cast("bigint"), F.lit(dimensions)).cast("int")


def hashed_terms(processed: DataFrame, dimensions: int = S.TFIDF_DIMENSIONS) -> DataFrame:
    """(id, bucket, tf) of every document and bucket that its tokens fall into, counted inside its row."""
    ordered = processed.select("id", F.sort_array(F.transform("tokens", lambda t: term_bucket(t, dimensions))).alias("tokens"))
    return ordered.select("id", F.inline(term_counts(F.col("tokens")))).withColumnRenamed("keyword", "bucket")


def hashed_weights(
    processed: DataFrame, dimensions: int = S.TFIDF_DIMENSIONS, min_doc_freq: int = S.MIN_DOC_FREQ
) -> DataFrame:
    """(id, bucket, tf, documents, weight): hashed TF-IDF as a long table, one row per document and bucket.

    `documents` is how many documents hold the bucket. The table of buckets has `dimensions` rows at most, so it meets
    the terms by a join that Spark broadcasts.
    """
    terms = hashed_terms(processed, dimensions)
    n_docs = processed.select(F.count("*").alias("n")).scalar()
    held = terms.groupBy("bucket").agg(F.count("*").alias("documents"))
    rare = F.col("documents") < min_doc_freq
    idf = held.withColumn("idf", F.when(rare, F.lit(0.0)).otherwise(F.log((n_docs + 1) / (F.col("documents") + 1).cast("double"))))
    return terms.join(idf, "bucket").select("id", "bucket", "tf", "documents", (F.col("tf") * F.col("idf")).alias("weight"))


def bucket_map(processed: DataFrame, dimensions: int = S.TFIDF_DIMENSIONS) -> DataFrame:
    """(bucket, keyword, documents): which keywords fall into each bucket. A bucket with several rows is a collision."""
    words = processed.select(F.explode(F.array_distinct("tokens")).alias("keyword"))
    counts = words.groupBy("keyword").agg(F.count("*").alias("documents"))
    return counts.select(term_bucket(F.col("keyword"), dimensions).alias("bucket"), "keyword", "documents")
