"""Related keywords of every tracked keyword: an edge list by documents in common."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import settings as S
from tidemark.functions.text import is_token

#: A task's counters are the square of the tracked keywords; so many at most.
MOST_TRACKED = 4096
#: Documents whose marks are multiplied at a time.
ROWS = 512


def tracked_keywords(words_per_doc: DataFrame, n: int = S.TOP_KEYWORDS) -> DataFrame:
    """(keyword, documents) of the n keywords found in most documents; equal numbers in keyword order."""
    words = words_per_doc.select(F.explode(F.array_distinct("words")).alias("keyword"))
    counts = words.filter(is_token(F.col("keyword"))).groupBy("keyword").agg(F.count("*").alias("documents"))
    return counts.orderBy(F.desc("documents"), "keyword").limit(n)


def marks(words: pa.Array, keywords: pa.Array) -> np.ndarray:
    """(document, keyword): 1 where the document holds the keyword. Null lists and words hold none."""
    words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
    found = np.zeros((len(words), len(keywords)), np.float32)
    of = pc.list_parent_indices(words)
    at = pc.index_in(words.flatten(), value_set=keywords)
    held = at.is_valid()
    found[of.filter(held).to_numpy(), at.filter(held).to_numpy()] = 1
    return found


def together(words_per_doc: DataFrame, keywords: list[str]) -> DataFrame:
    """(a, b, documents): numbers of two keywords, a < b, and in how many documents both are.

    A task keeps one counter for each pair of tracked keywords and adds a block of documents to all of them by
    a product of their marks, so a document of any length costs its words and a row of marks; its pairs are
    never listed. What leaves a task is a row per pair that it has seen at all.
    """
    sent = words_per_doc.sparkSession.sparkContext.broadcast(keywords)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(sent.value, pa.string())
        counts = np.zeros((len(known), len(known)))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                block = marks(batch["words"].slice(at, ROWS), known)
                counts += block.T @ block  # sums of at most ROWS ones are exact in single precision
        a, b = np.nonzero(np.triu(counts, 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int32()), pa.array(b, pa.int32()), pa.array(counts[a, b].astype(np.int64))], names=["a", "b", "documents"]
        )

    pairs = words_per_doc.select("words").mapInArrow(run, "a int, b int, documents long")
    return pairs.groupBy("a", "b").agg(F.sum("documents").alias("documents"))


def related_edges(words_per_doc: DataFrame, n: int = S.TOP_KEYWORDS, k: int = 6) -> DataFrame:
    """(keyword, related, documents, rank): for each of the n keywords found in most documents, the k others of
    them that it shares most documents with; equal numbers in keyword order.

    From one row per document with its `words`, of any length. Repeated words count once, documents as often as
    they are repeated. A keyword that meets no other has no edge. Counts are exact; n is at most MOST_TRACKED.
    """
    if not 0 < n <= MOST_TRACKED:
        raise ValueError(f"between 1 and {MOST_TRACKED} keywords are tracked, not {n}")
    names = [r["keyword"] for r in tracked_keywords(words_per_doc, n).collect()]  # n rows
    spark = words_per_doc.sparkSession
    numbered = spark.createDataFrame([(i, w) for i, w in enumerate(names)], "number int, keyword string")
    pairs = together(words_per_doc, names)
    ways = F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("b").alias("y")), F.struct(F.col("b").alias("x"), F.col("a").alias("y"))))
    both = pairs.select("documents", ways.alias("e")).select("e.x", "e.y", "documents")  # n * (n - 1) rows at most
    named = both.join(numbered.select(F.col("number").alias("y"), F.col("keyword").alias("related")), "y")
    named = named.join(numbered.select(F.col("number").alias("x"), "keyword"), "x")
    order = Window.partitionBy("keyword").orderBy(F.desc("documents"), "related")
    ranked = named.select("keyword", "related", "documents", F.row_number().over(order).alias("rank"))
    return ranked.filter(F.col("rank") <= k)
