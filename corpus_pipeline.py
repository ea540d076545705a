"""From raw documents to packed training sequences: five stages, each one operator of tidemark.llm.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, packing, pii, quality, simhash
from tidemark.llm.common import table
from tidemark.session import discard, scratch, scratch_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.reject(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies: SimHash links and the pairs that are further apart in
    bits, both held against a similarity of 0.8 of the shingles of five words."""
    return simhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in sequences of 2048: a row per piece."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("near dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("personal data", pii_stage),
    ("packing", packing_stage),
]

#: Models, fingerprints, alignments and token ids have no SQL form; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, one after another. Of what they write only the last table stays."""
    docs, before = table(spark, sf_dir, "documents"), None
    for number, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"pipeline-{number}", kept=True)
        with scratch():
            made = stage(spark, docs, sf_dir)
            made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
        if before is not None:
            discard(before)
        before = path
    return docs
