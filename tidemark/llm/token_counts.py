"""Token counts by source, language and tokenizer version, maintained by deltas.

Totals are additive: documents, tokens and characters. A change inserts a document's counts, deletes them,
or revises them from old to new, and is turned into signed rows. A batch of changes is summed over its keys
into a small delta.

Every attempt writes its delta to a folder of its own; only then one small entry that names it is appended to the
list of entries, and readers follow the entries, the latest of a batch alone. So an attempt that fails while it
writes changes nothing, whatever was there before, and a retried or replayed commit counts once: it need not
know whether it ran before. `compact` folds all deltas into the base of a new generation, after which reads
open that and the batches since; a batch that went into a base is closed, and a replay of it is left out.
One writer at a time commits or compacts; readers need not wait.

    root/current               the generations that are ready, one row each
    root/gen=N/base            totals of all batches before; covered: their names
    root/gen=N/entries         (batch, number, folder), appended
    root/gen=N/deltas/...      one folder an attempt
"""

from __future__ import annotations

import uuid
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import texts
from tidemark.sources.files import path_exists
from tidemark.llm.packing import parts

KEYS = ("source", "lang", "tokenizer")
MEASURES = ("documents", "tokens", "chars")
DELTA = "source string, lang string, tokenizer string, documents long, tokens long, chars long"
ENTRY = "batch string, number long, folder string"


@cache
def tokenizer(name: str):
    """A public byte-level vocabulary by the name of its file, as a tokenizer version."""
    import public_tokenizers

    from tidemark.llm.packing import encoding

    return encoding(str(public_tokenizers.path(name)))


def token_count(text: Column, version: str) -> Column:
    """Tokens of a whole text; 0 for an empty or null one."""

    def run(column: pa.Array) -> pa.Array:
        encode = tokenizer(version).encode_to_numpy
        decoded = (value.decode("utf-8", "replace") for value in texts(column))
        return pa.array([sum(len(encode(p, allowed_special="all")) for p in parts(t)) for t in decoded], pa.int64())

    return F.arrow_udf(run, "long")(text.cast("string"))


def counted(docs: DataFrame, version: str, *keep: str) -> DataFrame:
    """(doc_id, source, lang, tokenizer, tokens, chars) of each document and the columns to keep; a null source
    or lang counts as 'unknown', a null text as empty. Other columns are not read."""
    key = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("unknown")).alias(name)
    size = F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))).cast("long")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), key("source"), key("lang"), F.lit(version).alias("tokenizer"),
        token_count(F.col("text"), version).alias("tokens"), size.alias("chars"), *keep,
    )


def inserts(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(1).cast("long").alias("documents"), "tokens", "chars")


def deletes(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, F.lit(-1).cast("long").alias("documents"), (-F.col("tokens")).alias("tokens"), (-F.col("chars")).alias("chars"))


def revisions(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old counts go and new ones come; both sides cancel where a key and its counts stay."""
    return deletes(old).unionByName(inserts(new))


def summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*KEYS).agg(*[F.sum(m).cast("long").alias(m) for m in MEASURES])


def commit(spark: SparkSession, root: str, batch: str, changes: DataFrame) -> None:
    """Sum the signed changes over their keys and publish them under the batch's name, in place of what it held
    before. A batch that a compaction has closed stays as it is."""
    if not batch or not all(c.isalnum() or c in "-_" for c in batch):
        raise ValueError("a batch is named by letters, digits, - and _")
    here = _generation(spark, root)
    if not _read(spark, f"{here}/covered", "batch string").filter(F.col("batch") == batch).isEmpty():
        return
    folder = f"{batch}-{uuid.uuid4().hex}"
    summed(changes).write.parquet(f"{here}/deltas/{folder}")
    last = _read(spark, f"{here}/entries", ENTRY).agg(F.max("number")).first()[0] or 0
    _append(spark, f"{here}/entries", (batch, last + 1, folder), ENTRY)


def totals(spark: SparkSession, root: str) -> DataFrame:
    """(source, lang, tokenizer, documents, tokens, chars) over all committed batches, without keys that cancelled
    out. Where nothing was ever committed there are no rows."""
    return _totals(spark, _generation(spark, root))


def compact(spark: SparkSession, root: str) -> None:
    """Fold the base and the deltas into the base of a new generation, which readers then follow."""
    here = _generation(spark, root)
    number = int(here.rsplit("=", 1)[1]) + 1
    there = f"{root}/gen={number}"
    # An attempt that failed before it was published may have left files there
    _totals(spark, here).write.mode("overwrite").parquet(f"{there}/base")
    names = _read(spark, f"{here}/covered", "batch string").union(_read(spark, f"{here}/entries", ENTRY).select("batch"))
    names.distinct().write.mode("overwrite").parquet(f"{there}/covered")
    _append(spark, f"{root}/current", (number,), "generation long")


def _generation(spark: SparkSession, root: str) -> str:
    last = _read(spark, f"{root}/current", "generation long").agg(F.max("generation")).first()[0] or 0
    return f"{root}/gen={last}"


def _totals(spark: SparkSession, here: str) -> DataFrame:
    entries = _read(spark, f"{here}/entries", ENTRY)
    latest = entries.groupBy("batch").agg(F.max_by("folder", "number").alias("folder")).collect()  # batches since the base
    rows = _read(spark, f"{here}/base", DELTA)
    if latest:
        rows = rows.unionByName(spark.read.schema(DELTA).parquet(*[f"{here}/deltas/{r['folder']}" for r in latest]))
    return summed(rows).filter(" OR ".join(f"{m} != 0" for m in MEASURES))


def _read(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    return spark.read.schema(ddl).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], ddl)


def _append(spark: SparkSession, path: str, row: tuple, ddl: str) -> None:
    """One file with one row: it is there whole or not at all."""
    spark.createDataFrame([row], ddl).coalesce(1).write.mode("append").parquet(path)
