"""The registered queries of the operators, by name: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontam, langid, negatives, packing, pii, prefix_trie, quality, rules, simhash, substrings, token_counts, toxicity, warc
from tidemark.llm.common import fresh, table
from tidemark.llm.oracles import ORACLES
from tidemark.session import materialize, scratch_path


def _remainder(divisor: int):
    """crc32 of the doc_id as text, modulo; a null doc_id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in sequences of 2048 tokens: a row per piece."""
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through WARC archives and back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its fingerprint and the smallest doc_id that links reach."""
    found = simhash.similar(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals after three batches over all documents: a load, a revision, and withdrawals.

    The load inserts every document under the first tokenizer version. The revision moves the sources of even
    number to the second version, old counts out and new ones in. The withdrawals delete every document that
    holds no lower-case letter. The load is committed twice, as after a lost acknowledgement.
    """
    first, second = "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"
    moved = F.coalesce(F.regexp_extract("source", "([0-9]+)$", 1).try_cast("long") % 2 == 0, F.lit(False))
    gone = ~F.coalesce(F.col("text").rlike(r"\p{Ll}"), F.lit(False))
    docs = table(spark, sf_dir, "documents")
    moves, goes = fresh(docs, "_moved"), fresh(docs, "_gone")
    docs = docs.withColumns({moves: moved, goes: gone})
    old = materialize(token_counts.counted(docs, first, moves, goes), "op4-first")
    new = materialize(token_counts.counted(docs.filter(F.col(moves)), second, goes), "op4-second")
    root = scratch_path(spark, "op4-totals")
    for _ in range(2):
        token_counts.commit(spark, root, "load", token_counts.inserts(old))
    token_counts.commit(spark, root, "revision", token_counts.revisions(old.filter(F.col(moves)), new))
    current = old.filter(~F.col(moves)).select(*new.columns).unionByName(new)
    token_counts.commit(spark, root, "withdrawal", token_counts.deletes(current.filter(F.col(goes))))
    return token_counts.totals(spark, root)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document under the base rules and a learnt decision list."""
    stats = materialize(rules.statistics(table(spark, sf_dir, "documents")), "op5-stats")
    learnt = rules.train(stats, table(spark, sf_dir, "labels"))
    judged = rules.judge(stats, learnt)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("doc_id", *[F.col(f"s.{c}").alias(c) for c in counts], "base_failed", "kept", "rule")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    docs = table(spark, sf_dir, "documents")
    held_out = _remainder(3) == 1
    model = langid.train(docs.filter(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), langid.predicted(model, F.col("text")).alias("p"))
    return found.select(
        "doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"),
        F.col("p.ambiguous").alias("ambiguous"),
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and spans."""
    found = pii.find(table(spark, sf_dir, "documents"))
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[number(kind) for kind in pii.BASE_KINDS],
        F.sha2(pii.listed(F.col("base")), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item that some document holds, with the document and the alignment's score."""
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the strings of 200 bytes that occur elsewhere."""
    found = substrings.remove(table(spark, sf_dir, "documents"), with_bytes=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality score."""
    stats = materialize(quality.statistics(table(spark, sf_dir, "documents")), "op10-stats")
    held_out = _remainder(5) == 0
    model = quality.train(stats, table(spark, sf_dir, "labels"), held_out)
    scored = quality.predictions(stats, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of the rebuilt conversations."""
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its toxicity score."""
    docs = table(spark, sf_dir, "documents")
    held_out = _remainder(5) == 0
    network = toxicity.train(docs.filter(~held_out), table(spark, sf_dir, "labels"))
    return toxicity.predictions(docs, network, held_out.alias("held_out"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for every hundredth vector and each of its five positives."""
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.select("vec_id", label.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


CATALOGUE = {
    "op1_packing": op1_packing,
    "op2_warc": op2_warc,
    "op3_simhash": op3_simhash,
    "op4_token_counts": op4_token_counts,
    "op5_quality_rules": op5_quality_rules,
    "op6_language_id": op6_language_id,
    "op7_pii": op7_pii,
    "op8_decontamination": op8_decontamination,
    "op9_substrings": op9_substrings,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_toxicity": op12_toxicity,
    "op13_hard_negatives": op13_hard_negatives,
}

__all__ = ["CATALOGUE", "ORACLES"]
