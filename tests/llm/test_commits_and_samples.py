"""Commits that fail or come again, and samples that stay bounded whatever the table holds."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import difference
from tidemark.llm import langid, rules, simhash, textstats, token_counts, warc
from tidemark.llm.oracles import ORACLES
from tidemark.session import scratch_path

ROW = "source string, lang string, tokenizer string, documents long, tokens long, chars long"


def changes(spark, *rows):
    return spark.createDataFrame([("s", "en", "t", *r) for r in rows], ROW).repartition(len(rows))


def seen(spark, root):
    return sorted(tuple(r)[3:] for r in token_counts.totals(spark, root).collect())


def test_failed_replay_changes_nothing(spark):
    root = scratch_path(spark, "totals")
    assert seen(spark, root) == []
    token_counts.commit(spark, root, "a", changes(spark, (2, 20, 200), (1, 1, 1)))
    token_counts.commit(spark, root, "b", changes(spark, (1, 5, 50)))
    assert seen(spark, root) == [(4, 26, 251)]
    # Each sum fits; they overflow where they meet, in the task that writes
    with pytest.raises(Exception, match="(?i)overflow"):
        token_counts.commit(spark, root, "a", changes(spark, (2**62, 1, 1), (2**62, 1, 1)))
    assert seen(spark, root) == [(4, 26, 251)]
    token_counts.commit(spark, root, "a", changes(spark, (2, 20, 200), (1, 1, 1)))
    assert seen(spark, root) == [(4, 26, 251)]
    token_counts.commit(spark, root, "a", changes(spark, (1, 1, 1)))  # another content under the name takes its place
    assert seen(spark, root) == [(2, 6, 51)]


def test_compaction_closes_batches_and_bounds_reads(spark):
    root = scratch_path(spark, "totals")
    token_counts.compact(spark, root)  # of nothing
    for k in range(3):
        token_counts.commit(spark, root, f"b{k}", changes(spark, (1, k, 1)))
    before = seen(spark, root)
    token_counts.compact(spark, root)
    assert seen(spark, root) == before == [(3, 3, 3)]
    token_counts.commit(spark, root, "b1", changes(spark, (7, 7, 7)))  # closed
    assert seen(spark, root) == before
    token_counts.commit(spark, root, "b3", changes(spark, (-3, -3, -3)))
    assert seen(spark, root) == []
    token_counts.compact(spark, root)
    token_counts.commit(spark, root, "b4", changes(spark, (1, 1, 1)))
    files = token_counts.totals(spark, root).inputFiles()
    assert seen(spark, root) == [(1, 1, 1)] and all("gen=3" in f for f in files)
    # A compaction that dies before it is published leaves the readers where they were
    spark.createDataFrame([("s", "en", "t", 9, 9, 9)], ROW).write.parquet(f"{root}/gen=4/base")
    assert seen(spark, root) == [(1, 1, 1)]
    token_counts.compact(spark, root)
    assert seen(spark, root) == [(1, 1, 1)]


def test_language_of_copies_alone_is_learnt(spark):
    rng = np.random.default_rng(1)
    varied = [" ".join(rng.choice(["the", "cat", "sat", "on", "a", "mat", "then", "ran"], 12)) + f" {k}" for k in range(2000)]
    rows = [("en", t) for t in varied] + [("ru", "кошка сидела на коврике и смотрела в окно")] * 2000
    table = spark.createDataFrame(rows, "lang string, text string")
    model = langid.train(table, rows=200)
    again = langid.train(table.repartition(37), rows=200)
    assert model.languages == again.languages == ["en", "ru"] and (model.weights == again.weights).all()
    asked = spark.createDataFrame([("кошка на коврике",), ("the cat ran",)], "text string")
    assert [r["p"]["lang"] for r in asked.select(langid.predicted(model, F.col("text")).alias("p")).collect()] == ["ru", "en"]


def test_many_languages_are_bounded(spark):
    rows = [(f"l{k:03}", f"word{k} letters{j}") for k in range(60) for j in range(1 + k % 3)]
    model = langid.train(spark.createDataFrame(rows, "lang string, text string"), rows=40, most_languages=10)
    assert len(model.languages) == 10 and all(int(x[1:]) % 3 == 2 for x in model.languages)


def test_decoding_is_the_nearest_codeword_by_weighted_loss():
    rng = np.random.default_rng(2)
    x = rng.random((60, 16)).astype(np.float32)
    y = np.repeat([0, 1, 2], 20)
    x[np.arange(60), y] += 2
    model = langid.train_on(x, y, ["a", "b", "c"])
    best, share, ambiguous = model.decode(x)
    for row, found, score, near in zip(x.astype(float), best, share, ambiguous, strict=True):
        bits = [sum(row[j] * float(model.weights[j, b]) for j in range(16)) + model.bias[b] for b in range(model.words.shape[1])]
        loss = []
        for word in model.words:
            each = [np.exp(-2 * min(max(bit * sign, -4), 4)) * trust for bit, sign, trust in zip(bits, word, model.trust, strict=True)]
            loss.append(sum(each) / sum(model.trust))
        odds = [np.exp(-4 * (v - min(loss))) for v in loss]
        ranked = sorted((v / sum(odds) for v in odds), reverse=True)
        assert found == int(np.argmin(loss)) and score == pytest.approx(ranked[0], abs=1e-4)
        assert near == (ranked[0] - ranked[1] < langid.MARGIN) or abs(ranked[0] - ranked[1] - langid.MARGIN) < 1e-4


def test_rules_learn_from_a_bounded_sample_of_distinct_rows(spark, sf):
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    copies = docs.crossJoin(spark.range(20).select(F.col("id").alias("copy"))).filter("copy = 0 OR doc_id % 7 = 0").drop("copy")
    stats = rules.statistics(docs).cache()
    listed = list(map(str, rules.train(stats, labels)))
    assert listed == list(map(str, rules.train(rules.statistics(copies.repartition(40)), labels)))
    few = rules.train(stats, labels, most_rules=1, most_conditions=1)
    assert len(few) <= 1 and all(len(r.conditions) == 1 for r in few)
    # kept and base_failed of every row, by reading the list
    learnt = rules.train(stats, labels)
    rows = rules.judge(stats.select("doc_id", "s", *[c.alias(f"r_{n}") for n, c in textstats.ratios().items()]), learnt).collect()
    for r in rows:
        failed = r.s.n_words < 10 or 100 * r.s.n_repeat_words > 20 * r.s.n_words
        met = 0
        for number, rule in enumerate(learnt, 1):
            if all((r[f"r_{c.feature}"] > c.cut) == c.above for c in rule.conditions):
                met = number
                break
        assert (r.base_failed, r.rule, r.kept) == (failed, met, not failed and not met)


def test_common_shingles_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SAMPLED", 1)
    monkeypatch.setattr(simhash, "COMMON", 40)
    texts = [f"{'a b c d e f g h ' * (k % 3 > 0)} {'i j k l m n o p q r s t ' * (k % 2)} x{k}" for k in range(60)]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = rows.select(*simhash.text_key("text"), "text")
    hashes, counts = simhash.common_shingles(rows, 5)
    assert 0 < len(hashes) <= 60 and (np.diff(hashes.astype(object)) > 0).all() and counts.min() > 1


def test_warc_revisits_equal_the_sql(spark):
    """Equal payloads around the limit of 1000 bytes, null and empty ones, against the registered SQL."""
    same, small = "<p>é" + "x" * 995, "y" * 999
    pages = [same, same, small, small, None, "", "z" * 1000, "z" * 1000, "z" * 1000, "only one"]
    rows = [(i, f"http://a/{i}", html) for i, html in enumerate(pages)]
    table = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = warc.round_trip(table).toPandas()
    con = duckdb.connect()
    con.register("pages", table.toPandas())
    want = con.execute(ORACLES["op2_warc"]).df()
    assert difference(got, want) == ""
    assert sorted(got[got.record_type == "revisit"].page_id) == [0, 6, 7]
