from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark import settings as S
from tidemark.functions import text
from tidemark.operators import entities, keywords, normalize

TEXTS = [
    "Hello WORLD! see https://a.b/c?d=1 now",
    "www.site.org is down, #Spark @user 2024",
    "  tabs\tand\nnewlines   everywhere  ",
    "123 4567 a1 ab abc a-b-c",
    "The and via RT amp http",
    "naïve café ÜBER",
    "",
    "!!! ...",
    "https://only.link",
    "word " * 5000,
]


def brute_clean(raw: str) -> str:
    out = re.sub(r"https?://\S+|www\.\S+", " ", raw).lower()
    out = re.sub(r"[^a-z0-9\s#@]", " ", out)
    return re.sub(r"\s{2,}", " ", out).strip(" ")


def brute_tokens(raw: str) -> list[str]:
    stop = {*S.STOPWORDS, *S.EXTRA_STOPWORDS}
    return [
        t
        for t in re.split(r"\s+", brute_clean(raw))
        if len(t) >= 3 and re.search("[a-z]", t) and not re.fullmatch(r"[\d\W]+", t) and t not in stop
    ]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(str(i), t, "en", "s") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "id string, text string, lang string, source string")


def test_clean_and_tokens(texts):
    done = texts.withColumn("c", text.clean(F.col("text"))).withColumn("t", text.tokens(F.col("c")))
    for row in done.collect():
        assert row["c"] == brute_clean(row["text"])
        assert row["t"] == brute_tokens(row["text"])


def test_events_of_raw_text_equal_tokens(texts):
    made = keywords.keyword_events(texts, ("id",)).groupBy("id").agg(F.collect_list("keyword").alias("k"))
    got = {r["id"]: sorted(r["k"]) for r in made.collect()}
    want = {str(i): sorted(brute_tokens(t)) for i, t in enumerate(TEXTS) if brute_tokens(t)}
    assert got == want


def test_language_filter_keeps_unknown(spark):
    df = spark.createDataFrame([("a", "en"), ("b", None), ("c", "de")], "id string, lang string")
    assert sorted(r["id"] for r in normalize.english(df).collect()) == ["a", "b"]


def test_truncate_and_link_id(spark):
    df = spark.createDataFrame([("abcdefghij",), ("abc",)], "s string")
    shown = [r[0] for r in df.select(text.truncate(F.col("s"), 8)).collect()]
    assert shown == ["abcde...", "abc"]
    assert len(df.select(text.link_id(F.col("s"))).first()[0]) == 16


def test_is_keyword(spark):
    df = spark.createDataFrame([("ab",), ("123",), ("a12",), ("###",), ("abc",)], "k string")
    assert [r["k"] for r in df.filter(text.is_keyword(F.col("k"))).collect()] == ["a12", "abc"]


def test_term_counts_and_tfidf(spark):
    docs = [("1", ["b", "a", "b"]), ("2", ["a"]), ("3", []), ("4", ["c", "c"])]
    df = spark.createDataFrame(docs, "id string, tokens array<string>")
    got = {r["keyword"]: r["avg_tfidf_score"] for r in keywords.tfidf_keywords(df).collect()}
    import math

    # a is in two of four documents, once each; b and c are in one and weigh nothing
    assert got.keys() == {"a", "b", "c"}
    assert got["a"] == pytest.approx(math.log(5 / 3))
    assert got["b"] == got["c"] == 0.0


def test_hashed_tfidf_equals_relational(spark):
    from pyspark.ml.feature import HashingTF

    docs = [("1", ["spark", "data", "spark"]), ("2", ["data", "trend"]), ("3", ["spark"]), ("4", [])]
    df = spark.createDataFrame(docs, "id string, tokens array<string>")
    rows = {r["id"]: r["tfidf"] for r in keywords.hashed_tfidf(df).collect()}
    index = HashingTF(numFeatures=S.TFIDF_DIMENSIONS).indexOf
    import math

    idf = {"spark": math.log(5 / 3), "data": math.log(5 / 3), "trend": 0.0}
    for name, tokens in docs:
        for token in set(tokens):
            assert rows[name][index(token)] == pytest.approx(tokens.count(token) * idf[token])


def test_entities_in_text_order(spark):
    docs = spark.createDataFrame(
        [("1", "s", "new york beats boston in new york"), ("2", "s", "nothing here"), ("3", "s", "")],
        "id string, source string, clean_text string",
    )
    words = spark.createDataFrame(
        [("new york", "GPE"), ("boston", "GPE"), ("york", "PERSON")], "entity string, label string"
    )
    got = {
        r["id"]: [(e["entity"], e["label"]) for e in r["entities"]]
        for r in entities.tag_entities(docs, words, 2, ("id", "source")).collect()
    }
    assert got["1"] == [
        ("new york", "GPE"), ("york", "PERSON"), ("boston", "GPE"), ("new york", "GPE"), ("york", "PERSON"),
    ]
    assert got["2"] == got["3"] == []


def test_entities_keep_rows_with_null_and_repeated_keys(spark):
    rows = [("1", None, "in france"), ("1", None, "from spain"), (None, "s", "france france"), (None, "s", None), ("1", "s", "")]
    docs = spark.createDataFrame(rows, "id string, source string, clean_text string")
    labels = [("france", "GPE"), ("spain", "ORG"), ("from", "PERSON"), ("in france", "EVENT")]
    words = spark.createDataFrame(labels, "entity string, label string")
    got = entities.tag_entities(docs, words, 2, ("id", "source")).collect()
    found = sorted((str(r["id"]), str(r["source"]), [e["label"] for e in r["entities"]]) for r in got)
    assert found == [
        ("1", "None", ["EVENT", "GPE"]), ("1", "None", ["PERSON", "ORG"]), ("1", "s", []),
        ("None", "s", []), ("None", "s", ["GPE", "GPE"]),
    ]


@pytest.mark.parametrize("block_bytes", [1 << 20, 400, 30])
def test_entities_equal_every_run_joined_to_the_dictionary(spark, block_bytes):
    rng = random.Random(4)
    words = ["ab", "cd", "ef", "gh", "é"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 40))) + rng.choice(["", " ", "\n ab", "\u00a0ab"]) for _ in range(80)]
    dictionary = [(" ".join(rng.choices(words, k=rng.randint(1, 4))), rng.choice(["PERSON", "ORG", "GPE", "EVENT"])) for _ in range(60)]
    dictionary += [(None, "ORG"), ("ab", None), ("", "ORG"), ("ab  cd", "ORG"), (" ab", "ORG"), ("ab", "ORG"), ("ab", "ORG")]
    rows = [(None if k % 9 == 0 else k, None, t) for k, t in enumerate(texts)] + [(1, None, None), (1, None, "")]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "id int, timestamp timestamp, clean_text string, entity string")
    got = entities.tag_entities(
        docs, spark.createDataFrame(dictionary, "entity string, label string"), 3, ("id", "timestamp"), block_bytes
    ).collect()
    want = []
    for key, _, text in rows:
        parts = re.split(r"[ \t\n\x0b\f\r]+", text or "")
        parts = [p for p in parts if p]
        runs = [(i, " ".join(parts[i : i + n])) for i in range(len(parts)) for n in (1, 2, 3) if i + n <= len(parts)]
        found = sorted((i, run, label) for i, run in runs for entity, label in dictionary if entity == run and label is not None)
        want.append((str(key), [(run, label) for _, run, label in found]))
    assert sorted((str(r["id"]), [tuple(e) for e in r["entities"]]) for r in got) == sorted(want)


def test_entities_take_no_exchange(spark):
    docs = spark.range(10).select("id", F.lit("in new york").alias("clean_text"))
    words = spark.createDataFrame([("new york", "GPE")], "entity string, label string")
    plan = entities.tag_entities(docs, words, 2, ("id",))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "Generate" not in plan
    none = entities.tag_entities(docs, words.limit(0), 2, ("id",))
    assert none.count() == 10 and none.filter("size(entities) > 0").isEmpty()


def test_words_are_split_by_single_characters(spark):
    """The class of word characters names each: ranges take several times as long. The words are the same."""
    assert "-" not in text.NOT_WORD
    odd = "Ab-c d_e\tf9#x @u,,é ß×0z\u2028ÀK\U0001f600q [x^y] \\w `{|}~ /:;<=>? A\x00b"
    frame = spark.createDataFrame([(odd,), ("",), (None,)], "t string")
    got = frame.select(text.words(F.col("t")), F.split(F.lower(text.strip_links(F.col("t"))), "[^a-z0-9#@]+")).collect()
    assert [r[0] for r in got] == [r[1] for r in got] and len(got[0][0]) > 10
