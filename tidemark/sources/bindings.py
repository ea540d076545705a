"""The given tables in the shapes the operators take.

None of the tables holds social posts, so each binding derives them, whole table by whole table:
documents stand for tweets, conversations for forum posts, pages for news, part names and event
types for denser keyword series. Post times come from the row's key, spread over 30 days.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import text, times
from tidemark.operators.keywords import keyword_events

EPOCH = 1704067200  # 2024-01-01 00:00:00 UTC
SPREAD = 30 * 86400
STRIDE = 104729


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _seconds(key: Column) -> Column:
    return F.lit(EPOCH) + F.pmod(key * STRIDE, F.lit(SPREAD))


def _iso(seconds: Column) -> Column:
    return F.date_format(F.timestamp_seconds(seconds), times.ISO_OUT)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a post, with its own source."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.col("doc_id").cast("string").alias("id"),
        "text",
        F.timestamp_seconds(_seconds(F.col("doc_id"))).alias("timestamp"),
        "source",
        F.col("n_chars").cast("int").alias("engagement"),
        "lang",
    )


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts with the batch, 0 to 3, in which they arrive: every eight days one, and every ninth post one or two late."""
    key = F.col("id").cast("bigint")
    on_time = F.floor((F.unix_timestamp("timestamp") - EPOCH) / (8 * 86400))
    delay = F.when(key % 9 == 0, 1 + key % 2).otherwise(0)
    return posts(spark, sf_dir).withColumn("batch", F.least(on_time + delay, F.lit(3)).cast("int"))


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """English posts with clean text and tokens."""
    cleaned = (
        posts(spark, sf_dir)
        .filter(F.col("lang").isNull() | (F.col("lang") == "en"))
        .withColumn("clean_text", text.clean(F.col("text")))
        .withColumn("tokens", text.tokens(F.col("clean_text")))
    )
    return cleaned.select(*schemas.names(schemas.PROCESSED))


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyword events of all posts."""
    return keyword_events(posts(spark, sf_dir))


def part_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the part names of every line item: few keywords, dense series."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_shipdate", "l_returnflag")
    names = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return lines.join(names, "l_partkey").select(
        F.explode(F.split("p_name", " ")).alias("keyword"),
        F.col("l_shipdate").cast("timestamp").alias("timestamp"),
        F.col("l_returnflag").alias("source"),
    )


def event_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types as keywords, at the events' own times."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("keyword"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("group"), (F.col("user_id") % 4).cast("string")).alias("source"),
    )


def raw_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in the flat tweet layout; counts from the event of the same number."""
    docs = table(spark, sf_dir, "documents")
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("doc_id"), "user_id", "event_type", "value", "props"
    )
    joined = docs.join(events, "doc_id", "left")
    k = F.get_json_object("props", "$.k").cast("int")
    return joined.select(
        F.concat(F.lit("tw_"), F.col("doc_id").cast("string")).alias("id"),
        "text",
        _iso(_seconds(F.col("doc_id"))).alias("created_at"),
        F.col("user_id").cast("string").alias("author_id"),
        F.when(F.col("lang") != "es", F.col("lang")).alias("lang"),
        "source",
        k.alias("retweet_count"),
        F.floor("value").cast("int").alias("like_count"),
        F.when(F.col("user_id") % 3 > 0, F.col("user_id").cast("int")).alias("reply_count"),
        F.when(F.col("event_type").isNotNull(), F.array("event_type", "source")).alias("hashtags"),
        F.lit("twitter").alias("data_source"),
    )


def raw_forum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns in the forum layout; every fifth has its text in the title and no body."""
    turns = table(spark, sf_dir, "conversations")
    bare = F.pmod(F.col("conv_id") * 8 + F.col("turn"), F.lit(5)) == 0
    return turns.select(
        F.concat_ws("_", F.lit("rd"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.when(bare, F.concat_ws(" ", "role", "text")).otherwise(F.col("role")).alias("title"),
        F.when(~bare, F.col("text")).alias("selftext"),
        F.concat(F.lit("r"), (F.col("conv_id") % 7).cast("string")).alias("subreddit"),
        (F.col("turn") * 3).cast("int").alias("score"),
        F.when(F.col("role") == "user", F.col("turn").cast("int")).alias("num_comments"),
        _seconds(F.col("conv_id") * 8 + F.col("turn")).alias("created_utc"),
        F.concat(F.lit("https://forum.example/"), F.col("conv_id").cast("string")).alias("url"),
        F.lit("reddit").alias("data_source"),
    )


def _first_group(html: str, pattern: str) -> Column:
    return F.regexp_extract(html, pattern, 1)


def feed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as entries of a feed; dates as RFC 2822, ISO, plain day or text that is no date."""
    pages = table(spark, sf_dir, "pages")
    at = F.timestamp_seconds(_seconds(F.col("page_id")))
    key = F.col("page_id") % 5
    published = (
        F.when(key == 0, F.concat(F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
        .when(key == 1, F.concat(F.date_format(at, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0200")))
        .when(key == 2, F.date_format(at, "yyyy-MM-dd"))
        .when(key == 3, _iso(_seconds(F.col("page_id"))))
        .otherwise(F.lit("soon"))
    )
    return pages.select(
        _first_group("html", "<title>([^<]*)</title>").alias("title"),
        F.col("html").alias("summary"),
        published.alias("published"),
        _first_group("url", "^https?://([^/]+)").alias("source"),
        F.col("url").alias("link"),
        "page_id",
    )


def raw_news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in the news layout: title and the whole page, tags taken out."""
    pages = table(spark, sf_dir, "pages")
    return pages.select(
        text.link_id(F.col("url")).alias("id"),
        _first_group("html", "<title>([^<]*)</title>").alias("title"),
        F.regexp_replace("html", "<[^>]*>", " ").alias("summary"),
        _iso(_seconds(F.col("page_id"))).alias("published"),
        _first_group("url", "^https?://([^/]+)").alias("source"),
        F.col("url").alias("link"),
        F.lit("news").alias("data_source"),
    )


def nested_tweets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as API records: nested JSON text, some of them already flat."""
    events = table(spark, sf_dir, "events")
    flat = F.col("event_id") % 4 == 0
    likes = F.floor("value").cast("int")
    k = F.get_json_object("props", "$.k").cast("int")
    text_id = F.col("event_id").cast("string")
    tag = F.struct(F.when(F.col("event_id") % 3 == 0, F.lit("")).otherwise(F.col("event_type")).alias("tag"))
    other = F.struct(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("tag"))
    record = F.struct(
        text_id.alias("id"),
        F.col("props").alias("text"),
        F.date_format("ts", times.ISO_OUT).alias("created_at"),
        F.col("user_id").cast("string").alias("author_id"),
        F.when(F.col("event_id") % 5 > 0, F.lit("de")).alias("lang"),
        F.when(F.col("event_id") % 7 > 0, F.lit("app")).alias("source"),
        F.when(
            ~flat,
            F.struct(
                k.alias("retweet_count"),
                likes.alias("like_count"),
                F.when(F.col("event_id") % 2 == 0, likes).alias("reply_count"),
            ),
        ).alias("public_metrics"),
        F.when(~flat, F.struct(F.array(tag, other).alias("hashtags"))).alias("entities"),
        F.when(flat, likes).alias("retweet_count"),
        F.when(flat, likes).alias("like_count"),
        F.when(flat, likes).alias("reply_count"),
        F.when(flat, F.lit("a,b")).alias("hashtags"),
        F.when(flat, F.lit("twitter")).alias("data_source"),
    )
    return events.select(F.to_json(record).alias("value"))


def entity_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(entity, label): nation and region names, and of the benchmark items the long words, the first and the last two."""
    places = [
        table(spark, sf_dir, name).select(F.lower(column).alias("entity"), F.lit("GPE").alias("label"))
        for name, column in (("nation", "n_name"), ("region", "r_name"))
    ]
    items = table(spark, sf_dir, "benchmark").select(F.filter(F.split(text.clean(F.col("text")), " "), lambda w: w != "").alias("w"))
    events = items.select(F.explode("w").alias("entity")).filter(F.col("entity").rlike("^[a-z]{8,}$"))
    pairs = items.filter(F.size("w") > 1)
    return reduce(DataFrame.union, [
        *places,
        events.select("entity", F.lit("EVENT")),
        pairs.select(F.array_join(F.slice("w", 1, 2), " "), F.lit("PERSON")),
        pairs.select(F.array_join(F.slice("w", -2, 2), " "), F.lit("ORG")),
    ]).distinct()


# Written alike in Spark and in the SQL oracle: a hand-typed trend table out of the events.
TYPED_UPLOAD = {
    "Keyword ": "event_type",
    "TIMESTAMP": "CASE WHEN event_id % 5 = 0 THEN 'not a time' WHEN event_id % 5 = 1 THEN NULL "
    "ELSE concat('2024-01-', CAST(10 + event_id % 20 AS VARCHAR(9)), ' 10:00:00') END",
    "frequency": "CASE WHEN event_id % 4 = 0 THEN concat(CAST(1 + user_id AS VARCHAR(20)), ',000') "
    "WHEN event_id % 4 = 1 THEN CAST(user_id AS VARCHAR(20)) WHEN event_id % 4 = 2 THEN 'abc' END",
    "growth_rate": "CASE WHEN event_id % 3 = 0 THEN concat('+', CAST(user_id % 100 AS VARCHAR(9)), '.5%') "
    "WHEN event_id % 3 = 1 THEN concat('-', CAST(user_id % 100 AS VARCHAR(9)), '.25') ELSE 'NaN' END",
    "z_score": "CASE WHEN event_id % 2 = 0 THEN concat(CAST(user_id % 5 AS VARCHAR(9)), '.125') ELSE '' END",
    "is_anomaly": "CASE WHEN event_id % 3 = 0 THEN '1' WHEN event_id % 3 = 1 THEN '0' ELSE 'x' END",
    "Trend_Label": "CASE WHEN event_id % 8 = 0 THEN 'Hot' WHEN event_id % 8 = 1 THEN ' rising ' "
    "WHEN event_id % 8 = 2 THEN 'NORMAL' WHEN event_id % 8 = 3 THEN 'falling' "
    "WHEN event_id % 8 = 4 THEN 'Viral' WHEN event_id % 8 = 5 THEN 'nan' WHEN event_id % 8 = 6 THEN '' END",
}


def typed_upload(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    """A hand-typed trend table, with all columns or some."""
    chosen = names or tuple(TYPED_UPLOAD)
    events = table(spark, sf_dir, "events")
    return events.select("event_id", *[F.expr(TYPED_UPLOAD[n]).alias(n) for n in chosen])
