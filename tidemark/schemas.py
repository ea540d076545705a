"""Table contracts, as DDL strings.

Fixed values: column names, order and types every producer and reader agrees on.
"""

from __future__ import annotations

from pyspark.sql import types as T

RAW_TWEET = (
    "id string, text string, created_at string, author_id string, lang string, "
    "source string, retweet_count int, like_count int, reply_count int, "
    "hashtags array<string>, data_source string"
)

RAW_FORUM = (
    "id string, title string, selftext string, subreddit string, score int, "
    "num_comments int, created_utc bigint, url string, data_source string"
)

RAW_NEWS = (
    "id string, title string, summary string, published string, source string, "
    "link string, data_source string"
)

NESTED_TWEET = (
    "id string, text string, created_at string, author_id string, lang string, source string, "
    "public_metrics struct<retweet_count:int,like_count:int,reply_count:int>, "
    "entities struct<hashtags:array<struct<tag:string>>>, "
    "retweet_count int, like_count int, reply_count int, hashtags string, data_source string"
)

POST = "id string, text string, timestamp string, source string, engagement int, lang string"

PROCESSED = (
    "id string, text string, clean_text string, tokens array<string>, "
    "timestamp timestamp, source string, engagement int, lang string"
)

KEYWORD_FREQ = (
    "keyword string, window string, window_start timestamp, window_end timestamp, "
    "frequency bigint, source string"
)

TREND = KEYWORD_FREQ + (
    ", growth_rate double, velocity double, acceleration double, z_score double, "
    "is_anomaly int, spike_direction string, trend_label string"
)

FEATURE = (
    "keyword string, timestamp timestamp, freq_1h bigint, freq_6h bigint, freq_24h bigint, "
    "freq_7d bigint, growth_rate_1h double, growth_rate_24h double, z_score_1h double, "
    "z_score_24h double, velocity double, acceleration double, avg_sentiment float, "
    "source_diversity int, is_anomaly int, trend_label string"
)

PREDICTION = (
    "keyword string, predicted_at timestamp, forecast_period string, predicted_freq double, "
    "lower_bound double, upper_bound double, trend_class string, confidence float"
)

KEYWORD_TABLE = "keyword string, frequency bigint, avg_tfidf_score double"

ENTITIES = "array<struct<entity:string,label:string>>"


def struct(ddl: str) -> T.StructType:
    """The StructType a DDL contract describes."""
    return T.StructType.fromDDL(ddl)


def names(ddl: str) -> list[str]:
    """Column names of a DDL contract, in order."""
    return struct(ddl).fieldNames()
