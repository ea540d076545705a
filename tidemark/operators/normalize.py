"""Raw records of the three sources to one post layout, and post-level clean-up."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import add
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import numbers, text, times


class Layout(NamedTuple):
    """Which raw fields of a source make up a post."""

    text: tuple[str, ...]  # several are joined by a blank, nulls left out
    time: str
    counts: tuple[str, ...] = ()  # summed to the engagement, null counts as 0
    lang: str | None = None  # no field or a null: English


# The field names of the raw records. Order matters to routing by path.
LAYOUTS = {
    "twitter": Layout(("text",), "created_at", ("like_count", "retweet_count", "reply_count"), "lang"),
    "reddit": Layout(("title", "selftext"), "created_utc", ("score", "num_comments")),
    "news": Layout(("title", "summary"), "published"),
}


def to_posts(raw: DataFrame, source: str) -> DataFrame:
    """Raw records of a source in the post layout."""
    layout = LAYOUTS[source]
    english = F.lit("en")
    derived = {
        "id": F.col("id"),
        "text": F.concat_ws(" ", *layout.text) if len(layout.text) > 1 else F.col(*layout.text),
        "timestamp": F.col(layout.time),
        "source": F.lit(source),
        "engagement": reduce(add, [F.coalesce(c, F.lit(0)) for c in layout.counts], F.lit(0)),
        "lang": F.coalesce(layout.lang, english) if layout.lang else english,
    }
    return align(raw.select(*[value.alias(name) for name, value in derived.items()]), schemas.POST)


def by_source(paths: Iterable[str]) -> dict[str, list[str]]:
    """Paths by the source they name, each under the first of LAYOUTS that fits; one that fits none is an error."""
    left, groups = list(paths), {}
    for source in LAYOUTS:
        groups[source] = [p for p in left if source in p.casefold()]
        left = [p for p in left if p not in groups[source]]
    if left:
        raise ValueError(f"no known source in {', '.join(left)}")
    return {source: found for source, found in groups.items() if found}


def source_of_path(path: Column) -> Column:
    """The same routing per row, for a file-path column; null where no source matches."""
    return F.coalesce(*[F.when(F.lower(path).contains(source), F.lit(source)) for source in LAYOUTS])


def with_text(posts: DataFrame) -> DataFrame:
    """Posts whose text is neither null nor blank."""
    return posts.filter(F.col("text").isNotNull() & (F.trim("text") != ""))


def unify(frames: list[DataFrame]) -> DataFrame:
    """All posts of several sources, blank ones dropped."""
    if not frames:
        raise ValueError("no raw posts to unify")
    return with_text(reduce(DataFrame.unionByName, frames))


def flatten_nested(raw: DataFrame) -> DataFrame:
    """Nested API posts to the flat tweet layout.

    Rows that already carry a data source are flat and pass through unchanged.
    """
    flat = F.col("data_source") == "twitter"
    tags = F.transform(F.col("entities.hashtags"), lambda h: h["tag"])
    kept = F.filter(F.coalesce(tags, F.array().cast("array<string>")), lambda t: t.isNotNull() & (t != ""))

    def pick(name: str, nested: Column) -> Column:
        return F.when(flat, F.col(name)).otherwise(nested).alias(name)

    def metric(name: str) -> Column:
        return pick(name, F.coalesce(F.col(f"public_metrics.{name}"), F.lit(0)))

    return raw.select(
        "id",
        "text",
        "created_at",
        "author_id",
        pick("lang", F.coalesce("lang", F.lit("en"))),
        pick("source", F.coalesce("source", F.lit("Twitter Web App"))),
        metric("retweet_count"),
        metric("like_count"),
        metric("reply_count"),
        pick("hashtags", F.array_join(kept, ",")),
        F.lit("twitter").alias("data_source"),
    )


def coerce_forum(raw: DataFrame) -> DataFrame:
    """Forum rows with unreadable numbers as 0 and no body as empty text."""
    whole = {c: numbers.int_or(F.col(c)) for c in ("score", "num_comments", "created_utc")}
    blank = {c: F.coalesce(c, F.lit("")) for c in ("title", "selftext", "subreddit", "url")}
    return raw.withColumns({**whole, **blank, "data_source": F.lit("reddit")})


def feed_to_news(entries: DataFrame, max_chars: int = 1000, to_utc: bool = False) -> DataFrame:
    """Feed entries (title, summary, published, source, link) to the raw news layout."""
    return entries.select(
        text.link_id(F.col("link")).alias("id"),
        "title",
        text.truncate(F.col("summary"), max_chars).alias("summary"),
        times.parse_feed_date(F.col("published"), to_utc).alias("published"),
        "source",
        "link",
        F.lit("news").alias("data_source"),
    )


def first_per_link(entries: DataFrame, *order: str) -> DataFrame:
    """The first entry of every link in feed order.

    The winner is taken with `min_by`, which combines before the shuffle, so a link copied into
    very many feeds never gathers its copies in one task.
    """
    others = [c for c in entries.columns if c != "link"]
    first = F.min_by(F.struct(*others), F.struct(*order)).alias("first")
    return entries.groupBy("link").agg(first).select("link", *[f"first.{c}" for c in others])


def ingest_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Records per source, sources without records included, and their total."""
    tagged = [df.select(F.lit(name).alias("source"), F.lit(1).alias("n")) for name, df in frames.items()]
    zeros = [df.sparkSession.range(1).select(F.lit(name).alias("source"), F.lit(0).alias("n"))
             for name, df in frames.items()]
    return (
        reduce(DataFrame.union, tagged + zeros)
        .rollup("source")
        .agg(F.sum("n").alias("records"))
        .select(F.coalesce("source", F.lit("total")).alias("source"), "records")
    )


def parse_times(posts: DataFrame, column: str = "timestamp") -> DataFrame:
    """Text times to timestamps; unreadable ones are null."""
    return posts.withColumn(column, times.parse_timestamp(F.col(column)))


def english(posts: DataFrame, lang: str = "en") -> DataFrame:
    """Posts in the language, or of unknown language. Applied first, so the scan skips the rest."""
    return posts.filter(F.col("lang").isNull() | (F.col("lang") == lang))


def align(df: DataFrame, ddl: str) -> DataFrame:
    """Exactly the columns of a contract: cast, in order, missing ones as typed nulls."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schemas.struct(ddl)
        ]
    )


def process_posts(posts: DataFrame, min_length: int | None = None) -> DataFrame:
    """Unified posts to the processed layout: language, clean text, tokens, parsed time."""
    kept = english(posts).withColumn("clean_text", text.clean(F.col("text")))
    extra = {} if min_length is None else {"min_length": min_length}
    tokenised = kept.withColumn("tokens", text.tokens(F.col("clean_text"), **extra))
    return align(parse_times(tokenised), schemas.PROCESSED)


def latest_rows(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in the given order."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")
