"""Keyword counts in time windows, globally and per source."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import settings as S
from tidemark.functions.times import bucket_start, slide_seconds, window_seconds

COLUMNS = ("keyword", "window_start", "window_end", "frequency", "window", "source")

#: Partitions of a roll-up for each shuffle partition of the session. Its rows multiply behind the exchange, where
#: Spark, which merges partitions by exchanged bytes, doesn't see them: they are dealt finer, and by number.
FINER = 4


def grain(labels: Sequence[str], slide_fraction: float) -> int:
    """Longest bucket that every window starts and ends on."""
    spans = [window_seconds(x) for x in labels] + [slide_seconds(x, slide_fraction) for x in labels]
    return math.gcd(*spans)


def base_counts(events: DataFrame, seconds: int, by_source: bool = True) -> DataFrame:
    """Mentions per (keyword, source, bucket) at the common grain.

    The only step that reads every mention. It combines before its shuffle, so a keyword or
    source holding a third of all rows still leaves each map task as one row per bucket.
    """
    keys = ["keyword", "source"] if by_source else ["keyword"]
    at = bucket_start(F.unix_seconds(F.col("timestamp").cast("timestamp")), seconds)
    return (
        events.filter(F.col("timestamp").isNotNull())
        .groupBy(*keys, at.alias("bucket"))
        .agg(F.count("*").alias("frequency"))
    )


def _spans(bucket: Column, labels: Sequence[str], slide_fraction: float) -> Column:
    """Array of the windows (label number, start) that hold a bucket.

    One expression a label, whatever the slide: where windows overlap the starts are a sequence from the
    earliest window that reaches the bucket to the last one that begins before it; else there is one, which
    takes no function over an array and is compiled. No bucket is in no window.
    """
    single, parts = [], []
    for number, label in enumerate(labels):
        size, slide = window_seconds(label), slide_seconds(label, slide_fraction)
        last = bucket_start(bucket, slide)
        if slide == size:
            single.append(F.struct(F.lit(number).alias("label"), last.alias("start")))
            continue
        first = bucket_start(bucket - F.lit(size), slide) + F.lit(slide)
        starts = F.when(first <= last, F.sequence(first, last, F.lit(slide).cast("long")))
        starts = F.coalesce(starts, F.array().cast("array<bigint>"))
        named = F.lit(number).alias("label")
        parts.append(F.transform(starts, lambda at: F.struct(named, at.alias("start"))))  # noqa: B023 - called at once
    if single:
        parts.insert(0, F.when(bucket.isNotNull(), F.array(*single)).otherwise(F.array().cast("array<struct<label:int,start:bigint>>")))
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def dealt(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Rows dealt by their keys over so many partitions, by default FINER for each shuffle partition of the session."""
    return df.repartition(partitions or FINER * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def roll_up(
    counts: DataFrame, labels: Sequence[str], slide_fraction: float, keys: list[str], partitions: int | None = None
) -> DataFrame:
    """Base counts to the windows of every label, as (keys, label number, start, frequency).

    Partitioned by series before the buckets are expanded: a series holds at most one row per
    bucket of the calendar, and the sums here and the window functions on the same keys that
    follow need no further exchange.
    """
    spans = F.inline(_spans(F.col("bucket"), labels, slide_fraction))
    return (
        dealt(counts, *keys, partitions=partitions)
        .select(*keys, "frequency", spans)
        .groupBy(*keys, "label", "start")
        .agg(F.sum("frequency").alias("frequency"))
    )


def name_windows(rolled: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Label numbers and starts in seconds to the window columns; other columns are kept."""
    sizes = F.array(*[F.lit(window_seconds(x)) for x in labels])
    number = F.col("label") + 1
    end = F.col("start") + F.element_at(sizes, number)
    return rolled.withColumns(
        {
            "window": F.element_at(F.array(*map(F.lit, labels)), number),
            "window_start": F.timestamp_seconds("start"),
            "window_end": F.timestamp_seconds(end),
        }
    ).drop("label", "start")


def all_windows(
    events: DataFrame, labels: Sequence[str] = S.WINDOWS, slide_fraction: float = 1.0
) -> DataFrame:
    """Counts over all sources, for every label."""
    counts = base_counts(events, grain(labels, slide_fraction), by_source=False)
    rolled = name_windows(roll_up(counts, labels, slide_fraction, ["keyword"]), labels)
    return rolled.withColumn("source", F.lit(S.ALL_SOURCES)).select(*COLUMNS)


def window_frequency(events: DataFrame, label: str, slide_fraction: float = 1.0) -> DataFrame:
    """Mentions per keyword in the windows of one label, over all sources."""
    return all_windows(events, [label], slide_fraction).drop("source")


def per_source(
    events: DataFrame, labels: Sequence[str] = S.WINDOWS, slide_fraction: float = 1.0
) -> DataFrame:
    """Counts per source, for every label."""
    counts = base_counts(events, grain(labels, slide_fraction))
    rolled = roll_up(counts, labels, slide_fraction, ["keyword", "source"])
    return name_windows(rolled, labels).select(*COLUMNS)


def keyword_frequency(
    events: DataFrame,
    labels: Sequence[str] = S.WINDOWS,
    slide_fraction: float = 1.0,
    min_frequency: int = 0,
) -> DataFrame:
    """Global and per-source counts in one table; the global rows carry the marker source.

    Both halves start from the same per-source base counts, whose exchange Spark reuses: the
    texts are tokenised once. `min_frequency` drops keywords with fewer mentions in all; one that
    is common enough keeps its quiet windows.
    """
    global_half, source_half = frequency_halves(events, labels, slide_fraction, min_frequency)
    return global_half.unionByName(source_half)


def frequency_halves(
    events: DataFrame, labels: Sequence[str] = S.WINDOWS, slide_fraction: float = 1.0, min_frequency: int = 0
) -> tuple[DataFrame, DataFrame]:
    """The global and the per-source part of the frequency table, each kept by its own series."""
    return halves_of_counts(base_counts(events, grain(labels, slide_fraction)), labels, slide_fraction, min_frequency)


def halves_of_counts(
    counts: DataFrame, labels: Sequence[str] = S.WINDOWS, slide_fraction: float = 1.0, min_frequency: int = 0
) -> tuple[DataFrame, DataFrame]:
    """The same two parts from base counts, one row per keyword, source and bucket."""
    if min_frequency > 0:
        totals = counts.groupBy("keyword").agg(F.sum("frequency").alias("total"))
        counts = counts.join(totals.filter(F.col("total") >= min_frequency), "keyword", "left_semi")
    merged = counts.groupBy("keyword", "bucket").agg(F.sum("frequency").alias("frequency"))
    global_half = roll_up(merged, labels, slide_fraction, ["keyword"])
    source_half = roll_up(counts, labels, slide_fraction, ["keyword", "source"])
    return (
        name_windows(global_half, labels).withColumn("source", F.lit(S.ALL_SOURCES)).select(*COLUMNS),
        name_windows(source_half, labels).select(*COLUMNS),
    )


def frequency_of_days(days: DataFrame, labels: Sequence[str] = S.WINDOWS, slide_fraction: float = 1.0) -> DataFrame:
    """The frequency table of base counts that were stored day by day: a bucket that several days hold is summed."""
    counts = days.groupBy("keyword", "source", "bucket").agg(F.sum("frequency").alias("frequency"))
    global_half, source_half = halves_of_counts(counts, labels, slide_fraction)
    return global_half.unionByName(source_half)


def most_mentioned(counts: DataFrame, n: int) -> DataFrame:
    """The n keywords with the highest sums of `frequency`; equal sums in keyword order."""
    totals = counts.groupBy("keyword").agg(F.sum("frequency").alias("total_freq"))
    return totals.orderBy(F.desc("total_freq"), "keyword").limit(n)


def with_source_counts(events: DataFrame, labels: Sequence[str] = S.WINDOWS, top: int | None = None) -> DataFrame:
    """Global counts that also carry the number of `sources` behind each, kept by keyword.

    With `top` only those of the `top` most mentioned keywords: they are found from the same base counts, whose
    exchange Spark reuses, and nothing else is rolled up. A null keyword is no candidate.
    """
    counts = base_counts(events if top is None else events.filter(F.col("keyword").isNotNull()), grain(labels, 1.0))
    if top is not None:
        # Not a semi-join, which Spark would push below the counting; nor may only one side drop null keywords
        counts = counts.join(most_mentioned(counts, top).select("keyword"), "keyword")
    rolled = roll_up(counts, labels, 1.0, ["keyword", "source"])
    merged = rolled.groupBy("keyword", "label", "start").agg(F.sum("frequency").alias("frequency"), F.count("*").alias("sources"))
    return name_windows(dealt(merged, "keyword"), labels).withColumn("source", F.lit(S.ALL_SOURCES))
