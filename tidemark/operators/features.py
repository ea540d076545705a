"""The wide feature table: one row per keyword and window start."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark import settings as S
from tidemark.operators.frequency import dealt, with_source_counts
from tidemark.operators.normalize import align
from tidemark.operators.signals import detect_trends

KEY = ("keyword", "timestamp")

# Fixed order: the strongest label of a key wins.
LABELS_BY_STRENGTH = ("stable", "declining", "emerging", "viral")


def _key() -> list[Column]:
    return [F.col("keyword"), F.col("window_start").alias("timestamp")]


def _global(df: DataFrame) -> DataFrame:
    return df.filter(F.col("source") == S.ALL_SOURCES)


def _in(label: str, value: str) -> Column:
    return F.max(F.when(F.col("window") == label, F.col(value)))


def pivot_frequency(frequency: DataFrame, labels: Sequence[str] = S.WINDOWS) -> DataFrame:
    """Global counts with one column per window label; absent windows count 0."""
    wide = _global(frequency).groupBy(*_key()).pivot("window", list(labels)).agg(F.max("frequency"))
    return wide.select(*KEY, *[F.coalesce(label, F.lit(0)).alias(f"freq_{label}") for label in labels])


def source_diversity(frequency: DataFrame) -> DataFrame:
    """Distinct sources per keyword and start, over every label that shares the start."""
    named = frequency.filter(F.col("source") != S.ALL_SOURCES)
    return named.groupBy(*_key()).agg(F.count_distinct("source").alias("source_diversity"))


def _metrics() -> list[Column]:
    rank = F.lit(1)
    for strength, label in enumerate(LABELS_BY_STRENGTH, 1):
        rank = F.when(F.col("trend_label") == label, F.lit(strength)).otherwise(rank)
    strongest = F.element_at(F.array(*map(F.lit, LABELS_BY_STRENGTH)), F.max(rank))
    return [
        _in("1h", "growth_rate").alias("growth_rate_1h"),
        _in("24h", "growth_rate").alias("growth_rate_24h"),
        _in("1h", "z_score").alias("z_score_1h"),
        _in("24h", "z_score").alias("z_score_24h"),
        _in("24h", "velocity").alias("velocity"),
        _in("24h", "acceleration").alias("acceleration"),
        F.max("is_anomaly").alias("is_anomaly"),
        strongest.alias("trend_label"),
    ]


def pivot_trend_metrics(trends: DataFrame) -> DataFrame:
    """Global signals per keyword and start, with the strongest label of all windows."""
    return _global(trends).groupBy(*_key()).agg(*_metrics())


def _finish(features: DataFrame) -> DataFrame:
    filled = features.withColumn("avg_sentiment", F.lit(0.0)).fillna(
        {"source_diversity": 0, "is_anomaly": 0, "trend_label": "stable"}
    )
    return align(filled, schemas.FEATURE)


def build_features(frequency: DataFrame, trends: DataFrame) -> DataFrame:
    """Feature table of a frequency and a trend table that may cover different keys. Dealt by number, so that a
    task of the joins holds a small part of the wide rows."""
    key = list(KEY)
    counted, metrics, diversity = (
        dealt(part, *key) for part in (pivot_frequency(frequency), pivot_trend_metrics(trends), source_diversity(frequency))
    )
    return _finish(counted.join(metrics, key, "left").join(diversity, key, "left"))


def features_of_trends(global_trends: DataFrame) -> DataFrame:
    """Feature table of global trends that carry the number of their `sources`.

    A trend row carries its own frequency, so one aggregation yields both pivots, and no join
    is left. Windows that share a start are nested, so the largest of their source counts is
    the number of distinct sources over all of them.
    """
    counts = [F.coalesce(_in(w, "frequency"), F.lit(0)).alias(f"freq_{w}") for w in S.WINDOWS]
    diversity = F.max("sources").alias("source_diversity")
    return _finish(global_trends.groupBy(*_key()).agg(*counts, *_metrics(), diversity))


def features_of_events(events: DataFrame, top: int | None = None, **params) -> DataFrame:
    """Feature table straight from keyword events; parameters go to `detect_trends`.

    Four exchanges: base counts, per-source series, counts over all sources, and keyword. The
    last serves the window functions and the final aggregation alike. With `top` the table holds only the `top`
    keywords with the most mentions.
    """
    return features_of_trends(detect_trends(with_source_counts(events, top=top), **params))
