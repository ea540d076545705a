from __future__ import annotations

import math
import statistics

import pytest
from pyspark.sql import functions as F

from tests.helpers import RISING, STEADY, column, hour, series
from tidemark.operators import features, frequency, signals
from tidemark.sources import bindings as B


def brute_growth(values):
    return [None] + [(b - a) / (a + 1.0) for a, b in zip(values, values[1:])]


def brute_z(rates):
    known = [r for r in rates if r is not None]
    if len(known) < 2 or statistics.stdev(known) < 1e-12:
        return [0.0] * len(rates)
    mean, sigma = statistics.mean(known), statistics.stdev(known)
    return [0.0 if r is None else (r - mean) / sigma for r in rates]


@pytest.mark.parametrize("values", [RISING, STEADY, [3], [5, 5, 5, 5], [0, 10, 0, 10]])
def test_series_by_hand(spark, values):
    done = signals.detect_trends(series(spark, values))
    rates = brute_growth(values)
    assert column(done, "growth_rate") == pytest.approx(rates)
    assert column(done, "velocity") == column(done, "growth_rate")
    want = [None if a is None or b is None else b - a for a, b in zip([None, *rates], rates)]
    assert column(done, "acceleration") == pytest.approx(want)
    assert column(done, "z_score") == pytest.approx(brute_z(rates), abs=1e-8)


def test_first_rates(spark):
    rates = column(signals.growth_rate(series(spark, RISING)), "growth_rate")
    assert rates[:5] == [None, 1 / 5, 0.0, 1 / 6, 1 / 7]


def test_burst_is_viral_only_hourly(spark):
    flat_then_burst = [10] * 12 + [60]
    for window, label in (("1h", "viral"), ("24h", "emerging")):
        last = signals.detect_trends(series(spark, flat_then_burst, window=window)).orderBy(F.desc("window_start")).first()
        assert (last["trend_label"], last["is_anomaly"], last["spike_direction"]) == (label, 1, "up")


def test_labels_and_strict_rule(spark):
    rows = [(3.1, "1h", 0.0), (3.1, "24h", 0.0), (2.5, "6h", 0.0), (0.0, "1h", -0.6), (3.0, "1h", None), (0.0, "1h", None)]
    df = spark.createDataFrame(rows, "z_score double, window string, growth_rate double").coalesce(1)
    loose = [r["trend_label"] for r in signals.classify(df).collect()]
    strict = [r["trend_label"] for r in signals.classify(df, emerging_window="24h").collect()]
    assert loose == ["viral", "emerging", "emerging", "declining", "emerging", "stable"]
    assert strict == ["viral", "emerging", "stable", "declining", "stable", "stable"]


def test_down_spike(spark):
    df = spark.createDataFrame([(-2.6,), (2.5,), (2.6,)], "z_score double").coalesce(1)
    rows = signals.flag_anomalies(df).collect()
    assert [(r["is_anomaly"], r["spike_direction"]) for r in rows] == [(1, "down"), (0, "none"), (1, "up")]


def test_score_bound(spark, sf):
    """With n growth values no |z| exceeds (n - 1) / sqrt(n)."""
    trends = signals.trends_of_events(B.event_mentions(spark, sf))
    worst = trends.groupBy("keyword", "window", "source").agg(
        F.count("growth_rate").alias("n"), F.max(F.abs("z_score")).alias("z")
    )
    for row in worst.collect():
        if row["n"]:
            assert row["z"] <= (row["n"] - 1) / math.sqrt(row["n"]) + 1e-6


def test_clamped_growth(spark):
    df = series(spark, [4, -2, 3])
    assert column(signals.growth_rate_clamped(df), "growth_rate") == pytest.approx([None, -4 / 5, 3.0])


def test_peer_scores(spark):
    rows = [("a", "1h", hour(0), "s", 1.0), ("b", "1h", hour(0), "s", 3.0), ("c", "1h", hour(1), "s", 9.0)]
    df = spark.createDataFrame(rows, "keyword string, window string, window_start timestamp, source string, growth_rate double")
    got = {r["keyword"]: r["peer_z"] for r in signals.peer_zscore(df).collect()}
    assert got == {"a": -1.0, "b": 1.0, "c": 0.0}


def test_acceleration_starts_at_zero(spark):
    df = signals.growth_rate(series(spark, [1, 3, 3])).filter("growth_rate is not null")
    assert column(signals.acceleration_zero_first(df), "acceleration") == [0.0, -1.0]


def test_source_diversity(spark):
    rows = [("a", "x"), ("a", "x "), ("a", "y"), ("a", ""), ("a", None), ("b", "")]
    df = spark.createDataFrame(rows, "keyword string, source string")
    got = {r["keyword"]: r["source_diversity"] for r in signals.source_diversity(df).collect()}
    assert got == {"a": 2, "b": 0}


def test_halves_equal_whole(spark, sf):
    events = B.event_mentions(spark, sf)
    a = signals.trends_of_events(events)
    b = signals.detect_trends(frequency.keyword_frequency(events))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_joined_features_equal_one_pass(spark, sf):
    events = B.event_mentions(spark, sf)
    freq = frequency.keyword_frequency(events)
    a = features.build_features(freq, signals.detect_trends(freq))
    b = features.features_of_events(events)
    assert a.schema == b.schema
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_features_without_trends(spark):
    freq = series(spark, [3, 4]).unionByName(series(spark, [3], source="x"))
    empty = signals.detect_trends(freq).limit(0)
    rows = features.build_features(freq, empty).orderBy("timestamp").collect()
    assert [(r["freq_1h"], r["freq_7d"], r["source_diversity"], r["trend_label"]) for r in rows] == [
        (3, 0, 1, "stable"), (4, 0, 0, "stable"),
    ]


def test_hot_bucket_is_dealt_over_many_tasks(spark):
    """Nine tenths of the rows in one bucket, no adaptive splitting, no broadcast: no task gets a third of them."""
    rows = spark.range(4000).select(
        F.concat(F.lit("k"), F.col("id").cast("string")).alias("keyword"), F.lit("1h").alias("window"), F.lit("s").alias("source"),
        F.timestamp_seconds(F.lit(1704067200) + F.when(F.col("id") % 10 == 0, F.col("id") * 3600).otherwise(0)).alias("window_start"),
        (F.col("id") % 97).cast("double").alias("growth_rate"),
    )
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        made = signals.peer_zscore(rows, salts=64)
        sizes = [r["count"] for r in made.groupBy(F.spark_partition_id()).count().collect()]
        got = {r["keyword"]: r["peer_z"] for r in made.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 4000 and max(sizes) < 4000 / 3 and "_salt" not in made.columns
    assert got == {r["keyword"]: r["peer_z"] for r in signals.peer_zscore(rows, salts=1).collect()}


def test_merged_sketches_stay_within_their_bound(spark):
    """Ten thousand sources over five overlapping snapshots."""
    parts = [spark.range(k * 1500, k * 1500 + 4000).select(F.lit("k").alias("keyword"), F.concat(F.lit(" s"), F.col("id").cast("string")).alias("source")) for k in range(5)]
    few = spark.createDataFrame([("few", "a"), ("few", " a "), ("few", ""), ("few", None), ("few", "b"), ("none", None)], "keyword string, source string")
    stored = [signals.source_sketches(p) for p in (*parts, few, few)]
    union = stored[0]
    for each in stored[1:]:
        union = union.unionByName(each)
    got = {r["keyword"]: r["source_diversity"] for r in signals.merged_diversity(union).collect()}
    assert got["few"] == 2 and got["none"] == 0 and abs(got["k"] - 10_000) < 4 * 0.016 * 10_000


def test_small_peer_statistics_leave_the_series_where_they_are(spark):
    rows = series(spark, [1, 2, 4, 8], "a").unionByName(series(spark, [2, 2, 3, 9], "b"))
    scored = signals.peer_zscore(signals.growth_rate(rows))
    text = scored._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "HashAggregate" not in text


def test_trends_of_stored_counts(spark, sf):
    events = B.event_mentions(spark, sf)
    counts = frequency.base_counts(events, frequency.grain(("1h", "24h"), 1.0))
    made = signals.trends_of_counts(counts, ("1h", "24h"))
    direct = signals.trends_of_events(events, ("1h", "24h"))
    assert made.exceptAll(direct).isEmpty() and direct.exceptAll(made).isEmpty() and not made.isEmpty()
