from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.helpers import hour
from tidemark.operators import board, outlook

ROW = (
    "keyword string, timestamp timestamp, window string, source string, frequency bigint, "
    "growth_rate double, z_score double, is_anomaly int, trend_label string"
)


@pytest.fixture(scope="module")
def table(spark):
    rows = [
        ("AI chips", hour(0), "1h", "__all__", 10, None, 0.0, 0, "stable"),
        ("AI chips", hour(30), "1h", "__all__", 50, 4.0, 3.5, 1, "viral"),
        ("football", hour(1), "1h", "news", 20, 0.5, 2.1, 0, "emerging"),
        ("football", hour(49), "1h", "news", 20, -0.6, -2.6, 1, "declining"),
        ("votes", hour(48), "1h", "__all__", 7, 0.0, 0.2, 0, None),
    ]
    return spark.createDataFrame(rows, ROW).cache()


def names(df, column="keyword"):
    return [r[column] for r in df.collect()]


def test_lookback_and_replay(table):
    assert table.count() - board.lookback(table, 24).count() == 2
    assert board.lookback(table, 6, datetime(2024, 1, 2, 6)).count() == 3
    assert sorted(names(board.replay_day(table, date(2024, 1, 1)))) == ["AI chips", "football"]


def test_search_is_plain_text(table):
    assert set(names(board.search(table, "ai C"))) == {"AI chips"}
    assert board.search(table, ".*").isEmpty()


def test_choose(table):
    assert names(board.choose(table, None, 5, 0.0, None)) == ["AI chips", "votes"]
    assert names(board.choose(table, ["Stable"], 1, 0.0)) == ["votes"]
    assert names(board.choose(table, None, 5, -1.0, ["news"])) == ["football", "football"]


def test_surprise_takes_all_rows_of_a_hot_keyword(table):
    for seed in range(6):
        rows = board.surprise(table, seed).collect()
        assert len(rows) == 2 and rows[0]["keyword"] in {"AI chips", "football"}
    cold = table.filter("trend_label is null")
    assert names(board.surprise(cold, 1)) == ["votes"]


def test_alerts_and_rankings(table):
    assert names(board.watchlist_alerts(table, ["AI chips", "votes"])) == ["AI chips"]
    assert names(board.ranking(table, 2)) == ["AI chips", "football"]
    assert [r["z_score"] for r in board.anomaly_alerts(table, 1).collect()] == [3.5]
    assert names(board.top_by_max_frequency(table, 2)) == ["AI chips", "football"]
    lead = board.growth_leaderboard(table, 3).collect()
    assert [(r["growth_rate"], r["direction"]) for r in lead] == [(0.0, "up"), (0.5, "up"), (4.0, "up")]


def test_metrics_and_summary(table):
    row = board.metrics(table).first()
    assert tuple(row) == (3, 1, 1, 2)
    told = board.summary_text(table).first()["summary"]
    assert told.startswith("Tracking 3 keywords in this snapshot. 1 viral trend - exploding right now")
    assert told.endswith("2 anomalies detected - unusual spikes worth investigating")
    assert board.summary_text(table.limit(0)).first()["summary"] == "No data available to summarize."
    one = board.keyword_summary_text(table, "AI chips").first()["summary"]
    assert one == (
        "AI chips is currently 🔥 Viral. Exploding right now — sharp spike in mentions "
        "Current frequency: 50 mentions | Growth: +400.0% "
        "Alert: unusual spike (Z-score: 3.50)"
    )
    assert board.keyword_summary_text(table, "none").first()["summary"] == "No data found for 'none'."


def test_distribution_and_labels(table):
    got = {r["trend_label"]: (r["rows"], r["share"]) for r in board.label_distribution(table).collect()}
    assert got["viral"] == (1, 0.25) and len(got) == 4
    assert set(names(board.distinct_labels(table), "trend_label")) == {"stable", "viral", "emerging", "declining"}


def test_compare_latest_and_timeline(table):
    got = {r["keyword"]: tuple(r)[1:] for r in board.compare_latest(table, "football", "votes").collect()}
    assert got == {"football": (20, -0.6), "votes": (7, 0.0)}
    assert board.compare(table, "football", "votes").count() == 3
    line = board.timeline(table, "AI chips").collect()
    assert [r["anomaly_frequency"] for r in line] == [None, 50]
    assert {r["keyword"]: r["frequency"] for r in board.latest_per_keyword(table).collect()} == {
        "AI chips": 50, "football": 20, "votes": 7,
    }


def test_related(table, spark):
    same = table.withColumn("trend_label", F.lit("viral"))
    assert names(board.related_by_label(same, "football")) == ["AI chips", "votes"]
    docs = [("1", ["x", "aaa", "bbb"]), ("2", ["aaa", "bbb", "ccc", "bbb"]), ("3", ["aaa", "ccc"]), ("4", ["ccc"])]
    arrays = spark.createDataFrame(docs, "id string, words array<string>")
    pairs = arrays.select("id", F.explode("words").alias("keyword")).filter("keyword != 'x'")
    want = [("bbb", 2), ("ccc", 2)]
    assert [tuple(r) for r in board.related_in_texts(arrays, "aaa").collect()] == want
    assert [tuple(r) for r in board.related_by_documents(pairs, "aaa").collect()] == want


def test_display_and_bubbles(table):
    shown = {(r["keyword"], r["z"]): (r["growth"], r["anomaly"]) for r in board.display(table).collect()}
    assert shown[("AI chips", "0.00")] == ("-", "No")
    assert shown[("AI chips", "3.50")] == ("+400.0%", "Yes")
    assert shown[("football", "-2.60")] == ("-60.0%", "Yes")
    sizes = {r["z_score"]: r["bubble_size"] for r in board.bubbles(table).collect()}
    assert sizes == {3.5: 22.5, 2.1: 15.5, -2.6: 18.0}


def test_prepare_fills_only_absent(spark):
    df = spark.createDataFrame(
        [(hour(1), 1.0, 2.0, 5, " Viral ")],
        "window_start timestamp, growth_rate double, growth_rate_24h double, freq_24h int, trend_label string",
    )
    row = board.prepare(df).first()
    assert (row["timestamp"], row["growth_rate"], row["frequency"], row["trend_label"]) == (hour(1), 1.0, 5, "viral")
    texts = spark.createDataFrame([("2024-01-01 00:00:00",), ("bad",)], "timestamp string").coalesce(1)
    assert names(board.prepare(texts), "timestamp") == [hour(0), None]
    both = board.combine([df.select("window_start"), texts])
    assert both.count() == 3 and "timestamp" in both.columns


def test_facets_limits_status(table):
    facets = {(r["facet"], r["value"]) for r in board.facets(table, ["source", "keyword"]).collect()}
    assert ("source", "news") in facets and len(facets) == 5
    assert tuple(board.limits(table).first()) == (50, 4.0)
    status = board.dataset_status({"t": (table, "timestamp"), "e": (table.limit(0), "timestamp")}).collect()
    assert {r["dataset"]: (r["latest"], r["rows"]) for r in status} == {"t": (hour(49), 5), "e": (None, 0)}


PRED = (
    "keyword string, predicted_at timestamp, forecast_period string, predicted_freq double, lower_bound double, "
    "upper_bound double, trend_class string, confidence float"
)


@pytest.fixture(scope="module")
def made(spark):
    rows = [
        ("crypto ai", hour(1), "24h", 24.0, 0.0, 30.0, "viral", 0.5),
        ("crypto ai", hour(2), "24h", None, 20.0, 40.0, None, 0.75),
        ("stocks", hour(1), "7d", 12.0, 0.0, 15.0, "odd", 0.25),
        ("garden", hour(1), "24h", None, 0.0, 15.0, "stable", None),
    ]
    return spark.createDataFrame(rows, PRED).cache()


def test_outlook_choose(made):
    assert names(outlook.choose(made, "24h", 0.5)) == ["crypto ai", "crypto ai"]
    assert outlook.choose(made, "7d").count() == 1


def test_priority(made, spark):
    rows = [tuple(r) for r in outlook.priority(made).collect()]
    assert rows[0] == ("crypto ai", 20.0, 24.0, "viral", 0.75, pytest.approx(20.0))
    assert rows[1][0] == "stocks" and rows[1][-1] is None
    assert rows[2][0] == "garden" and rows[2][2] is None
    current = spark.createDataFrame([("stocks", 8)], "keyword string, current_freq int")
    change = {r["keyword"]: r["change_pct"] for r in outlook.priority(made, current).collect()}
    assert change == {"crypto ai": None, "stocks": 50.0, "garden": None}


def test_lifecycle_velocity_topics(made):
    stages = {r["trend_class"]: (r["stage"], r["stage_value"]) for r in outlook.lifecycle(made).collect()}
    assert stages["viral"] == ("Rising → Peak", 0.8) and stages["odd"] == ("Unknown", 0.0)
    pace = {r["keyword"]: (r["velocity"], r["acceleration"]) for r in outlook.projected_velocity(made).collect()}
    assert pace["crypto ai"] == (1.0, pytest.approx(0.1))
    topics = {r["topic"]: r["rows"] for r in outlook.topic_buckets(made).collect()}
    assert topics == {"Technology": 2, "Finance": 1, "General": 1}


def test_snapshot_and_track(made, table):
    best = {r["keyword"]: tuple(r)[1:] for r in outlook.classification_snapshot(made).collect()}
    assert best["crypto ai"] == ("viral", 0.5, 24.0)
    assert best["garden"] == ("stable", None, None)
    past = table.withColumn("keyword", F.lit("crypto ai"))
    rows = outlook.track(made, "crypto ai", past).collect()
    assert len(rows) == 7 and [r["predicted_at"] for r in rows] == sorted(r["predicted_at"] for r in rows)
    assert outlook.track(made, "crypto ai").count() == 2
    assert outlook.latest_row(made).filter("keyword = 'crypto ai'").first()["predicted_at"] == hour(2)
