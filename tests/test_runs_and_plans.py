from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.helpers import hour
from tidemark import schemas
from tidemark.operators import features, forecast, frequency, keywords, normalize, signals
from tidemark.plans import trend_run
from tidemark.plans.queries import CATALOGUE
from tidemark.plans.trend_run import TrendRun
from tidemark.session import CHECKPOINT_KEY, materialize, scratch, scratch_root
from tidemark.sources import bindings as B
from tidemark.sources import files
from tidemark.streaming import counts as streams


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_trend_table_shuffles_once_per_need(spark, sf):
    """Signals of a frequency table: one exchange, one sort, two window nodes."""
    freq = spark.createDataFrame([], schemas.KEYWORD_FREQ)
    text = plan(signals.detect_trends(freq))
    assert text.count("Exchange") == 1 and text.count("Sort ") == 1 and text.count("Window ") == 2


def test_no_python_in_the_plans(spark, sf):
    for name in ("keyword_frequency", "detect_trends", "build_features", "tfidf_keywords", "forecast_all"):
        text = plan(CATALOGUE[name](spark, sf))
        assert "Python" not in text and "InPandas" not in text, name
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_features_take_four_exchanges(spark, sf):
    text = plan(features.features_of_events(B.event_mentions(spark, sf)))
    assert text.count("Exchange ") == 4


def test_scan_reads_only_needed_columns(spark, sf):
    text = plan(frequency.all_windows(B.event_mentions(spark, sf)))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text
    text = plan(keywords.keyword_events(B.posts(spark, sf), ()))
    assert "PushedFilters: [Or(IsNull(lang),EqualTo(lang,en))]" in text


def test_scratch_follows_the_session(spark):
    assert scratch_root(spark) == spark.conf.get(CHECKPOINT_KEY).rstrip("/")
    stored = materialize(spark.range(5).withColumn("x", F.col("id") * 2))
    assert stored.agg(F.sum("x")).first()[0] == 20
    assert "Range" not in plan(stored)


def test_scratch_tables_are_removed(spark):
    root = Path(scratch_root(spark))
    before = set(root.iterdir())
    with scratch():
        assert materialize(spark.range(3), "kept").count() == 3
        assert set(root.iterdir()) > before
    assert set(root.iterdir()) == before
    with pytest.raises(ZeroDivisionError), scratch():
        materialize(spark.range(3), "lost")
        1 / 0
    assert set(root.iterdir()) == before
    outside = Path(materialize(spark.range(3), "outside").inputFiles()[0].removeprefix("file://")).parent
    assert outside.parent == root and outside.exists()


@pytest.fixture(scope="module")
def raw(spark, sf, tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")
    made = {"twitter": B.raw_tweets, "reddit": B.raw_forum, "news": B.raw_news}
    for name, make in made.items():
        files.write_jsonl(make(spark, sf), f"{root}/source={name}")
    return [f"{root}/source={name}" for name in made]


def test_whole_run(spark, raw, tmp_path):
    root = str(tmp_path / "lake")
    words = str(tmp_path / "words")
    spark.createDataFrame([("the first", "EVENT"), ("news", "ORG")], "entity string, label string").write.parquet(words)
    trend_run.main(
        [root, "--dt", "2024-01-31", "--raw", *raw, "--forecast", "--anomalies", "zscore", "--keywords", "--dictionary", words]
    )
    job = TrendRun(spark, root)
    assert job.read("keywords").count() == 500
    assert job.read("entities").count() == job.read("processed").count()
    assert [f.name for f in job.read("processed").schema] == schemas.names(schemas.PROCESSED)
    assert {r["source"] for r in job.read("processed").select("source").distinct().collect()} == {
        "twitter", "reddit", "news",
    }
    assert job.read("frequency").columns == list(frequency.COLUMNS)
    assert set(job.read("trends").columns) == set(schemas.names(schemas.TREND))
    table = job.snapshot("features", "2024-01-31")
    joined = job.build(job.read("frequency"), job.read("trends"), "2024-01-30")
    assert joined.exceptAll(table.select(joined.columns)).isEmpty() and joined.count() == table.count()
    assert set(table.columns) == set(schemas.names(schemas.FEATURE))
    direct = features.features_of_events(keywords.token_events(job.read("processed")))
    assert table.select(direct.columns).exceptAll(direct).isEmpty()
    made = job.snapshot("predictions", "2024-01-31")
    assert made.count() == 20 * 24
    assert job.snapshot("anomalies", "2024-01-31").count() == table.count()
    job.forecast(table, "2024-02-01", seasonal=True)
    assert job.read("models").count() == 20
    assert job.snapshot("predictions", "2024-01-31").count() == 480
    top, tagged = job.extract_keywords(job.read("processed"))
    assert top.columns == schemas.names(schemas.KEYWORD_TABLE) and top.count() == 500
    assert tagged.filter("size(entities) > 0").isEmpty()
    words = job.read("trends").select(F.col("keyword").alias("entity"), F.lit("EVENT").alias("label")).distinct()
    _, tagged = job.extract_keywords(job.read("processed"), words, 1)
    assert tagged.count() == job.read("processed").count()
    assert not tagged.filter("size(entities) > 0").isEmpty()
    with pytest.raises(ValueError):
        job.path("other")


def test_empty_run_raises(spark, tmp_path):
    posts = spark.createDataFrame([("1", "bonjour", "1704067200", "x", 0, "fr")], schemas.POST)
    with pytest.raises(ValueError):
        TrendRun(spark, str(tmp_path)).process(posts)


def test_unify_drops_blank(spark):
    posts = spark.createDataFrame([("1", " ", "", "x", 0, "en"), ("2", "a", "", "x", 0, "en"), ("3", None, "", "x", 0, "en")], schemas.POST)
    assert [r["id"] for r in normalize.unify([posts]).collect()] == ["2"]
    with pytest.raises(ValueError):
        normalize.unify([])


def test_stream_drops_late_posts(spark, tmp_path):
    """A post far behind the watermark of an earlier batch does not count; one within it does."""
    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def arrive(name, at, text):
        row = [(name, text, at, "s", 0, "en")]
        spark.createDataFrame(row, streams.POST_DDL).coalesce(1).write.mode("append").parquet(src)

    def run():
        counted = streams.stream_window_frequency(streams.read_posts(spark, src), "1h", lateness="2 hours")
        streams.run_available(counted, out, state)

    arrive("1", hour(10), "storm storm")
    run()
    arrive("2", hour(10), "storm")
    arrive("3", hour(9), "storm")
    arrive("4", hour(1), "storm")
    run()
    got = {r["window_start"].hour: r["frequency"] for r in streams.current_counts(spark, out).collect()}
    assert got == {10: 3, 9: 1}


def test_hot_keyword_leaves_small_series(spark):
    """One keyword with nearly all rows: after the first combine it is one row per bucket."""
    events = spark.range(200_000).select(
        F.when(F.col("id") % 10 < 9, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id").cast("string"))).alias("keyword"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 86400).alias("timestamp"),
        F.lit("s").alias("source"),
    )
    base = frequency.base_counts(events, 3600)
    assert base.filter("keyword = 'hot'").count() == 24
    rolled = frequency.all_windows(events, ["1h", "24h"])
    assert rolled.filter("keyword = 'hot'").count() == 25
    assert rolled.filter("keyword = 'hot' and window = '24h'").first()["frequency"] == 180_000


def test_compacted_stream_counts(spark, tmp_path):
    """Compaction keeps the newest counts; later batches go on top of it, earlier ones are not opened."""
    out, small, smaller = (str(tmp_path / n) for n in ("out", "small", "smaller"))
    ddl = "keyword string, window_start timestamp, window_end timestamp, frequency long, window string"

    def batch(number, **counts):
        rows = [(k, hour(0), hour(1), n, "1h") for k, n in counts.items()]
        spark.createDataFrame(rows, ddl).write.parquet(f"{out}/batch={number}")

    def counts(*args):
        return {r["keyword"]: r["frequency"] for r in streams.current_counts(spark, *args).collect()}

    batch(0, a=1, b=5)
    batch(2, a=3)
    assert streams.compact(spark, out, small) == 2
    assert counts(small) == counts(out, small) == {"a": 3, "b": 5}
    batch(10, b=6, c=1)
    assert counts(out, small) == counts(out) == {"a": 3, "b": 6, "c": 1}
    assert plan(streams.current_counts(spark, out, small)).count("PartitionFilters: [isnotnull(batch") == 1
    assert streams.compact(spark, out, smaller, small) == 10
    assert counts(smaller) == {"a": 3, "b": 6, "c": 1}


def test_linear_forecast_takes_no_window(spark):
    """A series collapses by aggregates alone, before the limit; a table that is kept by keyword isn't dealt anew."""
    empty = spark.createDataFrame([], "keyword string, ts timestamp, y double, trend_label string")
    for points in (empty, empty.repartition("keyword")):
        text = plan(forecast.linear(points, 20))
        assert "Window" not in text and "Join" not in text
        assert text.count("Exchange hashpartitioning") == (2 if points is empty else 1), text


def test_forecast_of_events_rolls_up_candidates_only(spark, sf):
    """Candidates are ranked on the base counts, whose exchange is reused, and meet them before the roll-up."""
    made = forecast.forecast_of_events(B.event_mentions(spark, sf), 3)
    text = plan(made)
    assert text.count("FileScan") == 2  # the second is gone once the exchange is reused
    made.collect()
    final = plan(made).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
    whole = forecast.forecast_linear(features.features_of_events(B.event_mentions(spark, sf)), 3)
    assert sorted(map(str, whole.collect())) == sorted(map(str, made.collect()))


def test_latest_points_of_long_series(spark):
    """Points that lie in different stretches, fewer and more than the buffer holds."""
    rows = [(k, hour(24 * 17 * i), float(i * i % 7), "viral" if i % 2 else None) for k, n in (("a", 40), ("b", 3), ("c", 1)) for i in range(n)]
    points = spark.createDataFrame(rows, "keyword string, ts timestamp, y double, trend_label string")
    got = {r["keyword"]: r for r in forecast._ends(points, 5).collect()}
    for key, n in (("a", 40), ("b", 3), ("c", 1)):
        own = [r for r in rows if r[0] == key]
        last = own[-5:]
        delta = (last[-1][2] - last[0][2]) / (len(last) - 1) if len(last) > 1 else 0.0
        label = [r[3] for r in own if r[3]]
        assert tuple(got[key])[1:] == (last[-1][1], last[-1][2], delta, label[-1] if label else "stable", sum(r[2] for r in own))


def test_closed_windows_are_written_once_without_late_posts(spark, tmp_path):
    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def run(*posts):
        rows = [(str(i), "storm", at, "s", 0, "en") for i, at in enumerate(posts)]
        spark.createDataFrame(rows, streams.POST_DDL).coalesce(1).write.mode("append").parquet(src)
        counted = streams.stream_window_frequency(streams.read_posts(spark, src), "1h", lateness="2 hours")
        return streams.run_available(counted, out, state, closed_only=True)

    told = run(hour(0), hour(1), hour(5))
    assert told[-1]["late"] == 0 and told[-1]["watermark"].startswith("2024-01-01T03:00")
    assert {r["window_start"].hour: r["frequency"] for r in streams.closed_counts(spark, out).collect()} == {0: 1, 1: 1}
    told = run(hour(1), hour(4), hour(5), hour(8))  # the first belongs to a closed hour
    assert sum(t["late"] for t in told) == 1 and told[-1]["open"] == 1
    told = run(hour(20))
    got = sorted((r["window_start"].hour, r["frequency"]) for r in streams.closed_counts(spark, out).collect())
    assert got == [(0, 1), (1, 1), (4, 1), (5, 2), (8, 1)]


def test_a_day_run_again_rewrites_its_folder_only(spark, tmp_path):
    job = TrendRun(spark, str(tmp_path))
    days = {f"2024-01-0{d}": [f"storm flood{d % 2}", "storm rain"][: 1 + d % 2] for d in range(1, 4)}

    def posts(texts):
        rows = [(str(i), t, t, t.split(), hour(i * 30), "s", 0, "en") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, schemas.PROCESSED)

    job.count_day(posts(["wrong wrong"]), "2024-01-02")
    for day, texts in days.items():
        job.count_day(posts(texts), day)
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "daily_counts").rglob("*.parquet")}
    job.count_day(posts(days["2024-01-02"]), "2024-01-02")
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "daily_counts").rglob("*.parquet")}
    same = [f for f in after if before.get(f) == after[f]]
    assert same and all("2024-01-02" not in str(f) for f in same) and all("2024-01-02" in str(f) for f in after if f not in same)
    whole = None
    for texts in days.values():
        whole = posts(texts) if whole is None else whole.unionByName(posts(texts))
    want = frequency.keyword_frequency(keywords.token_events(whole))
    got = job.count_stored()
    assert got.exceptAll(want.select(got.columns)).isEmpty() and want.count() == got.count() > 0
