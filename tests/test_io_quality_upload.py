from __future__ import annotations

import uuid
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.helpers import hour
from tidemark import schemas
from tidemark.operators import normalize, quality, upload
from tidemark.plans.trend_run import TrendRun
from tidemark.sources import files


def at():
    return F.lit(datetime(2024, 2, 1)).cast("timestamp")


def test_jsonl_skips_blank_and_missing(spark, tmp_path):
    folder = tmp_path / "source=reddit"
    folder.mkdir()
    (folder / "a.jsonl").write_text('{"id":"1","title":"t","created_utc":1704067200,"data_source":"reddit"}\n\n')
    posts = files.load_raw_posts(spark, [str(folder), str(tmp_path / "news-missing")])
    row = posts.first()
    assert (row["text"], row["timestamp"], row["engagement"]) == ("t", "1704067200", 0)


def test_jsonl_malformed(spark, tmp_path):
    bad = tmp_path / "b.jsonl"
    bad.write_text('{"id":"1"}\nnot json\n')
    with pytest.raises(Exception):  # noqa: B017 - the reader's own error type
        files.read_jsonl(spark, str(bad), schemas.RAW_NEWS).collect()
    kept = files.read_jsonl(spark, str(bad), schemas.RAW_NEWS, strict=False)
    assert [r["_corrupt_record"] for r in kept.collect()] == [None, "not json"]


def test_no_raw_data(spark, tmp_path):
    with pytest.raises(RuntimeError):
        files.load_raw_posts(spark, [str(tmp_path / "twitter")])


def test_unknown_source():
    with pytest.raises(ValueError):
        normalize.by_source(["/data/other"])
    routed = normalize.by_source(["/raw/News/a", "/raw/reddit/b", "/raw/news/twitter", "/raw/news/c"])
    assert routed == {"twitter": ["/raw/news/twitter"], "reddit": ["/raw/reddit/b"], "news": ["/raw/News/a", "/raw/news/c"]}


def test_snapshot_replaces_its_day_only(spark, tmp_path):
    root = str(tmp_path / "snap")
    one = spark.range(3)
    files.write_snapshot(one, root, "2024-01-01")
    files.write_snapshot(one, root, "2024-01-02")
    files.write_snapshot(spark.range(1), root, "2024-01-02")
    counts = spark.read.parquet(root).groupBy("dt").count().collect()
    assert sorted(r["count"] for r in counts) == [1, 3]


def test_dated_layout_prunes(spark, tmp_path):
    root = str(tmp_path / "dated")
    rows = [(str(i), hour(24 * (i % 4)), f"s{i % 2}") for i in range(40)]
    df = spark.createDataFrame(rows, "id string, timestamp timestamp, source string")
    files.write_dated(df, root)
    assert Path(files.dated_path(root, "s0", datetime(2024, 1, 3))).is_dir()
    read = files.read_dated(spark, root, "s0", datetime(2024, 1, 3))
    assert read.count() == 10
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan


def test_folder_union_and_append(spark, tmp_path):
    root = tmp_path / "board"
    files.write_parquet(spark.range(2).toDF("a"), str(root / "x"))
    files.write_parquet(spark.range(2).toDF("a"), str(root / "x"))
    files.write_parquet(spark.range(1).toDF("b"), str(root / "y"))
    read = files.read_folder(spark, str(root))
    assert set(read.columns) == {"a", "b"} and read.count() == 5
    assert files.read_folder_or_none(spark, str(tmp_path / "none")) is None


def test_required_columns(spark):
    df = spark.createDataFrame([(1, "a")], "n int, s string")
    assert quality.require_columns(df, ["n"]) and quality.require_columns(df, df.schema)
    with pytest.raises(ValueError):
        quality.require_columns(df, ["n", "other"])
    with pytest.raises(TypeError):
        quality.require_columns(df, "n")


def test_rows_and_battery(spark, caplog):
    df = spark.createDataFrame([(1, None), (2, None), (3, "x")], "n int, s string")
    assert quality.require_rows(df)
    with pytest.raises(ValueError):
        quality.require_rows(df.limit(0))
    assert quality.check(df, ["n"], "ctx", ["s"]) is df
    assert "is null" in caplog.text
    with pytest.raises(ValueError):
        quality.check(df.limit(0), ["n"])
    report = quality.null_rate(df, "s").first()
    assert (report["null_count"], report["null_fraction"], report["passed"]) == (2, 0.6667, False)
    assert quality.null_rate(df.limit(0), "s").first()["passed"]
    profile = {r["column"]: (r["row_count"], r["column_count"], r["null_count"]) for r in quality.profile(df).collect()}
    assert profile == {"n": (3, 2, 0), "s": (3, 2, 2)}


def test_upload(spark):
    rows = [
        ("a", "1,234", "+15.5%", "Hot", "2024-01-10 10:00:00"),
        ("b", "abc", "NaN", " ", "bad"),
        ("c", None, "-3", None, None),
        ("d", "7", "0", "Own Label", "2024-01-10"),
    ]
    df = spark.createDataFrame(rows, "`Keyword ` string, FREQUENCY string, growth_rate string, trend_label string, timestamp string")
    got = {r["keyword"]: r for r in upload.load_trends(df, at()).collect()}
    assert (got["a"]["frequency"], got["a"]["growth_rate"], got["a"]["trend_label"]) == (1234.0, 15.5, "viral")
    assert (got["b"]["frequency"], got["b"]["growth_rate"], got["b"]["trend_label"]) == (0.0, 0.0, "stable")
    assert (got["c"]["frequency"], got["c"]["growth_rate"], got["c"]["trend_label"]) == (0.0, -3.0, "stable")
    assert got["d"]["trend_label"] == "own label"
    assert got["b"]["timestamp"] == datetime(2024, 2, 1) and got["d"]["timestamp"] == datetime(2024, 1, 10)
    assert {r["z_score"] for r in got.values()} == {0.0}


def test_upload_requires_columns(spark):
    with pytest.raises(ValueError):
        upload.load_trends(spark.createDataFrame([("a",)], "keyword string"), at())
    with pytest.raises(ValueError):
        upload.load_predictions(spark.createDataFrame([("a",)], "keyword string"), at())


def test_uploaded_predictions(spark):
    df = spark.createDataFrame([("a", 10.0, "7d")], "Keyword string, Predicted_Freq double, forecast_period string")
    row = upload.load_predictions(df, at()).first()
    assert (row["lower_bound"], row["upper_bound"], row["forecast_period"], row["confidence"]) == (8.0, 12.0, "7d", 0.5)


def test_manual_keywords(spark):
    df = spark.createDataFrame([("climate change\n\n  ai \t\n",)], "text string")
    assert [r["keyword"] for r in upload.manual_keywords(df, "text", at()).collect()] == ["climate change", "ai"]


def test_flatten_defaults(spark):
    ddl = schemas.NESTED_TWEET
    text = [
        ('{"id":"1","text":"t","entities":{"hashtags":[{"tag":"a"},{"tag":""},{"tag":"b"}]},"public_metrics":{"like_count":3}}',),
        ('{"id":"2","text":"u","data_source":"twitter","like_count":9,"hashtags":"x"}',),
        ('{"id":"3","text":"v"}',),
    ]
    raw = spark.createDataFrame(text, "v string").select(F.from_json("v", ddl).alias("r")).select("r.*")
    got = {r["id"]: r for r in normalize.flatten_nested(raw).collect()}
    assert (got["1"]["hashtags"], got["1"]["like_count"], got["1"]["retweet_count"], got["1"]["lang"]) == ("a,b", 3, 0, "en")
    assert (got["2"]["hashtags"], got["2"]["like_count"], got["2"]["retweet_count"], got["2"]["lang"]) == ("x", 9, None, None)
    assert (got["3"]["hashtags"], got["3"]["source"]) == ("", "Twitter Web App")


def test_first_per_link(spark):
    rows = [("l", 1, 0, "late"), ("l", 0, 5, "early"), ("m", 1, 1, None)]
    df = spark.createDataFrame(rows, "link string, feed int, entry int, title string")
    got = {r["link"]: r["title"] for r in normalize.first_per_link(df, "feed", "entry").collect()}
    assert got == {"l": "early", "m": None}


def test_counts_of_empty_source(spark):
    frames = {"twitter": spark.range(3), "news": spark.range(0)}
    got = {r["source"]: r["records"] for r in normalize.ingest_counts(frames).collect()}
    assert got == {"twitter": 3, "news": 0, "total": 3}


def jobs_of(spark, run) -> int:
    """How many jobs a call starts."""
    group = f"count-{uuid.uuid4()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        run()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_watched_write_adds_no_job(spark, tmp_path, caplog):
    rows = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (3, "x", None)], "n int, s string, `odd.name` string").repartition(3)
    plain = jobs_of(spark, lambda: rows.write.parquet(str(tmp_path / "plain")))
    seen = quality.watch(rows, ["n"], "ctx", ["s", "n"], max_fraction=0.5)
    assert jobs_of(spark, lambda: (seen.frame.write.parquet(str(tmp_path / "seen")), seen.settle())) == plain
    assert seen.rows == 3 and spark.read.parquet(str(tmp_path / "seen")).count() == 3
    assert "66.7% of s" in caplog.text and "of n is null" not in caplog.text
    told = {f["column"]: (f["null_count"], f["null_fraction"], f["passed"]) for f in seen.facts()}
    assert told == {"n": (0, 0.0, True), "s": (2, 0.6667, False), "odd.name": (1, 0.3333, True)}
    assert seen.report().filter("NOT passed").first()["column"] == "s"


def test_watch_of_no_rows(spark, tmp_path):
    none = spark.createDataFrame([], "n int, s string")
    for needs in (True, False):
        seen = quality.watch(none, needs_rows=needs, null_checks=["s"])
        seen.frame.write.parquet(str(tmp_path / str(needs)))
        assert seen.facts()[0] == {"column": "n", "row_count": 0, "null_count": 0, "null_fraction": 0.0, "passed": True}
        if needs:
            with pytest.raises(ValueError):
                seen.settle()
        else:
            seen.settle()
    with pytest.raises(ValueError):
        quality.watch(none, ["other"])


def test_watch_behind_a_shuffle_counts_every_row(spark, tmp_path):
    halves = spark.range(1000, numPartitions=4).withColumn("k", F.when(F.col("id") % 2 == 0, F.col("id"))).repartition(3)
    seen = quality.watch(halves)
    seen.frame.write.parquet(str(tmp_path / "a"))
    assert seen.rows == 1000 and seen.facts()[1]["null_count"] == 500


def test_malformed_lines_are_counted_and_set_apart(spark, tmp_path):
    for source, lines in {
        "twitter": ['{"id":"1","text":"one","data_source":"twitter"}', '{"id":"2"', "no json", ""],
        "reddit": ['{"id":"3","title":"three","score":"much"}', '{"id":"4","title":"four","score":1}'],
        "news": ['{"id":"5","title":"five"}'],
    }.items():
        folder = tmp_path / f"source={source}"
        folder.mkdir()
        (folder / "a.jsonl").write_text("\n".join(lines))
    paths = [str(tmp_path / f"source={s}") for s in ("twitter", "reddit", "news")]
    bad = files.BadLines()
    posts = files.load_raw_posts(spark, paths, bad_lines=bad)
    assert sorted(r["id"] for r in posts.collect()) == ["1", "4", "5"]
    assert bad.counts() == {"twitter": 2, "reddit": 1, "news": 0}
    out = str(tmp_path / "rejected")
    assert bad.divert(out) == 3
    kept = spark.read.parquet(out).collect()
    assert sorted((r["source"], r["line"]) for r in kept) == [
        ("reddit", '{"id":"3","title":"three","score":"much"}'), ("twitter", "no json"), ("twitter", '{"id":"2"'),
    ]
    assert all(r["file"].endswith("a.jsonl") for r in kept)
    clean = files.BadLines()
    files.load_raw_posts(spark, paths[2:], bad_lines=clean).collect()
    assert clean.divert(str(tmp_path / "none")) == 0 and not (tmp_path / "none").exists()
    job = TrendRun(spark, str(tmp_path / "lake"))
    assert job.process_raw(paths, strict=False).count() == 3 and job.read("rejected").count() == 3
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        job.process_raw(paths)
