"""The query catalogue: every operator over the given tables, by name."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark import settings as S
from tidemark.functions import text, times
from tidemark.operators import (
    anomaly, board, entities, features, forecast, frequency, keywords, normalize, outlook, quality, related, signals, upload,
)
from tidemark.plans.trend_run import TrendRun
from tidemark.session import materialize, scratch_path
from tidemark.sources import bindings as B
from tidemark.sources import files
from tidemark.streaming import counts as streams

Query = Callable[[SparkSession, str], DataFrame]
CATALOGUE: dict[str, Query] = {}

# Fixed parameters of the board queries.
FOCUS = ("ing", "ble")
REPLAY = date(2024, 1, 15)
DAY = datetime(2024, 1, 15)


def query(fn: Query) -> Query:
    """Register a query under its function's name; times are always read and shown in UTC."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
        return fn(spark, sf_dir)

    run.__doc__ = fn.__doc__
    CATALOGUE[fn.__name__] = run
    return fn


def rounded(df: DataFrame, digits: int = 6, *columns: str) -> DataFrame:
    """Means and deviations differ in their last bits from run to run; show fewer digits.

    Spelt out rather than `round`, whose handling of ties differs between engines.
    """
    unit = 10.0**digits
    return df.withColumns({c: F.floor(F.col(c).cast("double") * unit + 0.5) / unit for c in columns})


def loaded_at():
    return F.lit(datetime(2024, 2, 1)).cast("timestamp")


# --- derived tables ------------------------------------------------------------------------


def trends(spark, sf):
    return signals.trends_of_events(B.mentions(spark, sf))


def global_trends(spark, sf):
    return signals.global_trends_of_events(B.mentions(spark, sf))


def series(spark, sf):
    """Series of all windows, over all sources and each: the input of the signal operators."""
    return frequency.keyword_frequency(B.mentions(spark, sf))


def feature_table(spark, sf):
    return features.features_of_events(B.mentions(spark, sf))


def trend_board(spark, sf):
    return board.prepare(trends(spark, sf))


def global_board(spark, sf):
    return board.prepare(global_trends(spark, sf))


def predictions(spark, sf):
    """Linear forecasts of every keyword."""
    return forecast.forecast_linear(feature_table(spark, sf), n=None)


def keywords_of_documents(spark, sf):
    """(id, keyword) of every occurrence."""
    return keywords.keyword_events(B.posts(spark, sf), ("id",))


def shown_predictions(df):
    return rounded(df, 4, "confidence")


# --- sources and sinks ---------------------------------------------------------------------


def _raw_folders(spark, sf) -> dict[str, str]:
    root = scratch_path(spark, "raw")
    made = {"twitter": B.raw_tweets, "reddit": B.raw_forum, "news": B.raw_news}
    paths = {name: f"{root}/source={name}" for name in made}
    for name, make in made.items():
        files.write_jsonl(make(spark, sf), paths[name])
    return paths


@query
def scan_jsonl(spark, sf):
    paths = list(_raw_folders(spark, sf).values())
    return files.load_raw_posts(spark, [*paths, paths[0] + "-missing-twitter"])


@query
def scan_jsonl_lenient(spark, sf):
    """Raw folders in which one line in sixteen is cut off: posts kept, lines set apart, and which ones, by source."""
    root = scratch_path(spark, "raw-cut")
    made = {"twitter": B.raw_tweets, "reddit": B.raw_forum, "news": B.raw_news}
    for name, make in made.items():
        whole = F.to_json(F.struct("*"), {"ignoreNullFields": "false"})
        cut = F.concat(F.lit('{"id":"'), "id")
        value = F.when(F.substring(F.md5(F.col("id").cast("binary")), 1, 1) == "0", cut).otherwise(whole)
        make(spark, sf).select(value.alias("value")).write.text(f"{root}/source={name}")
    bad = files.BadLines()
    posts = files.load_raw_posts(spark, [f"{root}/source={name}" for name in made], bad_lines=bad, pattern="*.txt")
    posts = materialize(posts, "lenient-posts")
    bad.divert(f"{root}/rejected")
    kept = posts.groupBy("source").agg(F.count("*").alias("posts"))
    apart = files.read_parquet(spark, f"{root}/rejected").groupBy("source").agg(
        F.count("*").alias("lines"), F.min("line").alias("first_line"), F.max("line").alias("last_line")
    )
    return kept.join(apart, "source", "full")


@query
def sink_jsonl(spark, sf):
    path = scratch_path(spark, "jsonl")
    files.write_jsonl(B.raw_forum(spark, sf), path)
    return files.read_jsonl(spark, path, schemas.RAW_FORUM)


@query
def sink_parquet_partitioned(spark, sf):
    path = scratch_path(spark, "by-window")
    files.write_parquet(frequency.all_windows(B.mentions(spark, sf)), path, "overwrite", ["window"])
    return files.read_parquet(spark, path).select(*frequency.COLUMNS)


@query
def partition_pruned_read(spark, sf):
    path = scratch_path(spark, "dated")
    files.write_dated(B.event_mentions(spark, sf), path)
    return files.read_dated(spark, path, "group1", DAY).select("keyword", "timestamp", "source")


@query
def sink_dt_snapshot(spark, sf):
    """Two days' snapshots, then one of them again: only that day is replaced."""
    path = scratch_path(spark, "snapshot")
    daily = frequency.all_windows(B.mentions(spark, sf), ["24h"]).select("keyword", "window_start", "frequency")
    files.write_snapshot(daily, path, "2024-01-01")
    files.write_snapshot(daily, path, "2024-01-02")
    files.write_snapshot(daily.withColumn("frequency", -F.col("frequency")), path, "2024-01-02")
    return files.read_parquet(spark, path).withColumn("dt", F.col("dt").cast("string"))


@query
def sink_csv(spark, sf):
    path = scratch_path(spark, "csv")
    shown = B.raw_forum(spark, sf).select("id", "title", "score", "created_utc", "url")
    files.write_csv(shown, path)
    return files.read_csv(spark, path, "id string, title string, score int, created_utc bigint, url string", multiline=True)


@query
def scan_csv(spark, sf):
    path = scratch_path(spark, "csv-infer")
    files.write_csv(B.table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"), path)
    read = files.read_csv(spark, path)
    return read.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query
def board_load(spark, sf):
    """Feature tables, typed rows with text times and bare keywords of three folders, as one board."""
    root = scratch_path(spark, "board")
    typed = upload.tidy_names(B.typed_upload(spark, sf, "Keyword ", "TIMESTAMP", "Trend_Label"))
    words = B.part_mentions(spark, sf).select("keyword", F.col("source").alias("trend_label")).distinct()
    stored = {
        "features/dt=2024-01-31": feature_table(spark, sf).drop("is_anomaly"),
        "typed/late/rows": typed,
        "words": words,
    }
    for name, table in stored.items():
        files.write_parquet(table, f"{root}/{name}", "overwrite")
    loaded = board.combine([files.read_folder(spark, f"{root}/{name.split('/')[0]}") for name in stored])
    return rounded(
        loaded.select("keyword", "timestamp", "frequency", "growth_rate", "z_score", "trend_label"),
        6, "z_score",
    )


@query
def board_load_trends(spark, sf):
    """Stored trend tables of differing columns without a board time: their window start stands in."""
    root = scratch_path(spark, "board-trends")
    # Both tables go through the counts; the texts are read once
    counts = materialize(frequency.base_counts(B.mentions(spark, sf), frequency.grain(S.WINDOWS, 1.0)), "base-counts")
    table = signals.trends_of_counts(counts)
    own = F.col("source") == S.ALL_SOURCES
    files.write_parquet(table.filter(own).drop("source", "growth_rate"), f"{root}/all/dt=2024-01-31", "overwrite")
    files.write_parquet(table.filter(~own).drop("velocity"), f"{root}/each/dt=2024-01-31", "overwrite")
    loaded = board.prepare(files.read_folder(spark, root))
    return loaded.select("keyword", "timestamp", "window", "source", "frequency", "growth_rate", "trend_label")


def _exported(spark, sf):
    shown = board.choose(global_board(spark, sf), ["viral", "emerging"])
    return shown.select("keyword", "timestamp", "window", "frequency", "growth_rate", "trend_label")


EXPORT = "keyword string, timestamp timestamp, window string, frequency bigint, growth_rate double, trend_label string"


@query
def export_board(spark, sf):
    path = scratch_path(spark, "export-csv")
    files.export_csv(_exported(spark, sf), path)
    return files.read_csv(spark, path, EXPORT)


@query
def export_board_json(spark, sf):
    path = scratch_path(spark, "export-json")
    files.export_json(_exported(spark, sf), path)
    return files.read_jsonl(spark, path, EXPORT)


# --- normalisation -------------------------------------------------------------------------


@query
def normalize_tweets(spark, sf):
    return normalize.to_posts(B.raw_tweets(spark, sf), "twitter")


@query
def normalize_forum(spark, sf):
    return normalize.to_posts(B.raw_forum(spark, sf), "reddit")


@query
def normalize_news(spark, sf):
    return normalize.to_posts(B.raw_news(spark, sf), "news")


def _unified(spark, sf):
    return normalize.unify(
        [
            normalize.to_posts(B.raw_tweets(spark, sf), "twitter"),
            normalize.to_posts(B.raw_forum(spark, sf), "reddit"),
            normalize.to_posts(B.raw_news(spark, sf), "news"),
        ]
    )


@query
def unified_posts(spark, sf):
    return _unified(spark, sf)


@query
def infer_source(spark, sf):
    """Records per source, routed by the folder each file lies in."""
    lines = spark.read.text(list(_raw_folders(spark, sf).values()))
    routed = lines.select(normalize.source_of_path(F.col("_metadata.file_path")).alias("source"))
    return routed.groupBy("source").agg(F.count("*").alias("records"))


@query
def flatten_nested_posts(spark, sf):
    records = B.nested_tweets(spark, sf).select(F.from_json("value", schemas.NESTED_TWEET).alias("r"))
    return normalize.flatten_nested(records.select("r.*"))


@query
def coerce_ints(spark, sf):
    upload_rows = B.typed_upload(spark, sf, "frequency", "growth_rate", "is_anomaly")
    raw = upload_rows.select(
        F.col("event_id").cast("string").alias("id"),
        F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("string").alias("selftext"),
        F.col("growth_rate").alias("subreddit"),
        F.col("frequency").alias("score"),
        F.col("is_anomaly").alias("num_comments"),
        F.col("growth_rate").alias("created_utc"),
        F.lit(None).cast("string").alias("url"),
    )
    return normalize.coerce_forum(raw)


@query
def link_id(spark, sf):
    return B.table(spark, sf, "pages").select("page_id", text.link_id(F.col("url")).alias("link_id"))


@query
def truncate_text(spark, sf):
    docs = B.table(spark, sf, "documents")
    return docs.select("doc_id", text.truncate(F.col("text"), 1000).alias("text"))


@query
def parse_feed_dates(spark, sf):
    """Feed dates converted to UTC."""
    entries = B.feed_entries(spark, sf)
    return entries.select("link", times.parse_feed_date(F.col("published"), to_utc=True).alias("published"))


@query
def parse_feed_dates_wallclock(spark, sf):
    """Feed dates with their wall-clock fields kept and offsets dropped."""
    entries = B.feed_entries(spark, sf)
    return entries.select("link", times.parse_feed_date(F.col("published")).alias("published"))


@query
def feed_to_news(spark, sf):
    """Feed entries in the raw news layout: id, cut summary, wall-clock date."""
    return normalize.feed_to_news(B.feed_entries(spark, sf))


@query
def dedup_links(spark, sf):
    """Three feeds that carry the same pages, two of them cut to their sites."""
    entries = B.feed_entries(spark, sf).select("link", "title", "source", "page_id")
    site = F.concat(F.lit("https://"), F.col("source"))
    feeds = [entries, entries.withColumn("link", site), entries.withColumns({"link": site, "title": F.lit("late")})]
    stacked = [df.withColumn("feed", F.lit(i)) for i, df in enumerate(feeds)]
    both = stacked[0].unionByName(stacked[1]).unionByName(stacked[2])
    return normalize.first_per_link(both, "feed", "page_id")


@query
def ingest_counts(spark, sf):
    return normalize.ingest_counts(
        {
            "twitter": B.raw_tweets(spark, sf).select("id"),
            "reddit": B.raw_forum(spark, sf).select("id"),
            "news": B.raw_news(spark, sf).select("id"),
        }
    )


@query
def align_schema(spark, sf):
    docs = B.table(spark, sf, "documents").select(
        "text", "lang", F.col("doc_id").alias("id"), F.col("n_chars").alias("engagement"), "source"
    )
    return normalize.align(docs, "id string, text string, clean_text string, source string, engagement int, lang string")


@query
def normalize_timestamps(spark, sf):
    events = B.table(spark, sf, "events")
    at = F.col("ts").cast("timestamp")
    key = F.col("event_id") % 5
    written = (
        F.when(key == 0, F.date_format(at, times.ISO_OUT))
        .when(key == 1, F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .when(key == 2, F.date_format(at, "yyyy-MM-dd HH:mm:ss"))
        .when(key == 3, F.unix_seconds(at).cast("string"))
        .otherwise(F.lit("yesterday"))
    )
    return normalize.parse_times(events.select("event_id", written.alias("timestamp")))


# --- text ----------------------------------------------------------------------------------


@query
def clean_text(spark, sf):
    cleaned = text.clean(F.col("text")).alias("clean_text")
    return normalize.english(B.posts(spark, sf)).select("id", cleaned)


@query
def lang_filter(spark, sf):
    return normalize.english(B.posts(spark, sf)).select("id", "lang", "source")


@query
def tokenize(spark, sf):
    return B.processed(spark, sf).select("id", F.array_join("tokens", " ").alias("tokens"))


@query
def process_posts(spark, sf):
    """All three sources from raw layout to the processed layout."""
    made = normalize.process_posts(_unified(spark, sf))
    return made.withColumn("tokens", F.array_join("tokens", " ")).drop("text")


@query
def keyword_events(spark, sf):
    return B.mentions(spark, sf)


@query
def filter_keywords(spark, sf):
    docs = normalize.english(B.posts(spark, sf))
    words = docs.select("id", F.explode(text.words(F.col("text"))).alias("keyword"))
    return keywords.filter_keywords(words, 4).groupBy("keyword").agg(F.count("*").alias("occurrences"))


# --- windows -------------------------------------------------------------------------------


def _window_query(label: str) -> None:
    def run(spark, sf):
        return frequency.window_frequency(B.mentions(spark, sf), label)

    run.__name__ = f"window_freq_{label}"
    query(run)


for _label in S.WINDOWS:
    _window_query(_label)


@query
def window_freq_sliding(spark, sf):
    return frequency.window_frequency(B.mentions(spark, sf), "24h", 0.25)


@query
def freq_all_windows_sliding(spark, sf):
    """Sliding windows of several lengths from one set of base counts."""
    return frequency.all_windows(B.mentions(spark, sf), ["6h", "24h"], 0.5)


@query
def freq_all_windows(spark, sf):
    return frequency.all_windows(B.mentions(spark, sf))


@query
def freq_per_source(spark, sf):
    return frequency.per_source(B.mentions(spark, sf))


@query
def keyword_frequency(spark, sf):
    return frequency.keyword_frequency(B.mentions(spark, sf))


@query
def frequency_of_days(spark, sf):
    """The frequency table out of four days' stored counts; the second day is first stored wrongly, then again."""
    job = TrendRun(spark, scratch_path(spark, "days"))
    came = B.arrivals(spark, sf).select("id", "batch")
    posts = materialize(B.processed(spark, sf).select("id", "tokens", "timestamp", "source").join(came, "id"), "arrived")
    for day, part in ((0, "batch = 0"), (1, "batch < 2"), (2, "batch = 2"), (3, "batch = 3"), (1, "batch = 1")):
        job.count_day(posts.filter(part), f"2024-02-0{day + 1}")
    return frequency.frequency_of_days(job.read("daily_counts").drop("dt"))


@query
def part_frequency(spark, sf):
    """Day and week counts of part words over all line items: dense series."""
    return frequency.keyword_frequency(B.part_mentions(spark, sf), ["1d", "7d"])


# --- signals -------------------------------------------------------------------------------


@query
def growth_rate(spark, sf):
    return signals.growth_rate(series(spark, sf))


@query
def velocity_acceleration(spark, sf):
    return signals.velocity_acceleration(signals.growth_rate(series(spark, sf)))


def _scored(spark, sf):
    return signals.zscore(signals.growth_rate(series(spark, sf)))


@query
def zscore(spark, sf):
    return rounded(_scored(spark, sf), 6, "z_score")


@query
def flag_anomalies(spark, sf):
    return rounded(signals.flag_anomalies(_scored(spark, sf)), 6, "z_score")


@query
def classify_trend(spark, sf):
    return rounded(signals.classify(_scored(spark, sf)), 6, "z_score")


@query
def classify_trend_strict(spark, sf):
    """Labels where emerging holds on 24h windows only."""
    counted = frequency.all_windows(B.mentions(spark, sf))
    scored = signals.zscore(signals.growth_rate(counted))
    return rounded(signals.classify(scored, emerging_window="24h"), 6, "z_score")


@query
def detect_trends(spark, sf):
    return rounded(trends(spark, sf), 6, "z_score")


@query
def part_trends(spark, sf):
    """Signals of part words: long dense series."""
    return rounded(signals.trends_of_events(B.part_mentions(spark, sf), ["1d", "7d"]), 6, "z_score")


@query
def trend_summary(spark, sf):
    return signals.trend_summary(trends(spark, sf))


@query
def growth_rate_clamped(spark, sf):
    """Growth of corrected counts, some of which fall below 0."""
    corrected = series(spark, sf).withColumn("frequency", F.col("frequency") - 2)
    return signals.growth_rate_clamped(corrected)


@query
def peer_zscore(spark, sf):
    rated = materialize(signals.growth_rate(series(spark, sf)), "rated")  # read for its statistics, then for its rows
    return rounded(signals.peer_zscore(rated), 6, "peer_z")


@query
def acceleration_zero_first(spark, sf):
    rated = signals.growth_rate(series(spark, sf)).filter(F.col("growth_rate").isNotNull())
    return signals.acceleration_zero_first(rated)


@query
def source_diversity(spark, sf):
    return signals.source_diversity(B.mentions(spark, sf))


# --- features ------------------------------------------------------------------------------


@query
def source_diversity_merged(spark, sf):
    """Distinct sources of every keyword from the sketches of four snapshots."""
    path = scratch_path(spark, "sketches")
    posts = materialize(B.arrivals(spark, sf), "arrived")
    for batch in range(4):
        events = keywords.keyword_events(posts.filter(F.col("batch") == batch), ("source",))
        files.write_snapshot(signals.source_sketches(events), path, f"2024-02-0{batch + 1}")
    return signals.merged_diversity(files.read_parquet(spark, path).drop("dt"))


@query
def pivot_frequency(spark, sf):
    return features.pivot_frequency(frequency.all_windows(B.mentions(spark, sf)))


@query
def feature_source_diversity(spark, sf):
    return features.source_diversity(frequency.per_source(B.mentions(spark, sf)))


Z_COLUMNS = ("z_score_1h", "z_score_24h")


@query
def pivot_trend_metrics(spark, sf):
    return rounded(features.pivot_trend_metrics(global_trends(spark, sf)), 6, *Z_COLUMNS)


@query
def build_features(spark, sf):
    return rounded(feature_table(spark, sf), 6, *Z_COLUMNS)


@query
def build_features_joined(spark, sf):
    """The same table from a frequency and a trend table that are joined."""
    counted = frequency.keyword_frequency(B.mentions(spark, sf))
    return rounded(features.build_features(counted, trends(spark, sf)), 6, *Z_COLUMNS)


# --- keywords ------------------------------------------------------------------------------


@query
def top_keywords(spark, sf):
    return keywords.top_keywords(B.mentions(spark, sf))


@query
def tfidf_keywords(spark, sf):
    return rounded(keywords.ranked_tfidf(B.processed(spark, sf)), 6, "avg_tfidf_score")


@query
def tfidf_hashed(spark, sf):
    return keywords.hashed_tfidf(B.processed(spark, sf))


@query
def tfidf_hashed_weights(spark, sf):
    """Weight, count and document frequency of every document and bucket, written out."""
    return rounded(keywords.hashed_weights(B.processed(spark, sf)), 6, "weight")


@query
def tfidf_bucket_map(spark, sf):
    return keywords.bucket_map(B.processed(spark, sf))


@query
def tag_entities(spark, sf):
    """Entities of all four labels in every post; one post in eleven has no time."""
    known = F.when(F.col("id").cast("bigint") % 11 != 0, F.col("timestamp"))
    posts = B.processed(spark, sf).withColumn("timestamp", known)
    tagged = entities.tag_entities(posts, B.entity_dictionary(spark, sf), longest=2)
    shown = F.transform("entities", lambda e: F.concat_ws(":", e["label"], e["entity"]))
    return tagged.withColumn("entities", F.array_join(shown, ","))


@query
def keyword_table(spark, sf):
    return rounded(keywords.keyword_table(B.processed(spark, sf)), 6, "avg_tfidf_score")


# --- anomalies -----------------------------------------------------------------------------


@query
def impute_features(spark, sf):
    wide = materialize(feature_table(spark, sf).select("keyword", "timestamp", *S.ANOMALY_FEATURES))
    return rounded(anomaly.impute(wide), 6, "z_score_1h")


def _flags(spark, sf, method):
    found = anomaly.detect(feature_table(spark, sf), method)
    return found.select("keyword", "timestamp", "is_anomaly", "anomaly_score")


@query
def anomaly_zscore(spark, sf):
    return _flags(spark, sf, "zscore").drop("anomaly_score")


@query
def anomaly_iqr(spark, sf):
    return _flags(spark, sf, "iqr").drop("anomaly_score")


@query
def anomaly_score(spark, sf):
    return rounded(_flags(spark, sf, "zscore"), 4, "anomaly_score").drop("is_anomaly")


@query
def anomaly_isolation_forest(spark, sf):
    return _flags(spark, sf, "isolation_forest")


@query
def anomaly_forest_check(spark, sf):
    """What any isolation forest must keep, over all rows: each scored once, scores from 0 to 1, no more flags
    than the contamination allows, and those on the highest scores."""
    found = materialize(_flags(spark, sf, "isolation_forest"), "forest-flags")
    flagged, score = F.col("is_anomaly"), F.col("anomaly_score")
    return found.agg(
        F.count("*").alias("rows"),
        F.count_distinct("keyword").alias("keywords"),
        F.count(score).alias("scored"),
        F.min(score).alias("least"),
        F.max(score).alias("most"),
        F.count_if(flagged).between(1, F.ceil(0.05 * F.count("*"))).alias("share_holds"),
        (F.min(F.when(flagged, score)) >= F.max(F.when(~flagged, score))).alias("highest_flagged"),
    )


@query
def anomaly_report(spark, sf):
    shown = anomaly.report(anomaly.enrich(feature_table(spark, sf), "zscore"))
    return rounded(rounded(shown, 4, "anomaly_score"), 6, "z_score_1h")


@query
def enrich_features(spark, sf):
    made = anomaly.enrich(feature_table(spark, sf), "iqr")
    return rounded(rounded(made, 4, "anomaly_score"), 6, *Z_COLUMNS)


# --- forecasts -----------------------------------------------------------------------------


@query
def forecast_candidates(spark, sf):
    return forecast.candidates(feature_table(spark, sf))


@query
def forecast_linear(spark, sf):
    return shown_predictions(forecast.forecast_of_events(B.mentions(spark, sf)))


@query
def forecast_linear_stored(spark, sf):
    """The same from a stored feature table of all keywords."""
    stored = materialize(feature_table(spark, sf), "features")
    return shown_predictions(forecast.forecast_linear(stored))


@query
def forecast_all(spark, sf):
    return shown_predictions(predictions(spark, sf))


@query
def forecast_seasonal(spark, sf):
    return forecast.forecast_seasonal(feature_table(spark, sf))


@query
def forecast_model_table(spark, sf):
    """Seasonal coefficients of every candidate, written and read back."""
    path = scratch_path(spark, "models")
    past = forecast.history(feature_table(spark, sf))
    files.write_parquet(forecast.fit_seasonal(past), path, "overwrite")
    return files.read_parquet(spark, path)


@query
def forecast_model_check(spark, sf):
    """Stored seasonal coefficients, read back and held against the series they were fitted on."""
    path = scratch_path(spark, "checked-models")
    past = materialize(forecast.history(feature_table(spark, sf)), "series")
    files.write_parquet(forecast.fit_seasonal(past), path, "overwrite")
    return forecast.check_seasonal(files.read_parquet(spark, path), past)


# --- trend board ---------------------------------------------------------------------------


@query
def board_lookback(spark, sf):
    stored = materialize(trend_board(spark, sf), "board")  # read for its newest time, then for its rows
    return rounded(board.lookback(stored, 48), 6, "z_score")


@query
def board_lookback_as_of(spark, sf):
    return rounded(board.lookback(global_board(spark, sf), 168, datetime(2024, 1, 20)), 6, "z_score")


@query
def board_replay_day(spark, sf):
    return rounded(board.replay_day(trend_board(spark, sf), REPLAY), 6, "z_score")


@query
def board_search(spark, sf):
    return rounded(board.search(trend_board(spark, sf), "TION"), 6, "z_score")


@query
def board_filter(spark, sf):
    chosen = board.choose(trend_board(spark, sf), ["viral", "emerging", "stable"], 2, 0.0, ["src0", "src1", "__all__"])
    return rounded(chosen, 6, "z_score")


@query
def board_surprise(spark, sf):
    stored = materialize(trend_board(spark, sf), "board")  # read for its draw, then for its rows
    return rounded(board.surprise(stored, 7), 6, "z_score")


WATCHLIST = ("ing", "ble", "tion", "ther", "rewh", "orre")


@query
def watchlist_alerts(spark, sf):
    return rounded(board.watchlist_alerts(trend_board(spark, sf), WATCHLIST), 6, "z_score")


@query
def trend_ranking(spark, sf):
    return rounded(board.ranking(global_board(spark, sf)), 6, "z_score")


@query
def board_metrics(spark, sf):
    return board.metrics(trend_board(spark, sf))


@query
def anomaly_alerts(spark, sf):
    return rounded(board.anomaly_alerts(global_board(spark, sf)), 6, "z_score")


@query
def top_by_max_freq(spark, sf):
    return board.top_by_max_frequency(trend_board(spark, sf))


@query
def growth_leaderboard(spark, sf):
    return board.growth_leaderboard(trend_board(spark, sf))


@query
def label_distribution(spark, sf):
    return board.label_distribution(trend_board(spark, sf))


@query
def keyword_timeline(spark, sf):
    return board.timeline(trend_board(spark, sf), FOCUS[0])


@query
def bubble_set(spark, sf):
    shown = board.bubbles(feature_table(spark, sf))
    return rounded(shown, 6, "z_score", "bubble_size")


@query
def compare_keywords(spark, sf):
    return rounded(board.compare(trend_board(spark, sf), *FOCUS), 6, "z_score")


@query
def compare_latest(spark, sf):
    return board.compare_latest(trend_board(spark, sf), *FOCUS)


@query
def board_summary_text(spark, sf):
    return board.summary_text(trend_board(spark, sf))


@query
def keyword_summary_text(spark, sf):
    return board.keyword_summary_text(global_board(spark, sf), FOCUS[0])


@query
def related_by_label(spark, sf):
    shown = trend_board(spark, sf).select("keyword", "timestamp", "window", "source", "trend_label", "frequency")
    return board.related_by_label(materialize(shown, "board"), FOCUS[0])  # read for the keyword's label, then for its rows


@query
def related_cooccurrence(spark, sf):
    docs = normalize.english(B.posts(spark, sf)).select(text.words(F.col("text")).alias("words"))
    return board.related_in_texts(docs, FOCUS[0], 20)


@query
def related_edges(spark, sf):
    """The six closest keywords of each of the 500 keywords found in most posts."""
    docs = normalize.english(B.posts(spark, sf)).select(text.words(F.col("text")).alias("words"))
    return related.related_edges(docs)


@query
def related_cooccurrence_joined(spark, sf):
    """The same from keyword events joined on their document."""
    events = keywords_of_documents(spark, sf)
    return board.related_by_documents(events, FOCUS[0], 20)


@query
def distinct_labels(spark, sf):
    return board.distinct_labels(trend_board(spark, sf))


@query
def latest_per_keyword(spark, sf):
    return rounded(board.latest_per_keyword(trend_board(spark, sf)), 6, "z_score")


@query
def ranking_display(spark, sf):
    return board.display(board.ranking(global_board(spark, sf)))


@query
def board_facets(spark, sf):
    return board.facets(trend_board(spark, sf), ["source", "window", "keyword"])


@query
def forecast_facets(spark, sf):
    """Choices of the forecast board: periods and keywords of its predictions."""
    return board.facets(predictions(spark, sf), ["forecast_period", "keyword"])


@query
def forecast_board_load(spark, sf):
    """Predictions of two folders, one with its times as text, read as one forecast board."""
    root = scratch_path(spark, "predictions")
    table = materialize(predictions(spark, sf), "predicted")  # read for each folder
    early = F.col("trend_class").eqNullSafe("stable")
    shown = {
        "kept": table.filter(early),
        "text": table.filter(~early).withColumn("predicted_at", F.date_format("predicted_at", times.ISO_OUT)),
    }
    for name, part in shown.items():
        files.write_parquet(part, f"{root}/{name}/dt=2024-01-31", "overwrite")
    loaded = board.combine([files.read_folder(spark, f"{root}/{name}") for name in shown])
    return shown_predictions(loaded.select(*table.columns))


@query
def board_limits(spark, sf):
    return board.limits(trend_board(spark, sf))


@query
def dataset_status(spark, sf):
    """The stored datasets of a run: each is written once, the later ones out of the earlier."""
    processed = materialize(B.processed(spark, sf), "processed")
    counted = materialize(frequency.keyword_frequency(keywords.token_events(processed)), "frequency")
    table = materialize(features.build_features(counted, signals.detect_trends(counted)), "features")
    return board.dataset_status(
        {"processed": (processed, "timestamp"), "frequency": (counted, "window_start"), "features": (table, "timestamp")}
    )


# --- forecast board ------------------------------------------------------------------------


@query
def forecast_track(spark, sf):
    table = feature_table(spark, sf)
    past = table.select("keyword", "timestamp", F.col("freq_1h").alias("frequency"))
    return outlook.track(forecast.forecast_linear(table), FOCUS[0], past)


@query
def forecast_priority(spark, sf):
    """Forecasts against the newest hourly count of each keyword."""
    # Read for its forecasts, then for its newest counts
    table = materialize(feature_table(spark, sf).select("keyword", "timestamp", "freq_1h", "trend_label"), "hourly")
    current = table.groupBy("keyword").agg(F.max_by("freq_1h", "timestamp").alias("current_freq"))
    ranked = outlook.priority(forecast.forecast_linear(table, n=None), current)
    return rounded(rounded(ranked, 4, "confidence"), 6, "change_pct")


@query
def forecast_priority_lower_bound(spark, sf):
    """The same with the lower bound in the place of the current count."""
    return rounded(rounded(outlook.priority(predictions(spark, sf)), 4, "confidence"), 6, "change_pct")


@query
def forecast_filter(spark, sf):
    return shown_predictions(outlook.choose(predictions(spark, sf), "24h", 0.5))


@query
def lifecycle_stage(spark, sf):
    staged = outlook.lifecycle(outlook.latest_row(predictions(spark, sf)))
    return staged.select("keyword", "trend_class", "stage", "stage_value")


@query
def projected_velocity(spark, sf):
    return rounded(outlook.projected_velocity(predictions(spark, sf)), 6, "velocity", "acceleration")


@query
def topic_buckets(spark, sf):
    return outlook.topic_buckets(predictions(spark, sf))


@query
def classification_snapshot(spark, sf):
    return shown_predictions(outlook.classification_snapshot(predictions(spark, sf)))


# --- uploads -------------------------------------------------------------------------------


@query
def upload_clean_numeric(spark, sf):
    typed = B.typed_upload(spark, sf, "frequency", "growth_rate", "z_score", "is_anomaly")
    return upload.clean_numbers(typed)


@query
def upload_defaults(spark, sf):
    typed = upload.tidy_names(B.typed_upload(spark, sf, "Keyword ", "TIMESTAMP", "frequency"))
    return upload.fill_defaults(typed, loaded_at())


@query
def upload_label_map(spark, sf):
    return upload.map_labels(upload.tidy_names(B.typed_upload(spark, sf, "Trend_Label")))


@query
def upload_trends(spark, sf):
    """The whole upload path on a hand-typed table."""
    return upload.load_trends(B.typed_upload(spark, sf), loaded_at())


@query
def manual_keywords(spark, sf):
    return upload.manual_keywords(B.table(spark, sf, "conversations"), "text", loaded_at())


@query
def upload_predictions(spark, sf):
    parts = B.table(spark, sf, "part")
    named = parts.select(
        "p_partkey", F.col("p_name").alias(" Keyword"), F.col("p_retailprice").alias("PREDICTED_FREQ")
    )
    return rounded(upload.load_predictions(named, loaded_at()), 6, "lower_bound", "upper_bound")


# --- quality -------------------------------------------------------------------------------


@query
def null_rate(spark, sf):
    return quality.null_rate(B.raw_forum(spark, sf), "num_comments")


@query
def profile_nulls(spark, sf):
    return quality.profile(B.raw_tweets(spark, sf))


@query
def null_rates_of_write(spark, sf):
    """Null shares of the forum posts, counted by the job that writes them."""
    seen = quality.watch(B.raw_forum(spark, sf), ["id"], "forum posts", max_fraction=0.3)
    materialize(seen.frame, "watched")
    return seen.report()


# --- streaming -----------------------------------------------------------------------------


@query
def stream_window_freq(spark, sf):
    """Daily keyword counts of all posts, read as a stream of files in several batches."""
    root = scratch_path(spark, "stream")
    B.posts(spark, sf).repartition(6).write.parquet(f"{root}/in")
    posts = streams.read_posts(spark, f"{root}/in", files_per_batch=2)
    counted = streams.stream_window_frequency(posts, "24h", lateness="40 days")
    streams.run_available(counted, f"{root}/out", f"{root}/state")
    return streams.current_counts(spark, f"{root}/out")


@query
def stream_closed_windows(spark, sf):
    """Daily counts of windows that the watermark has closed, from posts that arrive in four batches.

    A post arrives with its week, or, one in nine, a week or two later. What comes more than two days behind the
    newest post of the earlier batches and belongs to a closed day is dropped.
    """
    root = scratch_path(spark, "late")
    posts = materialize(B.arrivals(spark, sf), "arrivals")
    for batch in range(4):
        posts.filter(F.col("batch") == batch).drop("batch").write.mode("append").parquet(f"{root}/in")
        counted = streams.stream_window_frequency(streams.read_posts(spark, f"{root}/in"), "24h", lateness="2 days")
        streams.run_available(counted, f"{root}/out", f"{root}/state", closed_only=True)
    return streams.closed_counts(spark, f"{root}/out")
