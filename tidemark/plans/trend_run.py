"""The whole batch run: raw posts to processed, frequency, trend, feature and forecast tables."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark import settings as S
from tidemark.operators import anomaly, entities, features, forecast, frequency, keywords, normalize, quality, signals
from tidemark.session import scratch
from tidemark.sources import files

log = logging.getLogger(__name__)

# One folder per dataset, side by side: none is nested in another's layout.
DATASETS = (
    "processed", "frequency", "trends", "features", "anomalies", "predictions", "models", "keywords", "entities", "rejected",
    "daily_counts",
)


class TrendRun:
    """Stages over a root folder. Each stage writes its table; the next reads it back, so a lost
    executor costs the current stage only and every table is readable on its own."""

    def __init__(self, spark: SparkSession, root: str, windows: Sequence[str] = S.WINDOWS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.windows = tuple(windows)

    def path(self, dataset: str) -> str:
        if dataset not in DATASETS:
            raise ValueError(f"unknown dataset {dataset!r}")
        return f"{self.root}/{dataset}"

    def read(self, dataset: str) -> DataFrame:
        return files.read_parquet(self.spark, self.path(dataset))

    def snapshot(self, dataset: str, dt: str) -> DataFrame:
        """One day of a dataset kept by day; other days' folders are not opened."""
        return self.read(dataset).filter(F.col("dt") == F.lit(dt).cast("date")).drop("dt")

    def _write(self, df: DataFrame, dataset: str, **expected) -> DataFrame:
        """Write a table; what is expected of its rows is counted by the write itself."""
        seen = quality.watch(df, context=dataset, **({"needs_rows": False} | expected))
        files.write_parquet(seen.frame, self.path(dataset), "overwrite")
        seen.settle()
        return self.read(dataset)

    def process(self, posts: DataFrame) -> DataFrame:
        cleaned = normalize.process_posts(posts)
        return self._write(
            cleaned, "processed", required=schemas.struct(schemas.PROCESSED), null_checks=("text", "timestamp"), needs_rows=True
        )

    def process_raw(self, paths: Sequence[str], strict: bool = True) -> DataFrame:
        """Process raw folders. Malformed lines fail the run, or, if it isn't strict, go to `rejected`."""
        if strict:
            return self.process(files.load_raw_posts(self.spark, paths))
        bad = files.BadLines()
        processed = self.process(files.load_raw_posts(self.spark, paths, bad_lines=bad))
        if diverted := bad.divert(self.path("rejected")):
            log.warning("%d malformed lines of the raw folders are in %s", diverted, self.path("rejected"))
        return processed

    def count(self, processed: DataFrame) -> DataFrame:
        events = keywords.token_events(processed)
        return self._write(frequency.keyword_frequency(events, self.windows), "frequency")

    def count_day(self, processed: DataFrame, dt: str) -> None:
        """Store the base counts of the posts that came on a day, in that day's folder; a day run again replaces it."""
        events = keywords.token_events(processed)
        base = frequency.base_counts(events, frequency.grain(self.windows, 1.0))
        files.write_snapshot(base, self.path("daily_counts"), dt)

    def count_stored(self) -> DataFrame:
        """The frequency table of all days' base counts; no text is read."""
        days = self.read("daily_counts").drop("dt")
        return self._write(frequency.frequency_of_days(days, self.windows), "frequency")

    def detect(self, frequency: DataFrame, **rules) -> DataFrame:
        return self._write(signals.detect_trends(frequency, **rules), "trends")

    def build(self, frequency: DataFrame, trends: DataFrame, dt: str) -> DataFrame:
        table = features.build_features(frequency, trends)
        return self._write_features(table, dt)

    def build_from_posts(self, processed: DataFrame, dt: str) -> DataFrame:
        """The same table out of one pass over the tokens, without a join of the stored tables."""
        return self._write_features(features.features_of_events(keywords.token_events(processed)), dt)

    def _write_features(self, table: DataFrame, dt: str) -> DataFrame:
        files.write_snapshot(table, self.path("features"), dt)
        return self.snapshot("features", dt).select(*schemas.names(schemas.FEATURE))

    def extract_keywords(
        self, processed: DataFrame, dictionary: DataFrame | None = None, longest: int = 3
    ) -> tuple[DataFrame, DataFrame]:
        """Top keywords with their TF-IDF, and the entities of every post: of the dictionary
        (entity, label), or none without one."""
        table = keywords.keyword_table(processed)
        top = self._write(table, "keywords", required=schemas.struct(schemas.KEYWORD_TABLE), needs_rows=True)
        if dictionary is None:
            none = F.array().cast(schemas.ENTITIES).alias("entities")
            tagged = processed.select("id", "source", "timestamp", none)
        else:
            tagged = entities.tag_entities(processed, dictionary, longest)
        return top, self._write(tagged, "entities")

    def find_anomalies(self, feature_table: DataFrame, dt: str, method: str = "isolation_forest", **params) -> DataFrame:
        with scratch():
            files.write_snapshot(anomaly.enrich(feature_table, method, **params), self.path("anomalies"), dt)
        return self.snapshot("anomalies", dt)

    def forecast(self, feature_table: DataFrame, dt: str, seasonal: bool = False, n: int | None = S.TOP_FORECAST_KEYWORDS) -> DataFrame:
        """Write the day's predictions; a seasonal run also keeps its coefficients per keyword."""
        if seasonal:
            fitted = forecast.fit_seasonal(forecast.history(feature_table, n))
            files.write_snapshot(fitted, self.path("models"), dt)
            made = forecast.predictions(forecast.predict_seasonal(self.snapshot("models", dt)))
        else:
            made = forecast.forecast_linear(feature_table, n)
        files.write_snapshot(made, self.path("predictions"), dt)
        return self.snapshot("predictions", dt)

    def run(self, posts: DataFrame, dt: str) -> dict[str, DataFrame]:
        """All stages up to the features, as the daily batch does."""
        return self.run_processed(self.process(posts), dt)

    def run_processed(self, processed: DataFrame, dt: str) -> dict[str, DataFrame]:
        frequency = self.count(processed)
        trends = self.detect(frequency)
        return {
            "processed": processed,
            "frequency": frequency,
            "trends": trends,
            "features": self.build_from_posts(processed, dt),
        }


def main(argv: Sequence[str] | None = None) -> None:
    """`python -m tidemark.plans.trend_run ROOT --dt DAY [--raw PATH ...] [--forecast] ...`"""
    parser = argparse.ArgumentParser(prog="trend_run", description="Run the batch stages over a root folder.")
    parser.add_argument("root", help="folder that holds one sub-folder per dataset")
    parser.add_argument("--dt", required=True, help="day of the snapshots, yyyy-MM-dd")
    parser.add_argument("--raw", nargs="+", default=[], help="raw JSON Lines folders to process first")
    parser.add_argument("--lenient", action="store_true", help="set malformed raw lines apart instead of failing")
    parser.add_argument("--forecast", action="store_true", help="write the day's predictions")
    parser.add_argument("--seasonal", action="store_true", help="forecast with the seasonal model")
    parser.add_argument("--keywords", action="store_true", help="write the top keywords and the entities of the posts")
    parser.add_argument("--dictionary", help="Parquet folder of (entity, label) for --keywords")
    parser.add_argument("--longest", type=int, default=3, help="words of the longest entity looked for")
    parser.add_argument("--anomalies", choices=anomaly.METHODS, help="write the day's anomalies")
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    job = TrendRun(spark, args.root)
    if args.raw:
        job.run_processed(job.process_raw(args.raw, strict=not args.lenient), args.dt)
    if args.keywords:
        dictionary = files.read_parquet(spark, args.dictionary) if args.dictionary else None
        job.extract_keywords(job.read("processed"), dictionary, args.longest)
    if args.anomalies:
        job.find_anomalies(job.snapshot("features", args.dt), args.dt, args.anomalies)
    if args.forecast or args.seasonal:
        job.forecast(job.snapshot("features", args.dt), args.dt, args.seasonal)


if __name__ == "__main__":
    main()
