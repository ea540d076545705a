"""Queries of the forecast board over a prediction table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.normalize import latest_rows

# Lifecycle stage and progress of each label, topic rules in order.
STAGES = {
    "emerging": ("Pre-emergence → Rising", 0.4),
    "viral": ("Rising → Peak", 0.8),
    "stable": ("Peak → Declining", 0.6),
    "declining": ("Declining", 0.2),
}
TOPICS = (
    ("Technology", ("ai", "tech", "gpt", "robot")),
    ("Sports", ("sport", "football", "nba")),
    ("Politics", ("politic", "vote", "election")),
    ("Finance", ("crypto", "bitcoin", "stock")),
)


def choose(predictions: DataFrame, period: str, min_confidence: float = 0.0) -> DataFrame:
    enough = F.col("confidence").cast("double") >= min_confidence
    return predictions.filter((F.col("forecast_period") == period) & enough)


def last_known(column: str, time: str = "predicted_at") -> Column:
    """Aggregate: the newest non-null value of a column."""
    return F.max_by(column, F.when(F.col(column).isNotNull(), F.col(time)))


def priority(predictions: DataFrame, current: DataFrame | None = None) -> DataFrame:
    """Keywords by predicted frequency with the change against the current one.

    `current` holds (keyword, current_freq); without it the lower bound stands in. No change is
    given for a current frequency of 0 or an unknown one.
    """
    newest = predictions.groupBy("keyword").agg(
        last_known("lower_bound").alias("lower_bound"),
        last_known("predicted_freq").alias("predicted_freq"),
        last_known("trend_class").alias("trend_class"),
        last_known("confidence").cast("double").alias("confidence"),
    )
    if current is None:
        known = newest.withColumn("current_freq", F.col("lower_bound"))
    else:
        known = newest.join(current, "keyword", "left").withColumn(
            "current_freq", F.col("current_freq").cast("double")
        )
    now, then = F.col("current_freq"), F.col("predicted_freq")
    change = F.try_divide(then - now, now) * 100
    return known.select(
        "keyword", "current_freq", "predicted_freq", "trend_class", "confidence",
        change.alias("change_pct"),
    ).orderBy(F.desc_nulls_last("predicted_freq"), "keyword")


def lifecycle(predictions: DataFrame, label: str = "trend_class") -> DataFrame:
    """Stage text and progress of each row's label."""
    name = F.lower(F.col(label))
    rules = list(STAGES.items())
    stage = F.coalesce(*[F.when(name == k, F.lit(v[0])) for k, v in rules], F.lit("Unknown"))
    value = F.coalesce(*[F.when(name == k, F.lit(v[1])) for k, v in rules], F.lit(0.0))
    return predictions.withColumns({"stage": stage, "stage_value": value})


def projected_velocity(predictions: DataFrame) -> DataFrame:
    """Hourly pace of each keyword's first forecast row, and a tenth of it as acceleration."""
    first = predictions.groupBy("keyword").agg(
        F.min_by("predicted_freq", "predicted_at").alias("predicted_freq")
    )
    velocity = F.col("predicted_freq") / 24
    return first.select("keyword", velocity.alias("velocity"), (velocity * 0.1).alias("acceleration"))


def topic(keyword: Column) -> Column:
    """Topic of a keyword: the first rule with a matching part, else General."""
    low = F.lower(keyword)
    rules = []
    for name, parts in TOPICS:
        hit = low.contains(parts[0])
        for part in parts[1:]:
            hit = hit | low.contains(part)
        rules.append(F.when(hit, F.lit(name)))
    return F.coalesce(*rules, F.lit("General"))


def topic_buckets(predictions: DataFrame) -> DataFrame:
    """Forecast rows per topic."""
    return predictions.groupBy(topic(F.col("keyword")).alias("topic")).agg(
        F.count("keyword").alias("rows")
    )


def classification_snapshot(predictions: DataFrame) -> DataFrame:
    """Per keyword the values of its best predicted row, each the first known one."""
    rank = F.struct(F.col("predicted_freq"), -F.unix_micros("predicted_at"))

    def best(column: str) -> Column:
        return F.max_by(column, F.when(F.col(column).isNotNull(), rank)).alias(column)

    return predictions.groupBy("keyword").agg(
        best("trend_class"), best("confidence"), F.max("predicted_freq").alias("predicted_freq")
    )


def track(predictions: DataFrame, keyword: str, actuals: DataFrame | None = None) -> DataFrame:
    """A keyword's forecast with its band, after its actual points (keyword, timestamp,
    frequency) where given; in time order."""
    shown = ("keyword", "predicted_at", "frequency", "predicted_freq", "lower_bound", "upper_bound")
    own = predictions.filter(F.col("keyword") == keyword)
    if "frequency" not in own.columns:
        own = own.withColumn("frequency", F.lit(None).cast("double"))
    rows = own.select(*shown)
    if actuals is not None:
        past = actuals.filter(F.col("keyword") == keyword).select(
            "keyword", F.col("timestamp").alias("predicted_at"), F.col("frequency").cast("double").alias("frequency")
        )
        rows = rows.withColumn("frequency", F.col("frequency").cast("double"))
        rows = past.unionByName(rows, allowMissingColumns=True).select(*shown)
    return rows.orderBy("predicted_at")


def latest_row(predictions: DataFrame) -> DataFrame:
    """Each keyword's last forecast row."""
    return latest_rows(predictions, ["keyword"], [F.desc("predicted_at")])
