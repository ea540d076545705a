"""Trend signals over keyword series: growth, velocity, acceleration, z-score, flags, labels.

A series is one (keyword, window, source), ordered by window start; "previous" is the previous
observed bucket, empty buckets are not filled in. A series holds one row per bucket of the
calendar, whatever the number of mentions behind it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark import settings as S
from tidemark.operators import frequency as freq
from tidemark.session import materialize

SERIES = ("keyword", "window", "source")


def _series():
    return Window.partitionBy(*SERIES)


def _ordered():
    return _series().orderBy("window_start")


def growth(now: Column, before: Column, epsilon: float = S.EPSILON) -> Column:
    """Relative change between two counts, damped by epsilon; null without a predecessor."""
    return (now - before) / (before + F.lit(epsilon))


def growth_rate(df: DataFrame, epsilon: float = S.EPSILON) -> DataFrame:
    now = F.col("frequency")
    before = F.lag("frequency").over(_ordered())
    return df.withColumn("growth_rate", growth(now, before, epsilon))


def velocity_acceleration(df: DataFrame) -> DataFrame:
    """Velocity is the growth rate; acceleration its change since the previous bucket."""
    rate = F.col("growth_rate")
    return df.withColumns(
        {"velocity": rate, "acceleration": rate - F.lag("growth_rate").over(_ordered())}
    )


def _score(value: Column, mean: Column, sigma: Column) -> Column:
    flat = sigma.isNull() | (sigma < S.FLAT_SIGMA) | value.isNull()
    return F.when(flat, F.lit(0.0)).otherwise(F.round((value - mean) / sigma, S.SCORE_DIGITS))


def zscore(df: DataFrame) -> DataFrame:
    """Growth rate against its own series: sample deviation, 0 for flat or short series."""
    rate = F.col("growth_rate")
    mean, sigma = F.avg(rate).over(_series()), F.stddev_samp(rate).over(_series())
    return df.withColumn("z_score", _score(rate, mean, sigma))


def is_outlier(z: Column, threshold: float = S.ANOMALY_Z) -> Column:
    """Two-tailed test of a z-score."""
    return F.abs(z) > threshold


def flag_anomalies(df: DataFrame, threshold: float = S.ANOMALY_Z) -> DataFrame:
    z = F.col("z_score")
    return df.withColumns(
        {
            "is_anomaly": F.when(is_outlier(z, threshold), F.lit(1)).otherwise(F.lit(0)),
            "spike_direction": F.when(z > threshold, F.lit("up"))
            .when(z < -threshold, F.lit("down"))
            .otherwise(F.lit("none")),
        }
    )


def trend_label(
    viral_z: float = S.VIRAL_Z,
    emerging_z: float = S.EMERGING_Z,
    declining: float = S.DECLINING_GROWTH,
    emerging_window: str | None = None,
) -> Column:
    """viral, emerging, declining or stable; the first rule that holds.

    Emerging holds on any window, or on one only when `emerging_window` names it.
    """
    z, window = F.col("z_score"), F.col("window")
    emerging = z > emerging_z
    if emerging_window is not None:
        emerging = emerging & (window == emerging_window)
    return (
        F.when((z > viral_z) & (window == S.VIRAL_WINDOW), F.lit("viral"))
        .when(emerging, F.lit("emerging"))
        .when(F.col("growth_rate") < declining, F.lit("declining"))
        .otherwise(F.lit("stable"))
    )


def classify(df: DataFrame, **rules) -> DataFrame:
    return df.withColumn("trend_label", trend_label(**rules))


def detect_trends(
    frequency: DataFrame,
    epsilon: float = S.EPSILON,
    threshold: float = S.ANOMALY_Z,
    **rules,
) -> DataFrame:
    """The full trend table of a frequency table.

    Growth and the previous growth come from lags 1 and 2 of the same ordered window, mean and
    deviation from the unordered one on the same keys: one exchange and one sort in all. Columns
    beyond the frequency table's are kept, last.
    """
    now = F.col("frequency")
    lagged = frequency.withColumns(
        {"_p1": F.lag(now, 1).over(_ordered()), "_p2": F.lag(now, 2).over(_ordered())}
    )
    rate = growth(now, F.col("_p1"), epsilon)
    rated = lagged.withColumns(
        {
            "growth_rate": rate,
            "velocity": rate,
            "acceleration": rate - growth(F.col("_p1"), F.col("_p2"), epsilon),
        }
    ).drop("_p1", "_p2")
    labelled = classify(flag_anomalies(zscore(rated), threshold), **rules)
    own = schemas.names(schemas.TREND)
    return labelled.select(*own, *[c for c in frequency.columns if c not in own])


def trends_of_events(events: DataFrame, labels=S.WINDOWS, slide_fraction: float = 1.0, **params) -> DataFrame:
    """Trend table straight from keyword events.

    Signals are derived on each half of the frequency table before the union, while the rows of
    a series still share a partition, so the window functions add no exchange.
    """
    return trends_of_counts(freq.base_counts(events, freq.grain(labels, slide_fraction)), labels, slide_fraction, **params)


def trends_of_counts(counts: DataFrame, labels=S.WINDOWS, slide_fraction: float = 1.0, **params) -> DataFrame:
    """The same from base counts, for readers that store them and go through them more than once."""
    halves = freq.halves_of_counts(counts, labels, slide_fraction)
    global_half, source_half = (detect_trends(half, **params) for half in halves)
    return global_half.unionByName(source_half)


def global_trends_of_events(events: DataFrame, labels=S.WINDOWS, slide_fraction: float = 1.0, **params) -> DataFrame:
    """Only the rows over all sources, for readers that need no others."""
    return detect_trends(freq.all_windows(events, labels, slide_fraction), **params)


def trend_summary(trends: DataFrame) -> DataFrame:
    """Row, anomaly and viral counts in one pass."""
    return trends.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("is_anomaly") == 1).alias("anomalies"),
        F.count_if(F.col("trend_label") == "viral").alias("viral"),
    )


def growth_rate_clamped(df: DataFrame, epsilon: float = S.EPSILON) -> DataFrame:
    """Growth with both counts clamped to 0 or more."""
    def clamped(count: Column) -> Column:
        return F.when(count.isNotNull(), F.greatest(count, F.lit(0)))

    before = F.lag("frequency").over(_ordered())
    return df.withColumn("growth_rate", growth(clamped(F.col("frequency")), clamped(before), epsilon))


def peer_zscore(df: DataFrame, value: str = "growth_rate", output: str = "peer_z", salts: int = 16) -> DataFrame:
    """Score of each keyword against the others in its bucket: population deviation.

    A bucket may hold every keyword there is, so its statistics are aggregated (combined before
    the shuffle) and joined back on the bucket and a salt: each bucket's one row is there `salts` times, and its keywords
    are dealt over as many tasks whether or not Spark splits them itself. The statistics are written first: while they are
    small, Spark broadcasts them and the series stay where they are. Reads its input twice.
    """
    bucket = ["window", "source", "window_start"]
    stats = df.groupBy(*bucket).agg(
        F.avg(value).alias("_mean"), F.stddev_pop(value).alias("_sigma"), F.count(value).alias("_n")
    )
    stats = materialize(stats, "peer-statistics")
    usable = F.when(F.col("_n") >= 2, F.col("_sigma"))
    score = _score(F.col(value), F.col("_mean"), usable)
    dealt = df.withColumn("_salt", F.pmod(F.xxhash64("keyword"), F.lit(salts)).cast("int"))
    spread = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    joined = dealt.join(spread, [*bucket, "_salt"])
    return joined.withColumn(output, score).drop("_mean", "_sigma", "_n", "_salt")


def acceleration_zero_first(df: DataFrame) -> DataFrame:
    """Change of the growth rate, 0 at the first growth value of a series; input without nulls
    in between."""
    change = F.col("growth_rate") - F.lag("growth_rate").over(_ordered())
    return df.withColumn("acceleration", F.coalesce(change, F.lit(0.0)))


def source_diversity(events: DataFrame, exact: bool = True) -> DataFrame:
    """Distinct non-blank sources per keyword, spaces around their names ignored."""
    # Blank names are dropped before trimming; a name of spaces only still counts as one.
    name = F.when(F.col("source") != "", F.trim("source"))
    count = F.count_distinct if exact else F.approx_count_distinct
    return events.groupBy("keyword").agg(count(name).alias("source_diversity"))


def source_sketches(events: DataFrame, accuracy: int = 12) -> DataFrame:
    """(keyword, sources): a sketch of the distinct non-blank sources of each keyword, for one snapshot.

    A sketch has a bounded size whatever the number of sources, and sketches of several snapshots merge: a new day needs
    its own events only. Spaces around names are ignored.
    """
    name = F.when(F.col("source") != "", F.trim("source"))
    return events.groupBy("keyword").agg(F.hll_sketch_agg(name, F.lit(accuracy)).alias("sources"))


def merged_diversity(sketches: DataFrame) -> DataFrame:
    """(keyword, source_diversity) over all snapshots' sketches: exact for few sources, else within a relative
    deviation of 1.04 / sqrt(2 ** accuracy), 1.6 % at 12."""
    merged = sketches.groupBy("keyword").agg(F.hll_union_agg("sources").alias("sources"))
    return merged.select("keyword", F.hll_sketch_estimate("sources").alias("source_diversity"))
