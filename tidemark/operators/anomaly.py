"""Outliers in the feature table: z-score, interquartile range, isolation forest."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import settings as S
from tidemark.functions.numbers import finite
from tidemark.functions.quantiles import exact_quantiles
from tidemark.operators import forest
from tidemark.session import materialize

METHODS = ("isolation_forest", "zscore", "iqr")
REPORT = (
    "keyword", "anomaly_score", "trend_label", "freq_1h", "freq_6h", "growth_rate_1h", "z_score_1h",
)


def _any(flags: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, flags)


def impute(features: DataFrame, columns: Sequence[str] = S.ANOMALY_FEATURES) -> DataFrame:
    """Feature columns as doubles without gaps: absent columns are 0, other gaps the median of
    the finite values (0 if there are none). Reads the input several times."""
    present = [c for c in columns if c in features.columns]
    gaps = [F.count_if(finite(F.col(c)).isNull()).alias(c) for c in present]
    count = features.agg(*gaps).first() if gaps else {}
    medians = exact_quantiles(features, [c for c in present if count[c]], [0.5])
    filled = {
        c: F.coalesce(finite(F.col(c)), F.lit(medians.get(c, [None])[0] or 0.0)) if c in present else F.lit(0.0)
        for c in columns
    }
    return features.withColumns(filled)


def _moments(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column: one pass, one row."""
    facts = [f(c).alias(f"{k}_{c}") for c in columns for k, f in (("m", F.avg), ("s", F.stddev_pop))]
    row = df.agg(*facts).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"]) for c in columns}


def _z(column: str, mean: float | None, sigma: float | None) -> Column:
    if sigma is None or sigma < S.FLAT_SIGMA:
        return F.lit(0.0)
    return F.round((F.col(column) - F.lit(mean)) / F.lit(sigma), S.SCORE_DIGITS)


def zscore_outlier(
    df: DataFrame, threshold: float = S.ANOMALY_Z, columns: Sequence[str] = S.ANOMALY_FEATURES
) -> Column:
    """Any feature further than the threshold from its mean over the whole table."""
    moments = _moments(df, columns)
    return _any([F.abs(_z(c, *moments[c])) > threshold for c in columns])


def iqr_outlier(
    df: DataFrame, columns: Sequence[str] = S.ANOMALY_FEATURES, reach: float = 1.5
) -> Column:
    """Any feature outside the fences around its quartiles."""
    flags = [F.lit(False)]
    for c, (q1, q3) in exact_quantiles(df, columns, [0.25, 0.75]).items():
        if q1 is not None:
            span = reach * (q3 - q1)
            flags += [F.col(c) < F.lit(q1 - span), F.col(c) > F.lit(q3 + span)]
    return _any(flags)


def statistical_score(df: DataFrame, columns: Sequence[str] = S.ANOMALY_FEATURES) -> Column:
    """The largest absolute z-score of all features."""
    moments = _moments(df, columns)
    return F.greatest(*[F.abs(_z(c, *moments[c])) for c in columns])


def _scored(
    filled: DataFrame, columns: Sequence[str], method: str, threshold: float, contamination: float,
    n_trees: int, seed: int, max_samples: int,
) -> DataFrame:
    """is_anomaly and anomaly_score beside columns without gaps, row by row."""
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}; one of {', '.join(METHODS)}")
    if method == "isolation_forest":
        return forest.detect(filled, columns, n_trees, contamination, seed, max_samples)
    flag = zscore_outlier(filled, threshold, columns) if method == "zscore" else iqr_outlier(filled, columns)
    return filled.withColumns({"is_anomaly": flag, "anomaly_score": statistical_score(filled, columns)})


def detect(
    features: DataFrame,
    method: str = "isolation_forest",
    threshold: float = S.ANOMALY_Z,
    contamination: float = 0.05,
    n_trees: int = 100,
    seed: int = 42,
    columns: Sequence[str] = S.ANOMALY_FEATURES,
    max_samples: int = forest.SAMPLE,
) -> DataFrame:
    """(keyword, timestamp, imputed features, is_anomaly, anomaly_score) of a feature table.

    The narrow input is written once; every statistic is a pass over that table and comes back
    as a handful of numbers that the final projection uses as literals.
    """
    kept = [c for c in columns if c in features.columns]
    narrow = materialize(features.select("keyword", "timestamp", *kept), "anomaly-input")
    return _scored(impute(narrow, columns), columns, method, threshold, contamination, n_trees, seed, max_samples)


def enrich(
    features: DataFrame,
    method: str = "isolation_forest",
    threshold: float = S.ANOMALY_Z,
    contamination: float = 0.05,
    n_trees: int = 100,
    seed: int = 42,
    columns: Sequence[str] = S.ANOMALY_FEATURES,
    max_samples: int = forest.SAMPLE,
) -> DataFrame:
    """The feature table with boolean `is_anomaly` and `anomaly_score`; gaps stay as they were.

    Each row carries its own imputed values while it is scored, so there is no join: every row comes
    back once, whatever its keyword and time, null and repeated ones too.
    """
    stored = materialize(features.drop("is_anomaly", "anomaly_score"), "features")
    beside = {c: f"_imputed_{c}" for c in columns}
    present = [c for c in columns if c in stored.columns]
    doubled = stored.withColumns({beside[c]: F.col(c) for c in present})
    filled = impute(doubled, list(beside.values()))
    scored = _scored(filled, list(beside.values()), method, threshold, contamination, n_trees, seed, max_samples)
    return scored.drop(*beside.values())


def report(enriched: DataFrame) -> DataFrame:
    """Anomalous rows, most anomalous first."""
    shown = [c for c in REPORT if c in enriched.columns]
    return (
        enriched.filter("is_anomaly")
        .orderBy(F.desc("anomaly_score"), "keyword", "timestamp")
        .select(*shown)
    )
