"""Hourly forecasts of keyword frequency: linear extrapolation and a seasonal regression."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark import settings as S
from tidemark.functions.numbers import clamp
from tidemark.operators.features import features_of_events
from tidemark.operators.normalize import align

HOUR = "INTERVAL 1 HOUR"
#: Days whose points share a buffer.
CHUNK = 30


def candidates(features: DataFrame, n: int = S.TOP_FORECAST_KEYWORDS) -> DataFrame:
    """The n keywords with the most hourly mentions; equal sums in keyword order."""
    totals = features.groupBy("keyword").agg(F.sum("freq_1h").alias("total_freq"))
    return totals.orderBy(F.desc("total_freq"), "keyword").limit(n)


def _points(features: DataFrame) -> DataFrame:
    """Hourly points of every keyword: (keyword, ts, y, trend_label)."""
    return features.filter(F.col("timestamp").isNotNull()).select(
        "keyword",
        F.col("timestamp").alias("ts"),
        F.col("freq_1h").cast("double").alias("y"),
        "trend_label",
    )


def history(features: DataFrame, n: int | None = S.TOP_FORECAST_KEYWORDS) -> DataFrame:
    """The points of the n candidates, or of all keywords if n is None."""
    if n is None:
        return _points(features)
    # No hint: a limit of n rows has a known size, and Spark broadcasts it while that is small.
    top = candidates(features, n).select("keyword")
    return _points(features).join(top, "keyword", "left_semi")


def _steps(hours: int) -> Column:
    return F.explode(F.sequence(F.lit(1), F.lit(hours))).alias("step")


def _ends(points: DataFrame, recent: int) -> DataFrame:
    """One row a series: its latest `recent` points' ends and mean step, its last known label, its total.

    The latest points gather in a buffer that is cut to `recent` for every stretch of CHUNK days and again over the
    stretches, so a buffer holds no more points than a stretch has hours, or `recent` a stretch.
    """
    stretch = F.floor(F.unix_seconds("ts") / (CHUNK * 86400)).alias("stretch")
    newest = lambda buffer: F.slice(F.sort_array(buffer, asc=False), 1, recent)
    known = F.when(F.col("trend_label").isNotNull(), F.col("ts"))
    parts = points.groupBy("keyword", stretch).agg(
        newest(F.collect_list(F.struct("ts", "y"))).alias("points"),
        F.max(F.when(known.isNotNull(), F.struct(known.alias("ts"), "trend_label"))).alias("label"),
        F.sum("y").alias("total"),
    )
    series = parts.groupBy("keyword").agg(
        newest(F.flatten(F.collect_list("points"))).alias("points"), F.max("label").alias("label"), F.sum("total").alias("total")
    )
    last, first, count = F.col("points")[0], F.element_at("points", -1), F.size("points")
    return series.select(
        "keyword", last["ts"].alias("last_ts"), last["y"].alias("last_y"),
        F.when(count > 1, (last["y"] - first["y"]) / (count - 1)).otherwise(F.lit(0.0)).alias("delta"),
        F.coalesce("label.trend_label", F.lit("stable")).alias("trend_class"), "total",
    )


def linear(
    points: DataFrame,
    n: int | None = None,
    hours: int = S.FORECAST_HOURS,
    recent: int = S.FORECAST_HISTORY,
) -> DataFrame:
    """Last value plus the mean step of the latest points, with a 15 % band of at least 1, for
    the n keywords with the most mentions or for all.

    The mean of consecutive differences is (last - first) / (points - 1), so a series collapses
    to one row before the forecast hours are generated. Everything is kept by keyword: a feature
    table that already is needs no further exchange, and ranking takes no join.
    """
    ends = _ends(points, recent)
    if n is not None:
        ends = ends.orderBy(F.desc("total"), "keyword").limit(n)
    yhat = F.greatest(F.col("last_y") + F.col("delta") * F.col("step"), F.lit(0.0))
    band = F.greatest(F.col("yhat") * 0.15, F.lit(1.0))
    return (
        ends.select("keyword", "trend_class", "last_ts", "last_y", "delta", _steps(hours))
        .withColumn("yhat", yhat)
        .select(
            "keyword",
            "trend_class",
            (F.col("last_ts") + F.col("step") * F.expr(HOUR)).alias("predicted_at"),
            "yhat",
            F.greatest(F.col("yhat") - band, F.lit(0.0)).alias("yhat_lower"),
            (F.col("yhat") + band).alias("yhat_upper"),
        )
    )


def predictions(forecast: DataFrame, hours: int = S.FORECAST_HOURS) -> DataFrame:
    """Forecast rows in the prediction layout.

    Confidence is 1 minus the mean relative band width of the keyword's `hours` rows, within 0.1
    and 0.95.
    """
    width = F.greatest(F.col("yhat_upper") - F.col("yhat_lower"), F.lit(0.0))
    relative = width / F.greatest(F.abs("yhat"), F.lit(1.0))
    mean = F.avg(relative).over(Window.partitionBy("keyword"))

    def bounded(name: str) -> Column:
        return F.greatest(F.col(name), F.lit(0.0))

    shaped = forecast.withColumns(
        {
            "confidence": clamp(F.lit(1.0) - mean, 0.1, 0.95),
            "forecast_period": F.lit(f"{hours}h"),
            "predicted_freq": bounded("yhat"),
            "lower_bound": bounded("yhat_lower"),
            "upper_bound": bounded("yhat_upper"),
        }
    )
    return align(shaped, schemas.PREDICTION)


def forecast_linear(
    features: DataFrame, n: int | None = S.TOP_FORECAST_KEYWORDS, hours: int = S.FORECAST_HOURS
) -> DataFrame:
    return predictions(linear(_points(features), n, hours), hours)


def forecast_of_events(events: DataFrame, n: int = S.TOP_FORECAST_KEYWORDS, hours: int = S.FORECAST_HOURS) -> DataFrame:
    """The same straight from keyword events: features are derived for the n candidates only."""
    return forecast_linear(features_of_events(events, top=n), n, hours)



# --- seasonal regression -------------------------------------------------------------------

# Order of the Fourier terms per season, ridge strength, width of the band.
SEASONS = (("day", 24.0, 4), ("week", 168.0, 3))
RIDGE = 1.0
BAND_Z = 1.2815515655446004  # 80 % interval
MODEL = "keyword string, trend_class string, last_ts timestamp, scale_hours double, coef array<double>, sigma double"


def _angles() -> list[tuple[float, int]]:
    return [(period, k) for _, period, order in SEASONS for k in range(1, order + 1)]


def _design(hour: np.ndarray, scale: float) -> np.ndarray:
    """Regressors of hours relative to the last observation: level, trend, seasons."""
    parts = [np.ones_like(hour), hour / scale]
    for period, k in _angles():
        angle = 2 * math.pi * k * hour / period
        parts += [np.sin(angle), np.cos(angle)]
    return np.column_stack(parts)


def fit_seasonal(past: DataFrame) -> DataFrame:
    """Model table: ridge coefficients of trend, daily and weekly terms per keyword.

    One group is one keyword's hourly series, at most one row per hour of the calendar.
    """

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("ts")
        last = pdf["ts"].iloc[-1]
        hour = (pdf["ts"] - last).dt.total_seconds().to_numpy() / 3600.0
        scale = max(float(-hour.min()), 1.0)
        x, y = _design(hour, scale), pdf["y"].to_numpy(dtype=np.float64)
        penalty = RIDGE * np.eye(x.shape[1])
        penalty[0, 0] = 1e-6
        coef = np.linalg.solve(x.T @ x + penalty, x.T @ y)
        sigma = float(np.std(y - x @ coef))
        labels = pdf["trend_label"].dropna()
        return pd.DataFrame(
            {
                "keyword": [pdf["keyword"].iloc[0]],
                "trend_class": [labels.iloc[-1] if len(labels) else "stable"],
                "last_ts": [last],
                "scale_hours": [scale],
                "coef": [coef.tolist()],
                "sigma": [sigma],
            }
        )

    return past.groupBy("keyword").applyInPandas(fit, MODEL)


def _terms(hour: Column, scale: Column) -> list[Column]:
    """The regressors of `_design` as expressions."""
    terms = [F.lit(1.0), hour / scale]
    for period, k in _angles():
        angle = hour * (2 * math.pi * k / period)
        terms += [F.sin(angle), F.cos(angle)]
    return terms


def _fitted(terms: list[Column]) -> Column:
    return sum((F.get("coef", F.lit(i)) * t for i, t in enumerate(terms)), F.lit(0.0))


def check_seasonal(models: DataFrame, past: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Whether the rows of a model table, fitted now or long ago, are the fits of these series.

    Coefficients solve the ridge problem where its gradient vanishes; they and the deviation are held
    against sums over the points, relative to the sum of the values.
    """
    hour = (F.unix_seconds("ts") - F.unix_seconds("last_ts")) / 3600.0
    met = past.select("keyword", "ts", "y").join(models, "keyword").withColumn("hour", hour)
    terms = _terms(F.col("hour"), F.col("scale_hours"))
    rest = met.withColumns({"term": F.array(*terms), "rest": F.col("y") - _fitted(terms)})
    penalty = [1e-6] + [RIDGE] * (len(terms) - 1)
    slopes = [
        F.abs(F.sum(F.get("term", F.lit(i)) * F.col("rest")) - F.any_value(F.get("coef", F.lit(i))) * ridge)
        for i, ridge in enumerate(penalty)
    ]
    size = F.lit(tolerance) * (F.sum(F.abs("y")) + 1)
    spread = F.abs(F.stddev_pop("rest") - F.any_value("sigma"))
    return rest.groupBy("keyword", "trend_class", "last_ts", "scale_hours").agg(
        F.count("*").alias("points"),
        (F.greatest(*slopes) <= size).alias("solved"),
        (spread <= size).alias("spread_agrees"),
    )


def predict_seasonal(models: DataFrame, hours: int = S.FORECAST_HOURS) -> DataFrame:
    """Forecast rows of a model table, fitted now or read back."""
    step = F.col("step").cast("double")
    yhat = _fitted(_terms(step, F.col("scale_hours")))
    band = F.col("sigma") * BAND_Z
    return models.select("*", _steps(hours)).withColumn("yhat", yhat).select(
        "keyword",
        "trend_class",
        (F.col("last_ts") + F.col("step") * F.expr(HOUR)).alias("predicted_at"),
        "yhat",
        (F.col("yhat") - band).alias("yhat_lower"),
        (F.col("yhat") + band).alias("yhat_upper"),
    )


def forecast_seasonal(
    features: DataFrame, n: int | None = S.TOP_FORECAST_KEYWORDS, hours: int = S.FORECAST_HOURS
) -> DataFrame:
    return predictions(predict_seasonal(fit_seasonal(history(features, n)), hours), hours)
