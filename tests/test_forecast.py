from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import RISING, hour
from tidemark import schemas
from tidemark.operators import forecast

POINT = "keyword string, timestamp timestamp, freq_1h bigint, trend_label string"


def points(spark, values, keyword="flu", labels=None):
    rows = [
        (keyword, hour(i), int(v), labels[i] if labels else "viral") for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, POINT)


def test_linear_by_hand(spark):
    rows = forecast.forecast_linear(points(spark, RISING)).orderBy("predicted_at").collect()
    assert len(rows) == 24
    first = rows[0]
    assert first["predicted_at"] == hour(18)
    assert first["predicted_freq"] == pytest.approx(96 + 87 / 11)
    assert first["upper_bound"] - first["predicted_freq"] == pytest.approx(0.15 * (96 + 87 / 11))
    assert (first["forecast_period"], first["trend_class"]) == ("24h", "viral")
    assert first["confidence"] == pytest.approx(0.7, abs=1e-6)


def test_falling_series_stops_at_zero(spark):
    rows = forecast.forecast_linear(points(spark, [30, 20, 10])).orderBy("predicted_at").collect()
    assert rows[-1]["predicted_freq"] == 0.0 and rows[-1]["lower_bound"] == 0.0
    assert rows[-1]["upper_bound"] == 1.0
    assert 0.1 <= rows[0]["confidence"] <= 0.95


def test_single_point_is_flat(spark):
    rows = forecast.forecast_linear(points(spark, [8])).collect()
    assert {r["predicted_freq"] for r in rows} == {8.0}


def test_label_is_last_known(spark):
    known = points(spark, [1, 2, 3], labels=["viral", "emerging", None])
    none = points(spark, [1, 2], "quiet", labels=[None, None])
    both = forecast.forecast_linear(known.union(none))
    got = {r["keyword"]: r["trend_class"] for r in both.collect()}
    assert got == {"flu": "emerging", "quiet": "stable"}


def test_candidates_rank_and_ties(spark):
    df = points(spark, [5, 5], "b").union(points(spark, [10], "a")).union(points(spark, [1], "c"))
    assert [r["keyword"] for r in forecast.candidates(df, 2).collect()] == ["a", "b"]
    assert {r["keyword"] for r in forecast.forecast_linear(df, n=2).collect()} == {"a", "b"}


def test_schema(spark):
    made = forecast.forecast_linear(points(spark, RISING))
    assert [(f.name, f.dataType) for f in made.schema] == [
        (f.name, f.dataType) for f in schemas.struct(schemas.PREDICTION)
    ]


def test_seasonal_follows_a_daily_cycle(spark):
    values = [100 + 40 * math.sin(2 * math.pi * i / 24) for i in range(24 * 21)]
    df = points(spark, np.round(values))
    made = forecast.forecast_seasonal(df).orderBy("predicted_at").collect()
    want = [100 + 40 * math.sin(2 * math.pi * i / 24) for i in range(24 * 21, 24 * 22)]
    assert np.abs(np.array([r["predicted_freq"] for r in made]) - want).max() < 4
    assert all(r["lower_bound"] <= r["predicted_freq"] <= r["upper_bound"] for r in made)


def test_model_table_gives_the_same_forecast(spark, tmp_path):
    past = forecast.history(points(spark, RISING))
    models = forecast.fit_seasonal(past)
    models.write.parquet(str(tmp_path / "models"))
    stored = spark.read.parquet(str(tmp_path / "models"))
    a = forecast.predict_seasonal(models).orderBy("predicted_at").toPandas()
    b = forecast.predict_seasonal(stored).orderBy("predicted_at").toPandas()
    assert np.allclose(a["yhat"], b["yhat"])
    # the stored coefficients reproduce the design used for fitting
    row = stored.first()
    x = forecast._design(np.arange(1.0, 25.0), row["scale_hours"])
    assert np.allclose(x @ np.array(row["coef"]), b["yhat"])


def test_bounds_hold(spark, sf):
    from tidemark.plans.queries import predictions

    bad = predictions(spark, sf).filter(
        (F.col("lower_bound") > F.col("predicted_freq"))
        | (F.col("predicted_freq") > F.col("upper_bound"))
        | ~F.col("confidence").between(0.0999, 0.9501)
    )
    assert bad.isEmpty()
