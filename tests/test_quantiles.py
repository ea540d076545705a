from __future__ import annotations

import numpy as np
import pytest

from tidemark.functions import quantiles

PROBS = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]


def samples():
    rng = np.random.RandomState(5)
    return {
        "normal": rng.normal(size=5001),
        "ties": rng.randint(0, 4, size=4000).astype(float),
        "heavy": np.concatenate([rng.normal(size=3000), [1e300, -1e300, 1e18]]),
        "pair": np.array([1.0, 2.0]),
        "one": np.array([7.0]),
        "close": 1.0 + rng.randint(0, 50, size=999) * 2.0**-50,
    }


@pytest.mark.parametrize("name", list(samples()))
def test_equal_to_numpy(spark, name):
    values = samples()[name]
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(5)
    got = quantiles.exact_quantiles(df, ["v"], PROBS)["v"]
    want = [float(np.percentile(values, 100 * p)) for p in PROBS]
    assert got == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_few_bins_still_exact(spark, monkeypatch):
    monkeypatch.setattr(quantiles, "BINS", 4)
    values = samples()["normal"][:800]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = quantiles.exact_quantiles(df, ["v"], [0.5])["v"][0]
    assert got == pytest.approx(float(np.median(values)))


def test_ranks_outside_the_sketch(spark, monkeypatch):
    """Brackets that miss their ranks widen to the side where the rank lies."""
    monkeypatch.setattr(quantiles, "REACH", -0.3)
    values = samples()["normal"][:800]
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    got = quantiles.exact_quantiles(df, ["v"], PROBS)["v"]
    assert got == pytest.approx([float(np.percentile(values, 100 * p)) for p in PROBS], rel=1e-12, abs=1e-12)


def test_gaps_and_empty_columns(spark):
    rows = [(1.0, None), (float("nan"), None), (float("inf"), None), (None, None), (3.0, None)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert quantiles.exact_quantiles(df, ["a", "b"], [0.5]) == {"a": [2.0], "b": [None]}


@pytest.mark.parametrize("name", list(samples()))
def test_two_reads(spark, name):
    values = samples()[name]
    read = spark.sparkContext.accumulator(0)

    def passing(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(3).mapInArrow(passing, "v double")
    got = quantiles.exact_quantiles(df, ["v"], [0.25, 0.75])["v"]
    assert got == pytest.approx([float(np.percentile(values, q)) for q in (25, 75)], rel=1e-12, abs=1e-12)
    assert read.value <= 2 * len(values)
