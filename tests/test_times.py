from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions import times


@pytest.mark.parametrize("label,seconds", [("90s", 90), ("5m", 300), ("6h", 21600), ("7d", 604800), (" 1H ", 3600)])
def test_window_seconds(label, seconds):
    assert times.window_seconds(label) == seconds


@pytest.mark.parametrize("label", ["h", "6", "6w", "", "1.5h", "-1h", "0h"])
def test_bad_labels(label):
    with pytest.raises(ValueError):
        times.window_seconds(label)


def test_slide_seconds():
    assert times.slide_seconds("1h", 0.25) == 900
    assert times.slide_seconds("1s", 0.1) == 1


def test_parse_timestamp(spark):
    given = {
        "2024-01-10T10:00:00Z": datetime(2024, 1, 10, 10),
        "2024-01-10T10:00:00+02:00": datetime(2024, 1, 10, 8),
        "2024-01-10T10:00:00+02": datetime(2024, 1, 10, 8),
        "2024-01-10 10:00:00": datetime(2024, 1, 10, 10),
        "1704880800": datetime(2024, 1, 10, 10),
        "soon": None,
        "": None,
    }
    df = spark.createDataFrame([(k,) for k in given], "s string")
    got = {r["s"]: r["t"] for r in df.select("s", times.parse_timestamp(F.col("s")).alias("t")).collect()}
    assert got == given


def test_feed_dates(spark):
    kept = {
        "Wed, 10 Jan 2024 10:00:00 GMT": "2024-01-10T10:00:00Z",
        "Wed, 10 Jan 2024 10:00:00 +0200": "2024-01-10T10:00:00Z",
        "9 Jan 2024 10:00:00 -0500": "2024-01-09T10:00:00Z",
        "2024-01-10": "2024-01-10T00:00:00Z",
        "2024-01-10T10:00:00Z": "2024-01-10T10:00:00Z",
        "2024-01-10T10:00:00+02:00": "2024-01-10T10:00:00+02:00",
        "soon": "soon",
        "": "",
    }
    utc = kept | {
        "Wed, 10 Jan 2024 10:00:00 +0200": "2024-01-10T08:00:00Z",
        "9 Jan 2024 10:00:00 -0500": "2024-01-09T15:00:00Z",
        "2024-01-10T10:00:00+02:00": "2024-01-10T08:00:00Z",
    }
    df = spark.createDataFrame([(k,) for k in kept], "s string")
    for want, flag in ((kept, False), (utc, True)):
        shown = df.select("s", times.parse_feed_date(F.col("s"), flag).alias("t")).collect()
        assert {r["s"]: r["t"] for r in shown} == want


def test_bucket_start_before_epoch(spark):
    row = spark.range(1).select(times.bucket_start(F.lit(-1), 3600).alias("b")).first()
    assert row["b"] == -3600
