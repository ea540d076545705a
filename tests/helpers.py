"""Small frames for hand-worked cases."""

from __future__ import annotations

from datetime import datetime, timedelta

START = datetime(2024, 1, 1)

# Hourly mentions of a topic that takes off, and of a steady one.
RISING = [4, 5, 5, 6, 7, 8, 9, 12, 14, 18, 23, 29, 36, 45, 57, 68, 80, 96]
STEADY = [26, 25, 27, 26, 27, 28, 27, 29, 28, 27, 29, 28, 30, 29, 30, 31, 30, 31]

FREQ = (
    "keyword string, window string, window_start timestamp, window_end timestamp, "
    "frequency bigint, source string"
)


def hour(n: int) -> datetime:
    return START + timedelta(hours=n)


def series(spark, values, keyword="flu", window="1h", source="__all__", step=1):
    rows = [
        (keyword, window, hour(i * step), hour((i + 1) * step), int(v), source)
        for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, FREQ)


def column(df, name, *order):
    return [row[name] for row in df.orderBy(*(order or ("window_start",))).collect()]
