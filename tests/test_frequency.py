from __future__ import annotations

from functools import reduce

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tests.helpers import hour
from tidemark.functions import times
from tidemark.operators import frequency
from tidemark.sources import bindings as B

EVENT = "keyword string, timestamp timestamp, source string"


def same(a, b):
    columns = sorted(a.columns)
    assert sorted(b.columns) == columns
    a, b = a.select(*columns), b.select(*columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("labels,fraction", [(["1h", "6h", "24h", "7d"], 1.0), (["6h", "24h"], 0.25), (["90m"], 0.4)])
def test_roll_up_equals_direct_counts(spark, sf, labels, fraction):
    events = B.event_mentions(spark, sf)
    direct = []
    for label in labels:
        length, slide = (f"{n} seconds" for n in (times.window_seconds(label), times.slide_seconds(label, fraction)))
        counted = events.groupBy("keyword", F.window("timestamp", length, slide).alias("w")).agg(F.count("*").alias("frequency"))
        named = counted.select("keyword", "w.start", "w.end", "frequency", F.lit(label)).toDF(*frequency.COLUMNS[:-1])
        direct.append(named)
        same(frequency.window_frequency(events, label, fraction), named)
    same(frequency.all_windows(events, labels, fraction).drop("source"), reduce(DataFrame.unionByName, direct))


def test_sources_add_up(spark, sf):
    table = frequency.keyword_frequency(B.event_mentions(spark, sf))
    keys = ["keyword", "window", "window_start"]
    whole = table.filter(F.col("source") == "__all__").select(*keys, "frequency")
    parts = table.filter(F.col("source") != "__all__").groupBy(*keys).agg(F.sum("frequency").alias("frequency"))
    same(whole, parts)


def test_windows_add_up(spark, sf):
    table = frequency.all_windows(B.event_mentions(spark, sf))
    sums = table.groupBy("keyword", "window").agg(F.sum("frequency").alias("n"))
    assert sums.groupBy("keyword").agg(F.count_distinct("n").alias("d")).filter("d > 1").isEmpty()


def test_null_times_and_min_frequency(spark):
    rows = [("a", hour(0), "x"), ("a", hour(0), "x"), ("a", None, "x"), ("b", hour(1), None)]
    events = spark.createDataFrame(rows, EVENT)
    table = frequency.keyword_frequency(events, ["1h"])
    assert table.agg(F.sum("frequency")).first()[0] == 6
    kept = frequency.keyword_frequency(events, ["1h"], min_frequency=2)
    assert {r["keyword"] for r in kept.collect()} == {"a"}


def test_source_counts(spark):
    rows = [("a", hour(0), "x"), ("a", hour(0), "y"), ("a", hour(3), "z"), ("a", hour(7), "x")]
    events = spark.createDataFrame(rows, EVENT)
    got = {
        (r["window"], r["window_start"].hour): (r["frequency"], r["sources"])
        for r in frequency.with_source_counts(events, ["1h", "6h"]).collect()
    }
    assert got == {("1h", 0): (2, 2), ("1h", 3): (1, 1), ("1h", 7): (1, 1), ("6h", 0): (3, 3), ("6h", 6): (1, 1)}


def test_fine_slides_and_quiet_windows(spark):
    rows = [("a", hour(0), "x"), ("a", hour(0), "x"), ("a", hour(5), "x"), ("b", hour(1), "x")]
    events = spark.createDataFrame(rows, EVENT)
    for fraction in (0.002, 0.0005):
        table = frequency.all_windows(events.filter("keyword = 'b'"), ["24h"], fraction)
        assert table.count() == pytest.approx(1 / fraction, rel=0.01)
    kept = frequency.keyword_frequency(events, ["1h"], min_frequency=2)
    assert sorted((r["frequency"], r["source"]) for r in kept.collect()) == [(1, "__all__"), (1, "x"), (2, "__all__"), (2, "x")]


def test_tumbling_roll_up_is_compiled_and_dealt_finely(spark):
    """No function over an array runs per row, and a partition is a small part of the rows; no bucket is in no window."""
    rows = [("a", 3600 * k, 1 + k % 3) for k in range(-30, 60)] + [("a", None, 5), (None, 7200, 2)]
    counts = spark.createDataFrame(rows, "keyword string, bucket bigint, frequency bigint")
    labels = ["1h", "6h", "7d"]
    rolled = frequency.roll_up(counts, labels, 1.0, ["keyword"])
    text = rolled._jdf.queryExecution().executedPlan().toString()
    assert "lambda" not in text
    parts = int(spark.conf.get("spark.sql.shuffle.partitions")) * frequency.FINER
    assert "hashpartitioning(keyword#" in text and f", {parts}), REPARTITION_BY_NUM" in text
    want = {}
    for keyword, bucket, n in rows:
        for i, size in enumerate((3600, 21600, 604800)) if bucket is not None else ():
            key = (keyword, i, bucket - bucket % size)
            want[key] = want.get(key, 0) + n
    assert {(r.keyword, r.label, r.start): r.frequency for r in rolled.collect()} == want
    assert frequency.roll_up(counts, labels, 1.0, ["keyword"], 3).rdd.getNumPartitions() == 3
