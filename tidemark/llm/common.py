"""What several operators share: texts out of Arrow, tables, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialize


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, base: str) -> str:
    """A column name that the table doesn't have."""
    taken = {name.lower() for name in df.columns}
    while base in taken:
        base = "_" + base
    return base


def texts(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text, a few rows at a time; null counts as empty."""
    for at in range(0, len(column), 256):
        for value in column.slice(at, 256).cast(pa.large_binary()).to_pylist():
            yield value or b""


def lower_words(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.lower().split()


def starts_and_ends(words: list[bytes]) -> tuple[bytes, list[int], list[int]]:
    """The words joined by single spaces, and where each begins and ends there."""
    joined = b" ".join(words)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    return joined, [0, *(spaces + 1).tolist()], [*spaces.tolist(), len(joined)]


def components(edges: DataFrame, name: str = "component") -> DataFrame:
    """(node, component): the smallest node that each node of the edges (a, b) reaches.

    Each round takes the smallest label next to a node, then the label of that label, so labels
    cross a chain in a logarithmic number of rounds. Minima combine before their shuffle; the
    joins are plain ones, whose hot keys Spark splits. Rounds are cut by written tables, and only
    the number of changed labels reaches the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.filter("a != b").distinct(), f"{name}-edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("label")))
    while True:
        beside = both.join(labels.select(F.col("a").alias("b"), "label"), "b")
        beside = beside.groupBy("a").agg(F.min("label").alias("beside"))
        hopped = labels.join(beside, "a").select("a", F.col("label").alias("old"), F.least("label", "beside").alias("label"))
        hopped = materialize(hopped, f"{name}-hop")
        above = hopped.select(F.col("a").alias("label"), F.col("label").alias("above"))
        labels = materialize(hopped.join(above, "label").select("a", "old", F.col("above").alias("label")), f"{name}-jump")
        if labels.filter("label != old").isEmpty():
            return labels.select(F.col("a").alias("node"), F.col("label").alias("component"))
        labels = labels.select("a", "label")
