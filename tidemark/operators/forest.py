"""Isolation forest: trees grown on bounded samples, rows scored where they lie."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tidemark.functions.quantiles import exact_quantiles
from tidemark.session import materialize

SAMPLE = 256
NODES = "tree int, node int, feature int, cut double, low int, high int, path double"


def _uniform(*parts: Column) -> Column:
    """Repeatable number in [0, 1) of some columns."""
    return F.pmod(F.xxhash64(*parts), F.lit(2**40)) / float(2**40)


def average_path(n: int) -> float:
    """Mean depth of an unsuccessful search among n points: the usual path normaliser."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n


def samples(
    df: DataFrame, columns: Sequence[str], n_rows: int, n_trees: int, size: int, seed: int,
    keys: Sequence[str] = ("keyword", "timestamp"),
) -> DataFrame:
    """For every tree, `size` rows drawn without replacement (all rows when there are fewer).

    Membership hangs on hashes of the row's key, so a recomputed task draws the same rows. A
    first hash thins a large table to a pool about twice the rows all trees need; each pool row
    then draws its trees, and the rows with the smallest hashes of each tree stay.
    """
    key = [F.col(k) for k in keys]
    pool_share = min(1.0, 2.0 * n_trees * size / max(n_rows, 1))
    tree_share = min(1.0, 1.6 * size / max(n_rows * pool_share, 1))
    draw = F.filter(
        F.sequence(F.lit(0), F.lit(n_trees - 1)),
        lambda t: _uniform(F.lit(seed), t, *key) < tree_share,
    )
    drawn = (
        df.filter(_uniform(F.lit(seed), F.lit("pool"), *key) < pool_share)
        .select(*keys, *columns, F.explode(draw).alias("tree"))
        .withColumn("u", _uniform(F.lit(seed), F.col("tree"), *key))
    )
    order = Window.partitionBy("tree").orderBy("u", *keys)
    return drawn.withColumn("pos", F.row_number().over(order)).filter(F.col("pos") <= size)


def _grow(x: np.ndarray, rng: np.random.RandomState, limit: int) -> list[tuple]:
    """Nodes (node, feature, cut, low, high, path) of one tree; a leaf has feature -1."""
    nodes: list[tuple] = []
    todo = [(np.arange(len(x)), 0, 0)]
    used = 1
    while todo:
        rows, depth, node = todo.pop()
        values = x[rows]
        low, high = values.min(axis=0), values.max(axis=0)
        splittable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or len(splittable) == 0:
            nodes.append((node, -1, 0.0, node, node, depth + average_path(len(rows))))
            continue
        feature = int(rng.choice(splittable))
        cut = float(rng.uniform(low[feature], high[feature]))
        under = values[:, feature] <= cut
        nodes.append((node, feature, cut, used, used + 1, 0.0))
        todo += [(rows[under], depth + 1, used), (rows[~under], depth + 1, used + 1)]
        used += 2
    return nodes


def fit(sampled: DataFrame, columns: Sequence[str], size: int, seed: int) -> DataFrame:
    """Node table of the forest: one task input per tree, each at most `size` rows."""
    columns = list(columns)
    limit = math.ceil(math.log2(max(size, 2)))

    def tree(pdf: pd.DataFrame) -> pd.DataFrame:
        number = int(pdf["tree"].iloc[0])
        x = pdf.sort_values("pos")[columns].to_numpy(dtype=np.float64)
        grown = _grow(x, np.random.RandomState((seed * 1_000_003 + number) % 2**32), limit)
        out = pd.DataFrame(grown, columns=["node", "feature", "cut", "low", "high", "path"])
        out.insert(0, "tree", number)
        return out

    return sampled.groupBy("tree").applyInPandas(tree, NODES)


def scorer(nodes: DataFrame, columns: Sequence[str], size: int):
    """Column function that scores rows: 2 ** -(mean path / normal path), high is anomalous.

    The forest reaches the executors as a broadcast of at most (2 * size - 1) nodes per tree.
    """
    table = nodes.toPandas()
    table = table.sort_values(["tree", "node"])
    trees = [
        tuple(part[c].to_numpy() for c in ("feature", "cut", "low", "high", "path"))
        for _, part in table.groupby("tree")
    ]
    shared = nodes.sparkSession.sparkContext.broadcast(trees)
    depth = math.ceil(math.log2(max(size, 2)))
    normal = average_path(size) or 1.0

    @F.pandas_udf("double")
    def score(*features: pd.Series) -> pd.Series:
        x = np.column_stack([f.to_numpy(dtype=np.float64) for f in features])
        every = np.arange(len(x))
        total = np.zeros(len(x))
        for feature, cut, low, high, path in shared.value:
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                split = feature[at]
                under = x[every, np.maximum(split, 0)] <= cut[at]
                at = np.where(split < 0, at, np.where(under, low[at], high[at]))
            total += path[at]
        return pd.Series(np.exp2(-(total / len(shared.value)) / normal))

    return score(*[F.col(c) for c in columns])


def detect(
    filled: DataFrame,
    columns: Sequence[str],
    n_trees: int = 100,
    contamination: float = 0.05,
    seed: int = 42,
    max_samples: int = SAMPLE,
) -> DataFrame:
    """Scores scaled to 0..1 and flags for the contamination share with the highest scores.

    Each tree grows on `max_samples` rows (all, if there are fewer); every row is scored.
    """
    n_rows = filled.count()
    size = min(max_samples, n_rows)
    nodes = fit(samples(filled, columns, n_rows, n_trees, size, seed), columns, size, seed)
    scored = materialize(filled.withColumn("_score", scorer(nodes, columns, size)), "forest-scores")
    least, cut, most = exact_quantiles(scored, ["_score"], [0.0, 1.0 - contamination, 1.0])["_score"]
    span = (most - least) or 1.0
    return scored.withColumns(
        {
            "is_anomaly": F.col("_score") > F.lit(cut),
            "anomaly_score": (F.col("_score") - F.lit(least)) / F.lit(span),
        }
    ).drop("_score")
