from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.helpers import hour
from tidemark import settings as S
from tidemark.operators import anomaly, forest

SCHEMA = "keyword string, timestamp timestamp, " + ", ".join(f"{c} double" for c in S.ANOMALY_FEATURES) + ", trend_label string"


@pytest.fixture(scope="module")
def table(spark):
    """Two thousand ordinary rows, forty far away, some with gaps."""
    rng = np.random.RandomState(3)
    x = rng.normal(10, 1, size=(2000, 5))
    x[:40] += 60
    rows = []
    for i, row in enumerate(x.tolist()):
        if i >= 40 and i % 50 == 0:
            row[2], row[3] = None, float("nan")
        rows.append((f"k{i}", hour(i % 100), *row, "stable"))
    return spark.createDataFrame(rows, SCHEMA).cache()


def matrix(table):
    pdf = table.orderBy("keyword").toPandas()
    x = pdf[list(S.ANOMALY_FEATURES)].to_numpy(dtype=float)
    for j in range(x.shape[1]):
        ok = np.isfinite(x[:, j])
        x[~ok, j] = np.median(x[ok, j])
    return x


def flags(df):
    return np.array([r["is_anomaly"] for r in df.orderBy("keyword").select("is_anomaly").collect()])


def test_impute(table):
    got = anomaly.impute(table).orderBy("keyword").toPandas()[list(S.ANOMALY_FEATURES)].to_numpy()
    assert np.allclose(got, matrix(table))


def test_impute_absent_column(table):
    got = anomaly.impute(table.drop("freq_6h"))
    assert got.select(F.max("freq_6h"), F.min("freq_6h")).first() == (0.0, 0.0)


def test_zscore(table):
    x = matrix(table)
    z = np.abs((x - x.mean(axis=0)) / x.std(axis=0))
    found = anomaly.detect(table, "zscore")
    assert (flags(found) == (z > 2.5).any(axis=1)).all()
    score = found.orderBy("keyword").toPandas()["anomaly_score"].to_numpy()
    assert np.allclose(score, z.max(axis=1), atol=1e-7)


def test_iqr(table):
    x = matrix(table)
    q1, q3 = np.percentile(x, 25, axis=0), np.percentile(x, 75, axis=0)
    want = ((x < q1 - 1.5 * (q3 - q1)) | (x > q3 + 1.5 * (q3 - q1))).any(axis=1)
    assert (flags(anomaly.detect(table, "iqr")) == want).all()


def test_forest_finds_planted_rows(table):
    found = anomaly.detect(table, "isolation_forest", contamination=0.05).toPandas()
    planted = found["keyword"].isin([f"k{i}" for i in range(40)])
    assert found.loc[planted, "is_anomaly"].all()
    assert found["anomaly_score"].between(0, 1).all()
    assert found["anomaly_score"].max() == 1.0 and found["anomaly_score"].min() == 0.0
    assert abs(found["is_anomaly"].mean() - 0.05) < 0.01


def test_forest_repeats_whatever_the_partitioning(table):
    a = anomaly.detect(table.repartition(3), n_trees=20).orderBy("keyword").toPandas()
    b = anomaly.detect(table.repartition(11, "keyword"), n_trees=20).orderBy("keyword").toPandas()
    assert (a["is_anomaly"] == b["is_anomaly"]).all()
    assert np.allclose(a["anomaly_score"], b["anomaly_score"])


def test_samples_are_bounded_and_distinct(table):
    drawn = forest.samples(table, S.ANOMALY_FEATURES[:1], 2000, 10, 64, 1).toPandas()
    assert (drawn.groupby("tree").size() == 64).all()
    assert not drawn.duplicated(["tree", "keyword"]).any()


def test_scores_follow_tree_depth(spark):
    """The scorer equals a walk of each tree node by node."""
    rng = np.random.RandomState(0)
    x = rng.normal(size=(64, 2))
    rows = [(f"k{i}", hour(i), *map(float, r)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "keyword string, timestamp timestamp, a double, b double")
    nodes = forest.fit(forest.samples(df, ["a", "b"], 64, 5, 64, 7), ["a", "b"], 64, 7).cache()
    got = df.withColumn("s", forest.scorer(nodes, ["a", "b"], 64)).orderBy("timestamp").toPandas()["s"]
    table = {(r["tree"], r["node"]): r for r in nodes.collect()}

    def path(tree, point):
        at = table[(tree, 0)]
        while at["feature"] >= 0:
            at = table[(tree, at["low"] if point[at["feature"]] <= at["cut"] else at["high"])]
        return at["path"]

    trees = sorted({t for t, _ in table})
    want = [2 ** (-np.mean([path(t, p) for t in trees]) / forest.average_path(64)) for p in x]
    assert np.allclose(got, want)


def test_enrich_and_report(table):
    enriched = anomaly.enrich(table, "zscore")
    assert dict(enriched.dtypes)["is_anomaly"] == "boolean"
    assert enriched.count() == table.count()
    assert enriched.filter(F.col("growth_rate_1h").isNull()).count() > 0
    shown = anomaly.report(enriched).toPandas()
    assert list(shown["anomaly_score"]) == sorted(shown["anomaly_score"], reverse=True)
    assert len(shown) == enriched.filter("is_anomaly").count()


def test_unknown_method(table):
    with pytest.raises(ValueError):
        anomaly.detect(table, "magic")


def test_constant_table_has_no_outlier(spark):
    rows = [(f"k{i}", hour(i), *[1.0] * 5, "stable") for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    for method in anomaly.METHODS:
        assert not flags(anomaly.detect(df, method)).any()


def test_enrich_keeps_every_row(spark):
    rows = [("a", None, *[1.0] * 5, "stable"), ("b", hour(1), *[2.0] * 5, "stable"), ("b", hour(1), *[9.0] * 5, "viral")]
    rows += [(None, hour(2), *[None] * 5, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    for method in anomaly.METHODS:
        got = anomaly.enrich(df, method)
        assert got.columns == [*df.columns, "is_anomaly", "anomaly_score"]
        key = lambda r: str(tuple(r))
        assert sorted(got.select(*df.columns).collect(), key=key) == sorted(df.collect(), key=key)
        assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
