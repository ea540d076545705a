"""Quality classifier: ridge regression on random Fourier features of a document's statistics.

Statistics of form (tidemark.llm.textstats) are scaled to mean 0 and deviation 1. Cosines of random
projections approximate a Gaussian kernel over them. Each task sums its part of the normal equations;
the sums of all tasks are added by Spark, and only the finished matrix, whose size is the square of the
number of features whatever the number of rows, is solved on the driver. A quarter of the labelled rows,
chosen by a hash of the text's statistics, is kept out of the fit: raw scores are calibrated on it by an
isotonic step function, pooled from counts per raw score in thousandths.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts
from tidemark.llm.textstats import ratio_rows, ratios, text_statistics
from tidemark.llm.textstats import statistics as text_counts
from tidemark.session import materialize

FEATURES = 128
RIDGE = 1e-3
SEED = 10
THRESHOLD = 0.3
BINS = 1000
#: Raw scores leave [LOW, HIGH] only far from all labels; they are clipped there.
LOW, HIGH = -0.5, 1.5
#: Part of the raw score in the result, so that scores on one step of the calibration keep their order.
ORDER_SHARE = 0.02


@dataclass
class Model:
    center: np.ndarray
    scale: np.ndarray
    projection: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(fourier(x, self) @ self.weights, LOW, HIGH)

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        calibrated = np.interp(raw, self.steps, self.values)
        return (1 - ORDER_SHARE) * calibrated + ORDER_SHARE * (raw - LOW) / (HIGH - LOW)


def fourier(x: np.ndarray, model: Model) -> np.ndarray:
    """Random Fourier features of scaled statistics, a constant last."""
    z = np.clip((x - model.center) / model.scale, -6, 6) @ model.projection + model.phase
    return np.column_stack([np.cos(z) * np.sqrt(2 / z.shape[1]), np.ones(len(z))])


def matrix(columns: list[pa.Array]) -> np.ndarray:
    return np.column_stack([np.nan_to_num(c.to_numpy(zero_copy_only=False).astype(float)) for c in columns])


def pooled(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The nondecreasing sequence nearest to the values in weighted squares (adjacent violators pooled)."""
    blocks: list[list[float]] = []
    for value, weight in zip(values, weights, strict=True):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, n = blocks.pop()
            u = blocks[-1]
            blocks[-1] = [(u[0] * u[1] + v * w) / (u[1] + w), u[1] + w, u[2] + n]
    return np.repeat([b[0] for b in blocks], [b[2] for b in blocks])


def normal_equations(rows: DataFrame, names: list[str], model: Model, target: str) -> DataFrame:
    """(i, j, value): Z'Z in its upper triangle, and Z'y as column `size`, summed over all rows."""
    size = model.projection.shape[1] + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            if batch.num_rows:
                z = fourier(matrix([batch[n] for n in names]), model)
                y = batch[target].to_numpy(zero_copy_only=False).astype(float)
                total += z.T @ np.column_stack([z, y])
        i, j = np.nonzero(np.triu(np.ones((size, size + 1), bool)))
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], names=["i", "j", "value"])

    parts = rows.select(*names, target).mapInArrow(run, "i long, j long, value double")
    return parts.groupBy("i", "j").agg(F.sum("value").alias("value"))


def fit(rows: DataFrame, names: list[str], target: str = "y", features: int = FEATURES, ridge: float = RIDGE) -> Model | None:
    """A model of the target (0 or 1) from the columns `names`; None without labelled rows."""
    rows = rows.select(*[F.col(n).cast("double").alias(n) for n in names], F.col(target).cast("double").alias(target))
    part = F.pmod(F.xxhash64(*names), F.lit(4))
    fitted, held = rows.filter(part != 0), rows.filter(part == 0)
    moments = fitted.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(n).alias(f"m_{n}") for n in names],
        *[F.stddev_pop(n).alias(f"d_{n}") for n in names],
    ).first()
    if not moments["n"]:
        return None
    rng = np.random.default_rng(SEED)
    center = np.array([moments[f"m_{n}"] for n in names])
    scale = np.array([moments[f"d_{n}"] for n in names])
    width = np.sqrt(len(names))  # the usual distance of two scaled rows is of this order
    model = Model(
        center,
        np.where(scale > 1e-9, scale, 1.0),
        rng.standard_normal((len(names), features)) / width,
        rng.uniform(0, 2 * np.pi, features),
        np.zeros(features + 1),
        np.array([LOW, HIGH]),
        np.array([0.0, 1.0]),
    )
    size = features + 1
    sums = np.zeros((size, size + 1))
    for row in normal_equations(fitted, names, model, target).collect():  # size * (size + 3) / 2 rows
        sums[row["i"], row["j"]] = row["value"]
    gram = np.triu(sums[:, :size])
    gram = gram + np.triu(gram, 1).T
    penalty = np.eye(size) * ridge * moments["n"]
    penalty[-1, -1] = 1e-9
    model.weights = np.linalg.solve(gram + penalty, sums[:, size])

    scored = held.select(raw_score(model, [F.col(n) for n in names]).alias("raw"), target)
    counts = scored.groupBy(F.round(F.col("raw") * BINS).cast("long").alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(target).alias("y")
    )
    found = counts.orderBy("bin").collect()  # at most (HIGH - LOW) * BINS + 1 rows
    if found:
        model.steps = np.array([r["bin"] / BINS for r in found])
        model.values = pooled(np.array([r["y"] for r in found]), np.array([float(r["n"]) for r in found]))
    return model


def _apply(name: str, model: Model, columns: list[Column]) -> Column:
    def run(*values: pa.Array) -> pa.Array:
        x = matrix(list(values))
        return pa.array(getattr(model, name)(x) if len(x) else [], pa.float64())

    return F.arrow_udf(run, "double")(*columns)


def raw_score(model: Model, columns: list[Column]) -> Column:
    return _apply("raw", model, columns)


def score(model: Model | None, columns: list[Column]) -> Column:
    """From 0 to 1, higher where label 1 is likelier; 1 where nothing was learnt."""
    return F.lit(1.0) if model is None else _apply("score", model, columns)


def statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, s): the statistics of each text."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_statistics("text").alias("s"))


def labelled(stats: DataFrame, labels: DataFrame, held_out: Column | None = None) -> DataFrame:
    """Statistics with their label y. Rows without a doc_id or label don't teach; labels that repeat a doc_id
    count as their mean; rows for which held_out is true are left out."""
    marks = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL")
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.avg("quality").alias("y"))
    rows = stats.filter(~held_out) if held_out is not None else stats
    return rows.join(marks, "doc_id").select(*[c.alias(n) for n, c in ratios().items()], "y")


def train(stats: DataFrame, labels: DataFrame, held_out: Column | None = None) -> Model | None:
    return fit(labelled(stats, labels, held_out), list(ratios()))


def predictions(stats: DataFrame, model: Model | None) -> DataFrame:
    """stats with score and predicted (1 from the threshold on). Empty and null texts are scored like any
    other, by their statistics, which are all zero."""
    scored = stats.withColumn("score", score(model, list(ratios().values())))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents that the classifier keeps, with all their columns.

    The model is fitted on all labelled documents; rows with a null doc_id or text are judged too.
    """
    model = train(materialize(statistics(docs), "quality-stats"), labels)
    if model is None:
        return docs

    def run(column: pa.Array) -> pa.Array:
        values = texts(column)
        kept = []
        while part := [text_counts(t) for t in islice(values, 256)]:
            kept += (model.score(ratio_rows(part)) >= THRESHOLD).tolist()
        return pa.array(kept, pa.bool_())

    return docs.filter(F.arrow_udf(run, "boolean")(F.col("text").cast("string")))
