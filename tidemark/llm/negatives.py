"""Hard negatives by exact inner products, over candidate lists that a cluster of anchors shares.

Vectors become whole numbers, floor(256 * x), so that scores are exact. Anchors come in rounds of bounded size;
each round's anchors are clustered by direction and sent to the tasks, where the candidates stay. For a
cluster with centre c whose members lie within an angle b of it, a candidate x at the angle t from c has with no
member a more than |a| |x| cos(max(0, t - b)). A task sorts its block of candidates once for each cluster by the
part that members share, |x| cos(max(0, t - b)), and every member walks that list from the top until the bound
falls below the worst score that it still needs: nothing behind can count, so the walk is certified to be
complete. What it needs is a number of best scores within an interval, which is known from the start or tightens
as the walk goes on; what a task has found for an anchor tightens its walk through the task's next blocks.

Positives are mined first: the best rows of the anchor's own label. Their scores give the intervals for the
negatives of each (anchor, positive), the best rows of other labels inside them. A task sends the best it found
for each anchor and interval, and ranks over those give the result. No pair of rows leaves a task otherwise.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize

POSITIVES = 5
NEGATIVES = 10
#: Percent of the positive's score within which a negative's lies.
LOW, HIGH = 30, 90
#: Anchors of a round; their vectors, and a few results for each, pass through the driver.
ANCHORS = 8192
#: Anchors of a cluster, on average.
MEMBERS = 48
#: Candidates that a task sorts at a time, and how many of the list a cluster scores between two looks at its bounds.
BLOCK = 8192
STEP = 256
SCALE = 256.0
#: Angles are known to about this.
SLACK = 1e-6
FARTHEST = np.iinfo(np.int64).max


def whole_numbers(vectors: pa.Array, size: int) -> np.ndarray:
    """floor(256 * x) of each vector as doubles; shorter vectors end in zeros."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    counts = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
    if (counts == size).all():
        return np.floor(SCALE * flat.reshape(-1, size))
    out = np.zeros((len(counts), size))
    out[np.arange(size) < counts[:, None]] = np.floor(SCALE * flat)
    return out


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The inner products of all rows of a with all rows of b, as exact longs."""
    most = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if most < 2**53:  # every partial sum is a whole number that a double holds
        return (a @ b.T).astype(np.int64)
    if most < 2**62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    exact = lambda m: np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
    return (exact(a) @ exact(b).T).astype(np.int64)  # raises where a score is no long


def directions(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths, and vectors of length 1 (a zero vector stays)."""
    with np.errstate(over="ignore"):
        most = np.maximum(np.abs(rows).max(1, initial=0), 1)
        norm = most * np.linalg.norm(rows / most[:, None], axis=1)
    return norm, rows / np.maximum(norm, 1)[:, None]


def clustered(rows: np.ndarray, members: int) -> tuple[np.ndarray, np.ndarray]:
    """Centres of length 1 and each row's cluster: a few rounds of k-means on directions."""
    _, unit = directions(rows)
    count = -(-len(rows) // members)
    centre = unit[np.random.default_rng(13).choice(len(unit), count, replace=False)]
    for _ in range(6):
        own = (unit @ centre.T).argmax(1)
        sums = np.zeros_like(centre)
        np.add.at(sums, own, unit)
        length = np.linalg.norm(sums, axis=1)
        centre = np.where(length[:, None] > 1e-9, sums / np.maximum(length, 1e-9)[:, None], centre)
    return centre, (unit @ centre.T).argmax(1)


def angle(cosine: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosine, -1, 1))


@dataclass
class Wanted:
    """The anchors of a round: what each needs are the `count` best scores in each of its intervals."""

    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    same: bool
    count: int
    low: np.ndarray
    high: np.ndarray
    members: int = MEMBERS

    def __post_init__(self) -> None:
        self.norm, unit = directions(self.rows)
        self.centre, self.own = clustered(self.rows, self.members)
        apart = angle((unit * self.centre[self.own]).sum(1))
        self.reach = np.array([apart[self.own == k].max(initial=0) for k in range(len(self.centre))])


class Found:
    """The best (score, vec_id) of each anchor and interval so far; higher scores first, ties by smaller vec_id."""

    def __init__(self, wanted: Wanted) -> None:
        shape = (*wanted.low.shape, wanted.count)
        self.wanted = wanted
        self.score = np.full(shape, np.iinfo(np.int64).min)
        self.id = np.full(shape, FARTHEST)
        self.held = np.zeros(wanted.low.shape, np.int64)
        #: What a score must reach to count.
        self.needed = wanted.low.copy()
        self.needed[wanted.low > wanted.high] = FARTHEST
        self.scored = 0

    def add(self, want: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """want: anchor * intervals + interval of each new one."""
        count = self.wanted.count
        touched = np.unique(want)
        flat_score, flat_id, held = self.score.reshape(-1, count), self.id.reshape(-1, count), self.held.reshape(-1)
        known = np.arange(count) < held[touched, None]
        want = np.concatenate([want, np.repeat(touched, held[touched])])
        score = np.concatenate([score, flat_score[touched][known]])
        ids = np.concatenate([ids, flat_id[touched][known]])
        order = np.lexsort((ids, -score, want))
        want, score, ids = want[order], score[order], ids[order]
        first = np.ones(len(want), bool)  # a row that repeats counts once
        first[1:] = (np.diff(want) != 0) | (np.diff(score) != 0) | (np.diff(ids) != 0)
        want, score, ids = want[first], score[first], ids[first]
        rank = np.arange(len(want)) - np.searchsorted(want, want)
        best = rank < count
        want, score, ids, rank = want[best], score[best], ids[best], rank[best]
        flat_score[want, rank], flat_id[want, rank] = score, ids
        held[touched] = np.bincount(want, minlength=len(held))[touched]
        full = touched[held[touched] == count]
        self.needed.reshape(-1)[full] = flat_score[full, count - 1]

    def walk(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> None:
        """Every anchor meets the candidates of a block that can still count for it."""
        w = self.wanted
        norm, unit = directions(rows)
        from_centre = angle(unit @ w.centre.T)
        for cluster, reach in enumerate(w.reach):
            active = np.flatnonzero(w.own == cluster)
            bound = norm * np.cos(np.clip(from_centre[:, cluster] - reach - SLACK, 0, np.pi))
            order = np.argsort(-bound, kind="stable")
            for at in range(0, len(order), STEP):
                ceiling = w.norm[active] * bound[order[at]]
                ceiling += 1e-9 * np.abs(ceiling) + 1
                active = active[ceiling >= self.needed[active].min(1)]
                if not len(active):
                    break
                step = order[at : at + STEP]
                self.scored += len(active) * len(step)
                score = inner(w.rows[active], rows[step])
                usable = (labels[step] == w.labels[active, None]) == w.same
                if w.same:
                    usable &= ids[step] != w.ids[active, None]
                wants, scores, found = [], [], []
                for k in range(w.low.shape[1]):
                    hit = usable & (score >= self.needed[active, k, None]) & (score <= w.high[active, k, None])
                    r, c = np.nonzero(hit)
                    wants.append(active[r] * w.low.shape[1] + k)
                    scores.append(score[r, c])
                    found.append(ids[step[c]])
                if sum(map(len, wants)):
                    self.add(*map(np.concatenate, (wants, scores, found)))

    def batch(self) -> pa.RecordBatch:
        anchor, interval, rank = np.nonzero(np.arange(self.wanted.count) < self.held[:, :, None])
        arrays = [anchor, interval, self.score[anchor, interval, rank], self.id[anchor, interval, rank]]
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()) for a in arrays], names=["anchor", "interval", "score", "vec_id"])


def best(rows: DataFrame, wanted: Wanted) -> DataFrame:
    """(anchor, interval, score, vec_id, rank): what each anchor, by its number, wanted, over all rows."""
    shared = rows.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = Found(shared.value)
        size = shared.value.rows.shape[1]
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= BLOCK:
                meet(found, waiting, size)
                waiting = []
        if waiting:
            meet(found, waiting, size)
        yield found.batch()

    def meet(found: Found, waiting: list[pa.RecordBatch], size: int) -> None:
        block = pa.Table.from_batches(waiting)
        for at in range(0, block.num_rows, BLOCK):
            part = block.slice(at, BLOCK).combine_chunks()
            ids = part["vec_id"].fill_null(FARTHEST).to_numpy()
            found.walk(ids, part["label"].to_numpy(), whole_numbers(part["embedding"], size))

    candidates = rows.select("vec_id", "label", "embedding")
    each = candidates.mapInArrow(run, "anchor long, interval long, score long, vec_id long").distinct()
    order = Window.partitionBy("anchor", "interval").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= wanted.count)


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of the rows that take part: a label, and a vector whose components are all finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    return rows.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", finite))


def mine(
    embeddings: DataFrame, anchors: Column, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = LOW, high: int = HIGH, per_round: int = ANCHORS,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that `anchors` marks.

    An anchor's positives are the best `positives` rows of its label; for each of them the best `negatives` rows of
    other labels follow whose score is `low` to `high` percent of the positive's. Scores are inner products of
    floor(256 * x); equal ones rank by vec_id. Vectors of unequal sizes are compared as if the shorter ended in
    zeros. A row never is its own positive, nor is one with its vec_id; rows that repeat a vec_id with an equal
    score count once, and so do anchors that repeat whole. A null vec_id ranks last and is no anchor. An anchor
    without positives, or a positive without negatives, has no row. A score beyond a long ends in an error. Other
    columns are not read.
    """
    spark = embeddings.sparkSession
    rows = usable(embeddings)
    chosen = rows.filter(anchors & F.col("vec_id").isNotNull())
    told = rows.agg(F.max(F.size("embedding")).alias("size"), F.count_if(anchors & F.col("vec_id").isNotNull()).alias("anchors")).first()
    count = -(-told["anchors"] // per_round)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    parts = []
    for number in range(count):
        now = chosen.filter(F.pmod(F.xxhash64("vec_id"), F.lit(count)) == number) if count > 1 else chosen
        table = now.distinct().toArrow().sort_by([("vec_id", "ascending"), ("label", "ascending")])
        if table.num_rows:
            parts.append(materialize(_round(rows, table, told["size"], positives, negatives, low, high), "negatives"))
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], schema)


def _round(rows: DataFrame, table: pa.Table, size: int, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    ids, labels = table["vec_id"].to_numpy(), table["label"].to_numpy()
    numbers = whole_numbers(table["embedding"], size)
    everything = np.iinfo(np.int64)
    first = Wanted(ids, labels, numbers, True, positives, np.full((len(ids), 1), everything.min), np.full((len(ids), 1), everything.max))
    found = best(rows, first).toArrow()  # so many rows for each anchor of the round
    anchor, rank = found["anchor"].to_numpy(), found["rank"].to_numpy() - 1
    from_score = np.zeros((len(ids), positives), np.int64)
    from_id = np.zeros((len(ids), positives), np.int64)
    from_score[anchor, rank], from_id[anchor, rank] = found["score"].to_numpy(), found["vec_id"].to_numpy()
    # 100 n >= low * p and 100 n <= high * p, in whole numbers
    least = np.array([-(-low * int(p) // 100) for p in from_score.ravel()], np.int64).reshape(from_score.shape)
    most = np.array([high * int(p) // 100 for p in from_score.ravel()], np.int64).reshape(from_score.shape)
    missing = np.ones(from_score.shape, bool)
    missing[anchor, rank] = False
    least[missing], most[missing] = 1, 0
    second = best(rows, Wanted(ids, labels, numbers, False, negatives, least, most))
    has = np.flatnonzero(~missing.ravel())
    known = pa.table({"anchor": has // positives, "interval": has % positives, "anchor_id": ids[has // positives], "positive_id": from_id.ravel()[has], "positive_score": from_score.ravel()[has]})
    pairs = rows.sparkSession.createDataFrame(known)
    named = lambda c: F.nullif(F.col(c), F.lit(FARTHEST)).alias(c)
    joined = second.withColumnRenamed("score", "negative_score").withColumnRenamed("vec_id", "negative_id").join(pairs, ["anchor", "interval"])
    return joined.select("anchor_id", named("positive_id"), "rank", named("negative_id"), "positive_score", "negative_score")
