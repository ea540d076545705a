"""Toxicity: a bidirectional gated recurrent network with attention pooling, in numpy.

A text is its runs of letters, lower-cased. Each is one step of the network; its input is the embedding of
the word beside the summed embeddings of its character n-grams, both found by hashing, so that a word never
seen before still shows its parts. Two gated recurrences, one from either side, run over windows of `WINDOW`
words that overlap by half; attention weighs their states, and a logistic unit scores the window. A document's
score is that of its worst window: every window of the whole text is scored.

Labels mark documents, not windows, so each round of the fit takes, of every document in the sample, the
window that scores highest so far (multiple-instance learning). The embeddings' first component starts as the
log-odds of its bucket. The fit runs on the driver over a bounded sample; a quarter of it, left out of the fit,
calibrates the scores to the share of toxic documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts
from tidemark.llm.sampling import drawn
from tidemark.session import materialize

#: Labelled texts of each label that teach, at most, and the bytes of the longest of them.
SAMPLE_EACH = 800
SAMPLE_BYTES = 6000
THRESHOLD = 0.5

WINDOW = 40
STRIDE = 20
HIDDEN = 12
DIMENSIONS = 6
WORD_BUCKETS = 1 << 13
CHAR_BUCKETS = 1 << 15
#: Sizes in bytes of a word's character n-grams; < and > mark its ends.
CHAR_SIZES = (3, 5, 7)
#: A longer run of letters is cut into several words.
WORD_BYTES = 64

ROUNDS = 8
BATCH = 64
RATE = 0.01
SEED = 12
#: Windows that go through the network at a time, and distinct words whose inputs a task remembers.
AT_ONCE = 2048
REMEMBERED = 1 << 16

_LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_CUT = re.compile(rb".{1,%d}" % WORD_BYTES, re.DOTALL)


def words_of(text: bytes) -> list[bytes]:
    """Runs of letters of the whole text, lower-cased; what isn't ASCII counts as a letter."""
    lower = text if text.isascii() else text.decode("utf-8", "replace").lower().encode()
    words = lower.translate(_LETTERS).split()
    if any(len(w) > WORD_BYTES for w in words):
        words = [part for w in words for part in ([w] if len(w) <= WORD_BYTES else _CUT.findall(w))]
    return words


def buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word buckets, and the (word, bucket) pairs of all character n-grams of the words."""
    data = np.frombuffer(b"".join(b"<%b>" % w for w in words), np.uint8).astype(np.uint32)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    starts = np.cumsum(sizes) - sizes
    word_of = np.repeat(np.arange(len(words)), sizes)
    rows, codes = [], []
    for size in CHAR_SIZES:
        n = len(data) - size + 1
        if n <= 0:
            continue
        code = np.full(n, size, np.uint32)
        for k in range(size):
            code = (code ^ data[k : k + n]) * np.uint32(16777619)
            code ^= code >> np.uint32(13)
        inside = word_of[:n] == word_of[size - 1 :]
        rows.append(word_of[:n][inside])
        codes.append(code[inside] % CHAR_BUCKETS)
    # A word's own code sums over its letters and their places
    place = np.arange(len(data)) - starts[word_of]
    mixed = (data + np.uint32(1)) * (np.uint32(2654435761) * (2 * place.astype(np.uint32) + 1))
    mixed ^= mixed >> np.uint32(15)
    whole = np.add.reduceat(mixed.astype(np.uint64), starts) % WORD_BUCKETS if len(words) else np.zeros(0, np.uint64)
    empty = np.zeros(0, np.int64)
    return whole.astype(np.int64), np.concatenate([*rows, empty]), np.concatenate([*codes, empty]).astype(np.int64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * x)


@dataclass
class Network:
    """Parameters by name: embeddings, for each direction Wx, Wh and b, attention u, output w and bias."""

    values: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0
    moments: dict[str, np.ndarray] = field(default_factory=dict)

    def inputs(self, whole: np.ndarray, rows: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The input of each word, and by how much its n-gram sum was divided."""
        v = self.values
        n = len(whole)
        share = 1 / np.sqrt(np.maximum(np.bincount(rows, minlength=n), 1))
        chars = np.stack([np.bincount(rows, v["char"][codes, k], n) for k in range(DIMENSIONS)], 1) * share[:, None]
        return np.hstack([v["word"][whole], chars]).astype(np.float32), share

    def states(self, gates: np.ndarray, known: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """(step, window, HIDDEN) of one direction. gates: (step, window, 3 * HIDDEN) from the inputs; padding keeps the state."""
        recurrent = self.values[f"Wh{side}"]
        h = np.zeros((gates.shape[1], HIDDEN), np.float32)
        out = np.empty((*gates.shape[:2], HIDDEN), np.float32)
        for t in range(len(gates)) if side == "f" else reversed(range(len(gates))):
            g, back = gates[t], h @ recurrent
            zr = sigmoid(g[:, : 2 * HIDDEN] + back[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            new = np.tanh(g[:, 2 * HIDDEN :] + r * back[:, 2 * HIDDEN :])
            if keep is not None:
                keep.append((t, h, z, r, new, back[:, 2 * HIDDEN :]))
            h = np.where(known[t][:, None], new + z * (h - new), h)
            out[t] = h
        return out

    def pooled(self, states: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Attention over the steps of each window: the weighted state, and the weights."""
        weight = np.where(known, np.exp(np.clip(states @ self.values["u"], -30, 30)), 0)
        weight = weight / np.maximum(weight.sum(0), 1e-12)
        return np.einsum("tb,tbh->bh", weight, states), weight

    def logits(self, projected: np.ndarray, at: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Of windows, given as word numbers (window, step) into the projected inputs of both directions."""
        gates = projected[at.T]
        known = known.T
        both = [self.states(gates[:, :, k * 3 * HIDDEN : (k + 1) * 3 * HIDDEN], known, side) for k, side in enumerate("fb")]
        pool, _ = self.pooled(np.concatenate(both, 2), known)
        return pool @ self.values["w"] + self.values["bias"][0]

    def projected(self, x: np.ndarray) -> np.ndarray:
        v = self.values
        return np.hstack([x @ v["Wxf"] + v["bf"], x @ v["Wxb"] + v["bb"]])

    def score(self, logits: np.ndarray) -> np.ndarray:
        return sigmoid(self.scale * logits.astype(float) + self.shift)

    def learn(self, words: tuple[np.ndarray, np.ndarray, np.ndarray], at: np.ndarray, known: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        """One step down the gradient of the weighted logistic loss of these windows."""
        v, grads = self.values, {}
        whole, rows, codes = words
        x, share = self.inputs(*words)
        gates = self.projected(x)[at.T]
        known = known.T
        kept: dict[str, list] = {"f": [], "b": []}
        sides = {s: gates[:, :, k * 3 * HIDDEN : (k + 1) * 3 * HIDDEN] for k, s in enumerate("fb")}
        states = np.concatenate([self.states(sides[s], known, s, kept[s]) for s in "fb"], 2)
        pool, attention = self.pooled(states, known)
        logit = pool @ v["w"] + v["bias"][0]
        d_logit = (weight * (sigmoid(logit) - y) / weight.sum()).astype(np.float32)
        grads["w"], grads["bias"] = pool.T @ d_logit, d_logit.sum(keepdims=True)
        d_pool = d_logit[:, None] * v["w"]
        d_weight = np.einsum("bh,tbh->tb", d_pool, states)
        d_energy = attention * (d_weight - (attention * d_weight).sum(0))
        grads["u"] = np.einsum("tb,tbh->h", d_energy, states)
        d_states = attention[:, :, None] * d_pool + d_energy[:, :, None] * v["u"]
        d_x = np.zeros_like(x)
        for k, side in enumerate("fb"):
            d_gates = np.zeros_like(sides[side])
            d_recurrent = np.zeros_like(v[f"Wh{side}"])
            d_h = np.zeros((len(at), HIDDEN), np.float32)
            for t, before, z, r, new, back in reversed(kept[side]):
                d_h = d_h + d_states[t][:, k * HIDDEN : (k + 1) * HIDDEN]
                live = d_h * known[t][:, None]
                d_new = live * (1 - z) * (1 - new * new)
                d_z = live * (before - new) * z * (1 - z)
                d_r = d_new * back * r * (1 - r)
                d_back = np.hstack([d_z, d_r, d_new * r])
                d_gates[t] = np.hstack([d_z, d_r, d_new])
                d_recurrent += before.T @ d_back
                d_h = np.where(known[t][:, None], live * z + d_back @ v[f"Wh{side}"].T, d_h)
            flat = d_gates.reshape(-1, 3 * HIDDEN)
            of_word = np.stack([np.bincount(at.T.ravel(), flat[:, j], len(x)) for j in range(3 * HIDDEN)], 1).astype(np.float32)
            grads[f"Wh{side}"] = d_recurrent
            grads[f"Wx{side}"] = x.T @ of_word
            grads[f"b{side}"] = of_word.sum(0)
            d_x += of_word @ v[f"Wx{side}"].T
        d_chars = (d_x[:, DIMENSIONS:] * share[:, None])[rows]
        grads["word"] = np.stack([np.bincount(whole, d_x[:, k], WORD_BUCKETS) for k in range(DIMENSIONS)], 1)
        grads["char"] = np.stack([np.bincount(codes, d_chars[:, k], CHAR_BUCKETS) for k in range(DIMENSIONS)], 1)
        for name, grad in grads.items():  # step sizes fall with the squares a parameter has seen
            seen = self.moments.setdefault(name, np.full(grad.shape, 1e-8))
            seen += grad * grad
            v[name] -= (RATE * 5 * grad / np.sqrt(seen)).astype(np.float32)


def windows(count: int) -> np.ndarray:
    """Where the windows of a text of so many words begin; they overlap and reach its end."""
    return np.arange(0, max(count - WINDOW, 0) + STRIDE, STRIDE) if count > WINDOW else np.zeros(1, np.int64)


def framed(numbers: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of windows, padded with 0, and which of them are words."""
    at = starts[:, None] + np.arange(WINDOW)
    known = at < len(numbers)
    if not len(numbers):
        return np.zeros(at.shape, np.int64), known
    return np.where(known, numbers[np.minimum(at, len(numbers) - 1)], 0), known


def worst_windows(network: Network, documents: Iterable[list[bytes]]) -> Iterator[np.ndarray]:
    """For documents, given as word lists, the logits of all of their windows, one array a document."""
    number: dict[bytes, int] = {}
    table = np.zeros((0, 6 * HIDDEN), np.float32)

    def run(waiting: list[list[bytes]]) -> Iterator[np.ndarray]:
        nonlocal number, table
        new = list(dict.fromkeys(w for words in waiting for w in words if w not in number))
        if len(number) + len(new) > REMEMBERED:  # start over with the words at hand
            number, table = {}, table[:0]
            new = list(dict.fromkeys(w for words in waiting for w in words))
        number.update(zip(new, range(len(number), len(number) + len(new))))
        parts = [network.projected(network.inputs(*buckets(new[k : k + 20_000]))[0]) for k in range(0, len(new), 20_000)]
        table = np.concatenate([table, *parts]) if len(table) or parts else np.zeros((1, 6 * HIDDEN), np.float32)
        numbers = [np.fromiter((number[w] for w in words), np.int64, len(words)) for words in waiting]
        frames = ((n, starts[k : k + AT_ONCE]) for n in numbers for starts in [windows(len(n))] for k in range(0, len(starts), AT_ONCE))
        found, held, size = [], [], 0
        for n, starts in frames:
            held.append(framed(n, starts))
            size += len(starts)
            if size >= AT_ONCE:
                found.append(network.logits(table, *map(np.concatenate, zip(*held, strict=True))))
                held, size = [], 0
        if held:
            found.append(network.logits(table, *map(np.concatenate, zip(*held, strict=True))))
        yield from np.split(np.concatenate(found), np.cumsum([len(windows(len(n))) for n in numbers])[:-1])

    waiting, count = [], 0
    for words in documents:
        waiting.append(words)
        count += max(len(words) // STRIDE, 1)
        if count >= AT_ONCE:
            yield from run(waiting)
            waiting, count = [], 0
    if waiting:
        yield from run(waiting)


def fresh_network(documents: list[list[bytes]], y: np.ndarray) -> Network:
    """Small random weights; the embeddings' first component is the log-odds of their bucket."""
    rng = np.random.default_rng(SEED)
    draw = lambda *shape, by=0.1: (rng.standard_normal(shape) * by).astype(np.float32)
    size = 2 * DIMENSIONS
    values = {"word": draw(WORD_BUCKETS, DIMENSIONS), "char": draw(CHAR_BUCKETS, DIMENSIONS)}
    for side in "fb":
        values |= {f"Wx{side}": draw(size, 3 * HIDDEN, by=0.5), f"Wh{side}": draw(HIDDEN, 3 * HIDDEN, by=0.2), f"b{side}": np.zeros(3 * HIDDEN, np.float32)}
    values |= {"u": draw(2 * HIDDEN, by=0.5), "w": draw(2 * HIDDEN, by=0.5), "bias": np.zeros(1, np.float32)}
    seen = {name: np.zeros((2, len(values[name]))) for name in ("word", "char")}
    for words, mark in zip(documents, y.astype(int), strict=True):
        whole, _, codes = buckets(list(set(words)))
        seen["word"][mark, np.unique(whole)] += 1
        seen["char"][mark, np.unique(codes)] += 1
    total = np.array([(y == 0).sum(), (y == 1).sum()])
    for name, held in seen.items():
        odds = np.log((held[1] + 0.5) / (total[1] + 1)) - np.log((held[0] + 0.5) / (total[0] + 1))
        values[name][:, 0] = np.clip(odds, -4, 4) / 2
    return Network(values)


def fit(documents: list[list[bytes]], y: np.ndarray, shares: tuple[float, float], rounds: int = ROUNDS) -> Network | None:
    """A network from word lists and their labels (0 or 1); None unless both labels are there.

    shares: how many documents each label stands for; a document of the sample weighs accordingly in the calibration.
    """
    y = np.asarray(y, float)
    if not (y == 0).any() or not (y == 1).any():
        return None
    held = np.arange(len(y)) % 4 == 3 if len(y) >= 40 else np.zeros(len(y), bool)
    taught = [d for d, h in zip(documents, held, strict=True) if not h]
    marks = y[~held]
    if not (marks == 0).any() or not (marks == 1).any():
        taught, marks, held = documents, y, np.zeros(len(y), bool)
    network = fresh_network(taught, marks)
    vocabulary = list(dict.fromkeys(w for words in taught for w in words)) or [b""]
    number = {w: k for k, w in enumerate(vocabulary)}
    numbers = [np.array([number[w] for w in words], np.int64) for words in taught]
    whole, rows, codes = buckets(vocabulary)
    ends = np.searchsorted(rows, np.arange(len(vocabulary) + 1)) if len(rows) and (np.diff(rows) >= 0).all() else None
    if ends is None:
        order = np.argsort(rows, kind="stable")
        rows, codes = rows[order], codes[order]
        ends = np.searchsorted(rows, np.arange(len(vocabulary) + 1))
    balance = np.where(marks == 1, 0.5 / marks.mean(), 0.5 / (1 - marks.mean()))
    rng = np.random.default_rng(SEED)
    odds = network.inputs(whole, rows, codes)[0][:, [0, DIMENSIONS]].sum(1)  # the first round goes by log-odds
    chosen = []
    for n in numbers:
        at, known = framed(n, windows(len(n)))
        chosen.append(int(np.where(known, odds[at], -9.0).max(1).argmax()))
    for turn in range(rounds):
        if turn:
            chosen = [int(np.argmax(logits)) for logits in worst_windows(network, taught)]
        frames = [framed(n, windows(len(n))[[k]]) for n, k in zip(numbers, chosen, strict=True)]
        at, known = map(np.concatenate, zip(*frames, strict=True))
        order = rng.permutation(len(at))
        for k in range(0, len(order), BATCH):
            part = order[k : k + BATCH]
            used, local = np.unique(at[part], return_inverse=True)
            grams = np.concatenate([np.arange(ends[w], ends[w + 1]) for w in used])
            own = np.repeat(np.arange(len(used)), ends[used + 1] - ends[used])
            network.learn((whole[used], own, codes[grams]), local.reshape(at[part].shape), known[part], marks[part], balance[part])
    judged = [d for d, h in zip(documents, held, strict=True) if h] or taught
    truth = y[held] if held.any() else marks
    top = np.array([logits.max() for logits in worst_windows(network, judged)], float)
    weight = np.where(truth == 1, shares[1] / max((truth == 1).sum(), 1), shares[0] / max((truth == 0).sum(), 1))
    network.scale, network.shift = calibrated(top, truth, weight / weight.sum())
    network.moments = {}
    return network


def calibrated(logits: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and shift of a logistic curve through the labels, by Newton steps with a small ridge towards the logits."""
    design = np.column_stack([logits, np.ones(len(logits))])
    ridge = np.diag([1e-3, 1e-4])
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = sigmoid(design @ at)
        gradient = design.T @ (weight * (p - y)) + ridge @ (at - [1.0, 0.0])
        curve = design.T @ (design * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]) + ridge
        step = np.linalg.solve(curve, gradient)
        at = at - step * min(1.0, 2 / max(np.abs(step).max(), 1e-9))
    return max(float(at[0]), 1e-3), float(at[1])


def train(docs: DataFrame, labels: DataFrame, each: int = SAMPLE_EACH, most_bytes: int = SAMPLE_BYTES) -> Network | None:
    """A network from the labelled documents: of each label at most `each` distinct texts of at most `most_bytes` bytes.

    Null ids, labels and texts don't teach; a doc_id with several labels is toxic if any says so. The driver receives
    2 * each texts at most.
    """
    marks = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    texts_ = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts_ = texts_.filter("doc_id IS NOT NULL AND text IS NOT NULL").withColumn("text_hash", F.xxhash64("text"))
    # The texts stay where they are: only their hashes and sizes meet the labels
    rows = texts_.select("doc_id", "text_hash", F.octet_length("text").alias("size")).join(marks, "doc_id")
    shares = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = drawn(rows.filter(F.col("size") <= most_bytes), "toxic", ["text_hash"], each, 2)
    chosen = materialize(chosen.select("doc_id", "text_hash", "toxic"), "toxicity-sample")  # 2 * each rows
    sample = texts_.join(chosen, ["doc_id", "text_hash"]).select("toxic", "text").distinct().collect()
    sample = sorted((r["text"].encode(), r["toxic"]) for r in sample)
    rng = np.random.default_rng(SEED)
    sample = [sample[k] for k in rng.permutation(len(sample))]
    return fit([words_of(t) for t, _ in sample], np.array([m for _, m in sample]), (shares.get(0, 0), shares.get(1, 0)))


def score(network: Network | None, text: Column) -> Column:
    """From 0 to 1, that of the worst window of the whole text; 0 where nothing was learnt. A null text is empty."""
    if network is None:
        return F.lit(0.0)

    def run(column: pa.Array) -> pa.Array:
        documents = (words_of(t) for t in texts(column))
        top = np.array([logits.max() for logits in worst_windows(network, documents)], float)
        return pa.array(network.score(top), pa.float64())

    return F.arrow_udf(run, "double")(text.cast("string"))


def predictions(docs: DataFrame, network: Network | None, *keep: Column) -> DataFrame:
    """(doc_id, the columns to keep, score, predicted): predicted is 1 from the threshold on. No other column is read."""
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *keep, score(network, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
