"""Language identification by error-correcting output codes over letter n-grams.

Every language gets a codeword of bits. For each bit a linear classifier over hashed n-grams of the
text tells the languages with that bit set from the others. A text's bits are decoded to the codeword
with the least loss, each bit weighted by how well its classifier did on its own sample; a text whose
best two codewords lie close together is flagged as ambiguous.

The classifiers are fitted on the driver, on a bounded sample that is balanced over the languages;
every text is judged whole, in the tasks that read it, by a model of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts
from tidemark.llm.sampling import drawn
from tidemark.session import materialize

#: Documents that teach, over all languages, and languages that are learnt, at most.
SAMPLE_ROWS = 2000
MOST_LANGUAGES = 200
BUCKETS = 1 << 12
SIZES = (2, 3)
RIDGE = 1e-2
MARGIN = 0.1
UNKNOWN = "und"
#: Bytes of a text that are hashed at a time.
PART = 1 << 22

# Letters keep their bytes, A-Z in lower case; digits, signs and white space become a space.
_FOLD = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint32)


def ngram_counts(text: bytes) -> np.ndarray:
    """How often each bucket's n-grams occur in the whole text."""
    counts = np.zeros(BUCKETS)
    overlap = max(SIZES) - 1
    for at in range(0, max(len(text), 1), PART):
        data = _FOLD[np.frombuffer(text, np.uint8, count=min(PART + overlap, len(text) - at), offset=at)] if text else _FOLD[:0]
        last = at + PART >= len(text)
        for size in SIZES:
            n = len(data) - size + 1 if last else min(PART, len(data) - size + 1)
            if n <= 0:
                continue
            code = np.zeros(n, np.uint32)
            for k in range(size):
                code = (code + data[k : k + n] + 1) * np.uint32(2654435761 + 2 * size)
                code ^= code >> np.uint32(15)
            counts += np.bincount(code % BUCKETS, minlength=BUCKETS)
    return counts


def features(text: bytes) -> np.ndarray:
    """Square roots of the n-grams' shares, a vector of length 1."""
    counts = np.sqrt(ngram_counts(text))
    return (counts / max(np.linalg.norm(counts), 1e-12)).astype(np.float32)


def codewords(classes: int) -> np.ndarray:
    """A row of +1 and -1 for each class: all splits for up to six classes, else random ones far apart."""
    if classes <= 1:
        return np.ones((classes, 1))
    if classes <= 6:
        splits = [bits for bits in product((1, -1), repeat=classes) if bits[0] == 1 and -1 in bits]
        return np.array(splits, float).T
    length = 12 * int(np.ceil(np.log2(classes)))
    rng = np.random.default_rng(classes)
    best, far = None, -1
    for _ in range(50):
        words = rng.choice([-1.0, 1.0], (classes, length))
        words[:, np.abs(words.sum(0)) == classes] *= np.where(np.arange(classes) % 2, 1, -1)[:, None]
        near = (length - (words @ words.T - length * np.eye(classes) * 3).max()) / 2
        if near > far:
            best, far = words, near
    return best


@dataclass
class Model:
    languages: list[str]
    words: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best class, its score from 0 to 1, and whether the second best is close."""
        bits = x @ self.weights + self.bias
        margins = bits[:, None, :] * self.words[None]
        loss = (np.exp(-2 * np.clip(margins, -4, 4)) * self.trust).sum(2) / self.trust.sum()
        best = loss.argmin(1)
        odds = np.exp(-4 * (loss - loss.min(1, keepdims=True)))
        share = np.sort(odds / odds.sum(1, keepdims=True), axis=1)
        gap = share[:, -1] - (share[:, -2] if share.shape[1] > 1 else 0)
        return best, share[:, -1], gap < MARGIN


def train_on(x: np.ndarray, y: np.ndarray, languages: list[str]) -> Model:
    """Least-squares classifiers of the bits, solved over the sample's inner products."""
    words = codewords(len(languages))
    targets = words[y]
    bias = targets.mean(0)
    kernel = (x @ x.T).astype(float)
    solved = np.linalg.solve(kernel + RIDGE * np.eye(len(x)), targets - bias)
    hat = kernel @ np.linalg.inv(kernel + RIDGE * np.eye(len(x)))
    left_out = targets - ((targets - bias) - hat @ (targets - bias)) / np.maximum(1 - np.diag(hat), 1e-3)[:, None]
    wrong = np.clip((np.sign(left_out) != targets).mean(0), 0.5 / len(x), 0.5)
    trust = np.maximum(np.log((1 - wrong) / wrong), 1e-3)
    return Model(languages, words, (x.T.astype(float) @ solved).astype(np.float32), bias, trust)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def train(docs: DataFrame, rows: int = SAMPLE_ROWS, most_languages: int = MOST_LANGUAGES) -> Model | None:
    """A model of the documents' lang, from `rows` of them at most, in equal numbers for each language.

    Rows without lang or without a letter don't teach, and of more than `most_languages` values of lang those with
    the most distinct texts do. Copies of a text teach once, and a language of copies alone is learnt from that one.
    Which texts teach depends on their hashes alone, not on how the table lies. None if nothing teaches.
    """
    usable = docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    usable = usable.filter(F.col("lang").isNotNull() & has_letter(F.col("text"))).withColumn("text_hash", F.xxhash64("text"))
    languages = min(usable.select("lang").distinct().count(), most_languages)
    if not languages:
        return None
    chosen = drawn(usable.select("lang", "text_hash"), "lang", ["text_hash"], max(1, rows // languages), languages)
    chosen = materialize(chosen.select("lang", "text_hash"), "language-sample")  # the texts themselves stay in place

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [features(t).tobytes() for t in texts(batch["text"])]
            yield pa.RecordBatch.from_arrays([batch["lang"], pa.array(x, pa.binary())], names=["lang", "x"])

    taught = usable.join(chosen, ["lang", "text_hash"]).select("lang", "text").distinct()
    sample = taught.mapInArrow(run, "lang string, x binary").toPandas()
    sample = sample.sort_values(["lang", "x"], ignore_index=True)
    known = sorted(set(sample["lang"]))
    x = np.stack([np.frombuffer(v, np.float32) for v in sample["x"]])
    return train_on(x, np.array([known.index(v) for v in sample["lang"]]), known)


def predicted(model: Model | None, text: Column) -> Column:
    """struct<lang, score, ambiguous> of a text; lang is 'und' with score 0 for a null text, one without a
    letter, and where nothing was learnt."""
    unknown = F.struct(
        F.lit(UNKNOWN).alias("lang"), F.lit(0.0).cast("double").alias("score"), F.lit(True).alias("ambiguous")
    )
    if model is None:
        return unknown

    def run(column: pa.Array) -> pa.Array:
        lang, score, ambiguous = [], [], []
        values = list(texts(column))
        for at in range(0, len(values), 256):
            x = np.stack([features(t) for t in values[at : at + 256]])
            best, share, close = model.decode(x)
            lang += [model.languages[k] for k in best]
            score += share.tolist()
            ambiguous += close.tolist()
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(ambiguous, pa.bool_())],
            names=["lang", "score", "ambiguous"],
        )

    decoded = F.arrow_udf(run, "struct<lang:string,score:double,ambiguous:boolean>")(text.cast("string"))
    return F.when(has_letter(text), decoded).otherwise(unknown)
