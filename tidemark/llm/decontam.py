"""Benchmark decontamination: rare words and word pairs as seeds, then Smith-Waterman alignment.

Test items are cut into segments of bounded length. A first pass over all documents counts in how many
of them each word and each pair of neighbouring words of a segment occurs. The rarest become seeds, as many
as it takes for every alignment that reaches the score to hold one (`Block.choose_seeds`). A second pass looks
the seeds up in each document, drops what can't reach the score by a bound over its words (`stretches`), and
aligns the rest with the segment; the alignment is scored against the segment's own.

Documents are never shuffled or paired: both passes run where the texts are read. What is sent to the
tasks is a block of items of bounded size; a larger benchmark is worked off block by block.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, texts

#: Segments of fewer words are found as they are only.
SHORTEST = 3
#: Words of a segment; a longer item is several segments.
SEGMENT = 128
#: Words of the items in one block.
BLOCK_WORDS = 200_000
MIN_SCORE = 0.5
MATCH, MISMATCH, GAP = 2, -1, -1
#: Words per part in which a very long text is looked through.
PART_WORDS = 1 << 18

_SPACES = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
FOUND = "array<struct<item_id:bigint,score:double,first_word:bigint,last_word:bigint>>"


#: Scripts written without spaces: each of their characters is a word.
UNSPACED = ("Han", "Hiragana", "Katakana", "Bopomofo", "Thai", "Lao", "Khmer", "Myanmar")
_NAMES = ("CJK ", "HIRAGANA", "KATAKANA", "BOPOMOFO", "THAI ", "LAO ", "KHMER ", "MYANMAR ", "IDEOGRAPHIC ", "HALFWIDTH KATAKANA")
#: Beyond these the class of a character is looked up.
_LATIN = re.compile("[^\x00-\x7f\xc0-\xd6\xd8-\xf6\xf8-\u024f]")


class _Parted(dict):
    """What each character of a lower-case text becomes: itself, a space, or a word of its own."""

    def __missing__(self, code: int) -> str:
        char = chr(code)
        if unicodedata.category(char)[0] not in "LMN":
            part = " "
        else:
            part = f" {char} " if unicodedata.name(char, "").startswith(_NAMES) else char
        self[code] = part
        return part


_PARTED = _Parted()


def words_of(text: bytes) -> list[bytes]:
    """Lower-case words of letters and digits, or single characters of a script without spaces; all signs part words."""
    lower = text.decode("utf-8", "replace").lower()
    if not lower.isascii() and _LATIN.search(lower):
        lower = lower.translate(_PARTED)
    return lower.encode().translate(_SPACES).split()


@dataclass
class Segment:
    item: int
    ids: np.ndarray

    @property
    def needed(self) -> int:
        """The least score that counts; few words count only if all stand side by side."""
        return math.ceil((MIN_SCORE if len(self.ids) >= SHORTEST else 1) * MATCH * len(self.ids))


class Block:
    """Segments of some items, with their vocabulary and seeds."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.vocabulary: dict[bytes, int] = {}
        self.segments: list[Segment] = []
        for item, text in sorted(items):
            words = words_of(text)
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words], np.int64)
            pieces = max(1, math.ceil(len(ids) / SEGMENT))
            self.segments += [Segment(item, part) for part in np.array_split(ids, pieces) if len(part)]
        self.base = len(self.vocabulary) + 1
        if self.base >= 1 << 20:
            raise ValueError("a block's vocabulary must stay below 2**20 words")
        self.grams = np.unique(np.concatenate([self.codes(s.ids) for s in self.segments] or [np.zeros(0, np.int64)]))
        self.seed_codes = self.grams[:0]
        self.where: dict[int, list[int]] = {}

    def codes(self, ids: np.ndarray) -> np.ndarray:
        """The distinct numbers of the known words, and of the pairs of them that stand side by side."""
        a, b = ids[:-1], ids[1:]
        return np.unique(np.concatenate([ids[ids > 0], (a * self.base + b)[(a > 0) & (b > 0)]]))

    def ids(self, words: list[bytes]) -> np.ndarray:
        get = self.vocabulary.get
        return np.array([get(w, 0) for w in words], np.int64)

    def grams_of(self, text: bytes) -> np.ndarray:
        """Places in `grams` of the words and pairs that a text holds."""
        codes = self.codes(self.ids(words_of(text)))
        at = np.searchsorted(self.grams, codes)
        at[at == len(self.grams)] = 0
        return at[self.grams[at] == codes] if len(self.grams) else at[:0]

    def choose_seeds(self, documents: np.ndarray) -> None:
        """Of each segment the words and pairs in the fewest documents, so that every sufficient alignment holds one.

        Say that of n words M match and the score is s = 2 M - faults. Where M >= m, any n - m + 1 words hold a
        matching one. Otherwise at most 2 M - s of the M - 1 neighbouring matches are parted by a fault, so s - m
        pairs at least are whole, and any n - s + m of the n - 1 pairs hold a whole one. Of all m the one whose seeds
        occur in the fewest documents is taken. Seeds that occur nowhere count too, and cost nothing.
        """
        where = defaultdict(list)
        for number, segment in enumerate(self.segments):
            ids, size, needed = segment.ids, len(segment.ids), segment.needed
            words, pairs = (self._rarest(codes, documents) for codes in (ids, ids[:-1] * self.base + ids[1:]))
            least = math.ceil(needed / MATCH)
            ways = [(size - m + 1, 0 if m == least else size - needed + m) for m in range(least, size + 1) if m == least or m < needed]
            ways = [[*words[0][:a], *pairs[0][:b]] for a, b in ways]
            costs = dict(zip([*words[0], *pairs[0]], [*words[1], *pairs[1]], strict=True))
            for code in set(min(ways, key=lambda way: sum(costs[c] for c in set(way)))):
                if costs[code]:
                    where[code].append(number)
        self.where = dict(where)
        self.seed_codes = np.array(sorted(where), np.int64)

    def _rarest(self, codes: np.ndarray, documents: np.ndarray) -> tuple[list[int], list[int]]:
        """The codes and the number of documents that hold each, rarest first."""
        counts = documents[np.searchsorted(self.grams, codes)]
        order = np.argsort(counts, kind="stable")
        return codes[order].tolist(), counts[order].tolist()

    def find(self, text: bytes) -> list[tuple[int, float, int, int]]:
        """(item, score, first word, last word) of the best alignment with each item that reaches MIN_SCORE."""
        words = words_of(text)
        best: dict[int, tuple[float, int, int]] = {}
        for start in range(0, max(len(words), 1), PART_WORDS):
            part = words[max(0, start - 2 * SEGMENT) : start + PART_WORDS + 2 * SEGMENT]
            for item, score, a, b in self._find(self.ids(part)):
                if item not in best or score > best[item][0]:
                    shift = max(0, start - 2 * SEGMENT)
                    best[item] = (score, a + shift, b + shift)
        return [(item, *found) for item, found in sorted(best.items())]

    def _find(self, ids: np.ndarray) -> Iterator[tuple[int, float, int, int]]:
        if not len(self.seed_codes):
            return
        codes = self.codes(ids)
        at = np.searchsorted(self.seed_codes, codes)
        at[at == len(self.seed_codes)] = 0
        member = np.zeros(self.base, bool)
        for number in sorted({n for code in codes[self.seed_codes[at] == codes].tolist() for n in self.where[code]}):
            segment = self.segments[number]
            member[segment.ids] = True
            inside = member[ids]
            member[segment.ids] = False
            for first, last in stretches(inside, segment.needed):
                score, end = align(segment.ids, ids[first:last])
                if score >= segment.needed:
                    yield segment.item, score / (MATCH * len(segment.ids)), first, first + end


def stretches(inside: np.ndarray, needed: int) -> list[tuple[int, int]]:
    """Stretches of a text that hold all alignments with the score; `inside` tells the words that the segment has.

    An alignment gains MATCH by such a word at most, and loses one by any other. The sum of that along the text, begun
    anew wherever it falls to zero, bounds every alignment's score, and one that goes on beyond such a place
    is no worse without what lies before it.
    """
    if MATCH * np.count_nonzero(inside) < needed:
        return []
    sums = np.concatenate([[0], np.cumsum(np.where(inside, MATCH, -1))])
    lows = np.minimum.accumulate(sums)
    high = np.flatnonzero(sums - lows >= needed)
    if not len(high):
        return []
    zeros = np.flatnonzero(sums == lows)
    begins = np.searchsorted(zeros, high, "right") - 1
    out = []
    for k in np.unique(begins).tolist():
        out.append((int(zeros[k]), int(zeros[k + 1]) if k + 1 < len(zeros) else len(inside)))
    return out


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int]:
    """The best local alignment's score (Smith-Waterman, linear gaps) and its last word in the window."""
    along = np.arange(len(window) + 1) * -GAP
    row = np.zeros(len(window) + 1, np.int64)
    best, end = 0, 0
    for word in item.tolist():
        grown = np.maximum(row + GAP, 0)
        np.maximum(grown[1:], row[:-1] + np.where(window == word, MATCH, MISMATCH), out=grown[1:])
        row = np.maximum.accumulate(grown + along) - along  # gaps in the window
        k = int(row.argmax())
        if row[k] > best:
            best, end = int(row[k]), k - 1
    return best, end


def blocks(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """Blocks of items with their seeds chosen over all documents.

    Items of one or two words are found where all of their words stand side by side. Null items and items without
    words can't be found.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter(F.col("item_id").isNotNull() & F.col("text").isNotNull())
    alone = F.lit("[" + "".join(rf"\p{{Is{script}}}" for script in UNSPACED) + "]")
    size = items.agg(F.sum(F.size(F.split("text", r"[^\p{L}\p{N}]+")) + F.regexp_count("text", alone))).first()[0] or 0
    number = math.ceil(size / block_words)
    part = F.pmod(F.xxhash64("item_id"), F.lit(max(number, 1)))
    for k in range(number):
        rows = items.filter(part == k).collect()
        block = Block([(r["item_id"], r["text"].encode()) for r in rows])
        sent = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            counts = np.zeros(len(sent.value.grams), np.int64)
            for batch in batches:
                for text in texts(batch["text"]):
                    counts[sent.value.grams_of(text)] += 1
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["gram", "n"])

        counted = docs.select(F.col("text").cast("string")).mapInArrow(run, "gram long, n long")
        documents = np.zeros(len(block.grams), np.int64)
        for row in counted.groupBy("gram").agg(F.sum("n").alias("n")).collect():  # the block's words and pairs at most
            documents[row["gram"]] = row["n"]
        block.choose_seeds(documents)
        yield block


def found(docs: DataFrame, block: Block, text: Column) -> Column:
    """An array of struct<item_id, score, first_word, last_word> for a text."""
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def run(column: pa.Array) -> pa.Array:
        names = ("item_id", "score", "first_word", "last_word")
        rows = [[dict(zip(names, hit, strict=True)) for hit in sent.value.find(t)] for t in texts(column)]
        kind = pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("first_word", pa.int64()), ("last_word", pa.int64())])
        return pa.array(rows, pa.list_(kind))

    return F.arrow_udf(run, FOUND)(text.cast("string"))


def leaks(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word): each item that a document holds, copied or edited.

    A row for each row of docs and item; null and empty texts hold none. Items that repeat an item_id are one
    item with the best score. Other columns are not read.
    """
    result = None
    for block in blocks(docs, benchmark, block_words):
        hits = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(found(docs, block, F.col("text"))).alias("f"))
        hits = hits.select("doc_id", "f.*")
        result = hits if result is None else result.unionAll(hits)
    if result is None:
        return docs.sparkSession.createDataFrame(
            [], "doc_id long, item_id long, score double, first_word long, last_word long"
        )
    return result


def clean(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Documents that hold no item, with all their columns."""
    kept = docs
    for block in blocks(docs, benchmark, block_words):
        mark = fresh(kept, "_leaks")
        kept = kept.withColumn(mark, found(docs, block, F.col("text"))).filter(F.size(mark) == 0).drop(mark)
    return kept
