"""Repeated byte strings across documents, found by sorting sampled suffixes.

A suffix array over every byte would shuffle more than the corpus several times over, so suffixes are
sampled by content. Among the 161 places of a window of `length` bytes where `key` bytes begin, the one
whose key has the smallest hash is the window's anchor: equal windows have their anchor at the same
offset. An anchor stands for the run of windows that chose it, and for the bytes those windows span.

1. Keys that occur once are dropped; their windows can't repeat. Where all spans of a key are equal,
   every window of it repeats. Both are decided by counts that combine before their shuffle.
2. For the other keys one context (the bytes spanned) of each distinct span is fetched. Contexts are
   partitioned by range over their leading bytes, with splitters that Spark samples, and sorted; in each
   bucket the windows of neighbouring contexts with one key are sorted and compared. Equal leading bytes
   lie in one bucket, so no class crosses its boundary.
3. A key with more than `wide` different contexts doesn't go to one bucket. Its windows are taken 32
   offsets at a time: counts of the bytes that they share, and of all that they span, settle most of them,
   and the rest goes on in halves down to single windows.

Windows are compared by 64-bit hashes, documents by their hash and size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts
from tidemark.session import materialize

LENGTH = 200
KEY = 40
#: Contexts of a key that are compared in one task.
WIDE = 1000
#: Offsets that the comparisons of a wide key take together.
STEP_WIDTHS = (32, 16, 8, 4, 2, 1)
#: Bytes of a text that are hashed at a time.
PART = 1 << 19
#: Contexts that are hashed at a time.
BATCH = 1500

_INDEX_BITS = 20
_INDEX = np.uint64((1 << _INDEX_BITS) - 1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


@cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random number for each byte, and the powers of the factor and of its inverse."""
    size = 1 << _INDEX_BITS
    powers = []
    for base in (_FACTOR, _INVERSE):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        powers.append(np.multiply.accumulate(p))
    rng = np.random.default_rng(9)
    return rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1), powers[0], powers[1]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Sums:
    """Hashes of any substrings of some bytes, out of prefix sums."""

    def __init__(self, data: np.ndarray):
        values, powers, self.inverse = _tables()
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * powers[: len(data)], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start])

    def every(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.inverse[:n])


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest value of each run of `width`, from the minima of blocks in both directions."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.uint64(0xFFFFFFFFFFFFFFFF))
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def anchors_of(text: bytes, length: int = LENGTH, key: int = KEY) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor, first window, last window, key hash, span hash) of a text, in parts."""
    width = length - key + 1
    for at in range(0, len(text) - length + 1, PART):
        data = np.frombuffer(text, np.uint8, count=min(PART + length - 1, len(text) - at), offset=at)
        sums = Sums(data)
        keys = sums.every(key)
        tagged = (keys & ~_INDEX) | np.arange(len(keys), dtype=np.uint64)
        chosen = (sliding_minimum(tagged, width) & _INDEX).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(np.diff(chosen)) + 1])
        last = np.concatenate([first[1:] - 1, [len(chosen) - 1]])
        anchor = chosen[first]
        shape = ((anchor - first) << 20 | (last - first)).astype(np.uint64)
        span = mixed(sums.hash(first, last + length) ^ mixed(shape + np.uint64(1)))
        yield anchor + at, first + at, last + at, keys[anchor], span


def text_key(text: Column) -> list[Column]:
    whole = F.coalesce(text.cast("string"), F.lit(""))
    return [F.xxhash64(whole).alias("text_hash"), F.octet_length(whole).alias("size")]


ANCHORS = "text_hash long, size int, anchor int, first int, last int, key long, span long"


def anchors(docs: DataFrame, length: int, key: int) -> DataFrame:
    names = [f.split()[0] for f in ANCHORS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, rows = [], 0
            for text, text_hash, size in zip(texts(batch["text"]), batch["text_hash"].to_pylist(), batch["size"].to_pylist(), strict=True):
                for found in anchors_of(text, length, key):
                    parts.append((text_hash, size, found))
                    rows += len(found[0])
                if rows > 50_000:
                    yield table(parts)
                    parts, rows = [], 0
            yield table(parts)

    def table(parts: list) -> pa.RecordBatch:
        counts = [len(found[0]) for _, _, found in parts]
        columns = [np.repeat(np.array([p[k] for p in parts], kind), counts) for k, kind in ((0, np.int64), (1, np.int32))]
        for k, kind in enumerate((np.int32, np.int32, np.int32)):
            columns.append(np.concatenate([p[2][k] for p in parts] or [np.zeros(0)]).astype(kind))
        for k in (3, 4):
            columns.append(np.concatenate([p[2][k] for p in parts] or [np.zeros(0, np.uint64)]).view(np.int64))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    rows = docs.select(F.col("text").cast("string").alias("text"), *text_key(F.col("text")))
    return rows.filter(F.col("size") >= length).mapInArrow(run, ANCHORS)


CONTEXTS = "key long, span long, n long, low int, high int, lead binary, bytes binary"
CLASSES = "key long, span long, low int, high int"


def contexts(docs: DataFrame, wanted: DataFrame, length: int, key: int) -> DataFrame:
    """The bytes of the wanted spans (text_hash, size, anchor, first, last, key, span, n).

    Each is read from one document: that with the smallest doc_id among those with the text. Offsets from low
    to high say how far the span's windows begin before its anchor; lead holds the bytes at the anchor.
    """
    owners = docs.select(*text_key(F.col("text")), F.col("doc_id").cast("long").alias("doc_id"))
    owners = owners.groupBy("text_hash", "size").agg(F.min("doc_id").alias("doc_id"))
    spans = F.collect_list(F.struct("key", "span", "n", "anchor", "first", "last")).alias("spans")
    wanted = wanted.groupBy("text_hash", "size").agg(spans).join(owners, ["text_hash", "size"])
    wanted = wanted.select("text_hash", "size", F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "spans")
    rows = docs.select(F.col("text").cast("string").alias("text"), *text_key(F.col("text")), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"))
    met = rows.join(wanted, ["text_hash", "size", "doc_id"]).withColumn("text", F.col("text").cast("binary"))
    met = met.select("text", F.explode("spans").alias("s")).select("text", "s.*")
    start, low = F.col("first") + 1, F.col("anchor") - F.col("last")
    return met.select(
        "key", "span", "n", low.alias("low"), (F.col("anchor") - F.col("first")).alias("high"),
        F.substring("text", F.col("anchor") + 1, F.lit(key)).alias("lead"),
        F.substring("text", start, F.col("last") - F.col("first") + length).alias("bytes"),
    ).dropDuplicates(["key", "span"])  # rows that repeat both doc_id and text


def compare(found: DataFrame, length: int) -> DataFrame:
    """(key, span, low, high): runs of offsets whose windows repeat, for contexts sorted by their leading bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if len(held) >= BATCH and row["key"] != held[-1]["key"]:
                    yield classes(held, length)
                    held = []
                held.append(row)
        if held:
            yield classes(held, length)

    return found.repartitionByRange("lead", "key").sortWithinPartitions("lead", "key").mapInArrow(run, CLASSES)


def offsets_of(rows: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of some contexts: its context, its offset, and where it begins in their joined bytes."""
    sizes = np.array([r["high"] - r["low"] + 1 for r in rows])
    begins = np.concatenate([[0], np.cumsum([len(r["bytes"]) for r in rows])[:-1]])
    owner = np.repeat(np.arange(len(rows)), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    high = np.array([r["high"] for r in rows])
    return owner, high[owner] - place, begins[owner] + place


def joined(rows: list[dict]) -> np.ndarray:
    return np.frombuffer(b"".join(r["bytes"] for r in rows), np.uint8)


def window_codes(rows: list[dict], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    owner, offset, start = offsets_of(rows)
    keys = np.array([r["key"] for r in rows], np.int64).view(np.uint64)
    hashes = Sums(joined(rows)).hash(start, start + length)
    return owner, offset, mixed(hashes ^ mixed(keys[owner] + (offset.astype(np.uint64) + np.uint64(1)) * _FACTOR))


def classes(rows: list[dict], length: int) -> pa.RecordBatch:
    """Runs of repeated windows among contexts, those of a key together."""
    owner, offset, codes = window_codes(rows, length)
    order = np.argsort(codes, kind="stable")
    same = codes[order][1:] == codes[order][:-1]
    repeated = np.zeros(len(codes), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    repeated |= (np.array([r["n"] for r in rows]) > 1)[owner]
    return runs(rows, owner, offset, repeated)


def runs(rows: list[dict], owner: np.ndarray, offset: np.ndarray, repeated: np.ndarray) -> pa.RecordBatch:
    """Maximal runs of marked offsets in each context; offsets fall along a context."""
    edge = np.diff(np.concatenate([[-1], owner])) != 0
    begins = np.flatnonzero(repeated & (edge | ~np.concatenate([[False], repeated[:-1]])))
    closing = np.concatenate([edge[1:], [True]])
    ends = np.flatnonzero(repeated & (closing | ~np.concatenate([repeated[1:], [False]])))
    keys = np.array([r["key"] for r in rows], np.int64)[owner[begins]]
    spans = np.array([r["span"] for r in rows], np.int64)[owner[begins]]
    return pa.RecordBatch.from_arrays(
        [pa.array(keys), pa.array(spans), pa.array(offset[ends].astype(np.int32)), pa.array(offset[begins].astype(np.int32))],
        names=["key", "span", "low", "high"],
    )


STEPS = "key long, span long, n long, step int, low int, high int, shared long, own long"


def steps(rows: DataFrame, length: int, step: int) -> DataFrame:
    """The wanted windows of contexts, `step` offsets at a time: the hash of the bytes that a full step of
    windows shares, and that of what these windows span. ranges: the wanted offsets, null for all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            for at in range(0, len(rows), BATCH):
                yield part(rows[at : at + BATCH])

    def part(rows: list[dict]) -> pa.RecordBatch:
        sums = Sums(joined(rows))
        owner, offset, start = offsets_of(rows)
        wanted = np.zeros(len(owner), bool)
        begins = np.searchsorted(owner, np.arange(len(rows)))
        for begin, row in zip(begins, rows, strict=True):
            for r in row["ranges"] or [row]:
                wanted[begin + row["high"] - r["high"] : begin + row["high"] - r["low"] + 1] = True
        owner, offset, start = owner[wanted], offset[wanted], start[wanted]
        number = offset // step
        begin = np.flatnonzero(np.diff(np.concatenate([[-1], owner])) | np.diff(np.concatenate([[-1], number])))
        end = np.concatenate([begin[1:], [len(owner)]]) - 1
        anchor = start[begin] + offset[begin]
        low, high = offset[end], offset[begin]
        shared = sums.hash(anchor - number[begin] * step, anchor - number[begin] * step - (step - 1) + length)
        own = mixed(sums.hash(anchor - high, anchor - low + length) ^ mixed((high << 20 | low).astype(np.uint64)))
        take = lambda name: np.array([r[name] for r in rows], np.int64)[owner[begin]]
        numbers = [x.astype(np.int32) for x in (number[begin], low, high)]
        columns = [take("key"), take("span"), take("n"), *numbers, shared.view(np.int64), own.view(np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[f.split()[0] for f in STEPS.split(", ")])

    return rows.select("key", "span", "n", "low", "high", "bytes", "ranges").mapInArrow(run, STEPS)


def compare_wide(found: DataFrame, length: int) -> DataFrame:
    """As compare, for keys of any number of contexts: by counts alone.

    Offsets are taken in steps of falling width. Rows whose shared bytes occur once can't repeat; where all
    that share them span the same bytes, all their windows repeat. Only the others go on to half the width.
    """
    span = F.struct("low", "high")
    ranges = found.select("key", "span", F.lit(None).cast("array<struct<low:int,high:int>>").alias("ranges"))
    settled = []
    for step in STEP_WIDTHS:
        rows = materialize(steps(found.join(ranges, ["key", "span"]), length, step), "substrings-steps")
        met = ["key", "step", "shared"]
        groups = rows.groupBy(*met).agg(F.sum("n").alias("all"), F.min("own").alias("a"), F.max("own").alias("b"))
        # Written before the join, which Spark can then split where many contexts share their bytes
        groups = materialize(groups.filter("all > 1").select(*met, F.expr("a != b").alias("mixed")), "substrings-groups")
        marked = rows.join(groups, met).select("key", "span", "n", "low", "high", "mixed")
        marked = materialize(marked, "substrings-marked")
        settled.append(marked.filter("NOT mixed OR n > 1").select("key", "span", "low", "high"))
        # Rows that are settled in a mixed group stay in it, for others to be equal to
        ranges = marked.filter("mixed").groupBy("key", "span").agg(F.collect_list(span).alias("ranges"))
    return reduce(DataFrame.unionByName, settled)


def repeated(docs: DataFrame, length: int = LENGTH, key: int = KEY, wide: int = WIDE) -> DataFrame:
    """(text_hash, size, ranges): for each text the byte ranges covered by strings of `length` bytes that
    start anywhere else too, unmerged. Texts without any are left out."""
    sampled = anchors(docs, length, key)
    keys = sampled.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("span").alias("a"), F.max("span").alias("b"))
    # Written before the join, which Spark can then split at keys with very many anchors
    keys = materialize(keys.filter("n > 1").select("key", F.expr("a = b").alias("equal")), "substrings-keys")
    suspects = materialize(sampled.join(keys, "key"), "substrings-anchors")
    covered = suspects.filter("equal").select("text_hash", "size", F.col("first").alias("start"), (F.col("last") + length).alias("end"))

    unequal = suspects.filter("NOT equal")
    one = F.min(F.struct("text_hash", "size", "anchor", "first", "last")).alias("one")
    distinct = unequal.groupBy("key", "span").agg(F.count(F.lit(1)).alias("n"), one)
    distinct = distinct.select("one.*", "key", "span", "n")
    found = materialize(contexts(docs, distinct, length, key), "substrings-contexts")
    many = found.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") > wide).select("key")
    many = materialize(many, "substrings-wide")
    alike = compare(found.join(many, "key", "left_anti"), length)
    if not many.isEmpty():
        alike = alike.unionByName(compare_wide(found.join(many, "key", "left_semi"), length))
    alike = materialize(alike, "substrings-classes")

    settled = unequal.join(alike, ["key", "span"])
    settled = settled.select(
        "text_hash", "size", (F.col("anchor") - F.col("high")).alias("start"), (F.col("anchor") - F.col("low") + length).alias("end")
    )
    ranges = covered.unionByName(settled).distinct()
    return ranges.groupBy("text_hash", "size").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("ranges"))


def merged(ranges: list[dict]) -> list[tuple[int, int]]:
    """Sorted ranges with those that overlap or touch joined."""
    out: list[list[int]] = []
    for r in ranges:
        if out and r["start"] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], r["end"])
        else:
            out.append([r["start"], r["end"]])
    return [tuple(r) for r in out]


REMOVED = "struct<n_removed:bigint,n_spans:bigint,kept_sha256:string,kept:binary>"


def remove(docs: DataFrame, length: int = LENGTH, key: int = KEY, wide: int = WIDE, with_bytes: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row of documents.

    Each byte that lies in a string of `length` bytes which also starts elsewhere, in the same text or another,
    is taken out; strings are judged on the input. Null texts are empty, texts shorter than the length stay
    whole, and rows that repeat a text lose all of it from that length on. Matches don't cross documents, and
    may begin or end within a character, so what is kept is bytes. Other columns are not read.
    """
    ranges = materialize(repeated(docs, length, key, wide), "substrings-ranges")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *text_key(F.col("text")))
    met = rows.join(ranges, ["text_hash", "size"], "left")

    def run(column: pa.Array, lists: pa.Array) -> pa.Array:
        removed, spans, digests, left = [], [], [], []
        for text, some in zip(texts(column), lists.to_pylist(), strict=True):
            cut = merged(some or [])
            parts, past = [], 0
            for a, b in cut:
                parts.append(text[past:a])
                past = b
            rest = b"".join([*parts, text[past:]])
            removed.append(sum(b - a for a, b in cut))
            spans.append(len(cut))
            digests.append(hashlib.sha256(rest).hexdigest())
            left.append(rest if with_bytes else None)
        return pa.StructArray.from_arrays(
            [pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string()), pa.array(left, pa.binary())],
            names=["n_removed", "n_spans", "kept_sha256", "kept"],
        )

    cut = met.select("doc_id", F.col("size").cast("long").alias("n_bytes"), F.arrow_udf(run, REMOVED)("text", "ranges").alias("r"))
    return cut.select("doc_id", "n_bytes", "r.*")
