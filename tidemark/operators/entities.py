"""Dictionary entities in texts, found by a trie of the dictionary's tokens.

The dictionary goes to the tasks in blocks of bounded size, split by the entities' first words, and each task walks
its texts along the trie of a block. A word that starts no entity costs one look-up; no word or run of words
ever leaves its row, so there is neither a shuffle nor a join.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.session import materialize

#: Bytes of the entities and labels of a block, on average.
BLOCK_BYTES = 16 << 20
HITS = "array<struct<pos:int,entity:string,label:string>>"
#: Where a node of the trie keeps the labels of the entity that ends there; no word is empty.
END = b""


def trie_of(entries: Iterable[tuple[str, str]], longest: int) -> dict:
    """Nested dictionaries by word. An entry without a word or label, or with too many words, matches nothing, nor
    does one whose words aren't parted by single spaces."""
    root: dict = {}
    for entity, label in entries:
        if entity is None or label is None:
            continue
        words = entity.encode().split()
        if not 0 < len(words) <= longest or b" ".join(words) != entity.encode():
            continue
        node = root
        for word in words:
            node = node.setdefault(word, {})
        node.setdefault(END, []).append(label)
    for node in _nodes(root):
        if END in node:
            node[END].sort(key=str.encode)
    return root


def _nodes(root: dict) -> Iterable[dict]:
    waiting = [root]
    while waiting:
        node = waiting.pop()
        yield node
        waiting += [child for word, child in node.items() if word != END]


def matches(text: bytes, root: dict) -> list[dict]:
    """The entities of a text: by position from 1, shorter ones first, labels in order."""
    words = text.split()
    found = []
    for start, word in enumerate(words):
        node = root.get(word)
        at = start
        while node is not None:
            if END in node:
                entity = b" ".join(words[start : at + 1]).decode("utf-8", "replace")
                found += [{"pos": start + 1, "entity": entity, "label": label} for label in node[END]]
            at += 1
            node = node.get(words[at]) if at < len(words) else None
    return found


def hits(clean_text: Column, sent: Broadcast) -> Column:
    """Array of (pos, entity, label) of a text; empty for a null one."""

    def run(column: pa.Array) -> pa.Array:
        root = sent.value
        rows = []
        for at in range(0, len(column), 256):
            part = column.slice(at, 256).cast(pa.large_binary())
            rows += [matches(text, root) if text else [] for text in part.to_pylist()]
        return pa.array(rows, pa.list_(pa.struct([("pos", pa.int32()), ("entity", pa.string()), ("label", pa.string())])))

    return F.arrow_udf(run, HITS)(clean_text.cast("string"))


def tag_entities(
    processed: DataFrame,
    dictionary: DataFrame,
    longest: int = 1,
    keys: tuple[str, ...] = ("id", "source", "timestamp"),
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Entities of every document, in text order; documents without any keep an empty array.

    Runs of 1 to `longest` words of `clean_text`, parted by white space, are matched against the dictionary (entity,
    label); an entry that the dictionary repeats counts as often. Every row comes back once, null and repeated
    keys too. A dictionary of one block takes one pass over the texts. A larger one takes a pass for each block:
    the hits so far are written beside the texts, so the driver and the tasks hold one block at a time.
    """
    spark = processed.sparkSession
    size = F.sum(F.octet_length("entity") + F.octet_length("label"))
    blocks = max(-(-(dictionary.agg(size).first()[0] or 0) // block_bytes), 1)
    rows = processed.select(*keys, F.col("clean_text").alias("_text"))
    first = F.substring_index("entity", " ", 1)
    found: list[str] = []
    for number in range(blocks):
        part = dictionary.select("entity", "label").filter(F.pmod(F.xxhash64(first), F.lit(blocks)) == number)
        sent = spark.sparkContext.broadcast(trie_of(((r["entity"], r["label"]) for r in part.collect()), longest))
        found.append(f"_hits{number}")
        rows = rows.withColumn(found[-1], hits(F.col("_text"), sent))
        if number + 1 < blocks:
            rows = materialize(rows, "entities")
            sent.unpersist()
    every = reduce(lambda a, b: F.concat(a, b), map(F.col, found))
    if blocks > 1:
        # Blocks part the entities by first word, so at each position only one of them has any
        every = F.array_sort(every, lambda a, b: a["pos"] - b["pos"])
    shown = F.transform(every, lambda h: F.struct(h["entity"].alias("entity"), h["label"].alias("label")))
    return rows.select(*keys, shown.cast(schemas.ENTITIES).alias("entities"))
