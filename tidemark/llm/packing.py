"""Token packing: whole documents into sequences of a fixed capacity, by minimum bin slack.

A document is its token ids and a closing id. Full windows are cut off its front and are sequences
of their own; the remainders are packed. For each new sequence the longest remainder is set, and a
subset-sum over the counts of the remaining lengths, kept as the bits of one integer, finds the
multiset that leaves the least slack; the multiset is read back from the stored steps. Sequences
that would leave slack above the tolerance are not closed: their pieces wait for the next block.
What still waits when a task's rows end is laid end to end and cut at the capacity, so that each
task pads one sequence.

Work is one pass in the tasks that read the texts: no shuffle, nothing on the driver. A block holds
at most `block_tokens` tokens (and one document's windows), which bounds a task's memory. A sequence
id is the task's number in the upper bits and the running number of the sequence in the task.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts

CAPACITY = 2048
CLOSING_ID = 1
BLOCK_TOKENS = 4_000_000
#: Slack of a closed sequence, as a share of the capacity.
TOLERANCE = 1 / 256
#: A text is encoded in parts of about so many characters, cut where no token can cross.
PART_CHARS = 1_000_000
SEQUENCE_BITS = 36

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


@cache
def encoding(vocabulary: str) -> tiktoken.Encoding:
    """The byte-level vocabulary at a path; <|endoftext|> in a text is the special token, as in its JSON form."""
    import public_tokenizers

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "vocabulary",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=ranks,
        special_tokens={"<|endoftext|>": len(ranks)},
    )


def default_vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def parts(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """A long text in parts. A cut lies before a single space between two visible characters: every
    pattern of the vocabulary ends there, so the parts' ids are those of the whole text."""
    at = 0
    while len(text) - at > size:
        cut = at + size
        while True:
            cut = text.find(" ", cut)
            if cut < 0 or cut + 1 >= len(text):
                cut = len(text)
                break
            if not text[cut - 1].isspace() and not text[cut + 1].isspace():
                break
            cut += 1
        yield text[at:cut]
        at = cut
    yield text[at:]


def token_ids(text: str, vocabulary: str) -> np.ndarray:
    encode = encoding(vocabulary).encode_to_numpy
    found = [encode(part, allowed_special="all") for part in parts(text)]
    return found[0] if len(found) == 1 else np.concatenate(found)


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, at most counts[length] of each, whose sum comes closest to the capacity.

    Bit s of `sums` is set if some multiset of the lengths seen so far adds up to s. Counts are taken
    in binary parts, so a length costs a logarithmic number of shifts. Among equals the multiset that
    uses the longest lengths first stays.
    """
    within = (1 << (capacity + 1)) - 1
    sums, steps = 1, []
    for length in sorted((x for x in counts if x <= capacity and counts[x] > 0), reverse=True):
        left, take = min(counts[length], capacity // length), 1
        while left:
            take = min(take, left)
            grown = (sums | sums << (take * length)) & within
            if grown != sums:
                steps.append((sums, length, take))
                sums = grown
            left -= take
            take *= 2
        if sums >> capacity & 1:
            break
    total, chosen = sums.bit_length() - 1, defaultdict(int)
    for before, length, take in reversed(steps):
        if not before >> total & 1:
            total -= take * length
            chosen[length] += take
    return dict(chosen)


def close(counts: dict[int, int], capacity: int, slack: int) -> Iterator[tuple[dict[int, int], int]]:
    """Multisets that fill a sequence up to the slack, each with how often it is used.

    The longest remaining length starts each sequence. One that no multiset completes is put aside
    for this block, with its count left in `counts`.
    """
    open_ = {length: n for length, n in counts.items() if n > 0}
    while open_:
        longest = max(open_)
        rest = dict(open_)
        rest[longest] -= 1
        chosen = fill(rest, capacity - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        if capacity - sum(length * n for length, n in chosen.items()) > slack:
            del open_[longest]
            continue
        times = min(open_[length] // n for length, n in chosen.items())
        for length, n in chosen.items():
            for kept in (counts, open_):
                kept[length] -= n * times
                if not kept[length]:
                    del kept[length]
        yield chosen, times


class Packer:
    """The pieces of one task."""

    def __init__(self, task: int, capacity: int, block_tokens: int, tolerance: float):
        self.capacity, self.block_tokens = capacity, block_tokens
        self.slack = int(tolerance * capacity)
        self.next = task << SEQUENCE_BITS
        self.waiting: dict[int, list] = defaultdict(list)
        self.tokens = 0
        self.ready: list[tuple] = []

    def place(self, piece: tuple, sequence: int, offset: int) -> None:
        doc_id, start, ids, whole = piece
        self.ready.append((doc_id, start, len(ids), ids.astype("<u4").tobytes(), whole, sequence, offset))

    def add(self, doc_id, ids: np.ndarray) -> None:
        whole = len(ids)
        cut = whole - whole % self.capacity
        for start in range(0, cut, self.capacity):
            self.place((doc_id, start, ids[start : start + self.capacity], whole), self.next, 0)
            self.next += 1
        if cut < whole:
            self.waiting[whole - cut].append((doc_id, cut, ids[cut:], whole))
            self.tokens += whole - cut

    def pack(self) -> None:
        counts = {length: len(pieces) for length, pieces in self.waiting.items()}
        for chosen, times in close(counts, self.capacity, self.slack):
            for _ in range(times):
                offset = 0
                for length, n in sorted(chosen.items(), reverse=True):
                    for _ in range(n):
                        self.place(self.waiting[length].pop(), self.next, offset)
                        offset += length
                        self.tokens -= length
                self.next += 1
        self.waiting = defaultdict(list, {length: pieces for length, pieces in self.waiting.items() if pieces})
        if self.tokens > self.block_tokens // 2:
            self.lay()

    def lay(self) -> None:
        """Lay the waiting pieces end to end and cut at the capacity; the last sequence may stay short."""
        used = 0
        for length in sorted(self.waiting, reverse=True):
            for doc_id, start, ids, whole in self.waiting[length]:
                at = 0
                while at < len(ids):
                    part = ids[at : at + self.capacity - used]
                    self.place((doc_id, start + at, part, whole), self.next, used)
                    at += len(part)
                    used += len(part)
                    if used == self.capacity:
                        self.next, used = self.next + 1, 0
        self.next += used > 0
        self.waiting, self.tokens = defaultdict(list), 0

    def out(self, schema: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*self.ready, strict=True)) or [[] for _ in schema]
        self.ready = []
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def pack(
    docs: DataFrame,
    capacity: int = CAPACITY,
    vocabulary: str | None = None,
    closing_id: int = CLOSING_ID,
    block_tokens: int = BLOCK_TOKENS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """Pieces of the documents (doc_id, text) with their place: doc_id, start, length, ids (little-endian
    unsigned 32-bit), doc_tokens, sequence_id, offset.

    A null or empty text is its closing id alone. Null and repeated doc_ids are documents of their own.
    Other columns of the documents are not read. An empty table gives no piece.
    """
    path = vocabulary or default_vocabulary()
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
         ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(TaskContext.get().partitionId(), capacity, block_tokens, tolerance)
        end = np.array([closing_id], np.uint32)
        unsent = 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), texts(batch["text"]), strict=True):
                ids = np.concatenate([token_ids(text.decode("utf-8", "replace"), path), end])
                packer.add(doc_id, ids)
                unsent += len(ids)
                if packer.tokens > packer.block_tokens:
                    packer.pack()
                if unsent > 500_000 or len(packer.ready) > 5_000:
                    yield packer.out(schema)
                    unsent = 0
        packer.pack()
        packer.lay()
        yield packer.out(schema)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, PIECES)
