"""The prefix trie of conversations, by sorted shards and a skeleton of splitter paths.

A conversation is a path of turns; a turn is 24 bytes of it, the MD5 of its role and text and the text's size, so a
prefix of the path names the same first turns. Paths, with their conversation's id, are range-partitioned by
splitters: points of that order, drawn from a sample weighted by turns. Ids are part of the order, so that a path
that a third of all conversations share is cut into many shards too.

A node whose conversations lie in more than one shard is a prefix of a splitter between them. The trie of the
splitters' paths, the skeleton, has a bounded size and goes to every task. Each shard is sorted by (path, id)
and finishes every other node by itself; for the skeleton nodes that it meets it sends partial sums, and
the ids that end there as pieces. The partial sums are reduced by skeleton node, and what the skeleton's
nodes owe to each other is added up over that bounded trie.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import materialize

#: Bytes of a turn on a path.
TURN = 24
#: Turns of a shard, on average, beyond which there are more shards than shuffle partitions.
SHARD_TURNS = 200_000
#: Sampled paths for each splitter, and bytes of all of them at most: a longer one is cut to a prefix.
SAMPLED = 40
SAMPLE_BYTES = 32 << 20
#: Ids in a piece of an ending list.
PIECE = 1 << 15

SHARD_ROW = (
    "skeleton long, shard long, piece long, conv_id long, depth long, parent_conv_id long, parent_skeleton long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, ends string"
)


def turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, present, turn, symbol): a hex symbol for each turn. Rows without a conv_id belong to no conversation."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    said = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, said).cast("binary"))
    symbol = F.concat(digest, F.lower(F.lpad(F.hex(F.octet_length(said).cast("long")), 16, "0")))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().alias("present"), "turn", symbol.alias("symbol"))
    return rows.filter("conv_id IS NOT NULL")


def head_size(conv_id: Column) -> Column:
    """How many first turns a conversation takes from the first of its five."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(9)).cast("int")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, path): the first h turns of conversation c - c % 5, then c's own after its first h.

    Turns go by number, null first; turns of one number by their digest. One exchange, by c - c % 5, serves
    both the gathering of turns and the taking of heads. A path is one value: 24 bytes for each turn.
    """
    rows = turns(conversations).withColumn("first_id", F.col("conv_id") - F.col("conv_id") % 5).repartition("first_id")
    ordered = F.array_sort(F.collect_list(F.struct("present", "turn", "symbol")))
    own = rows.groupBy("first_id", "conv_id").agg(F.transform(ordered, lambda t: t["symbol"]).alias("own"))
    heads = own.filter("conv_id = first_id").select("first_id", F.slice("own", 1, 8).alias("head"))
    both = own.join(heads, "first_id", "left").withColumn("h", head_size(F.col("conv_id")))
    head = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    tail = F.slice("own", F.col("h") + 1, F.greatest(F.size("own"), F.lit(1)))
    return both.select("conv_id", F.unhex(F.array_join(F.concat(head, tail), "")).alias("path"))


def shared_turns(a: bytes, b: bytes) -> int:
    """How many first turns two paths share."""
    most = min(len(a), len(b)) // TURN
    if a[: most * TURN] == b[: most * TURN]:
        return most
    low, high = 0, most  # the first `low` are equal, the first `high` are not
    while high - low > 1:
        middle = (low + high) // 2
        if a[low * TURN : middle * TURN] == b[low * TURN : middle * TURN]:
            low = middle
        else:
            high = middle
    return low


@dataclass
class Skeleton:
    """Splitters, ascending, and the trie of their paths: nodes in preorder, the root first."""

    splitters: list[tuple[bytes, float]]
    #: For each splitter the node at each depth.
    nodes: list[list[int]]
    parent: list[int]
    size: list[int]

    def shard(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))


def skeleton_of(splitters: list[tuple[bytes, float]]) -> Skeleton:
    nodes: list[list[int]] = []
    parent, size = [-1], [0]
    before, at = b"", [0]
    for path, _ in splitters:
        at = at[: shared_turns(before, path) + 1]
        for depth in range(len(at), len(path) // TURN + 1):
            parent.append(at[-1])
            size.append(int.from_bytes(path[depth * TURN - 8 : depth * TURN]))
            at.append(len(parent) - 1)
        nodes.append(at)
        before, at = path, list(at)
    return Skeleton(splitters, nodes, parent, size)


def chosen_splitters(paths: DataFrame, shards: int | None = None) -> list[tuple[bytes, float]]:
    """Points that cut (path, conv_id) into shards of about as many turns. A sample picks them, so they bound no result."""
    turns_of = F.floor(F.octet_length("path") / TURN) + 1
    told = paths.agg(F.count(F.lit(1)).alias("n"), F.sum(turns_of).alias("turns")).first()
    if shards is None:
        shards = max(int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(told["turns"] or 0) // SHARD_TURNS))
    if not told["n"] or shards < 2:
        return []
    share = min(1.0, SAMPLED * shards / told["n"])
    most = max(SAMPLE_BYTES // (SAMPLED * shards) // TURN, 1) * TURN
    near = paths.filter(F.shiftrightunsigned(F.xxhash64(F.lit(11), "conv_id"), 1) <= F.lit(share) * float(1 << 63))
    cut = F.octet_length("path") > most
    rows = near.select(F.substring("path", 1, most).alias("path"), F.when(~cut, F.col("conv_id")).alias("id"), turns_of.alias("turns")).collect()
    # A cut path stands before all that begin with it, whatever their ids
    points = sorted((bytes(r["path"]), float("-inf") if r["id"] is None else r["id"], r["turns"]) for r in rows)
    passed = np.cumsum([p[2] for p in points])
    at = np.searchsorted(passed, passed[-1] * np.arange(1, shards) / shards) if len(points) else []
    return sorted({points[k][:2] for k in at})


class Shard:
    """Builds the nodes of one shard from its paths in order."""

    def __init__(self, number: int, skeleton: Skeleton) -> None:
        self.number = number
        near = [k for k in (number - 1, number) if 0 <= k < len(skeleton.splitters)]
        self.beside = [(skeleton.splitters[k][0], skeleton.nodes[k]) for k in near]
        self.depth, self.parent, self.skeleton, self.size = [0], [-1], [0], [0]
        self.children, self.ending, self.first = [0], [0], [FAR]
        self.sha: dict[int, str] = {}
        self.pieces: list[tuple[int, str]] = []
        self.path = b""
        self.at = [0]
        self.hash = None
        self.waiting: list[str] = []

    def add(self, path: bytes, conv_id: int) -> None:
        if path != self.path:
            self.flush()
            self.open(path)
        node = self.at[-1]
        self.ending[node] += 1
        if conv_id < self.first[node]:
            self.first[node] = conv_id
        self.waiting.append(str(conv_id))
        if len(self.waiting) >= PIECE:
            self.send()

    def open(self, path: bytes) -> None:
        self.at = self.at[: shared_turns(self.path, path) + 1]
        known = [(shared_turns(path, other), nodes) for other, nodes in self.beside]
        for depth in range(len(self.at), len(path) // TURN + 1):
            self.depth.append(depth)
            self.parent.append(self.at[-1])
            self.size.append(int.from_bytes(path[depth * TURN - 8 : depth * TURN]))
            self.skeleton.append(next((nodes[depth] for shared, nodes in known if depth <= shared), -1))
            self.children.append(0)
            self.ending.append(0)
            self.first.append(FAR)
            if self.skeleton[-1] < 0:
                self.children[self.at[-1]] += 1
            self.at.append(len(self.depth) - 1)
        self.path = path

    def send(self) -> None:
        """The ids at hand go into the hash, or, for a skeleton node, into a piece."""
        if not self.waiting:
            return
        joined = ",".join(self.waiting)
        if self.skeleton[self.at[-1]] >= 0:
            self.pieces.append((self.skeleton[self.at[-1]], joined))
        elif self.hash is None:
            self.hash = hashlib.sha256(joined.encode())
        else:
            self.hash.update(b"," + joined.encode())
        self.waiting = []

    def flush(self) -> None:
        self.send()
        if self.hash is not None:
            self.sha[self.at[-1]] = self.hash.hexdigest()
            self.hash = None

    def rows(self) -> Iterator[pa.RecordBatch]:
        self.flush()
        count = len(self.depth)
        members, first, leaves, saved = self.ending, self.first, [0] * count, [0] * count
        for node in range(count - 1, 0, -1):  # children come after their parents
            if self.skeleton[node] >= 0:
                continue  # a skeleton node's own reduction hands its sums on
            above = self.parent[node]
            if not self.children[node]:
                leaves[node] += 1
            saved[node] += (members[node] - 1) * self.size[node]
            members[above] += members[node]
            leaves[above] += leaves[node]
            saved[above] += saved[node]
            if first[node] < first[above]:
                first[above] = first[node]
        parents = [first[p] if p >= 0 and self.skeleton[p] < 0 else None for p in self.parent]
        through = [self.skeleton[p] if p >= 0 and self.skeleton[p] >= 0 else None for p in self.parent]
        on = [s if s >= 0 else None for s in self.skeleton]
        hashes = [self.sha.get(k, EMPTY) if s is None else None for k, s in enumerate(on)]
        first = [f if f != FAR else None for f in first]
        none = [None] * count
        yield self.batch([on, [self.number] * count, none, first, self.depth, parents, through, members, self.children, leaves, saved, hashes, none])
        for at in range(0, len(self.pieces), 64):
            part = self.pieces[at : at + 64]
            blank = [None] * len(part)
            yield self.batch([[s for s, _ in part], [self.number] * len(part), list(range(at, at + len(part))), *[blank] * 9, [e for _, e in part]])

    @staticmethod
    def batch(columns: list[list]) -> pa.RecordBatch:
        kinds = [pa.string() if k >= 11 else pa.int64() for k in range(13)]
        names = [c.split()[0] for c in SHARD_ROW.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)


FAR = 1 << 63
EMPTY = hashlib.sha256(b"").hexdigest()


def shard_rows(paths: DataFrame, splitters: list[tuple[bytes, float]]) -> DataFrame:
    """Finished nodes, partial sums of skeleton nodes (piece and ends null), and pieces of their ending ids."""
    shared = paths.sparkSession.sparkContext.broadcast(skeleton_of(splitters))

    def number(path: pa.Array, conv_id: pa.Array) -> pa.Array:
        of = shared.value.shard
        return pa.array(map(of, path.to_pylist(), conv_id.to_pylist()), pa.int32())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: Shard | None = None
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                for which, path, conv_id in zip(part["shard"].to_pylist(), part["path"].to_pylist(), part["conv_id"].to_pylist(), strict=True):
                    if shard is None or shard.number != which:
                        if shard is not None:
                            yield from shard.rows()
                        shard = Shard(which, shared.value)
                    shard.add(path, conv_id)
        if shard is not None:
            yield from shard.rows()

    numbered = paths.withColumn("shard", F.arrow_udf(number, "int")(F.col("path"), F.col("conv_id")))
    dealt = numbered.repartitionById(len(splitters) + 1, F.col("shard"))
    return dealt.sortWithinPartitions("shard", "path", "conv_id").mapInArrow(run, SHARD_ROW)


def finished(skeleton: Skeleton, partial: pa.Table, hashes: dict[int, str]) -> pa.Table:
    """The skeleton's nodes, from their reduced partial sums: children hand on to their parents, last ones first."""
    count = len(skeleton.parent)
    at = partial["skeleton"].to_numpy()
    sums = {n: np.zeros(count, np.int64) for n in ("n_convs", "n_children", "n_leaves", "saved_tokens")}
    for name, values in sums.items():
        values[at] = partial[name].to_numpy()
    first = np.full(count, FAR, object)
    first[at] = [f if f is not None else FAR for f in partial["conv_id"].to_pylist()]
    members, children, leaves, saved = (v.tolist() for v in sums.values())
    depth = [0] * count
    for node in range(1, count):
        depth[node] = depth[skeleton.parent[node]] + 1
        children[skeleton.parent[node]] += 1
    for node in range(count - 1, -1, -1):
        leaves[node] += not children[node]
        saved[node] += (members[node] - 1) * skeleton.size[node]
        if (above := skeleton.parent[node]) >= 0:
            members[above] += members[node]
            leaves[above] += leaves[node]
            saved[above] += saved[node]
            first[above] = min(first[above], first[node])
    parents = [first[p] if p >= 0 else None for p in skeleton.parent]
    table = {
        "skeleton": range(count), "conv_id": first.tolist(), "depth": depth, "parent_conv_id": parents, "n_convs": members, "n_children": children,
        "n_leaves": leaves, "saved_tokens": saved, "ends_sha256": [hashes.get(k, EMPTY) for k in range(count)],
    }
    return pa.table({n: pa.array(v, pa.string() if n == "ends_sha256" else pa.int64()) for n, v in table.items()})


def hashed_pieces(pieces: DataFrame) -> DataFrame:
    """(skeleton, ends_sha256): pieces pass in order through one hash for each node; none is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, hash_ = None, None
        for batch in batches:
            done: list[tuple[int, str]] = []
            for which, ends in zip(batch["skeleton"].to_pylist(), batch["ends"].to_pylist(), strict=True):
                if which == node:
                    hash_.update(b"," + ends.encode())
                    continue
                if node is not None:
                    done.append((node, hash_.hexdigest()))
                node, hash_ = which, hashlib.sha256(ends.encode())
            yield result(done)
        if node is not None:
            yield result([(node, hash_.hexdigest())])

    def result(done: list[tuple[int, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())], names=["skeleton", "ends_sha256"])

    ordered = pieces.select("skeleton", "shard", "piece", "ends").repartition("skeleton").sortWithinPartitions("skeleton", "shard", "piece")
    return ordered.mapInArrow(run, "skeleton long, ends_sha256 string")


def trie(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """A row per node of the trie of all rebuilt conversations, the root included.

    (conv_id: the smallest member, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256).
    A conversation whose head is absent and whose own turns are all replaced ends at the root. Null roles and
    texts are empty; rows that repeat a turn are turns of their own; a table without conversations has no node.
    Other columns are not read. A conversation's path is a value of 24 bytes a turn, and a shard's nodes are held
    by its task; neither the driver nor a broadcast holds more than the splitters' paths, SAMPLE_BYTES at most.
    """
    paths = materialize(rebuilt(conversations), "trie-paths")
    splitters = chosen_splitters(paths, shards)
    rows = materialize(shard_rows(paths, splitters), "trie-shards")
    return combined(paths.sparkSession, rows, skeleton_of(splitters))


def combined(spark: SparkSession, rows: DataFrame, skeleton: Skeleton) -> DataFrame:
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    on_skeleton = rows.filter("skeleton IS NOT NULL")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    partial = on_skeleton.filter("piece IS NULL").groupBy("skeleton").agg(F.min("conv_id").alias("conv_id"), *sums).toArrow()
    if not partial.num_rows:
        return rows.select(*columns).limit(0)
    hashes = {r["skeleton"]: r["ends_sha256"] for r in hashed_pieces(on_skeleton.filter("piece IS NOT NULL")).collect()}
    top = spark.createDataFrame(finished(skeleton, partial, hashes))
    # No more rows than turns on the splitters' paths
    parents = F.broadcast(top.select(F.col("skeleton").alias("parent_skeleton"), F.col("conv_id").alias("above")))
    local = rows.filter("skeleton IS NULL").join(parents, "parent_skeleton", "left")
    local = local.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    return local.select(*columns).unionByName(top.select(*columns))
