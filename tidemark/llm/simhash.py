"""SimHash near-duplicates with a pigeonring filter.

A fingerprint has a bit set where over half the hashes of the text's word shingles have it. Two
fingerprints of 64 bits that differ in at most t bits, cut into a ring of m segments, have a segment
from which on every chain of l segments differs in at most l * t / m bits (the pigeonring principle).
So some run of segments with a budget below one is equal: that run is the join key. Of the pairs it
yields, those that break the budget of a longer chain are dropped before the full Hamming check.

Equal fingerprints are grouped first, and only one row of each goes on. A key with more than
`wide` fingerprints doesn't emit its pairs: two fingerprints at most two bits apart have a common
neighbour at most one bit from each, so its members are linked by the neighbours that they share,
65 rows a fingerprint however many there are. Both ways together find every link.

Documents with a similar wording (`near_duplicates`) are linked the same way first: fingerprints, pigeonring,
Hamming check, then the Jaccard similarity of the two shingle sets, which decides. What it takes for similar grows
past what any run of equal bits could index, so pairs that are further apart in bits, and still in different classes,
come from a prefix filter: of two texts with that share of shingles in common, the rarest shingles of each hold a
common one. Sizes and parity bits drop pairs that can't be similar, and the same similarity decides.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, fresh, lower_words, starts_and_ends, texts
from tidemark.session import materialize

SHINGLE = 3
MAX_BITS = 2
SEGMENTS = 16
#: Fingerprints of a key that are compared pair by pair; beyond, shared neighbours link them.
WIDE = 48
HASH_SEED = 42

NEAR_SHINGLE = 5
SIMILARITY = 0.8
#: Longs of parity bits of a short text.
PARITIES = 8
#: One in so many distinct texts is counted for the order of shingles, and so many shingles at most have a count.
SAMPLED = 32
COMMON = 1 << 18
#: Bits of the map that keeps most texts that are not asked for out of a shuffle: at most 1 MB to send.
SIEVE = 1 << 23
#: Texts of a key whose pairs are listed; those of a larger key are compared in blocks of about BLOCK.
CROWDED = 48
BLOCK = 2048


def shingle_hashes(words: list[bytes], size: int) -> np.ndarray:
    """XXH64 of each run of `size` words joined by spaces; fewer words are one run."""
    if not words:
        return np.zeros(0, np.uint64)
    joined, starts, ends = starts_and_ends(words)
    ends = ends[min(size, len(ends)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], HASH_SEED) for a, b in zip(starts, ends)], np.uint64)


def majority(hashes: np.ndarray) -> list[int]:
    """For each column of hashes the 64 bits set in over half of its rows; 0 for no rows."""
    octets = hashes.astype(">u8").view(np.uint8)
    counts = np.zeros(8 * octets.shape[1], np.int64)
    for at in range(0, len(octets), 255):  # sums of so many bits fit into a byte
        counts += np.add.reduce(np.unpackbits(octets[at : at + 255], axis=1), axis=0, dtype=np.uint8)
    return np.packbits(2 * counts > len(octets)).view(">u8").tolist()


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: Column, size: int = SHINGLE) -> Column:
    """The 64-bit fingerprint of a whole text as a long; 0 for a text without words, or null."""

    def run(column: pa.Array) -> pa.Array:
        return pa.array([signed(majority(shingle_hashes(lower_words(t), size)[:, None])[0]) for t in texts(column)], pa.int64())

    return F.arrow_udf(run, "long")(text.cast("string"))


def budgets(bits: int, segments: int) -> list[int]:
    """What chains of 1, 2, ... segments may differ by."""
    return [length * bits // segments for length in range(1, segments + 1)]


def chain_condition(differing: Column, bits: int, segments: int) -> Column:
    """Chains from the highest segment on stay within their budgets; the last is the full Hamming check.

    Of chains with the same budget the longest implies the others.
    """
    allowed = budgets(bits, segments)
    width = 64 // segments
    met = F.lit(True)
    for length, budget in enumerate(allowed, 1):
        if length == segments or allowed[length] != budget:
            met &= F.bit_count(F.shiftrightunsigned(differing, 64 - length * width)) <= budget
    return met


def links(prints: DataFrame, bits: int = MAX_BITS, segments: int = SEGMENTS, wide: int = WIDE) -> DataFrame:
    """(a, b): links among the distinct fingerprints in column fp that differ in at most `bits` bits.

    Every pair that shares no wide key is listed itself; fingerprints that meet in a wide key are linked
    through the smallest fingerprint beside each of their common neighbours, so all links hold between the
    connected classes, while no group's pairs are emitted. Needs bits <= 2 for the latter.
    """
    if bits > 2:
        raise ValueError("links by shared neighbours hold up to two differing bits")
    width = 64 // segments
    run = sum(1 for b in budgets(bits, segments) if b == 0)
    turned = lambda k: F.shiftleft("fp", k * width).bitwiseOR(F.shiftrightunsigned("fp", 64 - k * width)) if k else F.col("fp")
    starts = F.array(*[F.struct(F.lit(k).alias("k"), turned(k).alias("turned")) for k in range(segments)])
    keyed = prints.select("fp", F.explode(starts).alias("s")).select(
        "fp", "s.k", "s.turned", F.shiftrightunsigned("s.turned", 64 - run * width).alias("key")
    )
    sizes = keyed.groupBy("k", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    keyed = materialize(keyed.join(sizes, ["k", "key"]), "simhash-keys")

    few = keyed.filter(F.col("n") <= wide)
    other = few.select("k", "key", F.col("fp").alias("b"), F.col("turned").alias("turned_b"))
    pairs = few.select("k", "key", F.col("fp").alias("a"), "turned").join(other, ["k", "key"])
    differing = F.col("turned").bitwiseXOR(F.col("turned_b"))
    close = pairs.filter((F.col("a") < F.col("b")) & chain_condition(differing, bits, segments)).select("a", "b")

    many = keyed.filter(F.col("n") > wide).select("fp").distinct()
    beside = F.array(F.col("fp"), *[F.col("fp").bitwiseXOR(F.lit(signed(1 << i))) for i in range(64)])
    neighbours = many.select("fp", F.explode(beside).alias("neighbour"))
    hubs = neighbours.groupBy("neighbour").agg(F.min("fp").alias("a"), F.collect_set("fp").alias("all"))  # 65 at most
    shared = hubs.filter(F.size("all") > 1).select("a", F.explode("all").alias("b")).filter("a != b")
    return close.union(shared).distinct()


def similar(docs: DataFrame, size: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id): every document with the smallest doc_id that links reach from it.

    Texts without words, null ones too, have fingerprint 0 and are linked like any other. Documents with a
    null doc_id keep their row and name no component, unless all of its ids are null. Repeated rows are one
    another's copies. Other columns are not read.
    """
    prints = docs.select(F.col("doc_id").cast("long").alias("doc_id"), fingerprint(F.col("text"), size).alias("fp"))
    prints = materialize(prints, "simhash-prints")
    distinct = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    near = materialize(links(distinct.select("fp"), bits), "simhash-links")
    classes = components(near, "simhash").select(F.col("node").alias("fp"), "component")
    named = distinct.join(classes, "fp", "left").select("fp", "first", F.coalesce("component", "fp").alias("component"))
    named = materialize(named, "simhash-classes")
    smallest = named.groupBy("component").agg(F.min("first").alias("component_id"))
    ids = named.join(smallest, "component").select("fp", "component_id")
    return prints.join(ids, "fp").select("doc_id", "fp", "component_id")


# Near duplicates at a similarity of wording


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """The distinct shingle hashes of a text, ascending."""
    return np.unique(shingle_hashes(lower_words(text), size))


def prefix(shingles: int, similarity: float) -> int:
    """Of two sets that similar, the first so many shingles in any common order share one."""
    return shingles - math.ceil(shingles * similarity - 1e-9) + 1 if shingles else 0


def parities(hashes: np.ndarray) -> np.ndarray:
    """Bits that tell the parity of the hashes that fall on them: two sets differ in as many hashes at least.

    64 * PARITIES bits, doubled until there is one for each hash.
    """
    width = 64 * PARITIES
    while width < len(hashes):
        width *= 2
    odd = np.bincount((hashes % np.uint64(width)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """The parities of a set with that many longs instead."""
    return np.bitwise_xor.reduce(bits.view(np.uint64).reshape(-1, width), axis=0)  # bits of signed numbers are counted without sign


def most_apart(n_a: np.ndarray, n_b: np.ndarray, similarity: float) -> np.ndarray:
    """The hashes in one of two sets only, of these sizes and that similar, at most."""
    return (n_a + n_b) * (1 - similarity) / (1 + similarity) + 1e-9


def near_enough(bits_a: Column, bits_b: Column, n_a: Column, n_b: Column, similarity: float) -> Column:
    """The parities of two sets leave that similarity open."""

    def run(left: pa.Array, right: pa.Array, n_left: pa.Array, n_right: pa.Array) -> pa.Array:
        most = most_apart(n_left.to_numpy(zero_copy_only=False), n_right.to_numpy(zero_copy_only=False), similarity)
        out = []
        for at in range(len(left)):
            a, b = left[at].values.to_numpy(), right[at].values.to_numpy()
            width = min(len(a), len(b))
            out.append(int(np.bitwise_count(folded(a, width) ^ folded(b, width)).sum()) <= most[at])
        return pa.array(out, pa.bool_())

    return F.arrow_udf(run, "boolean")(bits_a, bits_b, n_a, n_b)


def sketch(text: Column, size: int, similarity: float, common: Broadcast) -> Column:
    """struct<n, fp, cold, bits, keys>: the number of distinct shingles, their fingerprint, parities, and the prefix in
    the order of `common`.

    `common` holds hashes, ascending, and their counts in a sample; others count 0. The rarer come first, ties by
    hash. `cold` is how many of the prefix are not in `common`.
    """

    def run(column: pa.Array) -> pa.Array:
        hot, counts = common.value
        out = []
        for text in texts(column):
            hashes = shingle_set(text, size)
            ranks = np.zeros(len(hashes), np.int64)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, hashes), len(hot) - 1)
                ranks = np.where(hot[at] == hashes, counts[at], 0)
            first = np.argsort(ranks, kind="stable")[: prefix(len(hashes), similarity)]
            fp = signed(majority(hashes[:, None])[0])
            out.append((len(hashes), fp, int((ranks[first] == 0).sum()), parities(hashes), hashes[first].view(np.int64)))
        n, fp, cold, bits, keys = zip(*out, strict=True) if out else ((), (), (), (), ())
        numbers = [pa.array(n, pa.int32()), pa.array(fp, pa.int64()), pa.array(cold, pa.int32())]
        lists = [pa.array(x, pa.list_(pa.int64())) for x in (bits, keys)]
        return pa.StructArray.from_arrays([*numbers, *lists], names=["n", "fp", "cold", "bits", "keys"])

    return F.arrow_udf(run, "struct<n:int,fp:bigint,cold:int,bits:array<bigint>,keys:array<bigint>>")(text.cast("string"))


def common_shingles(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several of a sample of the distinct texts hold, ascending, and in how many.

    They only order the shingles: any order finds all pairs, and this one keeps what many texts share out of the
    prefixes. Hence a sample does, and no more than COMMON of them.
    """

    def run(column: pa.Array) -> pa.Array:
        return pa.array([shingle_set(t, size).view(np.int64) for t in texts(column)], pa.list_(pa.int64()))

    sample = rows.filter(F.pmod(F.xxhash64(F.lit(1), "text_hash"), F.lit(SAMPLED)) == 0)
    held = F.arrow_udf(run, "array<bigint>")(F.col("text"))
    held = sample.select("text_hash", "text_size", F.explode(held).alias("key")).distinct()
    counted = materialize(held.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "near-counted")
    # How many keys reach each size comes first: what is then fetched is about COMMON rows, whatever the tasks
    step = F.floor(F.log2("n") * 8).cast("int")
    sizes = counted.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("keys")).collect()
    left, share = COMMON, {}
    for at, keys in sorted(((r["step"], r["keys"]) for r in sizes), reverse=True):
        share[at] = min(1.0, left / keys)  # of the last step that fits in part, keys with small hashes
        left = max(left - keys, 0)
    shares = F.create_map(*[F.lit(v) for at, part in share.items() if part > 0 for v in (at, part)]) if share else None
    at = F.shiftrightunsigned(F.xxhash64(F.lit(3), "key"), 1)
    found = counted.filter(at <= F.try_element_at(shares, step) * float(1 << 63)).collect() if share else []
    hashes = np.array([r["key"] for r in found], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.array([r["n"] for r in found], np.int64)[order]


def alike(n_a: Column, n_b: Column, similarity: float) -> Column:
    """Sets of these sizes can be that similar."""
    return F.least(n_a, n_b) >= F.greatest(n_a, n_b) * similarity - 1e-9


def sieve(rows: DataFrame, key: str) -> Broadcast:
    """A bitmap of SIEVE bits with those set on which the hashes in `key` fall: 1 MB, however many rows there are."""
    bit = F.col(key).bitwiseAND(F.lit(SIEVE - 1))
    found = rows.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
    words = found.agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toArrow()
    bits = np.zeros(SIEVE // 64, np.int64)
    bits[words["word"].to_numpy()] = words["bits"].to_numpy()
    return rows.sparkSession.sparkContext.broadcast(bits)


def in_sieve(key: Column, bits: Broadcast) -> Column:
    """False for hashes that are surely not among those of the sieve. Once most bits are set it lets most rows pass."""

    def run(column: pa.Array) -> pa.Array:
        bit = column.to_numpy(zero_copy_only=False) & (SIEVE - 1)
        return pa.array((bits.value[bit >> 6] >> (bit & 63)) & 1 == 1, pa.bool_())

    return F.arrow_udf(run, "boolean")(key)


def verified(pairs: DataFrame, nodes: DataFrame, rows: DataFrame, size: int, similarity: float) -> DataFrame:
    """The pairs (a, b) whose shingle sets have that Jaccard similarity; the parities only drop what can't."""
    side = lambda name: nodes.select(F.col("node").alias(name), F.col("n").alias(f"n_{name}"), F.col("bits").alias(f"bits_{name}"))
    near = pairs.join(side("a"), "a").join(side("b"), "b")
    near = near.filter(near_enough(*[F.col(c) for c in ("bits_a", "bits_b", "n_a", "n_b")], similarity))
    near = materialize(near.select("a", "b"), "near-pairs")
    needed = near.select("a").union(near.select("b")).distinct().select("a.*")
    sieved = rows.filter(in_sieve(F.col("text_hash"), sieve(needed, "text_hash")))
    whole = sieved.join(needed, ["text_hash", "text_size"], "left_semi").dropDuplicates(["text_hash", "text_size"])
    whole = materialize(whole.select(F.struct("text_hash", "text_size").alias("node"), "text"), "near-texts")

    def run(left: pa.Array, right: pa.Array) -> pa.Array:
        known: dict[bytes, np.ndarray] = {}  # a leader's text comes again and again
        out = []
        for a, b in zip(texts(left), texts(right), strict=True):
            if len(known) > 512:
                known.clear()
            sets = [known[t] if t in known else known.setdefault(t, shingle_set(t, size)) for t in (a, b)]
            shared = len(sets[0]) + len(sets[1]) - len(np.union1d(*sets))
            out.append(shared >= similarity * (len(sets[0]) + len(sets[1]) - shared) - 1e-9)
        return pa.array(out, pa.bool_())

    texts_of = lambda name: whole.select(F.col("node").alias(name), F.col("text").alias(f"text_{name}"))
    both = near.join(texts_of("a"), "a").join(texts_of("b"), "b")
    return both.filter(F.arrow_udf(run, "boolean")(F.col("text_a"), F.col("text_b"))).select("a", "b")


def close_in_blocks(table: pa.Table, similarity: float) -> pa.Table:
    """The pairs (a, b) of one block with another, or of a block with itself, that sizes and parities leave open."""
    n = table["n"].to_numpy()
    bits = np.array([folded(x.values.to_numpy(), PARITIES) for x in table["bits"]])
    _, component = np.unique(table["label"].combine_chunks().to_numpy(zero_copy_only=False), return_inverse=True)
    block = table["block"].to_numpy()
    left = np.flatnonzero(block == block.min())
    right = np.flatnonzero(block == block.max())
    found = []
    for at in left.tolist():
        others = right[right > at] if block.min() == block.max() else right
        sizes = n[others]
        others = others[(component[others] != component[at]) & (np.minimum(sizes, n[at]) >= np.maximum(sizes, n[at]) * similarity - 1e-9)]
        apart = np.bitwise_count(bits[others] ^ bits[at]).sum(1, dtype=np.int64)
        others = others[apart <= most_apart(n[others], n[at], similarity)]
        found += [(at, k) for k in others.tolist()]
    nodes = table["node"].combine_chunks()
    pairs = np.array(found, np.int64).reshape(-1, 2)
    return pa.table({"a": nodes.take(pa.array(pairs[:, 0])), "b": nodes.take(pa.array(pairs[:, 1]))})


def across(met: DataFrame, found: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """(a, b): pairs that meet in a key and lie in different classes of `found` (node, component).

    A key that one class fills has no such pairs. Keys of up to CROWDED texts list them; the texts of a larger key
    are dealt out in blocks, and each two blocks are compared by a task of their own that lists what may be similar.
    """
    labelled = met.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = materialize(labelled, "near-labelled")
    open_ = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("m"))
    open_ = materialize(open_.filter("low != high and m > 2").select("key", "m"), "near-open")
    rows = labelled.join(open_, "key")
    few = rows.filter(F.col("m") <= CROWDED)
    a = few.select("key", F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("component").alias("c_a"))
    b = few.select("key", F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("component").alias("c_b"))
    pairs = a.join(b, ["key"]).filter((F.col("a") < F.col("b")) & (F.col("c_a") != F.col("c_b")) & alike(F.col("n_a"), F.col("n_b"), similarity))
    pairs = pairs.select("a", "b")

    number = F.ceil(F.col("m") / BLOCK).cast("int")
    many = rows.filter(F.col("m") > CROWDED).join(nodes.select("node", "bits"), "node")
    many = many.withColumn("block", F.pmod(F.xxhash64("key", "node"), number).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), number - 1)))
    many = many.select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "n", "bits",
        F.xxhash64("component").alias("label"),
    )
    node = "struct<text_hash:bigint,text_size:int>"
    blocks = many.groupBy("key", "i", "j").applyInArrow(lambda t: close_in_blocks(t, similarity), f"a {node}, b {node}")
    ordered = blocks.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.union(ordered).distinct()


def print_links(nodes: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """(a, b): texts whose fingerprints differ in at most `bits` bits, found by `links`.

    One text of each fingerprint stands for it: it is paired with the others that have the same, and with those that
    stand for the fingerprints beside it. Texts without words take no part.
    """
    worded = nodes.filter("n > 0").select("node", "fp")
    prints = materialize(worded.groupBy("fp").agg(F.min("node").alias("first")), "near-prints")
    equal = worded.join(prints, "fp").filter("node != first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    side = lambda name: prints.select(F.col("fp").alias(f"fp_{name}"), F.col("first").alias(name))
    close = links(prints.select("fp"), bits).select(F.col("a").alias("fp_a"), F.col("b").alias("fp_b"))
    return equal.union(close.join(side("a"), "fp_a").join(side("b"), "fp_b").select("a", "b"))


def near_duplicates(docs: DataFrame, size: int = NEAR_SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """(text_hash, text_size, group): the class of each distinct text among texts of similar wording.

    Classes are the connected components of all pairs of texts whose sets of shingles reach the similarity.
    Equal texts are one row from the start. Texts with close fingerprints are linked first, if they are that similar;
    the other pairs are searched between different classes only. Two such sets share a shingle of their prefixes, so
    texts that share none are never compared. In each key the text with the fewest rare shingles is compared with the
    others first; what then lies in different classes of a key is compared pair by pair. Texts without words are only
    equal to each other.
    """
    rows = docs.select(*text_key("text"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    common = docs.sparkSession.sparkContext.broadcast(common_shingles(rows, size))
    prints = rows.select("text_hash", "text_size", sketch(F.col("text"), size, similarity, common).alias("s"))
    # Equal texts have equal sketches: any row of a text will do
    nodes = prints.groupBy("text_hash", "text_size").agg(F.first("s").alias("s"))
    nodes = materialize(nodes.select(F.struct("text_hash", "text_size").alias("node"), "s.*"), "near-nodes")
    near = materialize(verified(print_links(nodes), nodes, rows, size, similarity), "near-linked")
    found = materialize(components(near, "near"), "near-found")
    keyed = nodes.select("node", "n", "cold", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("m")).filter("m > 1").select("key")
    met = keyed.join(shared, "key").join(found, "node", "left")
    met = materialize(met.withColumn("component", F.coalesce("component", "node")), "near-met")
    leaders = met.groupBy("key").agg(F.min(F.struct("cold", F.xxhash64("node").alias("o"), "node", "n", "component")).alias("l"))
    star = met.join(leaders, "key").filter((F.col("component") != F.col("l.component")) & alike(F.col("n"), F.col("l.n"), similarity))
    star = star.select(F.col("l.node").alias("a"), F.col("node").alias("b")).distinct()
    near = near.union(materialize(verified(star, nodes, rows, size, similarity), "near-star"))
    rest = across(met.drop("component"), components(near, "near"), nodes, similarity)
    near = near.union(materialize(verified(rest, nodes, rows, size, similarity), "near-across"))
    classes = components(near, "near")
    return classes.select("node.text_hash", "node.text_size", F.col("component").alias("group"))


def text_key(text: str) -> tuple[Column, Column]:
    """Names a text by hash and size; a null text is an empty one."""
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return F.xxhash64(whole).alias("text_hash"), F.octet_length(whole).alias("text_size")


def keep_one(docs: DataFrame, size: int = NEAR_SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """Documents without near copies: of each group the row with the smallest doc_id stays (null ids last, then
    the smallest hash of the text; of rows that repeat both, any one). All columns stay; rows with a null or
    empty text are one group. The documents' texts are shuffled once, to meet the narrow list of those that stay.
    """
    key = [fresh(docs, f"_near_{n}") for n in ("missing", "doc_id", "hash", "size")]
    text_hash, text_size = text_key("text")
    doc_id = F.col("doc_id").cast("long")
    named = [doc_id.isNull(), F.coalesce(doc_id, F.lit(0)), text_hash, text_size]
    named = [c.alias(n) for c, n in zip(named, key, strict=True)]
    groups = near_duplicates(docs, size, similarity)
    # Copies of a text meet as one row per task, so no task gets all rows of a text
    firsts = docs.select(F.struct(*named).alias("own"), *text_key("text")).groupBy("text_hash", "text_size").agg(F.min("own").alias("own"))
    ranked = firsts.join(groups, ["text_hash", "text_size"], "left")
    group = F.coalesce("group", F.struct("text_hash", "text_size")).alias("group")
    chosen = ranked.groupBy(group).agg(F.min("own").alias("first")).select(*[f"first.{n}" for n in key])
    chosen = materialize(chosen, "near-chosen")
    return docs.select("*", *named).join(chosen, key, "left_semi").dropDuplicates(key).drop(*key)
