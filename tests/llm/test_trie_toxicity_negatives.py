"""The prefix trie, toxicity and hard negatives against brute force, SQL, held-out labels and awkward rows."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.compare import difference, oracle_connection
from tidemark.llm import negatives, prefix_trie, queries, sampling, toxicity


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, sf, name):
    got = queries.CATALOGUE[name](spark, sf).toPandas()
    assert difference(got, oracle_connection(sf).execute(queries.ORACLES[name]).df()) == ""


# 11

TALK = "conv_id long, turn long, role string, text string, path string, depth int"


def trie_by_hand(rows):
    """Every node of the trie, by listing every prefix."""
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            said[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in said.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        first = c - int(np.fmod(c, 5))
        rebuilt[c] = tuple(own.get(first, [])[:h] + own[c][h:])
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, path in rebuilt.items():
        ends[path].append(c)
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
            if d:
                children[path[: d - 1]].add(path[:d])
    leaves, saved = defaultdict(int), defaultdict(int)
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
    digest = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return sorted(
        (min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), len(children[n]), leaves[n], saved[n], digest(ends[n])) for n, m in members.items()
    )


def trie_rows(spark, rows, shards=None):
    found = prefix_trie.trie(spark.createDataFrame([(*r, "p", 1) for r in rows], TALK), shards).collect()
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, *r[3:]) for r in found)


def talk(count, seed=1):
    """Conversations that share first turns, some of them whole; some very long, and one that a third of them repeat."""
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(count):
        length = 60 if c % 50 == 7 else int(rng.integers(1, 9))
        for n in range(length):
            text = "same" if c % 3 == 0 else f"t{rng.integers(0, 2)}é" if n < 3 else f"x{rng.integers(0, 9)}"
            rows.append((c, n, "user" if n % 2 else "system", text))
    return rows


@pytest.mark.parametrize("shards", [1, 2, 7, 40, 300])
def test_trie_whatever_the_shards(spark, shards):
    rows = talk(300)
    assert trie_rows(spark, rows, shards) == trie_by_hand(rows)


def test_trie_with_cut_splitters(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "SAMPLE_BYTES", 1)  # one turn of each sampled path
    monkeypatch.setattr(prefix_trie, "PIECE", 3)  # ending lists in many pieces
    rows = talk(200, seed=2)
    assert trie_rows(spark, rows, 9) == trie_by_hand(rows)


def test_trie_odd_rows(spark):
    rows = [
        (5, None, None, None), (5, 1, "", ""), (5, 2, None, "a" * 50_000), (6, 1, "u", "x"), (6, 1, "u", "x"), (-7, 3, "u", "ü"),
        (-5, 1, "u", "ü"), (None, 1, "u", "lost"), (None, None, None, None), (9, None, "u", None), (2**62, 1, "u", "x"),
    ]
    assert trie_rows(spark, rows, 4) == trie_by_hand(rows)
    assert trie_rows(spark, [(None, 1, "u", "x")]) == []
    assert trie_rows(spark, []) == []
    # The head of 11 is that of 10, which isn't there; all its own turns are replaced: it ends at the root
    assert zlib.crc32(b"11") % 9 > 1
    assert trie_rows(spark, [(11, 1, "u", "x")]) == trie_by_hand([(11, 1, "u", "x")])


# 12


def test_gradients():
    rng = np.random.default_rng(3)
    words = [b"w%d" % k for k in range(9)]
    network = toxicity.fresh_network([words, words[:3]], np.array([0.0, 1.0]))
    network.values = {k: v.astype(np.float64) for k, v in network.values.items()}
    whole, rows, codes = toxicity.buckets(words)
    at = rng.integers(0, 9, (4, toxicity.WINDOW))
    known = np.arange(toxicity.WINDOW) < np.array([[toxicity.WINDOW], [7], [1], [0]])
    y, weight = np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 1, 1])

    def loss():
        logits = network.logits(network.projected(network.inputs(whole, rows, codes)[0]), at, known).astype(float)
        p = toxicity.sigmoid(logits)
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum()

    before = {k: v.copy() for k, v in network.values.items()}
    network.learn((whole, rows, codes), at, known, y, weight)
    network.values = before
    for name in ("Wxf", "Wxb", "Whf", "Whb", "bf", "u", "w", "bias", "word", "char"):
        value = before[name]
        spot = np.unravel_index(np.argmax(network.moments[name]), value.shape)
        grad = np.sqrt(network.moments[name][spot] - 1e-8)
        old, high = value[spot], []
        for step in (1e-2, -1e-2):
            value[spot] = old + step
            high.append(loss())
        value[spot] = old
        assert abs(high[0] - high[1]) / 2e-2 == pytest.approx(grad, rel=0.05, abs=2e-4), name


def test_windows_cover_and_overlap():
    for n in range(0, 200):
        starts = toxicity.windows(n)
        held = {k for s in starts for k in range(s, min(s + toxicity.WINDOW, n))}
        assert held == set(range(n)) and (np.diff(starts) == toxicity.STRIDE).all()
        assert starts[-1] == 0 or starts[-1] < n


def test_long_runs_of_letters_are_cut_and_kept():
    words = toxicity.words_of(("Ab" * 100 + " É!b\x00c").encode())
    assert b"".join(words) == b"ab" * 100 + "ébc".encode() and max(map(len, words)) <= toxicity.WORD_BYTES


@pytest.fixture(scope="module")
def insults(spark):
    """Four words make a text toxic, wherever they stand in it."""
    rng = np.random.default_rng(5)
    rows, marks = [], []
    for d in range(900):
        words = [f"{a}{b}{c}" for a, b, c in rng.choice(["ba", "to", "ri", "ne", "su", "lo"], (int(rng.integers(5, 160)), 3))]
        toxic = int(d % 5 == 0)
        if toxic:
            words[int(rng.integers(len(words)))] = "grok" + str(rng.choice(["zu", "fi"]))
        rows.append((d, " ".join(words), None, None, None, 0, "x", "y"))
        marks.append((d, None, toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, start long, fp string, score string")
    return docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")


def test_toxicity_is_found_in_held_out_texts(insults):
    docs, labels = insults
    held = F.col("doc_id") % 3 == 0
    network = toxicity.train(docs.filter(~held), labels, each=400)
    got = toxicity.predictions(docs.filter(held), network).join(labels, "doc_id").toPandas()
    assert (got.predicted[got.toxic == 1] == 1).mean() > 0.95 and (got.predicted[got.toxic == 0] == 0).mean() > 0.97
    # The same model however the table lies
    again = toxicity.train(docs.filter(~held).repartition(13), labels.repartition(3), each=400)
    assert all((network.values[k] == again.values[k]).all() for k in network.values)
    # Far behind the first windows, after as many windows as go at a time
    calm = docs.filter("doc_id = 1").first().text
    quiet = " ".join([calm] * ((toxicity.AT_ONCE + 5) * toxicity.STRIDE // len(calm.split())))
    top = [w.max() for w in toxicity.worst_windows(network, [toxicity.words_of(t.encode()) for t in (quiet, quiet + " grokfi")])]
    low, high = network.score(np.array(top))
    assert low < 0.5 < high


def test_toxicity_odd_rows(spark, insults):
    docs, labels = insults
    network = toxicity.train(docs, labels, each=100)
    rows = [(1, None), (1, None), (None, ""), (2, " \n"), (3, "x" * 300_000), (4, "İ\U0001f600 grokzu")]
    odd = spark.createDataFrame([(*r, "s", 1) for r in rows], "doc_id long, text string, score string, predicted int")
    got = toxicity.predictions(odd, network).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, None)}) == 1
    none = docs.limit(0)
    assert toxicity.predictions(none, network).count() == 0
    assert toxicity.train(none, labels) is None and toxicity.train(docs, labels.filter("toxic = 0")) is None
    assert toxicity.train(docs, labels.limit(0)) is None
    assert {tuple(r) for r in toxicity.predictions(odd, None).select("score", "predicted").collect()} == {(0.0, 0)}


def test_sample_is_bounded_and_keeps_every_label(spark):
    rows = [("en", f"text {k}") for k in range(3000)] + [("ru", "the same")] * 3000 + [(None, "x")] + [("de", f"t{k}") for k in range(5)]
    table = spark.createDataFrame(rows, "lang string, text string")
    draw = lambda t: sorted(map(tuple, sampling.drawn(t, "lang", ["text"], 50, 3).collect()))
    got = draw(table)
    count = {lang: sum(1 for r in got if r[0] == lang) for lang in ("en", "ru", "de")}
    assert count == {"en": 50, "ru": 1, "de": 5} and len(got) == 56
    assert got == draw(table.repartition(17)) and sampling.drawn(table.limit(0), "lang", ["text"], 5, 3).count() == 0


# 13

VECTORS = "vec_id long, embedding array<float>, label int, score double, anchor long, rank int"


def mined_by_hand(rows, is_anchor):
    kept = []
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v], label))
    out = []
    far = lambda i: float("inf") if i is None else i
    anchors = {(i, tuple(v), label) for i, v, label in kept if i is not None and is_anchor(i)}
    for i, v, label in anchors:
        scored = sorted({(-sum(a * b for a, b in zip(v, w)), far(k), m) for k, w, m in kept if k != i})
        for p, k, _ in [s for s in scored if s[2] == label][:5]:
            fit = [s for s in scored if s[2] != label and 30 * -p <= 100 * -s[0] <= 90 * -p][:10]
            out += [(i, k, n, s[1], -p, -s[0]) for n, s in enumerate(fit, 1)]
    return sorted(out)


def mined(spark, rows, **kwargs):
    found = negatives.mine(spark.createDataFrame([(*r, 1.0, 2, 3) for r in rows], VECTORS).repartition(5), F.col("vec_id") % 10 == 0, **kwargs).collect()
    return sorted(tuple(float("inf") if x is None else x for x in r) for r in found)


@pytest.mark.parametrize("spread", [0.05, 2.0])
def test_negatives_equal_brute_force(spark, spread, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 60)
    monkeypatch.setattr(negatives, "STEP", 16)
    rng = np.random.default_rng(7)
    middle = rng.standard_normal((4, 6))
    rows = [(k, (middle[k % 4] + spread * rng.standard_normal(6)).tolist(), int(rng.integers(0, 3))) for k in range(500)]
    want = mined_by_hand(rows, lambda i: i % 10 == 0)
    assert want and mined(spark, rows) == want
    assert mined(spark, rows, per_round=12) == want


def test_walks_end_early_and_lose_nothing():
    rng = np.random.default_rng(8)
    middle = rng.standard_normal((40, 32))
    vectors = np.floor(256 * (np.repeat(middle, 50, 0) + 0.05 * rng.standard_normal((2000, 32))))
    ids = rng.permutation(2000)
    labels = np.zeros(2000, np.int64)
    low, high = np.full((100, 1), np.iinfo(np.int64).min), np.full((100, 1), np.iinfo(np.int64).max)
    found = negatives.Found(negatives.Wanted(ids[:100], labels[:100], vectors[:100], True, 5, low, high, members=10))
    found.walk(ids, labels, vectors)
    assert found.scored < 0.5 * 100 * 2000
    score = (vectors[:100] @ vectors.T).astype(np.int64)
    for a in range(100):
        best = sorted((-s, i) for s, i in zip(score[a].tolist(), ids.tolist()) if i != ids[a])[:5]
        assert [(-s, i) for s, i in zip(found.score[a, 0].tolist(), found.id[a, 0].tolist())] == best


def test_negatives_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    plain = [(k, [0.5 * (k % 3), 0.25, -0.1 * (k % 4)], k % 2) for k in range(1, 21)]  # many ties
    rows = plain + plain[:12] + [
        (30, None, 1), (40, [0.1, None, 0.2], 1), (50, [nan, 0.0, 0.0], 0), (60, [inf, 0.0, 0.0], 0), (70, [0.5, 0.5, 0.5], None),
        (None, [0.5, 0.4, 0.1], 0), (None, [0.9, 0.4, 0.1], 1), (80, [0.0, 0.0, 0.0], 1), (90, [], 0), (100, [0.7], 1), (10, [0.3, 0.2, 0.1], 0),
        (110, [4e6, 0.5, 0.0], 0), (111, [5e6, 0.5, 0.0], 0), (112, [2e6, 0.5, 0.0], 1),
    ]
    padded = [(i, None if v is None else v + [0.0] * (3 - len(v)), label) for i, v, label in rows]
    assert mined(spark, rows) == mined_by_hand(padded, lambda i: i % 10 == 0)
    assert mined(spark, []) == [] and mined(spark, [(1, [1.0], 1)]) == [] and mined(spark, [(10, [1.0], 1)]) == []
