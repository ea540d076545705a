from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import pytest

from tidemark.operators import related


def by_hand(docs, n, k):
    held = [{w for w in words or () if w and len(w) >= 3 and any("a" <= c <= "z" for c in w) and w not in ("the", "and")} for words in docs]
    often = Counter(w for words in held for w in words)
    top = [w for w, _ in sorted(often.items(), key=lambda x: (-x[1], x[0]))[:n]]
    pairs = Counter(p for words in held for p in combinations(sorted(words & set(top)), 2))
    out = []
    for a in top:
        near = sorted(((-c, *(set(p) - {a})) for p, c in pairs.items() if a in p))[:k]
        out += [(a, b, -c, i) for i, (c, b) in enumerate(near, 1)]
    return sorted(out)


@pytest.mark.parametrize("n", [1, 7, 30, 400])
def test_edges_equal_all_pairs(spark, monkeypatch, n):
    monkeypatch.setattr(related, "ROWS", 7)
    rng = random.Random(3)
    words = [f"w{a}{b}" for a in "abcdefg" for b in "hijklm"] + ["the", "and", "x1", "123", None]
    docs = [rng.choices(words, k=rng.randint(0, 30)) for _ in range(90)] + [None, [], ["waa"] * 50, words * 20]
    frame = spark.createDataFrame([(d, "clash") for d in docs], "words array<string>, keyword string").repartition(4)
    got = related.related_edges(frame.select("words"), n, 4).collect()
    assert sorted(map(tuple, got)) == by_hand(docs, n, 4)


def test_long_documents_list_no_pairs(spark):
    """A document of 40 000 words passes as one row; only pairs of tracked keywords leave the tasks."""
    long_ = [f"w{i}x" for i in range(40_000)]
    frame = spark.createDataFrame([(long_,)] * 3, "words array<string>").repartition(3)
    pairs = related.together(frame, long_[:50])
    assert pairs.count() == 50 * 49 // 2 and pairs.first()["documents"] == 3
    plan = related.together(frame, long_[:50])._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan


def test_no_documents_and_bounds(spark):
    none = spark.createDataFrame([], "words array<string>")
    assert related.related_edges(none).count() == 0
    for n in (0, related.MOST_TRACKED + 1):
        with pytest.raises(ValueError):
            related.related_edges(none, n)
