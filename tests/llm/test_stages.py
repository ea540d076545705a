"""The pipeline's quality, personal data and packing stages against plain Python on whole small tables."""

from __future__ import annotations

from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import pii, quality, textstats
from tidemark.session import scratch_root


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet").cache()


def test_quality_stage_by_direct_ridge_and_pooling(spark, sf, docs):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    stats = quality.statistics(docs)
    model = quality.train(stats, labels)
    ratios = textstats.ratios()
    rows = stats.select("doc_id", *[c.alias(n) for n, c in ratios.items()]).toPandas()
    x = rows[list(ratios)].to_numpy(float)
    taught = quality.labelled(stats, labels)
    parts = taught.withColumn("held", quality.F.pmod(quality.F.xxhash64(*ratios), quality.F.lit(4)) == 0).toPandas()
    own, y, held = parts[list(ratios)].to_numpy(float), parts["y"].to_numpy(float), parts["held"].to_numpy(bool)
    # Features, ridge and scores written out, from the drawn projection
    center, scale = own[~held].mean(0), own[~held].std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)

    def features(v):
        return np.hstack([np.sqrt(2 / 128) * np.cos(np.clip((v - center) / scale, -6, 6) @ model.projection + model.phase), np.ones((len(v), 1))])

    z = features(own[~held])
    penalty = np.diag([quality.RIDGE * len(z)] * 128 + [1e-9])
    weights = np.linalg.solve(z.T @ z + penalty, z.T @ y[~held])
    raw = np.clip(features(own[held]) @ weights, -0.5, 1.5)
    bins = np.round(raw * 1000).astype(int)
    steps = np.unique(bins)
    mean = np.array([y[held][bins == b].mean() for b in steps])
    count = np.array([(bins == b).sum() for b in steps])
    # The isotonic fit as the greatest of lows of means over intervals
    fitted = [
        max(min(np.average(mean[i : j + 1], weights=count[i : j + 1]) for j in range(k, len(steps))) for i in range(k + 1)) for k in range(len(steps))
    ]
    raw = np.clip(features(x) @ weights, -0.5, 1.5)
    score = 0.98 * np.interp(raw, steps / 1000, fitted) + 0.02 * (raw + 0.5) / 2
    got = model.score(x)
    assert (np.abs(score - got) < 0.02).mean() > 0.99  # a bin may tip by the last digit of a sum
    kept = {r.doc_id for r in corpus_pipeline.quality_stage(spark, docs, sf).collect()}
    clear = np.abs(score - quality.THRESHOLD) > 0.02
    want = set(rows["doc_id"][clear & (score >= quality.THRESHOLD)])
    assert want <= kept and not kept & set(rows["doc_id"][clear & (score < quality.THRESHOLD)])


def test_personal_data_stage_replaces_the_found_spans(spark, sf, docs):
    redacted = {r.doc_id: r for r in corpus_pipeline.pii_stage(spark, docs, sf).collect()}
    found = {r.doc_id: r.spans for r in pii.find(docs).collect()}
    hits = 0
    for row in docs.collect():
        text, out, past = row.text or "", [], 0
        for span in sorted(found[row.doc_id], key=lambda s: (s["start"], s["end"], s["kind"])):
            hits += 1
            if span["start"] >= past:
                out.append(text[past : span["start"]] + f"[{span['kind'].upper()}]")
            past = max(past, span["end"])
        want = "".join(out) + text[past:] if row.text is not None else None
        assert redacted[row.doc_id].text == want
        assert redacted[row.doc_id].n_chars == (len(want) if want is not None else None) or row.n_chars is None
    assert hits


def test_packing_stage_holds_every_document_whole(spark, sf, docs):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(str(path("byte_bpe_50k.json")))
    pieces = defaultdict(list)
    for r in corpus_pipeline.packing_stage(spark, docs, sf).collect():
        assert 0 < r.length <= 2048 and r.offset + r.length <= 2048
        pieces[r.doc_id].append((r.start, bytes(r.ids)))
    for row in docs.collect():
        ids = [*tokenizer.encode(row.text or "", add_special_tokens=False).ids, 1]
        assert b"".join(b for _, b in sorted(pieces[row.doc_id])) == np.array(ids, "<u4").tobytes()


def test_only_the_last_table_remains(spark, sf):
    root = Path(scratch_root(spark))
    before = set(root.iterdir())
    made = corpus_pipeline.run(spark, sf)
    assert made.count() > 0
    (left,) = set(root.iterdir()) - before
    assert left.name.startswith("pipeline-4-")
