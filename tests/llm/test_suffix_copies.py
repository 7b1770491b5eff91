"""Equal rows and hot anchors of the suffix dedup."""

import hashlib
import random
import time

import numpy as np
import pytest

from tessera.llm import op09_suffix


def plain(texts, span):
    """(removed, spans, kept digest) of every text by looking at all its windows."""
    seen = {}
    raw = [(t or "").encode() for _, t in texts]
    for t in raw:
        for s in range(len(t) - span + 1):
            seen[t[s:s + span]] = seen.get(t[s:s + span], 0) + 1
    out = []
    for (i, _), t in zip(texts, raw):
        gone = np.zeros(len(t) + 1, bool)
        for s in range(len(t) - span + 1):
            if seen[t[s:s + span]] > 1:
                gone[s:s + span] = True
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((i, len(t), int(gone.sum()), int((np.diff(gone.astype(int)) == 1).sum() + gone[0]), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, texts, **options):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    got = op09_suffix.suffix_dedup(df, **options)
    return sorted(map(tuple, got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect()), key=repr)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(n))


def test_equal_rows_beside_others(spark):
    rng = random.Random(1)
    passage, page = sentence(rng, 60), sentence(rng, 120)
    texts = [(None, page)] * 40 + [(7, page)] * 3 + [(None, "short")] * 5 + [(None, None)] * 2 + [(9, "")] * 2
    texts += [(k, sentence(rng, 30) + passage + sentence(rng, 30)) for k in range(5)]
    texts += [(100, sentence(rng, 20) + page[100:400] + sentence(rng, 20)), (101, sentence(rng, 200)), (101, sentence(rng, 200))]
    assert run(spark, texts) == plain(texts, 200)


@pytest.mark.parametrize("per_block", [1, 3, 512])
def test_hot_anchors_in_blocks_of_one_window(spark, monkeypatch, per_block):
    """With few rows a block, a passage's blocks shrink to single windows, dealt by content."""
    rng = random.Random(2)
    a, b = sentence(rng, 60), sentence(rng, 60)
    texts = [(k, sentence(rng, 8) + (a if k % 3 else a[:150] + b)[k % 5:] + sentence(rng, 8)) for k in range(260)]
    monkeypatch.setattr(op09_suffix, "PER_BLOCK", per_block)
    assert run(spark, texts) == plain(texts, 200)


def test_equal_rows_cost_no_more_than_distinct_ones(spark):
    rng = random.Random(3)
    page = sentence(rng, 600)
    run(spark, [(1, page)])
    began = time.perf_counter()
    assert {r[2] for r in run(spark, [(None, page)] * 2000)} == {len(page)}
    equal = time.perf_counter() - began
    began = time.perf_counter()
    assert {r[2] for r in run(spark, [(k, page) for k in range(2000)])} == {len(page)}
    assert equal < 2 * (time.perf_counter() - began) + 5
