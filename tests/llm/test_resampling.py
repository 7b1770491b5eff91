"""Importance resampling against a plain computation, and its quickselect on hot keys."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm import op11_importance as op11

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}
DOCS = "doc_id long, text string, score string, rank int"


def plain_features(text):
    w = WORDS.findall((text or "").translate(LOWER))
    return len(w), [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def plain(docs, bench):
    made = [(i, *plain_features(t)) for i, t in docs]
    s = Counter(zlib.crc32(f.encode()) % 10000 for _, _, fs in made for f in fs)
    t = Counter(zlib.crc32(f.encode()) % 10000 for b in bench for f in plain_features(b)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    rows = []
    for i, words, fs in made:
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000))))
                     for b in (zlib.crc32(f.encode()) % 10000 for f in fs))
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), words))
    fit = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = [(*r[:4], k + 1) for k, r in enumerate(fit[:5 * len(fit) // 100])]
    return sorted(ranks + [(*r[:4], None) for r in fit[len(ranks):]] + [(*r[:4], None) for r in rows if r[4] < 20], key=repr)


def run(spark, docs, bench):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], DOCS)  # extra columns with clashing names
    b = spark.createDataFrame([(t,) for t in bench], "text string")
    return sorted(map(tuple, op11.draw(op11.scored_documents(d, b)).collect()), key=repr)


@pytest.mark.parametrize("seed", range(4))
def test_features_by_array_operations(seed, monkeypatch):
    monkeypatch.setattr(op11, "PIECE", 150)  # long texts in many pieces
    rng = random.Random(seed)
    bits = ["a", "B", "é", "9", " ", ".", "x" * 40, "ß日", "  ", "\n"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 400))) for _ in range(40)]
    got, words = [Counter() for _ in texts], [0] * len(texts)
    for doc, crc, own, n in op11.features([t.encode() for t in texts]):
        for d, c in zip(doc.tolist(), crc.tolist()):
            got[d][c] += 1
        for d, k in zip(own.tolist(), n.tolist()):
            words[d] += k
    for t, c, k in zip(texts, got, words):
        n, fs = plain_features(t)
        assert c == Counter(zlib.crc32(f.encode()) for f in fs) and k == n


def test_against_plain(spark):
    rng = random.Random(5)
    vocab = ["alpha", "Beta", "gam-ma", "délta", "x1", "日本", "longword" * 6, "!", "the"]
    docs = [(k, " ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60)))) for k in range(300)]
    docs += [(None, "the alpha " * 15), (None, None), (500, None), (501, ""), (502, "!?"), (503, "alpha beta x1 " * 30_000)]
    bench = [" ".join(rng.choice(vocab) for _ in range(30)) for _ in range(5)] + [None, ""]
    assert run(spark, docs, bench) == plain(docs, bench)


def test_repeated_rows_fill_the_share(spark):
    docs = [(7, "alpha beta " * 20)] * 300 + [(k, f"word{k} beta " * 12) for k in range(200)]
    got = run(spark, docs, ["alpha beta gamma"])
    assert got == plain(docs, ["alpha beta gamma"])
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 26))


def test_empty_tables(spark):
    assert run(spark, [], ["a b"]) == []
    docs = [(k, "one two three " * 10) for k in range(20)]
    assert run(spark, docs, []) == plain(docs, [])


@pytest.mark.parametrize("k", [1, 2, 500, 999, 1000])
def test_quickselect(spark, k):
    keys = spark.range(1000).select((F.col("id") % 7).alias("rest"), F.lit(False).alias("no_id"), (F.col("id") % 50).alias("id"),
                                    F.lit(0).cast("long").alias("tie"))
    ordered = sorted(tuple(r) for r in keys.collect())
    key, taken = op11.quickselect(keys, k, pivots=3)
    assert key == ordered[k - 1] and ordered[:k].count(key) == taken


def test_copies_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(op11, "COPIES", 4)
    rows = spark.createDataFrame([("a", 11), ("b", 0), ("c", 4)], "x string, n long")
    got = sorted((r.x, r.number) for r in op11._copies(rows, "n").collect())
    assert got == [("a", k) for k in range(11)] + [("c", k) for k in range(4)]
