"""The filter audit against orders applied one document at a time."""

import random
import re
from collections import Counter
from fractions import Fraction
from itertools import permutations
from math import factorial

import duckdb
import pytest

from tessera.llm import op13_audit as op13

DOCS = "doc_id long, text string, lang string, part string, n int"
LABELS = "doc_id long, quality int, toxic int, lang string"


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text))}


def plain(docs, labels):
    good = {i for i, q, _, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t, _ in labels if i is not None and t == 1}
    rows = []
    for i, text, lang, _, _ in docs:
        text = text or ""
        copy = i is not None and any(j is not None and j < i and (t or "") == text for j, t, *_ in docs)
        rows.append((lang or "", i, {k for k, v in {**fails(text), "E": copy}.items() if v}))
    out = []
    for part in {r[0] for r in rows}:
        own, shapley, steps = [r for r in rows if r[0] == part], Counter(), []
        for order in permutations("ABCDE"):
            left, gone = own, []
            for step, f in enumerate(order, 1):
                hit = [r for r in left if f in r[2]]
                redundant = sum(f in r[2] for r in gone)
                left = [r for r in left if f not in r[2]]
                gone = gone + hit
                shapley[f] += len(hit)
                steps.append(("".join(order), step, len(left), len(hit), redundant, sum(r[2] == {f} for r in own),
                              sum(r[1] in good for r in hit), sum(r[1] in toxic for r in hit)))
        out += [(part, *s, shapley[s[0][s[1] - 1]]) for s in steps]
    return sorted(out)


def case(seed):
    rng = random.Random(seed)
    pieces = ["word", "Other", "BIG", "a#b", "x", "cost$", "end."]
    texts = [" ".join([rng.choice(pieces[:rng.randint(1, 7)])] * rng.randint(0, 3) + [f"w{k}" for k in range(rng.choice((0, 3, 250)))])
             for _ in range(8)] + [None, "", "\t \n", "\x0b\x1c a"]
    docs = [(rng.choice([None, *range(30)]), rng.choice(texts), rng.choice(["en", "de", "", None]), "x", 1) for _ in range(60)]
    labels = [(rng.choice([None, *range(30)]), rng.choice([0, 1, None]), rng.choice([0, 1, None]), "zz") for _ in range(30)]
    return docs + docs[:5], labels


@pytest.mark.parametrize("seed", range(3))
def test_against_plain_orders(spark, seed):
    docs, labels = case(seed)
    d, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    got = op13.filter_audit(op13.failure_counts(d, lab))
    assert sorted(map(tuple, got.collect())) == plain(docs, labels)
    con = duckdb.connect()
    con.register("documents", d.toPandas().astype({"doc_id": "Int64"}))
    con.register("labels", lab.toPandas().astype({"doc_id": "Int64", "quality": "Int64", "toxic": "Int64"}))
    rows = con.sql(op13.ORACLE).project(", ".join(got.columns)).fetchall()
    assert sorted(rows) == plain(docs, labels)


def test_empty_table(spark):
    got = op13.filter_audit(op13.failure_counts(spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)))
    assert got.count() == 0


@pytest.mark.parametrize("m", [2, 3, 5])
def test_least_squares_gives_the_shapley_value(m):
    rng = random.Random(m)
    v = [0] + [rng.randint(-50, 50) for _ in range(2 ** m - 1)]
    shares = [sum(c * x for c, x in zip(row, v)) for row in op13.shapley_matrix(m)]
    for i in range(m):
        total = 0
        for order in permutations(range(m)):
            before = sum(1 << j for j in order[:order.index(i)])
            total += v[before | 1 << i] - v[before]
        assert shares[i] == Fraction(total, factorial(m))
    assert sum(shares) == v[-1]


def test_copies_of_one_text_meet_as_few_rows(spark):
    """A text that many rows share is counted before it meets: its rows are no join key."""
    docs = [(k, "same text", "en", "x", 1) for k in range(2000)] + [(5, "same text", "de", "x", 1)]
    counts = op13.failure_counts(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], LABELS))
    assert {(r.part, r["mask"], r.n) for r in counts.collect()} == {("en", 1, 1), ("en", 17, 1999), ("de", 17, 1)}
