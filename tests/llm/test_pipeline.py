"""Pipeline stages against plain Python on the smallest tables; queries of the subpackage against their oracles."""

import random

import duckdb
import pytest

import corpus_pipeline
from scripts.check_oracles import _digest
from tessera.llm import ORACLES, QUERIES
from tessera.session import settle
from tessera.sources.readers import TABLES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    result = con.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(df.columns)
    assert _digest(df.columns, [tuple(r) for r in df.collect()])[0] == _digest(names, result.fetchall())[0]


def test_stages(spark):
    """Each stage keeps its contract on what the stage before left."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = settle(stage(spark, docs, SF))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            after = {r.doc_id: r.text for r in docs.collect()}
            assert set(after) <= set(before) and len(after) == docs.count()
            sizes.append(len(after))
            if name.startswith("suffix"):
                whole = b"\0".join(t.encode() for t in after.values())
                spans = [whole[s:s + 200] for s in range(len(whole) - 199) if b"\0" not in whole[s:s + 200]]
                assert set(after) == set(before) and all(len(after[i]) <= len(before[i]) for i in after)
                joins = len(spans) - len(set(spans))  # only strings that a cut has brought together can repeat now
                assert joins < len(whole) / 100
            else:
                assert all(after[i] == before[i] for i in after)
        else:
            assert {r.doc_id for r in docs.select("doc_id").collect()} == set(before)
    assert sizes[0] > sizes[1] > sizes[2] >= sizes[3] >= sizes[4] > 0


def test_near_duplicates_of_repeated_ids(spark):
    """Different texts under one id link nothing and do not take each other away."""
    rng = random.Random(5)
    a, b, c, d = (" ".join(f"w{rng.randrange(10_000)}" for _ in range(60)) for _ in range(4))
    rows = [(1, a), (7, a), (7, b), (7, b), (7, c), (9, c), (2, d), (2, d), (2, None), (3, ""), (None, a)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_duplicates(spark, docs, SF)
    assert kept.columns == docs.columns
    want = [(1, a), (7, b), (7, c), (2, d), (2, None), (None, a)]
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=repr) == sorted(want, key=repr)
