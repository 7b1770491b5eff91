"""Every operator on nulls, empty and long texts, repeated rows, empty tables and clashing column names."""

import hashlib
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import op01_warc, op02_token_counts, op03_chat, op04_ann, op05_packing, op06_quality, op07_simhash
from tessera.llm import op08_toxicity, op09_suffix, op10_tiling
from tessera.llm.labelled import label_sample
from tessera.llm.tokens import tokenizer_path

CLASHING = ["row", "place", "h", "n", "fp", "key", "rep", "kept", "n_bytes", "chunk", "salt", "score", "carry", "s", "e", "u", "v"]


def _sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    long = _sentence(rng, 30_000)
    shared = _sentence(rng, 80)
    base = _sentence(rng, 120)
    return [(1, None), (2, ""), (3, "Word"), (4, base), (5, base), (5, base), (6, base.replace("a", "b", 1)), (7, long),
            (8, _sentence(rng, 30) + "\n" + shared), (9, shared + " " + _sentence(rng, 40)), (10, "é" * 400), (11, "ab" * 300),
            (None, base), (None, "no id"), (12, "   \n\t "), (13, "x <|endoftext|> y")]


@pytest.fixture(scope="module")
def docs(spark, texts):
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    return df.select("doc_id", "text", *(F.lit("clash").alias(c) for c in CLASHING))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_token_counts(docs, texts):
    path = tokenizer_path("byte_bpe_50k.json")
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    want = sorted([(i, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in texts], key=repr)
    assert rows_of(op02_token_counts.token_counts(docs, path)) == want
    assert op02_token_counts.token_counts(docs.limit(0), path).count() == 0


def test_packing(docs, texts):
    path = tokenizer_path("word_bpe_49k.json")
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    got = op05_packing.pack_documents(docs, path, with_ids=True).collect()
    want = []
    for i, t in texts:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want += [(i, k, s, len(ids[s:s + 2048]), zlib.crc32(ids[s:s + 2048].tobytes()))
                 for k, s in enumerate(range(0, len(ids), 2048))]
    assert sorted([tuple(r)[:5] for r in got], key=repr) == sorted(want, key=repr)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    at = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert at.get(r.sequence_id, 0) == r.offset
        at[r.sequence_id] = r.offset + r.length
    assert max(at.values()) <= 2048
    assert op05_packing.pack_documents(docs.limit(0), path).count() == 0


@pytest.mark.parametrize("seed", range(8))
def test_pack_histogram_uses_every_piece_once(seed):
    rng = random.Random(seed)
    cap = rng.choice([10, 64, 500])
    hist = {rng.randint(1, cap): rng.choice([1, 2, 5, 300]) for _ in range(rng.randint(0, 40))}
    used = {}
    for times, lengths in op05_packing.pack_histogram(hist, cap):
        assert times > 0 and 0 < sum(lengths) <= cap
        for w in lengths:
            used[w] = used.get(w, 0) + times
    assert used == hist


@pytest.mark.parametrize("low, high", [(700, 1400), (200, 1100), (300, 900)])
def test_plan_is_bounded_by_the_lengths(low, high):
    for pieces in (20_000, 80_000):
        rng = random.Random(1)
        hist = {}
        for _ in range(pieces):
            w = rng.randint(low, high)
            hist[w] = hist.get(w, 0) + 1
        plan = op05_packing.pack_histogram(hist)
        assert len(plan) <= 3 * len(hist) and sum(n * len(lengths) for n, lengths in plan) == pieces


def _fewest(items, cap):
    best = [len(items)]

    def place(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + items[k] <= cap:
                place(k + 1, bins[:i] + [bins[i] + items[k]] + bins[i + 1:])
        place(k + 1, bins + [items[k]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(12))
def test_dominance_reduction_keeps_the_optimum(seed):
    rng = random.Random(seed)
    cap = 20
    items = sorted((rng.randint(3, 19) for _ in range(9)), reverse=True)
    counts = [items.count(w) for w in range(cap + 1)]
    fixed = op05_packing.reduce_dominance(counts, cap)
    left = [w for w in range(cap, 0, -1) for _ in range(counts[w])]
    assert sum(t for t, _ in fixed) + (_fewest(left, cap) if left else 0) == _fewest(items, cap)


def _fingerprint(text, k=4):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split(" ")
    words = [w for x in words for w in x.replace("\n", " ").replace("\t", " ").split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, texts):
    got = op07_simhash.simhash_components(docs).collect()
    prints = [(i, _fingerprint(t)) for i, t in texts]
    assert sorted([(r.doc_id, r.fp % (1 << 64)) for r in got], key=repr) == sorted(prints, key=repr)
    named = {i: f for i, f in prints if i is not None}
    root = {i: i for i in named}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in named:
        for b in named:
            if (named[a] ^ named[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    assert {(r.doc_id, r.component_id) for r in got} == {(i, find(i)) for i in named} | {(None, None)}
    assert op07_simhash.simhash_components(docs.limit(0)).count() == 0


@pytest.mark.parametrize("distance", [2, 4])
def test_simhash_loses_no_link(spark, distance):
    """Fingerprints planted at exactly ``distance`` bits, also across segments, meet; one bit more does not link."""
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 60, np.int64)
    rows = []
    for k, f in enumerate(base.tolist()):
        g = f
        for b in rng.choice(63, distance + (k % 2), replace=False).tolist():
            g ^= 1 << b
        rows += [(f, 2 * k), (g, 2 * k + 1)]
    keyed = spark.createDataFrame(rows, "fp long, rep long").select(
        F.explode(F.array(*op07_simhash._forms(F.col("fp"), distance))).alias("key"), "fp", "rep")
    edges = (keyed.repartition("key").sortWithinPartitions("key", "fp")
             .mapInArrow(op07_simhash._verify(distance), "u long, v long").distinct().collect())
    assert {(r.u, r.v) for r in edges} == {(2 * k, 2 * k + 1) for k in range(60) if k % 2 == 0}


def test_simhash_splits_hot_keys(spark):
    """Many fingerprints with an equal segment: small groups, and every pair within the distance still meets."""
    rng = np.random.default_rng(2)
    fps = set()
    for at, width in op07_simhash._segments(64, 4):
        own = rng.integers(0, 1 << 63, 250, np.int64).astype(np.uint64)
        mask = np.uint64(((1 << width) - 1) << at)
        for f in ((own & ~mask) | (np.uint64(0x0F0F3355AA55CC33) & mask)).tolist():
            g = f
            for b in rng.choice(64, rng.integers(1, 6), replace=False).tolist():
                g ^= 1 << b
            fps |= {f, g}
    signed = np.array(sorted(fps), np.uint64).view(np.int64).tolist()
    keyed = op07_simhash.keyed_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp long"), 4, most=60).cache()
    assert keyed.groupBy("key").count().agg(F.max("count")).first()[0] <= 60
    edges = keyed.repartition("key").sortWithinPartitions("key", "fp").mapInArrow(op07_simhash._verify(4), "u long, v long")
    near = {(a, b) for k, a in enumerate(signed) for b in signed[k + 1:] if ((a ^ b) % (1 << 64)).bit_count() <= 4}
    want, got = _roots(signed, near), _roots(signed, {(r.u, r.v) for r in edges.collect()})
    assert len(near) > 400 and want == got
    whole = op07_simhash.keyed_fingerprints(spark.createDataFrame([(f,) for f in signed], "fp long"), 4)
    assert whole.groupBy("key").count().agg(F.max("count")).first()[0] > 200


def _roots(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def _covered(texts, span):
    seen, out = {}, []
    data = [(t or "").encode() for _, t in texts]
    for t in data:
        for s in range(len(t) - span + 1):
            seen[t[s:s + span]] = seen.get(t[s:s + span], 0) + 1
    for t in data:
        mask = np.zeros(len(t) + 1, bool)
        for s in range(len(t) - span + 1):
            if seen[t[s:s + span]] > 1:
                mask[s:s + span] = True
        kept = bytes(np.frombuffer(t, np.uint8)[~mask[:-1]])
        out.append((len(t), int(mask.sum()), int((np.diff(mask.astype(int)) == 1).sum() + mask[0]), hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup(docs, texts):
    got = op09_suffix.suffix_dedup(docs)
    got = rows_of(got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)))
    assert got == sorted([(i, *r) for (i, _), r in zip(texts, _covered(texts, 200))], key=repr)
    assert op09_suffix.suffix_dedup(docs.limit(0), carry=("salt",)).count() == 0


def test_suffix_dedup_of_a_frequent_passage(spark):
    """One passage in very many documents, with its offsets split over blocks."""
    rng = random.Random(5)
    passage = _sentence(rng, 60)[:260]
    texts = [(i, _sentence(rng, 12) + passage + _sentence(rng, 12)) for i in range(700)]
    got = op09_suffix.suffix_dedup(spark.createDataFrame(texts, "doc_id long, text string"))
    got = rows_of(got.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)))
    assert got == sorted([(i, *r) for (i, _), r in zip(texts, _covered(texts, 200))], key=repr)


def test_multikey_ties():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 600).astype(np.uint8)
    start, group = np.arange(580), np.zeros(580, np.int64)
    for span in (8, 11, 20):
        grams = [data[s:s + span].tobytes() for s in range(580)]
        assert op09_suffix.multikey_ties(data, start, group, span).tolist() == [grams.count(g) > 1 for g in grams]


def test_decontamination(spark, docs):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight nine ten"), (2, None), (3, ""), (4, "Tiny item"),
                                   (5, "a b c d e f g h i j k l")], "item_id long, text string")
    found = [(1, "zzz ONE two, three four five six seven eight nine ten yyy"), (2, None), (3, ""),
             (4, "six seven eight nine ten -- and then one two three four five"), (5, "one two three four five other words"),
             (6, "a tiny item"), (7, "g h i j k l x a b c d e f"), (7, "g h i j k l x a b c d e f"), (None, "one two three four five six seven eight nine ten")]
    df = spark.createDataFrame(found, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    pairs = op10_tiling.contaminated_pairs(df, bench).select("doc_id", "item_id", "covered_words", "n_tiles")
    assert rows_of(pairs) == sorted([(1, 1, 10, 1), (4, 1, 10, 2), (6, 4, 2, 1), (7, 5, 12, 2), (7, 5, 12, 2), (None, 1, 10, 1)], key=repr)
    tiles = {r.doc_id: [tuple(t) for t in r.tiles] for r in op10_tiling.contaminated_pairs(df, bench).collect()}
    assert sorted(tiles[4]) == [(0, 5, 5), (7, 0, 5)] and tiles[1] == [(1, 0, 10)]
    kept = op10_tiling.decontaminate(df, bench)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 5]
    assert op10_tiling.contaminated_pairs(docs.limit(0), bench).count() == 0
    assert op10_tiling.contaminated_pairs(df, bench.limit(0)).count() == 0


def test_decontamination_with_null_item_ids(spark):
    bench = spark.createDataFrame([(None, "a b c d e f"), (3, "g h i j k l"), (None, "m n o p q r"), (None, None), (-1, "tiny")],
                                  "item_id long, text string").coalesce(1)
    df = spark.createDataFrame([(1, "x a b c d e f"), (2, "g h i j k l"), (3, "m n o p q r"), (4, "clean"), (None, "tiny")],
                               "doc_id long, text string")
    pairs = op10_tiling.contaminated_pairs(df, bench).select("doc_id", "item_id")
    assert rows_of(pairs) == sorted([(1, None), (2, 3), (3, None), (None, -1)], key=repr)
    assert [r.doc_id for r in op10_tiling.decontaminate(df, bench).collect()] == [4]


def test_greedy_tiles_longest_first():
    item = [1, 2, 3, 4, 5, 6, 7, 8]
    assert op10_tiling.greedy_tiles(item, [[4, 5, 6, 7, 8, 9, 1, 2, 3], [1, 2]], 2) == [(3, 0, 0, 5), (0, 0, 6, 3)]
    assert op10_tiling.greedy_tiles([1, 1, 1, 1], [[1, 1, 1]], 2) == [(0, 0, 0, 3)]


def test_warc_round_trip(spark):
    rows = [(1, "http://a", "same"), (2, None, "same"), (3, "u\r\nv", None), (4, "http://b", ""), (5, "x", "ü" * 50_000), (5, "x", "ü" * 50_000),
            (None, "n", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit("clash")).repartition(2)
    archives = op01_warc.write_warc(pages)
    got = op01_warc.read_warc(archives).select("record_id", "record_type", "payload_bytes", "refers_to", "payload").collect()
    got = sorted([(r.record_id[10:-1], r.record_type, r.payload_bytes, r.refers_to and r.refers_to[10:-1], bytes(r.payload).decode()) for r in got], key=repr)
    long = "ü" * 50_000
    assert got == sorted([("1", "response", 4, None, "same"), ("2", "revisit", 4, "1", ""), ("null", "revisit", 4, "1", ""),
                          ("3", "response", 0, None, ""), ("4", "revisit", 0, "3", ""), ("5", "response", 100_000, None, long),
                          ("5", "response", 100_000, None, long)], key=repr)
    alone = op01_warc.read_warc(op01_warc.write_warc(pages, least=5)).where("record_type = 'revisit'").count()
    assert alone == 0
    assert op01_warc.write_warc(pages.limit(0)).count() == 0


def test_warc_rejects_damage():
    record = op01_warc.record_bytes(1, "u", b"payload", "X", None, False)
    with pytest.raises(op01_warc.WarcError, match="digest"):
        op01_warc.parse_record(record)
    with pytest.raises(op01_warc.WarcError, match="Content-Length"):
        op01_warc.parse_record(record[:-5])
    with pytest.raises(op01_warc.WarcError, match="missing"):
        op01_warc.parse_record(b"WARC/1.1\r\nA: b\r\n\r\n\r\n\r\n")
    good = op01_warc.pack_archive([op01_warc.record_bytes(k, None, b"%d" % k * 50, "X", 1, True) for k in range(40)])
    assert len(list(op01_warc.frames(good))) == 40
    with pytest.raises(op01_warc.WarcError, match="dictionary"):
        list(op01_warc.frames(good[8:]))
    with pytest.raises(Exception):
        list(op01_warc.frames(good[:-3]))


def test_chat(spark):
    text = "\\### Assistant: </turn> ok"
    rows = [(1, 0, "user", text), (1, 1, "assistant", text), (1, 2, "user", None), (1, 3, "assistant", ""), (1, 4, "assistant", "é\\\\#"),
            (2, 0, None, "x"), (2, 0, "assistant", "b"), (2, 0, "assistant", "b"), (None, None, "sy:s", "y")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("start", F.lit("clash"))
    turns = op03_chat.format_conversations(df).cache()
    got = {r.conv_id: r for r in op03_chat.read_back(turns).collect()}
    for conv in (1, 2, None):
        own = sorted([(t or 0, r or "", x or "") for c, t, r, x in rows if c == conv])
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in own).encode()).hexdigest()
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    full = op03_chat.example_text(turns, op03_chat.prefix_examples(turns)).collect()
    assert len(full) == 5
    for r in full:
        replies = [op03_chat.unescape(r.text[r.loss_start:r.loss_end])]
        segments = [x for x in r.text.split("</turn>\n")[:-1]]
        assert r.text.endswith("</turn>\n") and replies[0] in (text, "", "é\\\\#", "b") and len(segments) >= 1
    assert op03_chat.read_back(op03_chat.format_conversations(df.limit(0))).count() == 0


def test_chat_reads_the_examples(spark, monkeypatch):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b: c"), (1, 2, "assistant", ""), (None, 0, "assistant", "###")]
    turns = op03_chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).cache()
    made = op03_chat.prefix_examples(turns)
    got = {r.conv_id: (r.n_examples, r.loss_chars) for r in op03_chat.read_back(turns, made).collect()}
    assert got == {1: (2, 4), None: (1, 3)}
    first = F.col("conv_id").eqNullSafe(1) & (F.col("target_turn") == 1)
    shifted = [made.withColumn(c, F.when(first, F.col(c) + d).otherwise(F.col(c)))
               for c in ("context_chars", "loss_start", "loss_end", "end") for d in (-1, 1)]
    for wrong in [made.where(~first), made.where("conv_id is not null"), made.union(made.where(first)),
                  made.withColumn("target_turn", F.when(first, 0).otherwise(F.col("target_turn"))), *shifted]:
        with pytest.raises(Exception, match="example|reply"):
            op03_chat.read_back(turns, wrong).collect()
    monkeypatch.setattr(op03_chat, "prefix_examples", lambda t: made.limit(0))
    with pytest.raises(Exception, match="no example"):  # the query stands on its examples
        op03_chat.op3_chat(spark, "/root/testdata/sf0.001").collect()


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((600, 24)).astype(np.float32)
    x[100:110] = x[50]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(600, None), (601, [0.0] * 24), (602, [float("nan")] * 24), (603, [None] * 24), (604, []), (650, [1.0, 2.0]), (651, [2.0, 4.0]),
             (None, [1.0] * 24), (7, x[7].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("code", F.lit("clash"))
    index = op04_ann.build_index(df)
    got = op04_ann.nearest(index, index.where("vec_id % 50 = 0")).collect()
    double = x.astype(np.float64)
    unit = double / np.linalg.norm(double, axis=1, keepdims=True)
    for q in range(0, 600, 50):
        score = unit @ unit[q]
        order = [i for i in np.lexsort((np.arange(600), -score.round(12))) if i != q][:5]
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[1] for m in mine] == order and np.allclose([m[2] for m in mine], score[order])
    assert [(r.rank, r.vec_id) for r in got if r.query_id == 650] == [(1, 651)]
    assert not {r.query_id for r in got} - set(range(0, 651, 50))
    empty = index.limit(0)
    assert op04_ann.nearest(empty, empty).count() == 0


def test_one_bit_estimates_hold_their_bounds():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    codes, scalar = op04_ann.encode(x)
    est, bound = op04_ann.estimate(codes, scalar, x[:20])
    error = np.abs(est - x @ x[:20].T)
    assert codes.shape == (400, 8) and (error <= bound[:, None] + 1e-5).mean() > 0.999


def test_label_sample_is_bounded_by_rows(spark):
    ids = [i for i in range(100, 140) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, f"text {i} {k}") for i in ids for k in range(50 if i == ids[0] else 1)] + [(ids[1], None), (ids[2], f"text {ids[2]} 0")]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = label_sample(df, labels, "quality", 12).collect()
    assert len(got) == len({r.doc_id for r in got}) == 24 and sum(r.y for r in got) == 12
    assert all((r.doc_id, bytes(r.text).decode() or None) in rows and r.y == r.doc_id % 2 for r in got)
    every = label_sample(df, labels, "quality", 100)
    assert every.count() == len(ids) and rows_of(every) == rows_of(label_sample(df.repartition(7), labels, "quality", 100))


def test_quality(spark, docs, texts):
    good = [(100 + i, " ".join(["Plain words make up a line."] * 3) + f"\nThey end well, number {i}.") for i in range(40)]
    bad = [(200 + i, "BUY!! NOW!! CHEAP!! BUY!! NOW!!\n" + "spam spam spam spam spam spam " * (i % 3 + 1)) for i in range(40)]
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(100, None), (None, 1)], "doc_id long, quality int")
    df = spark.createDataFrame(good + bad, "doc_id long, text string")
    chain = op06_quality.fit_quality(df, labels)
    scored = {r.doc_id: r.score for r in op06_quality.quality_scores(df, chain).collect()}
    assert all(scored[i] >= 0.3 for i, _ in good) and all(scored[i] < 0.3 for i, _ in bad)
    odd = op06_quality.quality_scores(docs, chain).collect()
    assert len(odd) == len(texts) and all(0 <= r.score <= 1 for r in odd)
    kept = op06_quality.quality_filter(df.withColumn("score", F.lit("clash")), chain)
    assert sorted(r.doc_id for r in kept.collect()) == [i for i, _ in good]
    blank = op06_quality.fit_quality(df, labels.limit(0))
    assert {r.score for r in op06_quality.quality_scores(docs.where("doc_id < 3"), blank).collect()} == {0.5}


def test_chain_marginals_match_enumeration():
    rng = np.random.default_rng(0)
    chain = op06_quality.Chain(np.zeros(1), (0.7, 1.3), 0, 1, 0.5)
    sizes = np.array([1, 4, 0, 3])
    u = rng.standard_normal(8)
    fwd, bwd = chain.messages(u, sizes)
    p = 1 / (1 + np.exp(-(fwd + bwd)))
    at = 0
    for n in sizes.tolist():
        weight, total = np.zeros(n), 0.0
        for code in range(1 << n):
            y = [(code >> k) & 1 for k in range(n)]
            w = np.exp(sum(u[at + k] * y[k] for k in range(n)) +
                       sum(0.7 if a + b == 0 else 1.3 if a + b == 2 else 0 for a, b in zip(y, y[1:])))
            total += w
            weight += w * np.array(y)
        if n:
            assert np.allclose(p[at:at + n], weight / total)
        at += n


def test_toxicity(spark, docs, texts):
    rng = random.Random(2)
    insults = ["zorgblat", "quimfex", "vuntrop"]
    clean = [(100 + i, _sentence(rng, 30) + ". " + _sentence(rng, 20)) for i in range(150)]
    toxic = [(300 + i, _sentence(rng, 15) + ". " + _sentence(rng, 5) + f" {rng.choice(insults)} " + _sentence(rng, 5)) for i in range(150)]
    df = spark.createDataFrame(clean + toxic, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0) for i, _ in clean] + [(i, 1) for i, _ in toxic] + [(100, None)], "doc_id long, toxic int")
    model = op08_toxicity.fit_toxicity(df, labels)
    scored = {r.doc_id: r.score for r in op08_toxicity.toxicity_scores(df, model).collect()}
    right = sum(scored[i] < 0.5 for i, _ in clean) + sum(scored[i] >= 0.5 for i, _ in toxic)
    assert right >= 295
    gapped = model.scores(["abc zor-gbl.at abc", "z o r g b l a t", "zo_rgblat"])
    assert (gapped >= 0.5).all(), gapped
    odd = op08_toxicity.toxicity_scores(docs, model).collect()
    assert len(odd) == len(texts) and all(0 <= r.score <= 1 for r in odd)
    assert op08_toxicity.toxicity_scores(docs.limit(0), model).count() == 0
    assert op08_toxicity.fit_toxicity(df, labels.where("toxic = 0")).scores(["x"]).tolist() == [0.0]


def test_word_kernel_matches_brute_force():
    from itertools import combinations
    names = op08_toxicity.marked(["idiot", "lose"])
    words = op08_toxicity.marked(["idiot", "ididot", "closer", "", "xyz"])

    def phi(w):
        out = {}
        for i, j, k in combinations(range(len(w)), 3):
            if k - i <= op08_toxicity.REACH:
                out[w[i], w[j], w[k]] = out.get((w[i], w[j], w[k]), 0) + op08_toxicity.DECAY ** (k - i - 2)
        return out

    def cosine(a, b):
        size = np.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))
        return sum(a.get(g, 0) * x for g, x in b.items()) / size if size else 0.0

    want = [[cosine(a, b) ** op08_toxicity.POWER for b in map(phi, names)] for a in map(phi, words)]
    assert np.allclose(op08_toxicity.WordKernel(names)(words), want)
    assert op08_toxicity.WordKernel(names)([]).shape == (0, 2)


def test_word_kernel_is_one_kernel():
    """Symmetric, 1 for equal strings, without negative eigenvalues; word beginnings included."""
    rng = random.Random(9)
    names = list({"\1" + "".join(rng.choice("abcde") for _ in range(rng.randint(4, 9))) + rng.choice(("", "\2")) for _ in range(40)})
    gram = op08_toxicity.WordKernel(names)(names)
    assert np.allclose(gram, gram.T) and np.allclose(np.diag(gram), 1) and np.linalg.eigvalsh(gram).min() > -1e-9


def test_toxicity_of_held_out_rows(spark):
    """On the given tables: most toxic documents found, few clean ones flagged."""
    import duckdb
    got = op08_toxicity.op8_toxicity(spark, "/root/testdata/sf0.1").where("held_out").select("doc_id", "predicted").toPandas()
    labels = duckdb.sql("SELECT doc_id, toxic FROM read_parquet('/root/testdata/sf0.1/labels.parquet')").df()
    both = got.merge(labels, on="doc_id")
    hit = ((both.predicted == 1) & (both.toxic == 1)).sum()
    assert len(both) > 500 and hit >= 0.75 * (both.toxic == 1).sum() and hit >= 0.75 * (both.predicted == 1).sum()
