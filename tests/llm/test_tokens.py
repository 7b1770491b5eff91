"""Ids by pieces equal the library's ids of the whole text."""

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from tessera.llm.tokens import encode_texts, load, slices, tokenizer_path

WORD = tokenizer_path("word_bpe_49k.json")


def library(path, text):
    return np.array(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("seed", range(3))
def test_ids_of_random_texts(seed):
    rng = random.Random(seed)
    chars = [*map(chr, range(0x250)), *"abc 123.,!? \n\t\x1c\x85\xa0" * 10, *"'s't're've'm'll'd" * 5,
             "<|endoftext|>", "<|ENDOFTEXT|>", "İ", "Σ", "ς", "é", "日本", "🙂"]
    texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 15))) for _ in range(400)]
    full = Tokenizer.from_file(WORD)
    want = [np.array(full.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert encode_texts(WORD, [t.encode() for t in texts]) == want


def test_long_texts_go_in_slices():
    text = " ".join(f"Word{i % 97} don't, {i}!" for i in range(500))
    assert b"".join(slices(text.encode(), 50)) == text.encode()
    assert list(slices(b"x" * 300, 50)) == [b"x" * 300]
    assert encode_texts(WORD, [text.encode(), b"", b"x" * 300], limit=50) == [library(WORD, t) for t in (text, "", "x" * 300)]


def test_invalid_utf8_is_read_with_replacement():
    raw = b"caf\xff\xfe ok"
    assert encode_texts(WORD, [raw]) == [library(WORD, raw.decode("utf-8", "replace"))]


def test_other_tokenizers_go_through_the_library():
    path = tokenizer_path("byte_bpe_50k.json")
    assert load(path).findall is None
    assert encode_texts(path, [b"Hello"]) == [library(path, "Hello")]


def test_long_pieces_are_not_remembered():
    encode_texts(WORD, [b"y" * 5000 + b" short"])
    assert "short" in load(WORD).known and not any(len(p) > 64 for p in load(WORD).known)


def test_frequent_lengths_are_dealt_over_buckets(spark, monkeypatch):
    """Ranks within a length that is dealt over many buckets still fill every sequence without a gap."""
    from tessera.llm import op05_packing
    monkeypatch.setattr(op05_packing, "BUCKET_ROWS", 7)
    docs = spark.createDataFrame([(k % 300, "one two " * (1 + k % 5 // 4)) for k in range(900)], "doc_id long, text string").repartition(4)
    got = op05_packing.pack_documents(docs, WORD, capacity=16).collect()
    assert len(got) == 900
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert ends.get(r.sequence_id, 0) == r.offset
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 16
