"""Token counts from distinct pre-tokens, without materialising ids.

A pre-token here is a run of white space with the run of other characters
after it: the library cuts its own pre-tokens inside these and merges nothing
across them, so a text has as many tokens as its pre-tokens together.

1. Documents are read in chunks. A chunk keeps its distinct pre-tokens and,
   per document, the frequency of each (packed numbers, no text).
2. The distinct pre-tokens of all chunks meet by hash; the tokenizer sees each
   one once. Blobs of a chunk and hash range are one row, not a row a word.
   The number of ranges follows the bytes read. A task reads its rows one by
   one and holds the counts of one range's pre-tokens, up to ``KNOWN_BYTES``
   of them (beyond that it forgets them and asks the tokenizer again).
3. The counts go back to the chunks, where frequency times count is summed.

Defined results: null and empty texts have 0 tokens and bytes; repeated rows
are counted each; an empty table gives no rows; columns other than the id and
the text are not read. Special strings inside a text count as the library
takes them by default (as their one special id).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordered import read_bytes
from .common import arrow_map, id_text, settle, table
from .tokens import load, tokenizer_path

CHUNK = 8 << 20  # bytes of text whose vocabulary is kept together
RANGE_BYTES = 16 << 30  # bytes read for each hash range; distinct pre-tokens grow more slowly than the text
KNOWN_BYTES = 128 << 20  # of pre-tokens whose counts a task remembers
LIMIT = 1024
# Unicode white space, as in the pattern of the tokenizer (fixed values)
_WS = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRE_TOKEN = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")


def _ranges(words: list[str], parts: int) -> np.ndarray:
    return np.fromiter((xxhash.xxh32_intdigest(w) for w in words), np.uint32, len(words)) % np.uint32(parts)


def _chunk(ids: list, texts: list[bytes], parts: int) -> dict:
    """One chunk: per hash range its pre-tokens in order, and per document the frequencies."""
    split = [PRE_TOKEN.findall(t.decode("utf-8", "replace")) for t in texts]
    words = list({w for s in split for w in s})
    part = _ranges(words, parts)
    order = np.argsort(part, kind="stable")
    number = {words[i]: k for k, i in enumerate(order.tolist())}
    counts = np.bincount(part, minlength=parts)
    ordered = [words[i] for i in order.tolist()]
    edges = np.concatenate(([0], np.cumsum(counts))).tolist()
    blobs = [(p, pack_words(ordered[edges[p]:edges[p + 1]])) for p in np.flatnonzero(counts).tolist()]
    doc = np.repeat(np.arange(len(texts)), [len(s) for s in split])
    at = np.fromiter((number[w] for s in split for w in s), np.int64, len(doc))
    pair, n = np.unique(doc * max(len(words), 1) + at, return_counts=True)
    freq = np.stack([pair // max(len(words), 1), pair % max(len(words), 1), n]).astype("<u4")
    freq[1, 1:] = np.diff(freq[1].astype(np.int64)).astype("<i4").view("<u4")  # steps pack better than places
    freq[0, 1:] = np.diff(freq[0])
    return {"ids": ids, "n_bytes": list(map(len, texts)), "blobs": blobs,
            "freq": zstandard.ZstdCompressor(3).compress(np.ascontiguousarray(freq).view(np.uint8).reshape(-1, 4).T.tobytes())}


def pack_words(words: list[str]) -> bytes:
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    length = np.fromiter(map(len, raw), "<u4", len(raw))
    return zstandard.ZstdCompressor(1).compress(np.uint32(len(raw)).tobytes() + length.tobytes() + b"".join(raw))


def unpack_words(blob: bytes) -> list[bytes]:
    data = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(data, "<u4", 1)[0])
    ends = (4 + 4 * n + np.cumsum(np.frombuffer(data, "<u4", n, 4), dtype=np.int64)).tolist()
    return [data[s:e] for s, e in zip([4 + 4 * n, *ends], ends)]


CHUNK_SCHEMA = "chunk string, ids array<long>, n_bytes array<long>, freq binary, blobs array<struct<part: int, words: binary>>"
CHUNK_ARROW = pa.schema([("chunk", pa.string()), ("ids", pa.list_(pa.int64())), ("n_bytes", pa.list_(pa.int64())), ("freq", pa.binary()),
                         ("blobs", pa.list_(pa.struct([("part", pa.int32()), ("words", pa.binary())])))])


def _chunks(parts: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        names, texts, size, number = [], [], 0, 0

        def close():
            nonlocal number
            made = _chunk(names, texts, parts)
            row = {"chunk": f"{TaskContext.get().partitionId()}-{number}", **made,
                   "blobs": [{"part": p, "words": w} for p, w in made["blobs"]]}
            number += 1
            return pa.RecordBatch.from_pylist([row], schema=CHUNK_ARROW)

        for batch in batches:
            for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                names.append(name)
                texts.append(text)
                size += len(text) + 100
                if size >= CHUNK:
                    yield close()
                    names, texts, size = [], [], 0
        if names:
            yield close()

    return run


def _count_pieces(path: str, room: int):
    """Rows sorted by range come in; the pre-tokens of a range are asked for once, row by row."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = load(path).full
        known: dict[bytes, int] = {}
        size, last = 0, None
        for batch in batches:
            counts: list[bytes] = []
            for part, blob in zip(batch.column("part").to_pylist(), batch.column("words")):
                if part != last or size > room:
                    known, size, last = {}, 0, part
                words = unpack_words(blob.as_py())
                new = [w for w in words if w not in known]
                for s in range(0, len(new), 1 << 14):
                    some = new[s:s + (1 << 14)]
                    found = tok.encode_batch_fast([w.decode("utf-8", "replace") for w in some], add_special_tokens=False)
                    known.update(zip(some, map(len, found)))
                size += sum(map(len, new)) + 100 * len(new)
                counts.append(np.fromiter(map(known.__getitem__, words), "<u4", len(words)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("part"), pa.array(counts, pa.binary())],
                                             names=["chunk", "part", "pieces"])

    return run


def _sum(batch: pa.RecordBatch) -> dict:
    ids, sizes, tokens = [], [], []
    for names, n_bytes, freq, back in zip(*(batch.column(c).to_pylist() for c in ("ids", "n_bytes", "freq", "back"))):
        weight = np.frombuffer(b"".join(r["pieces"] for r in sorted(back or (), key=lambda r: r["part"])), "<u4").astype(np.int64)
        data = zstandard.ZstdDecompressor().decompress(freq)
        f = np.frombuffer(data, np.uint8).reshape(4, -1).T.copy().view("<u4").reshape(3, -1).astype(np.int64)
        doc, at = np.cumsum(f[0]), np.cumsum(f[1].astype("<u4").view("<i4").astype(np.int64))
        ids += names
        sizes += n_bytes
        tokens += np.bincount(doc, f[2] * weight[at], minlength=len(names)).astype(np.int64).tolist()
    return {"doc_id": ids, "n_bytes": sizes, "n_tokens": tokens}


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)`` of every whole text."""
    text = id_text(docs, id_col, text_col)
    least = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, read_bytes(docs) // RANGE_BYTES)
    chunks = settle(text.mapInArrow(_chunks(parts), CHUNK_SCHEMA))
    words = chunks.select("chunk", F.explode("blobs").alias("b")).select("chunk", "b.part", "b.words")
    dealt = words.repartition(parts // 4, "part") if parts > least else words.repartition("part")
    pieces = dealt.sortWithinPartitions("part").mapInArrow(_count_pieces(path, KNOWN_BYTES), "chunk string, part int, pieces binary")
    back = pieces.groupBy("chunk").agg(F.collect_list(F.struct("part", "pieces")).alias("back"))
    joined = chunks.select("chunk", "ids", "n_bytes", "freq").join(back, "chunk", "left")
    return arrow_map(joined, _sum, "doc_id long, n_bytes long, n_tokens long")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
