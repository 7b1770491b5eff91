"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items become lower-cased word tokens. A shared run of
``seed`` tokens joins a document to an item; for each joined pair the longest
common token runs are marked greedily, longest first and without overlap (a
running Karp-Rabin hash finds the runs of each length), down to ``seed``
tokens. The share of the item's tokens under tiles is its coverage, whatever
the order of the tiles, so a passage cut up and reordered still counts. A pair
is contaminated at a coverage of ``threshold`` or more.

The benchmark is read in blocks of at most about 32 MB of text. Each block is
broadcast and meets all documents in one pass, so any benchmark size works.

Defined results: null and word-less texts match nothing; an item with fewer
than ``seed`` words is seeded by its whole length; repeated rows and ties are
reported for each row (leftmost run first); rows with a null document or item
id are searched like any other and reported under that null; very long texts and
items are searched whole (the search length halves, so an item of n words takes
log n scans); empty tables give no rows; columns other than ids and texts are not read by the search and pass
the filter.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytesops import groups, mix, span_hash, spans
from .common import table

SEED = 5
THRESHOLD = 0.8
BLOCK_BYTES = 32 << 20
CHUNK = 1 << 18
FILTER_BITS = 22
RADIX = np.uint64(0xD6E8FEB86659FD93)

_WORD = np.array([bytes([c]).isalnum() or c > 127 for c in range(256)])


def word_tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts, and each text's number of words."""
    raw = [t.lower().encode("utf-8", "replace") + b" " for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    start, end = spans(_WORD[data])
    stop = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
    return span_hash(data, start, end), np.diff(np.concatenate(([0], np.searchsorted(start, stop))))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hash of the ``n`` words from every place on."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    h = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        h = h * RADIX + words[j:j + len(h)]
    return mix(h)


def _running_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Karp-Rabin hash of the ``n`` words from every place on, from one running sum whatever ``n`` is."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    power = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(words), RADIX))))
    total = np.concatenate(([np.uint64(0)], np.cumsum(mix(words) * power[:-1])))
    inverse = np.cumprod(np.concatenate(([np.uint64(1)], np.full(len(words) - n, np.uint64(pow(int(RADIX), -1, 1 << 64))))))
    return (total[n:] - total[:-n]) * inverse


def _open_places(free: np.ndarray, n: int) -> np.ndarray:
    """Places from which ``n`` entries are all free."""
    s, e = spans(free)
    return np.concatenate([np.arange(x, y - n + 1) for x, y in zip(s.tolist(), e.tolist()) if y - x >= n] or [np.empty(0, np.int64)])


def greedy_tiles(item: list[int], runs: list[list[int]], least: int) -> list[tuple[int, int, int, int]]:
    """Greedy string tiling of ``item`` against token runs: ``(item place, run, run place, length)``, longest first, ties
    by run, its place and the item's place.

    Running Karp-Rabin: the search length halves from the longest possible down to ``least``. At each one the running
    hashes of the unmarked stretches of both sides meet by equality; hits that follow each other on a diagonal are one
    match of that length or more, and its words are compared. Matches are marked longest first; of one that a mark has
    cut, the parts still long enough come again in their turn.
    """
    own = np.array(item, np.uint64)
    ends = np.cumsum([len(r) + 1 for r in runs])
    begin = ends - [len(r) + 1 for r in runs]
    text = np.zeros(int(ends[-1]) if len(runs) else 0, np.uint64)
    open_text = np.zeros(len(text), bool)  # the gaps between the runs stay closed
    for b, r in zip(begin.tolist(), runs):
        text[b:b + len(r)] = r
        open_text[b:b + len(r)] = True
    free = np.ones(len(own), bool)
    tiles: list[tuple[int, int, int, int]] = []
    n = min(len(own), max(map(len, runs), default=0))
    while n >= least and n > 0:
        heap = [(-size, j, i) for size, j, i in _matches(own, free, text, open_text, n)]
        heapify(heap)
        while heap:
            size, j, i = heappop(heap)
            both = free[i:i - size] & open_text[j:j - size]
            if both.all():
                free[i:i - size] = open_text[j:j - size] = False
                r = int(np.searchsorted(ends, j, side="right"))
                tiles.append((i, r, j - int(begin[r]), -size))
                continue
            for x, y in zip(*map(np.ndarray.tolist, spans(both))):
                if y - x >= n:
                    heappush(heap, (x - y, j + x, i + x))
        if n == least:
            break
        n = max(least, n // 2)
    return tiles


def _matches(own: np.ndarray, free: np.ndarray, text: np.ndarray, open_text: np.ndarray, n: int) -> list[tuple[int, int, int]]:
    """Maximal common stretches ``(length, text place, item place)`` of ``n`` unmarked words or more."""
    i, j = _open_places(free, n), _open_places(open_text, n)
    if not len(i) or not len(j):
        return []
    hi, hj = _running_hashes(own, n)[i], _running_hashes(text, n)[j]
    order = np.argsort(hi, kind="stable")
    lo, up = np.searchsorted(hi[order], hj, "left"), np.searchsorted(hi[order], hj, "right")
    many = up - lo
    at_j = np.repeat(j, many)
    first = np.repeat(lo - (np.cumsum(many) - many), many)
    at_i = i[order][first + np.arange(len(at_j))]
    by = np.lexsort((at_i, at_j - at_i))
    at_i, at_j = at_i[by], at_j[by]
    new = np.flatnonzero(np.concatenate(([True], (np.diff(at_i) != 1) | (np.diff(at_j) != 1)))) if len(at_i) else np.empty(0, np.int64)
    out = []
    for b, e in zip(new.tolist(), [*new[1:].tolist(), len(at_i)]):
        x, y, size = int(at_i[b]), int(at_j[b]), e - b - 1 + n
        equal = own[x:x + size] == text[y:y + size]  # the words themselves, should two hashes agree by chance
        out += [(f - s, y + s, x + s) for s, f in zip(*map(np.ndarray.tolist, spans(equal))) if f - s >= n]
    return out


class BenchmarkBlock:
    """Items of one block and the table of their seeds."""

    def __init__(self, items: list[tuple[int, str]], seed: int = SEED, threshold: float = THRESHOLD):
        self.seed, self.threshold = seed, threshold
        words, count = word_tokens([t for _, t in items])
        self.ids = [i for (i, _), n in zip(items, count) if n]
        self.tokens = [w.tolist() for w, n in zip(np.split(words, np.cumsum(count)[:-1]), count) if n] if len(items) else []
        by_length: dict[int, list[tuple[np.ndarray, int]]] = {}
        for k, toks in enumerate(self.tokens):
            n = min(seed, len(toks))
            by_length.setdefault(n, []).append((np.unique(gram_hashes(np.array(toks, np.uint64), n)), k))
        self.seeds = {}
        for n, found in by_length.items():
            h = np.concatenate([x for x, _ in found])
            of = np.repeat([k for _, k in found], [len(x) for x, _ in found])
            order = np.argsort(h, kind="stable")
            maybe = np.zeros(1 << FILTER_BITS, bool)
            maybe[h >> np.uint64(64 - FILTER_BITS)] = True
            self.seeds[n] = (h[order], of[order], maybe)

    def _joined(self, words: np.ndarray, doc: np.ndarray) -> dict[tuple[int, int], list[tuple[int, int]]]:
        """(document, item) -> (place, length) of the shared seeds."""
        out: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for n, (known, of, maybe) in self.seeds.items():
            h = gram_hashes(words, n)
            at = np.flatnonzero(maybe[h >> np.uint64(64 - FILTER_BITS)])
            at = at[doc[at] == doc[at + n - 1]]
            lo, hi = np.searchsorted(known, h[at], "left"), np.searchsorted(known, h[at], "right")
            for p, x, y in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                for k in of[x:y].tolist():
                    out.setdefault((int(doc[p]), k), []).append((p, n))
        return out

    def matches(self, texts: list[str]) -> list[tuple[int, int, int, int, int, list[tuple[int, int, int]]]]:
        """``(text index, item id, item words, covered words, number of tiles, tiles)`` of every joined pair, a tile
        being (first word in the text, first word in the item, words)."""
        out = []
        for b, e in groups([len(t) for t in texts], CHUNK):
            words, count = word_tokens(texts[b:e])
            begin = np.cumsum(count) - count
            doc = np.repeat(np.arange(b, e), count)
            for (d, k), hits in self._joined(words, doc).items():
                runs, stop = [], -1
                for p, n in hits:  # places ascend; a tile of at least a seed lies inside a run of seeds
                    if p <= stop:
                        runs[-1][1] = stop = max(stop, p + n)
                    else:
                        runs.append([p, p + n])
                        stop = p + n
                item = self.tokens[k]
                tiles = greedy_tiles(item, [words[x:y].tolist() for x, y in runs], min(self.seed, len(item)))
                spans_ = [(int(runs[r][0] + j - begin[d - b]), i, n) for i, r, j, n in tiles]
                out.append((d, self.ids[k], len(item), sum(t[3] for t in tiles), len(tiles), spans_))
        return out

    def contaminated(self, texts: list[str]) -> list[tuple]:
        return [m for m in self.matches(texts) if m[3] >= self.threshold * m[2]]


def benchmark_blocks(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", seed: int = SEED,
                     threshold: float = THRESHOLD) -> Iterator:
    """Broadcast blocks of the benchmark, each of at most about ``BLOCK_BYTES`` of text."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).where("text is not null")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = -(-total // BLOCK_BYTES)
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        rows = sorted(((r.item_id, r.text) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        yield spark.sparkContext.broadcast(BenchmarkBlock(rows, seed, threshold))


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       seed: int = SEED, threshold: float = THRESHOLD) -> DataFrame:
    """``(doc_id, item_id, item_words, covered_words, n_tiles, tiles, coverage)`` of every contaminated pair."""
    schema = ("doc_id long, item_id long, item_words int, covered_words int, n_tiles int, "
              "tiles array<struct<doc_word: int, item_word: int, words: int>>")
    tile = pa.list_(pa.struct([("doc_word", pa.int32()), ("item_word", pa.int32()), ("words", pa.int32())]))
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def search(block):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = block.value.contaminated(batch.column("text").to_pylist())
                ids = batch.column("doc_id").take(pa.array([f[0] for f in found], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array([f[c] for f in found], pa.int64() if c == 1 else pa.int32()) for c in range(1, 5)),
                     pa.array([[dict(zip(("doc_word", "item_word", "words"), t)) for t in f[5]] for f in found], tile)],
                    names=["doc_id", "item_id", "item_words", "covered_words", "n_tiles", "tiles"])
        return run

    out = docs.sparkSession.createDataFrame([], schema)
    for block in benchmark_blocks(benchmark, seed=seed, threshold=threshold):
        out = out.union(texts.mapInArrow(search(block), schema))
    return out.withColumn("coverage", F.col("covered_words") / F.col("item_words"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", seed: int = SEED,
                  threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose text contains no benchmark item; all columns pass, nothing is shuffled."""
    def keep(block):
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                mask = np.ones(batch.num_rows, bool)
                mask[[f[0] for f in block.value.contaminated([t or "" for t in batch.column(text_col).to_pylist()])]] = False
                yield batch.filter(pa.array(mask))
        return run

    for block in benchmark_blocks(benchmark, seed=seed, threshold=threshold):
        docs = docs.mapInArrow(keep(block), docs.schema)
    return docs


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("tiles")
