"""Target-distribution importance resampling: hashed n-gram weights, then a distributed quickselect.

1. A text's features are its runs of one to three words. Their CRC-32 buckets
   are computed with array operations: the checksum is linear, so that of a run
   follows from those of its words by one table step per word.
2. Two passes count the buckets of the corpus and of the target; ``buckets``
   numbers come to the driver, whatever the size of the tables. A bucket's gain
   is the scaled logarithm of the two smoothed shares.
3. A third pass over the texts gives every document's weight and its score,
   the weight plus Gumbel noise from a hash of the id. Only slim rows remain.
4. Quickselect finds the k-th best composite key: random rows of the open range
   serve as pivots, one pass counts exactly the rows below and equal to each,
   and the range narrows to between two pivots until a pivot is the k-th key.
5. Only rows up to that key are sorted (ranges of even size, prefix sums of
   their sizes) and ranked; all other rows never move.

Defined results: a null, empty or word-less text has no features and weight 0;
a null id hashes as the empty string and comes last among equal scores; equal
scores and ids are ordered by a hash of the text; of equal rows so many are
drawn as fall under the limit, with ranks in a row; a very long text is counted
in pieces that share two words; empty tables give no rows (an empty target has
T = 0); columns other than the id and the texts are not read.
"""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bytesops import spans
from .common import discard, id_text, settle, table

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 5
SEED = 42
PIECE = 1 << 20  # bytes of text handled by one array operation
SHORT = 32  # bytes of a word up to which its table step is an array operation
PIVOTS = 15
RANKED = 200_000  # rows of one range of the final ranking, about
COPIES = 1 << 16  # equal rows written out by one row

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_WORD = np.array([48 <= c <= 57 or 97 <= c <= 122 or c > 127 for c in range(256)])
_END = re.compile(rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]")
ONES = np.uint32(0xFFFFFFFF)


def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """The byte table of CRC-32, and per length and state byte what ``length`` zero bytes make of it."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & np.uint32(1), (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1)).astype(np.uint32)
    state = (np.arange(256, dtype=np.uint32)[None, :] << (np.arange(4, dtype=np.uint32)[:, None] * np.uint32(8)))
    steps = [state]
    for _ in range(SHORT):
        state = t[state & np.uint32(255)] ^ (state >> np.uint32(8))
        steps.append(state)
    return t, np.stack(steps)


BYTE, STEP = _crc_tables()
_FLAT = STEP.reshape(-1)


def _feed(state: np.ndarray, length: np.ndarray, own: np.ndarray) -> np.ndarray:
    """The register ``state`` after a word of ``length`` bytes whose register from zero is ``own``."""
    base = length << 10
    out = own ^ _FLAT[base + (state & np.uint32(255))]
    for k in (1, 2, 3):
        out ^= _FLAT[base + (256 * k) + (state >> np.uint32(8 * k) & np.uint32(255))]
    return out


def _space(state: np.ndarray) -> np.ndarray:
    return BYTE[(state ^ np.uint32(32)) & np.uint32(255)] ^ (state >> np.uint32(8))


def _registers(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Register from zero of every word, a byte of all words at a time (words over ``SHORT`` bytes are left out)."""
    size = np.where(length > SHORT, 0, length)
    order = np.argsort(-size.astype(np.int16), kind="stable")
    begin, size = start[order], size[order]
    state = np.zeros(len(start), np.uint32)
    for k in range(int(size[0]) if len(size) else 0):
        n = int(np.searchsorted(-size, -k, side="left"))  # words longer than k come first
        s = state[:n]
        state[:n] = BYTE[(s ^ data[begin[:n] + k]) & np.uint32(255)] ^ (s >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = state
    return out


def _pieces(texts: list[bytes]) -> Iterator[tuple[bytes, list[int], list[int], list[int]]]:
    """Texts joined to buffers: bytes, and per text its index, its end in the buffer, and its leading words met before."""
    parts: list[bytes] = []
    doc: list[int] = []
    end: list[int] = []
    skip: list[int] = []
    size = 0
    for i, text in enumerate(texts):
        text = text.translate(_LOWER)
        at, carried = 0, []
        while True:
            cut = _END.search(text, at + PIECE) if len(text) - at > PIECE else None
            stop = cut.start() if cut else len(text)
            own = text[at:stop] if at or cut else text
            part = b" ".join([*carried, own]) + b" "
            parts.append(part)
            size += len(part)
            doc.append(i)
            end.append(size)
            skip.append(len(carried))
            if size >= PIECE:
                yield b"".join(parts), doc, end, skip
                parts, doc, end, skip, size = [], [], [], [], 0
            if not cut:
                break
            carried = _last_words(part)
            at = stop
    if parts:
        yield b"".join(parts), doc, end, skip


def _last_words(part: bytes) -> list[bytes]:
    s, e = spans(_WORD[np.frombuffer(part, np.uint8)])
    return [part[x:y] for x, y in zip(s[-2:].tolist(), e[-2:].tolist())]


def features(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per buffer: features' text index, their checksums, and the indices and numbers of words of its texts."""
    for raw, doc, end, skip in _pieces(texts):
        data = np.frombuffer(raw, np.uint8)
        start, stop = spans(_WORD[data])
        length = stop - start
        piece = np.searchsorted(np.array(end), start, side="right")
        doc_of, skip_of = np.array(doc)[piece], np.array(skip)
        first = np.searchsorted(piece, np.arange(len(doc)))
        number = np.arange(len(start)) - first[piece]
        own = _registers(data, start, length)
        size = np.minimum(length, SHORT).astype(np.uint32)
        long = length > SHORT
        state = _feed(np.full(len(start), ONES), size, own)
        index, sums = [], []
        run_long = long
        for n in (1, 2, 3):
            if n > 1:
                state = _feed(_space(state[:-1]), size[n - 1:], own[n - 1:])
                run_long = run_long[:-1] | long[n - 1:]
            if not len(state):
                break
            last = np.arange(n - 1, len(start))
            ok = (piece[:len(state)] == piece[last]) & (number[last] >= skip_of[piece[last]])
            crc = state ^ ONES
            for i in np.flatnonzero(ok & run_long).tolist():
                crc[i] = zlib.crc32(b" ".join(raw[s:e] for s, e in zip(start[i:i + n].tolist(), stop[i:i + n].tolist())))
            index.append(doc_of[last][ok])
            sums.append(crc[ok])
        words = np.bincount(piece, minlength=len(doc)) - skip_of
        yield (np.concatenate(index) if index else np.empty(0, np.int64), np.concatenate(sums) if sums else np.empty(0, np.uint32),
               np.array(doc), words)


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            column = batch.column("text")
            for i in range(0, batch.num_rows, 512):
                for _, crc, _, _ in features(column.slice(i, 512).to_pylist()):
                    total += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    raw = texts.select(F.col(text_col).cast("binary").alias("text")).where("text is not null")
    rows = raw.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r.bucket] = r.n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln(smoothed target share / smoothed source share)) of every bucket."""
    m, s_all, t_all = len(source), float(source.sum() + len(source)), float(target.sum() + len(target))
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all)))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64).reshape(m)


def gumbel(doc_id: int | None, seed: int = SEED) -> int:
    """Scaled Gumbel noise of an id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


SCORED = "doc_id long, n_features long, weight long, score long, words long, tie long"


def _score(gains: np.ndarray, seed: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 512):
                batch = whole.slice(i, 512)
                n = batch.num_rows
                weight, count, words = (np.zeros(n, np.int64) for _ in range(3))
                for doc, crc, own, n_words in features(batch.column("text").to_pylist()):
                    weight += np.bincount(doc, gains[crc % np.uint32(len(gains))], n).astype(np.int64)  # whole numbers far below 2**53
                    count += np.bincount(doc, minlength=n)
                    words += np.bincount(own, n_words, n).astype(np.int64)
                noise = np.array([gumbel(d, seed) for d in batch.column("doc_id").to_pylist()], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), *map(pa.array, (count, weight, weight + noise, words)), batch.column("tie")],
                    names=["doc_id", "n_features", "weight", "score", "words", "tie"])

    return run


def scored_documents(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """``(doc_id, n_features, weight, score, words, tie)`` of every document, as slim rows in the shared folder."""
    gains = bucket_gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, text_col, buckets))
    rows = id_text(docs, id_col, text_col).withColumn("tie", F.xxhash64("text"))
    return settle(rows.mapInArrow(_score(gains, seed), SCORED))


KEY = ("rest", "no_id", "id", "tie")


def _keyed(rows: DataFrame) -> DataFrame:
    """Adds the columns of the composite key: higher scores, then smaller ids (null last), then the text's hash."""
    return rows.select("*", (-F.col("score")).alias("rest"), F.col("doc_id").isNull().alias("no_id"),
                       F.coalesce("doc_id", F.lit(0)).alias("id"))


def _beyond(key: tuple, or_equal: bool = False) -> F.Column:
    """True for rows that come after ``key`` in the order."""
    own, other = F.struct(*KEY), F.struct(*(F.lit(v).cast(t).alias(k) for k, v, t in zip(KEY, key, ("long", "boolean", "long", "long"))))
    return own >= other if or_equal else own > other


def quickselect(keys: DataFrame, k: int, pivots: int = PIVOTS) -> tuple[tuple, int]:
    """The ``k``-th key (from 1) of ``keys`` in the order of ``KEY``, and how many of the first ``k`` rows hold it.

    ``keys`` holds at least ``k`` rows. Ranges that shrank to an eighth of the table read are written anew.
    """
    spark = keys.sparkSession
    opened, turn, read, made = keys.select(*KEY), 0, None, None
    while True:
        drawn = opened.orderBy(F.xxhash64(*KEY, F.lit(turn))).limit(pivots).collect()  # a random row each, the same at every run
        cuts = sorted({tuple(r) for r in drawn})
        sums = [F.count_if(~_beyond(c, True)).alias(f"lt{i}") for i, c in enumerate(cuts)]
        sums += [F.count_if(~_beyond(c)).alias(f"le{i}") for i, c in enumerate(cuts)]
        seen = opened.agg(F.count("*").alias("all"), *sums).first()
        low, high, skip, size = None, None, 0, seen["all"]
        for i, c in enumerate(cuts):
            if seen[f"lt{i}"] < k <= seen[f"le{i}"]:
                if made is not None:
                    discard(spark, made)
                return c, k - seen[f"lt{i}"]
            if seen[f"le{i}"] < k:
                low, skip = c, seen[f"le{i}"]
            elif high is None:
                high, size = c, seen[f"lt{i}"]
        if low is not None:
            opened = opened.where(_beyond(low))
        if high is not None:
            opened = opened.where(~_beyond(high, True))
        read = read or seen["all"]
        k, left, turn = k - skip, size - skip, turn + 1
        if left * 8 <= read:
            old, read = made, left
            opened = made = settle(opened)
            if old is not None:
                discard(spark, old)


def _copies(rows: DataFrame, n: str) -> DataFrame:
    """Every row ``n`` times with its ``number`` among them; long runs go through an intermediate row each ``COPIES``."""
    blocks = rows.where(F.col(n) > 0).withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col(n) - 1) / COPIES).cast("long"))))
    own = F.least(F.lit(COPIES), F.col(n) - F.col("block") * COPIES)
    return (blocks.withColumn("number", F.explode(F.sequence(F.lit(0).cast("long"), own.cast("long") - 1)))
            .withColumn("number", F.col("number") + F.col("block") * COPIES).drop("block"))


def ranked(rows: DataFrame, k: int) -> DataFrame:
    """``rows`` (keyed, with copies ``n``) with the place of their first copy among all as ``begin``; ``k`` is the sum of ``n``."""
    parts = max(1, k // RANKED)
    dealt = settle(rows.repartitionByRange(parts, *KEY).withColumn("range", F.spark_partition_id()))
    sizes = sorted(dealt.groupBy("range").agg(F.sum("n").alias("n")).collect())  # one row a range
    begin, total = [], 0
    for r in sizes:
        begin.append((r["range"], total))
        total += r["n"]
    offsets = rows.sparkSession.createDataFrame(begin, "range int, before long")
    own = Window.partitionBy("range").orderBy(*KEY).rowsBetween(Window.unboundedPreceding, -1)
    return (dealt.join(F.broadcast(offsets), "range")  # k / RANKED rows
            .withColumn("begin", F.col("before") + F.coalesce(F.sum("n").over(own), F.lit(0))))


def draw(scored: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of all rows; rank from 1 for the drawn share, null for the others."""
    names = ("doc_id", "n_features", "weight", "score")
    keyed = _keyed(scored)
    fit = F.col("words") >= least_words
    k = percent * keyed.where(fit).count() // 100
    none = F.lit(None).cast("long").alias("rank")
    if not k:
        return keyed.select(*names, none)
    last, taken = quickselect(keyed.where(fit), k)
    winners = (keyed.where(fit & ~_beyond(last)).groupBy(*KEY, *names).agg(F.count("*").alias("all"))  # equal rows as one
               .withColumn("n", F.when(_beyond(last, True), F.lit(taken)).otherwise(F.col("all"))))
    winners = ranked(winners, k)
    drawn = _copies(winners, "n").select(*names, (F.col("begin") + F.col("number") + 1).alias("rank"))
    left = _copies(winners.withColumn("rest_n", F.col("all") - F.col("n")), "rest_n").select(*names, none)
    return drawn.union(left).union(keyed.where(~fit | _beyond(last)).select(*names, none))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return draw(scored_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
