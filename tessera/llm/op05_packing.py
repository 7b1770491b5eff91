"""Best-fit packing of tokenised documents with Martello-Toth reduction.

Only the number of pieces of each length matters for the plan, and there are
at most ``capacity`` lengths, so the plan is made from that bounded histogram:
the dominance reduction first fixes sets of up to three pieces that no better
packing can do without, then best-fit decreasing packs the remainder. A plan
is a list of patterns (how many sequences, which lengths in each). Pieces get
their places on the cluster: a piece's rank among those of its length (counts
per salted bucket, then ranks inside the bucket) selects the pattern, the
sequence and the offset.

Defined results: a null or empty text is its closing id alone (length 1);
invalid UTF-8 is read with replacement characters; very long texts are encoded
in slices that end at white space; repeated rows are packed as often as they
come; an empty table gives no rows; columns other than the id and the text are
not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bytesops import groups
from .common import arrow_map, id_text, settle, table
from .tokens import encode_texts, tokenizer_path

CAPACITY = 2048
END_ID = 0
BUCKET_ROWS = 1 << 13  # pieces of one salt bucket, about: one length may hold a third of all pieces


def _cut(path: str, capacity: int, with_ids: bool):
    end = np.array([END_ID], "<u4").tobytes()

    def run(batch: pa.RecordBatch) -> dict:
        docs, piece, start, length, crc, ids = [], [], [], [], [], []
        names, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
        for b, e in groups(list(map(len, texts)), 1 << 20):
            for doc, ids_of in zip(names[b:e], encode_texts(path, texts[b:e])):
                raw = memoryview(ids_of + end)
                for k, s in enumerate(range(0, len(raw), 4 * capacity)):
                    part = raw[s:s + 4 * capacity]
                    docs.append(doc)
                    piece.append(k)
                    start.append(s // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(bytes(part))
        return {"doc_id": docs, "piece": piece, "start": start, "length": length, "ids_crc32": crc, "ids": ids}

    return run


def _room_for(counts: list[int], present: list[int], room: int, skip: int) -> int:
    """How many of the smallest pieces (without one of length ``skip``) fit into ``room``, up to three."""
    k = 0
    for w in present:
        for _ in range(min(3, counts[w] - (w == skip))):
            if room < w or k == 3:
                return k
            room -= w
            k += 1
    return k


def _best_pair(counts: list[int], present: list[int], room: int, skip: int) -> tuple[int, int] | None:
    """Two lengths of the largest sum within ``room``, the larger first."""
    own = {w: counts[w] - (w == skip) for w in present if counts[w] - (w == skip)}
    best, order = None, sorted(own)
    i, j = 0, len(order) - 1
    while i <= j:
        x, y = order[j], order[i]
        if x + y > room or (i == j and own[x] < 2):
            j -= 1
            continue
        if best is None or x + y > sum(best) or (x + y == sum(best) and x > best[0]):
            best = (x, y)
        i += 1
    return best


def reduce_dominance(counts: list[int], capacity: int) -> list[tuple[int, list[int]]]:
    """Martello-Toth reduction: take sets that dominate all alternatives out of ``counts`` -> ``(sequences, lengths)``.

    For the largest open piece: alone if nothing fits beside it; with the
    largest piece that fits if that fills the sequence or no two pieces fit;
    if two but no three fit, with that piece or the best pair when one
    dominates the other. A set is taken as often as its pieces last, as taking
    it leaves the same choice: no more pieces fit than before, and its own
    pieces stay the largest and the best pair that do. Every step so uses up
    a length (or all but two of it), and there are at most three a length.
    """
    fixed: list[tuple[int, list[int]]] = []
    changed = True
    while changed:
        changed = False
        for big in range(capacity, 0, -1):
            while counts[big]:
                present = [w for w in range(1, capacity + 1) if counts[w]]
                room = capacity - big
                k = _room_for(counts, present, room, big)
                if k == 0:
                    take = [big]
                else:
                    mate = max(w for w in present if w <= room and counts[w] - (w == big))
                    take = [big, mate] if k == 1 or mate == room else None
                    if k == 2 and take is None and (pair := _best_pair(counts, present, room, big)):
                        x, y = pair
                        between = [w for w in present if y < w < x for _ in range(min(2, counts[w] - (w == big)))][:2]
                        if mate >= x + y:
                            take = [big, mate]
                        elif mate == x and (len(between) < 2 or sum(between) > room):
                            take = [big, x, y]
                if take is None:
                    break
                times = min(counts[w] // take.count(w) for w in take)  # fewer pieces never undo the dominance
                for w in take:
                    counts[w] -= times
                fixed.append((times, take))
                changed = True
    return fixed


def best_fit(counts: list[int], capacity: int) -> list[tuple[int, list[int]]]:
    """Best-fit decreasing for a histogram: equal sequences are filled together."""
    open_bins: dict[int, list[tuple[int, list[int]]]] = {capacity: []}
    for w in range(capacity, 0, -1):
        n = counts[w]
        while n:
            room = min((r for r, g in open_bins.items() if r >= w and g), default=capacity)
            per = room // w
            have, lengths = open_bins[room].pop() if open_bins.get(room) else (max(1, n // per), [])
            full = min(have, n // per)
            if full:
                open_bins.setdefault(room - per * w, []).append((full, lengths + [w] * per))
                if have > full:
                    open_bins[room].append((have - full, lengths))
                n -= full * per
            else:  # the last few of this length share one sequence
                open_bins.setdefault(room - n * w, []).append((1, lengths + [w] * n))
                if have > 1:
                    open_bins[room].append((have - 1, lengths))
                n = 0
    return [g for gs in open_bins.values() for g in gs]


def pack_histogram(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[int]]]:
    """Patterns ``(sequences, lengths in each)`` for so many pieces of each length."""
    counts = [0] * (capacity + 1)
    for w, n in histogram.items():
        counts[w] = n
    fixed = reduce_dominance(counts, capacity)
    return fixed + best_fit(counts, capacity)


def _slots(patterns: list[tuple[int, list[int]]]) -> dict[str, np.ndarray]:
    """Per (pattern, place): first rank it serves among its length, its sequences and its offset; ordered by length and rank."""
    rows, used, base = [], {}, 0
    for times, lengths in patterns:
        at = 0
        for w in lengths:
            rows.append((w, used.get(w, 0), base, at))
            used[w] = used.get(w, 0) + times
            at += w
        base += times
    rows.sort()
    return dict(zip(("length", "rank", "base", "offset"), np.array(rows, np.int64).reshape(-1, 4).T))


def _place(slots: dict[str, np.ndarray]):
    key = (slots["length"] << 48) + slots["rank"]

    def run(batch: pa.RecordBatch) -> dict:
        length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
        k = np.searchsorted(key, (length << 48) + rank, side="right") - 1
        out = {n: batch.column(n) for n in batch.schema.names if n != "rank"}
        return out | {"sequence_id": slots["base"][k] + rank - slots["rank"][k], "offset": slots["offset"][k]}

    return run


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` and, if asked for, the piece's ``ids`` bytes."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    pieces = settle(arrow_map(id_text(docs, id_col, text_col), _cut(path, capacity, with_ids), schema))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    buckets = F.array(*[F.lit(1 + histogram.get(w, 0) // BUCKET_ROWS) for w in range(1, capacity + 1)])
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"),
                                              F.element_at(buckets, F.col("length").cast("int"))).cast("int"))
    sizes = settle(pieces.groupBy("length", "salt").agg(F.count("*").alias("n")))  # a row a length and BUCKET_ROWS pieces
    slots = _slots(pack_histogram(histogram, capacity))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (pieces.withColumn("own", F.row_number().over(own)).join(sizes, ["length", "salt"])
              .withColumn("rank", F.col("before") + F.col("own") - 1).drop("before", "own", "salt"))
    ranked = ranked.select(*(f.split()[0] for f in schema.split(", ")), "rank")
    return arrow_map(ranked, _place(slots), schema + ", sequence_id long, offset long")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
