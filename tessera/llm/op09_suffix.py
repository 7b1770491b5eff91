"""Suffix-array deduplication: remove every byte covered by a repeated 200-byte string.

Sorting the suffixes at all positions would shuffle many times the corpus, so
only suffixes that can start a repeated string get that far:

1. Each 200-byte window picks an anchor, its leftmost 32-gram of least hash.
   Equal windows pick equal anchors at equal offsets, so a window whose
   anchor occurs once in the corpus is unique and leaves here.
2. The other windows travel as pieces (the bytes around one anchor that all
   its windows cover). Splitters sampled from the repeated anchors divide the
   order of the anchors' leading bytes into buckets of even weight; a bucket is
   a partition.
3. Inside a bucket equal pieces meet first; the suffixes of the remaining ones
   are ordered by multikey quicksort, eight bytes a character, keeping only
   ties. What is tied after 200 bytes is repeated.

Equal windows agree in (leading bytes, anchor, offset block), which is what
splitters cut by, so comparing across a bucket boundary reduces to that key:
no run of equal suffixes lies on two sides. A frequent anchor is dealt over
several offset blocks, in the end of one window each, which are dealt by their
content; equal pieces of one batch leave it once.

Defined results: null text is empty; texts under the window length keep all
bytes; a repeated row is a document of its own, so its copy counts as another
place (such rows are searched once and, from the window length on, removed
whole); very long texts are read in segments; ids may be null or repeat (documents are told apart by a 64-bit hash of
id and text); an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, discard, id_text, settle, sorted_runs, table

SPAN = 200
GRAM = 32
SEGMENT = 1 << 17  # positions handled by one vector operation: its arrays stay in the CPU cache
BUCKET_ROWS = 1 << 20  # anchor rows of the corpus for one bucket, about (few of them recur)
PER_BLOCK = 512  # rows of one anchor in one offset block, about
BYTE_CODE = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
ODD = 0x9E3779B97F4A7C15


def _gram_hash(data: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of every k-gram (k a power of two), by doubling."""
    h, step, mul = BYTE_CODE[data], 1, ODD
    while step < k:
        h = h[:-step] * np.uint64(mul) + h[step:]
        mul = mul * mul % (1 << 64)
        step *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    step, m = 1, x
    while 2 * step <= w:
        m = np.minimum(m[:-step], m[step:])
        step *= 2
    return np.minimum(m[:len(x) - w + 1], m[w - step:w - step + len(x) - w + 1]) if w > step else m


def _segments(texts: list[bytes], span: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Join texts to segments: bytes, and per text its index, its offset in the segment less that in the text, its windows' end."""
    buf, idx, shift, stop, size = [], [], [], [], 0
    for i, t in enumerate(texts):
        for s in range(0, len(t) - span + 1, SEGMENT):
            part = t[s:s + SEGMENT + span - 1] if len(t) > SEGMENT else t
            if size and size + len(part) > 2 * SEGMENT:
                yield b"".join(buf), np.array(idx), np.array(shift), np.array(stop)
                buf, idx, shift, stop, size = [], [], [], [], 0
            buf.append(part)
            idx.append(i)
            shift.append(size - s)
            size += len(part)
            stop.append(size - span + 1)
    if size:
        yield b"".join(buf), np.array(idx), np.array(shift), np.array(stop)


def anchors(texts: list[bytes], span: int = SPAN, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Per run of windows with one anchor: text index ``i``, anchor ``a``, windows ``a - hi .. a - lo``, ``h``, ``lead``."""
    out: list[tuple] = []
    for raw, idx, shift, stop in _segments(texts, span):
        data = np.frombuffer(raw, np.uint8)
        h = _gram_hash(data, gram)
        order = (h >> np.uint64(20) << np.uint64(20)) | np.arange(len(h), dtype=np.uint64)
        at = (_sliding_min(order, span - gram + 1) & np.uint64((1 << 20) - 1)).astype(np.int64)
        s = np.arange(len(at))
        begin = np.concatenate(([0], stop[:-1] + span - 1))
        part = np.searchsorted(begin, s, side="right") - 1
        ok = s < stop[part]
        s, part, at = s[ok], part[ok], at[ok]
        first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (part[1:] != part[:-1]))))
        last = np.concatenate((first[1:], [len(s)])) - 1
        a, part = at[first], part[first]
        lead = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 4)[a]).view(">u4").ravel()
        out.append((idx[part], a - shift[part], a - s[last], a - s[first], h[a].view(np.int64),
                    (lead.astype(np.int64) - (1 << 31)).astype(np.int32)))
    names = ("i", "a", "lo", "hi", "h", "lead")
    return {n: np.concatenate([o[k] for o in out]) if out else np.empty(0, np.int64) for k, n in enumerate(names)}


def _anchor_rows(span: int):
    def run(batch: pa.RecordBatch) -> dict:
        rows = batch.column("row").to_numpy()
        found = anchors(batch.column("text").to_pylist(), span)
        return {"row": rows[found["i"]], "place": (found["a"] << 20) | (found["lo"] << 10) | found["hi"],
                "h": found["h"], "lead": found["lead"].astype(np.int32)}

    return run


def _rank(lead: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Place of an anchor in the order of leading bytes, then of the whole anchor's hash."""
    return (lead.astype(np.int64) << 32) + (h.astype(np.int64) >> 32)


def _splitters(again: DataFrame, buckets: int, sample: int = 200) -> np.ndarray:
    """Bucket bounds of even weight from a sample of about ``sample`` repeated anchors a bucket, each weighing its rows."""
    share = min(1.0, sample * buckets / max(again.count(), 1))
    rows = again.sample(share, seed=7).select("lead", "h", "n").toPandas()
    if not len(rows):
        return np.empty(0, np.int64)
    rank = _rank(rows["lead"].to_numpy(), rows["h"].to_numpy())
    order = np.argsort(rank)
    weight = np.cumsum(np.minimum(rows["n"].to_numpy()[order], PER_BLOCK))  # a more frequent anchor is dealt over blocks
    return np.unique(rank[order][np.searchsorted(weight, weight[-1] * np.arange(1, buckets) / buckets)])


PIECES = "bucket int, h long, block int, row long, s long, multi boolean, piece binary"  # bucket: the task


def _pieces(cuts: np.ndarray, buckets: int, span: int):
    """Documents with their repeated anchors -> pieces; equal ones of a slice leave as one marked ``multi``
    (rows without a piece say that the ``block`` windows from ``s`` on are repeated).

    A bucket is a range of anchors. The blocks of a frequent anchor go to buckets of their own; where a block is one
    window, equal pieces are all that can meet, so these are dealt (and grouped) by their content."""
    names = ("bucket", "h", "block", "row", "s", "multi", "piece")

    def run(batch: pa.RecordBatch) -> dict:
        keep: dict[tuple, list] = {}
        known: dict[int, list[list[int]]] = {}
        cand = batch.column("cand")
        flat, offsets = cand.flatten(), np.concatenate(([0], np.cumsum(cand.value_lengths().to_numpy())))
        place, h, n = (flat.field(c).to_numpy() for c in ("place", "h", "n"))
        ways = np.clip(n // PER_BLOCK + 1, 1, span).tolist()
        place = place.tolist()
        for k, (doc, raw) in enumerate(zip(batch.column("row").to_pylist(), batch.column("text").to_pylist())):
            text = unpack(raw)
            for j in sorted(range(offsets[k], offsets[k + 1]), key=place.__getitem__):
                a, lo, hi = place[j] >> 20, place[j] >> 10 & 1023, place[j] & 1023
                width = -(-span // ways[j])
                for block in range(hi // width, lo // width - 1, -1):
                    s, e = a - min(hi, block * width + width - 1), a - max(lo, block * width) + span
                    lead = int.from_bytes(text[a:a + 4], "big") - (1 << 31)
                    if (seen := keep.setdefault((int(h[j]), block, text[s:e]), [lead, doc, s, None, ways[j]]))[3] is None:
                        seen[3] = False
                        continue
                    seen[3] = True
                    runs = known.setdefault(doc, [])
                    if runs and runs[-1][0] <= s <= runs[-1][1] - span + 1:  # neighbouring pieces: one row
                        runs[-1][1] = max(runs[-1][1], e)
                    else:
                        runs.append([s, e])
        rows = [(s + doc & 0x7FFFFFFF, 0, e - s - span + 1, doc, s, True, None) for doc, runs in known.items() for s, e in runs]
        ranged = np.searchsorted(cuts, _rank(np.array([v[0] for v in keep.values()], np.int64),
                                             np.array([key[0] for key in keep], np.int64)), side="right").tolist()
        for b, ((anchor, block, piece), (_, doc, s, multi, dealt)) in zip(ranged, keep.items()):
            if dealt >= span:
                anchor = xxhash.xxh64_intdigest(piece) - (1 << 63)
                b = anchor % buckets
            elif dealt > 1:
                b = (anchor + 0x9E3779B1 * (block + 1)) % buckets
            rows.append((b, anchor, block, doc, s, multi, piece))
        return dict(zip(names, zip(*rows))) if rows else dict.fromkeys(names, ())

    return run


def multikey_ties(data: np.ndarray, start: np.ndarray, group: np.ndarray, span: int) -> np.ndarray:
    """Which suffixes ``data[start:]`` share ``span`` leading bytes and the group with another one.

    Multikey quicksort with eight-byte characters: order by (group, character),
    drop what became single, go on with the next character of the ties.
    """
    tied = np.zeros(len(start), bool)
    live = np.arange(len(start))
    words = np.lib.stride_tricks.sliding_window_view(data, 8)
    for depth in [*range(0, span - 7, 8), *([span - 8] if span % 8 else [])]:
        char = np.ascontiguousarray(words[start[live] + depth]).view("<u8").ravel()
        order = np.lexsort((char, group))
        g, c = group[order], char[order]
        new = np.concatenate(([True], (g[1:] != g[:-1]) | (c[1:] != c[:-1])))
        ids = np.cumsum(new)
        many = np.bincount(ids)[ids] > 1
        live, group = live[order][many], ids[many]
        if not len(live):
            return tied
    tied[live] = True
    return tied


def _resolve(part: pa.Table, span: int) -> list[tuple[int, int, int]]:
    """Repeated runs ``(doc, first byte, end)`` among the pieces of whole anchor groups."""
    out: list[tuple[int, int, int]] = []
    h, block, doc, s = (part.column(c).to_numpy() for c in ("h", "block", "row", "s"))
    multi, piece = part.column("multi").to_pylist(), part.column("piece").to_pylist()
    new = np.concatenate(([True], (h[1:] != h[:-1]) | (block[1:] != block[:-1])))
    bounds = np.concatenate((np.flatnonzero(new), [len(h)])).tolist()
    ragged: list[tuple[int, bytes, list[int]]] = []
    for g, (f, e) in enumerate(zip(bounds, bounds[1:])):
        if e - f == 1:
            if multi[f]:
                out.append((doc[f], s[f], s[f] + len(piece[f])))
            continue
        same: dict[bytes, list[int]] = {}
        for i in range(f, e):
            same.setdefault(piece[i], []).append(i)
        for p, rows in same.items():
            if len(rows) > 1 or multi[rows[0]]:
                out += [(doc[i], s[i], s[i] + len(p)) for i in rows]
        if len(same) > 1:
            ragged += [(g, p, rows if len(rows) == 1 and not multi[rows[0]] else []) for p, rows in same.items()]
    at = 0
    while at < len(ragged):  # some whole groups at a time
        end, size = at, 0
        while end < len(ragged) and (size < 1 << 19 or ragged[end][0] == ragged[end - 1][0]):
            size += len(ragged[end][1]) - span + 1
            end += 1
        some, at = ragged[at:end], end
        data = np.frombuffer(b"".join(p for _, p, _ in some), np.uint8)
        length = np.fromiter((len(p) for _, p, _ in some), np.int64)
        count = length - span + 1
        base, first = np.cumsum(length) - length, np.cumsum(count) - count
        start = np.arange(count.sum()) - np.repeat(first - base, count)
        group = np.repeat(np.fromiter((g for g, _, _ in some), np.int64), count)
        tied = multikey_ties(data, start, group, span)
        for (_, _, rows), f, c in zip(some, first.tolist(), count.tolist()):
            if rows and (t := tied[f:f + c]).any():
                edge = np.flatnonzero(np.diff(np.concatenate(([0], t.view(np.int8), [0]))))
                out += [(doc[rows[0]], s[rows[0]] + x, s[rows[0]] + y - 1 + span)
                        for x, y in zip(edge[::2].tolist(), edge[1::2].tolist())]
    return out


def _bucket_runs(span: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sorted_runs(batches, "h"):
            runs = _resolve(part, span)
            doc, s, e = zip(*runs) if runs else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (doc, s, e)], names=["row", "s", "e"])

    return run


def unpack(raw: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(raw)


def _packed(batch: pa.RecordBatch) -> dict:
    """Texts compressed, since they are shuffled twice."""
    pack = zstandard.ZstdCompressor(level=3).compress
    return {n: list(map(pack, batch.column(n).to_pylist())) if n == "text" else batch.column(n) for n in batch.schema.names}


def _cut(batch: pa.RecordBatch) -> dict:
    kept, removed, spans = [], [], []
    for raw, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
        text = unpack(raw)
        parts, at, cut, n = [], 0, 0, 0
        for s, e in sorted((r["s"], r["e"]) for r in runs or ()):
            if s > at or not n:
                parts.append(text[at:s])
                n += 1
                cut, at = cut + e - s, e
            elif e > at:
                cut, at = cut + e - at, e
        parts.append(text[at:])
        kept.append(b"".join(parts))
        removed.append(cut)
        spans.append(n)
    out = {"doc_id": batch.column("doc_id"), "kept": kept, "n_removed": removed, "n_spans": spans,
           "n_bytes": [len(k) + r for k, r in zip(kept, removed)]}
    if "carry" in batch.schema.names:
        out["carry"] = batch.column("carry")
    return out


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN,
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """``(doc_id, kept, n_bytes, n_removed, n_spans)``: ``kept`` the bytes no repeated ``span``-byte string covers.

    Columns named in ``carry`` come along in a struct column ``carry``.
    """
    spark = docs.sparkSession
    texts = id_text(docs, id_col, text_col).withColumn("row", F.xxhash64("doc_id", "text"))
    # Equal rows (one id, one text) are resolved once; that they cover each other is known without looking.
    copies = settle(texts.groupBy("row").agg(F.count("*").alias("n")).where("n > 1").select("row"))
    several = not copies.isEmpty()
    once, whole = texts, None
    if several:
        one = settle(texts.join(copies, "row", "left_semi").groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text")))
        once = texts.join(copies, "row", "left_anti").select("doc_id", "text", "row").union(one.select("doc_id", "text", "row"))
        size = F.octet_length("text").cast("long")
        whole = one.where(size >= span).select("row", F.lit(0).cast("long").alias("s"), size.alias("e"))
    found = settle(arrow_map(once.select("row", "text"), _anchor_rows(span), "row long, place long, h long, lead int"))
    again = settle(found.groupBy("h").agg(F.count("*").alias("n"), F.min("lead").alias("lead")).where("n > 1"))
    buckets = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), found.count() // BUCKET_ROWS)
    cuts = _splitters(again, buckets)
    cand = (found.select("row", "place", "h").join(again.select("h", "n"), "h").groupBy("row")
            .agg(F.collect_list(F.struct("place", "h", "n")).alias("cand")))
    packed = arrow_map(once.select("row", "text"), _packed, "row long, text binary")
    pieces = arrow_map(packed.join(cand, "row"), _pieces(cuts, buckets, span), PIECES)
    runs = pieces.repartitionById(buckets, "bucket").sortWithinPartitions("h", "block")
    covered = settle(runs.mapInArrow(_all_runs(span), "row long, s long, e long"))
    if several:
        covered = covered.join(copies, "row", "left_anti").union(whole)
    discard(spark, found, again)
    spans = covered.groupBy("row").agg(F.collect_list(F.struct("s", "e")).alias("runs"))
    schema, extra = "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long", ""
    if carry:
        own = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
        texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), own.alias("text"),
                            F.struct(*carry).alias("carry")).withColumn("row", F.xxhash64("doc_id", "text"))
        extra = f", carry {texts.schema['carry'].dataType.simpleString()}"
    names = ["doc_id", "row", "text", *["carry"] * bool(extra)]
    packed = arrow_map(texts.select(*names), _packed, "doc_id long, row long, text binary" + extra)
    return arrow_map(packed.join(spans, "row", "left"), _cut, schema + extra)


def _all_runs(span: int):
    """Bucket rows to covered runs; rows without a piece are covered already."""
    def split(batches: Iterable[pa.RecordBatch], direct: list) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            has = batch.column("piece").is_valid()
            plain = batch.filter(has.cast(pa.bool_()))
            rest = batch.filter(pa.compute.invert(has))
            if rest.num_rows:
                s = rest.column("s").to_numpy()
                direct.append(pa.RecordBatch.from_arrays(
                    [rest.column("row"), pa.array(s), pa.array(s + rest.column("block").to_numpy() + span - 1)],
                    names=["row", "s", "e"]))
            yield plain

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        direct: list[pa.RecordBatch] = []
        for out in _bucket_runs(span)(split(batches, direct)):
            yield from direct
            direct.clear()
            yield out
        yield from direct

    return run


def op9_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
