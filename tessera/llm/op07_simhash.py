"""SimHash near-duplicates with deletion-variant signatures.

A fingerprint is cut into ``distance // 2 + 1`` segments, fewer than an exact
match needs: of ``distance`` differing bits at least one segment then holds at
most one. Each segment is indexed under every form with one bit taken out, so
two segments that differ in one bit or none share a form. Forms are equality
keys; every pair met under a key is verified on all 64 bits. A form that more
than ``PER_KEY`` distinct fingerprints may share (a long common passage) is
joined with the forms of the remaining bits, so its group falls apart into
groups that agree in two segments, and every near pair still meets.

Defined results: null and word-less texts have fingerprint zero and link like
any other; repeated rows share a fingerprint; texts are linked by fingerprint
only, so different texts under one id stay apart; rows with a null id get a
fingerprint but link to nothing (null component); an empty table gives no rows;
columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, discard, id_text, settle, sorted_runs, table
from .components import connected_components

BITS = 64
PER_KEY = 4096  # distinct fingerprints under one key before its rows are keyed by their other bits too


def fingerprint(text: bytes, shingle: int = 4) -> int:
    """Signed 64-bit SimHash of a UTF-8 text: a bit is 1 if set in over half the shingle hashes."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the white space 0x20, 0x09-0x0D
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return int(np.uint64(xxhash.xxh64_intdigest(joined, 42)).astype(np.int64))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-shingle] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[s:e], 42) for s, e in zip(starts, ends[shingle - 1:].tolist())], "<u8")
    n, counts = len(hashes), np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):
        part = hashes[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<i8")[0])


def text_hash(text_col: str = "text") -> F.Column:
    """With the id it tells rows apart; a null text counts as empty."""
    return F.xxhash64(F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """``(doc_id, text_hash, fp)``, ``fp`` the signed fingerprint of the whole text."""
    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"),
                "fp": [fingerprint(t, shingle) for t in batch.column("text").to_pylist()]}

    rows = id_text(docs, id_col, text_col).withColumn("text_hash", text_hash())
    return arrow_map(rows, run, "doc_id long, text_hash long, fp long")


def _segments(bits: int, distance: int) -> list[tuple[int, int]]:
    """``(first bit, width)`` of the ``distance // 2 + 1`` segments of so many bits."""
    n, out, at = distance // 2 + 1, [], 0
    for s in range(n):
        out.append((at, (bits - at) // (n - s)))
        at += out[-1][1]
    return out


def _segment(fp: F.Column, at: int, width: int) -> F.Column:
    return F.shiftrightunsigned(fp, at).bitwiseAND(F.lit((1 << width) - 1)) if width < BITS else fp


def _forms(fp: F.Column, distance: int, bits: int = BITS) -> list:
    """One long per (segment, deleted bit): the number of that form above the segment's other bits."""
    out = []
    for at, width in _segments(bits, distance):
        seg = _segment(fp, at, width)
        for j in range(width):
            rest = F.shiftleft(F.shiftrightunsigned(seg, j + 1), j).bitwiseOR(seg.bitwiseAND(F.lit((1 << j) - 1)))
            out.append(rest.bitwiseOR(F.lit((at + j) << (BITS - 8))) if width <= BITS - 8
                       else F.xxhash64(rest, F.lit(at + j)))
    return out


def _split(distance: int) -> F.Column:
    """Keys of a row ``(key, fp)`` of a hot key: the key with every form of the bits outside the key's segment. Rows
    within ``distance`` bits differ in no more of those, so they share one of these keys again."""
    number, keys = F.shiftrightunsigned("key", BITS - 8), None
    for at, width in _segments(BITS, distance):
        others = F.shiftleft(F.shiftrightunsigned("fp", at + width), at) if at + width < BITS else F.lit(0).cast("long")
        others = others.bitwiseOR(F.col("fp").bitwiseAND(F.lit((1 << at) - 1)))
        forms = F.array(*(F.xxhash64("key", f) for f in _forms(others, distance, BITS - width)))
        keys = F.when(number < at + width, forms) if keys is None else keys.when(number < at + width, forms)
    return keys


def keyed_fingerprints(classes: DataFrame, distance: int, most: int = PER_KEY) -> DataFrame:
    """``(key, fp)``: every distinct fingerprint under its forms. A form joins two values of its segment, so those
    of a value that over ``most / 2`` fingerprints have may be hot; their rows are keyed by the other bits as well."""
    keyed = classes.select(F.explode(F.array(*_forms(F.col("fp"), distance))).alias("key"), "fp")
    if distance < 2:  # one segment: a form holds two fingerprints
        return keyed
    values = F.array(*(F.struct(F.lit(at).alias("at"), _segment(F.col("fp"), at, width).alias("value"))
                       for at, width in _segments(BITS, distance)))
    common = settle(classes.select(F.explode(values).alias("v")).groupBy("v.at", "v.value").count().where(F.col("count") > most // 2))
    hot = None
    for at, width in _segments(BITS, distance):
        fp = F.shiftleft("value", at)
        forms = F.array(*(f for k, f in enumerate(_forms(fp, distance)) if at <= k < at + width))
        part = common.where(F.col("at") == at).select(F.explode(forms).alias("key"))
        hot = part if hot is None else hot.union(part)
    if common.isEmpty():
        return keyed
    hot = F.broadcast(hot.distinct())  # few: each stands for over most / 2 fingerprints
    return (keyed.join(hot, "key", "left_anti")
            .union(keyed.join(hot, "key", "left_semi").select(F.explode(_split(distance)).alias("key"), "fp")))


def _spanning(fp: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Positions of a spanning forest of the pairs within ``distance`` bits: n - 1 edges at most."""
    left, edges = np.arange(len(fp)), []
    while len(left):
        todo, left = [int(left[0])], left[1:]
        while todo and len(left):
            u = todo.pop()
            near = np.bitwise_count(fp[left] ^ fp[u]) <= distance
            if near.any():
                hit = left[near].tolist()
                edges += [(u, v) for v in hit]
                todo += hit
                left = left[~near]
    return edges


def _verify(distance: int):
    """Edges between fingerprints (or between the ``rep`` given for each) that share a key and are near."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sorted_runs(batches, "key"):
            key, fp = part.column("key").to_numpy(), part.column("fp").to_numpy()
            rep = part.column("rep").to_numpy() if "rep" in part.column_names else fp
            fp = fp.view(np.uint64)
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            size = np.diff(np.concatenate((first, [len(key)])))
            us, vs = [], []
            two = first[size == 2]  # nearly all groups: one vector operation
            two = two[np.bitwise_count(fp[two] ^ fp[two + 1]) <= distance]
            us.append(rep[two])
            vs.append(rep[two + 1])
            for f, n in zip(first[size > 2].tolist(), size[size > 2].tolist()):
                if edges := _spanning(fp[f:f + n], distance):
                    e = np.array(edges) + f
                    us.append(rep[e[:, 0]])
                    vs.append(rep[e[:, 1]])
            u, v = np.concatenate(us), np.concatenate(vs)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["u", "v"])

    return run


def simhash_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                 distance: int = 4) -> DataFrame:
    """``(doc_id, text_hash, fp, component_id, component_text)`` for every row: the last two are the smallest
    ``(doc_id, text_hash)`` of its component, null for a row without an id."""
    spark = docs.sparkSession
    fps = settle(fingerprints(docs, id_col, text_col, shingle))
    first = F.min(F.struct("doc_id", "text_hash")).alias("first")
    classes = settle(fps.where("doc_id is not null").groupBy("fp").agg(first))
    edges = (keyed_fingerprints(classes.select("fp"), distance).repartition("key").sortWithinPartitions("key", "fp")
             .mapInArrow(_verify(distance), "u long, v long").distinct())
    labels = settle(connected_components(edges).withColumnRenamed("node", "fp"))
    linked = settle(classes.join(labels, "fp").select("fp", "component", "first"))
    least = linked.groupBy("component").agg(F.min("first").alias("first"))
    named = settle(linked.select("fp", "component").join(least, "component").select("fp", "first")
                   .union(classes.join(labels, "fp", "left_anti").select("fp", "first")))
    discard(spark, classes, labels, linked)

    def of_component(field: str, name: str) -> F.Column:
        return F.when(F.col("doc_id").isNotNull(), F.col("first")[field]).alias(name)

    return fps.join(named, "fp", "left").select("doc_id", "text_hash", "fp", of_component("doc_id", "component_id"),
                                                of_component("text_hash", "component_text"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4,
                       distance: int = 4) -> DataFrame:
    """``(doc_id, fp, component_id)``: the smallest id reachable over pairs within ``distance`` bits."""
    return simhash_rows(docs, id_col, text_col, shingle, distance).select("doc_id", "fp", "component_id")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
