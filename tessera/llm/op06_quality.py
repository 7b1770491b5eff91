"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad from its own features and those of the two
lines beside it; the chain couples the labels of neighbours. Forward-backward
gives each line's marginal of "good", and a document's quality is their mean
weighted by line length. The chain is trained by its likelihood, with the
document's label on all its lines, on a bounded sample of labelled documents.

Defined results: null and empty texts have no line and score the share of
label 1 in the sample (0.5 without any labelled row); a line over 64 KiB counts
as several; ids may repeat or be null (a null id is not held out); an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bytesops import groups, span_hash, spans
from .common import arrow_map, enter_stage, id_text, table
from .labelled import held_out, label_sample

LONGEST_LINE = 1 << 16
CHUNK = 1 << 19
N_FEATURES = 11

_SPACE, _UPPER, _LOWER, _DIGIT, _STOP, _SYMBOL, _HIGH = range(7)
_KIND = np.full(256, _SYMBOL, np.uint8)
for _c in range(256):
    _b = bytes([_c])
    _KIND[_c] = (_SPACE if _b.isspace() else _UPPER if _b.isupper() else _LOWER if _b.islower() else _DIGIT
                 if _b.isdigit() else _STOP if _b in b".,;:'\"()-?" else _HIGH if _c > 127 else _SYMBOL)


def _lines(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """Buffer, line starts (each line ends with one byte that is no part of it) and lines per text."""
    parts, per_text = [], []
    for t in texts:
        own = [x for x in t.split(b"\n") if x and not x.isspace()]
        if len(t) > LONGEST_LINE:
            own = [x[s:s + LONGEST_LINE] for x in own for s in range(0, len(x), LONGEST_LINE)]
        parts += own
        per_text.append(len(own))
    length = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    return b"\n".join(parts) + b"\n", np.cumsum(length) - length, np.array(per_text, np.int64)


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, the lines' lengths and each text's number of lines."""
    raw, start, per_text = _lines(texts)
    if not len(start):
        return np.empty((0, N_FEATURES), np.float32), np.empty(0, np.int64), per_text
    data = np.frombuffer(raw, np.uint8)
    kind = _KIND[data]
    n = np.diff(np.concatenate((start, [len(data)]))) - 1
    share = [np.add.reduceat((kind == k).astype(np.int32), start) / np.maximum(n, 1)
             for k in (_UPPER, _DIGIT, _STOP, _SYMBOL, _HIGH)]
    ws, we = spans(kind != _SPACE)
    line = np.searchsorted(start, ws, side="right") - 1
    h = span_hash(data, ws, we)
    words = np.maximum(np.bincount(line, minlength=len(start)), 1)
    same = np.concatenate(([False], (h[1:] == h[:-1]) & (line[1:] == line[:-1])))
    odd_end = kind[we - 1] == _SYMBOL
    odd_word = odd_end & (kind[ws] == _SYMBOL)
    order = np.lexsort((h, line))
    distinct = np.concatenate(([True], (h[order][1:] != h[order][:-1]) | (line[order][1:] != line[order][:-1])))
    kinds = np.bincount(line[order][distinct], minlength=len(start))
    ratio = [np.bincount(line, x, minlength=len(start)) / words for x in (same, odd_end, odd_word)]
    return (np.stack([*share, *ratio, kinds / words, np.log1p(n) / 6, words / np.maximum(n, 1)], axis=1)
            .astype(np.float32), n, per_text)


def with_neighbours(x: np.ndarray, per_text: np.ndarray) -> np.ndarray:
    """A line's features with those of the line before and after it in its text, and a constant."""
    first, last = np.cumsum(per_text) - per_text, np.cumsum(per_text) - 1
    before, after = np.roll(x, 1, axis=0), np.roll(x, -1, axis=0)
    some = per_text > 0
    before[first[some]] = 0
    after[last[some]] = 0
    return np.hstack([x, before, after, np.ones((len(x), 1), x.dtype)])


class Chain:
    """Binary linear chain: ``w`` weighs features, ``t`` the transitions 0-0 and 1-1 (0-1 and 1-0 have weight 0)."""

    def __init__(self, w: np.ndarray, t: tuple[float, float], mean: np.ndarray, std: np.ndarray, prior: float):
        self.w, self.t, self.mean, self.std, self.prior = w, t, mean, std, prior

    def unary(self, x3: np.ndarray) -> np.ndarray:
        return ((x3 - self.mean) / self.std) @ self.w

    def messages(self, u: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward and backward log-odds of every line; all texts advance one line at a time."""
        t0, t1 = self.t
        order = np.argsort(-per_text, kind="stable")
        first, size = (np.cumsum(per_text) - per_text)[order], per_text[order]
        last = first + size - 1
        fwd, bwd = u.copy(), np.zeros_like(u)
        for k in range(1, int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size, -k, side="left"))
            at = first[:live] + k
            a = fwd[at - 1]
            fwd[at] += np.logaddexp(a + t1, 0) - np.logaddexp(a, t0)
            at = last[:live] - k
            b = u[at + 1] + bwd[at + 1]
            bwd[at] = np.logaddexp(b + t1, 0) - np.logaddexp(b, t0)
        return fwd, bwd

    def marginals(self, x3: np.ndarray, per_text: np.ndarray) -> np.ndarray:
        fwd, bwd = self.messages(self.unary(x3), per_text)
        return 1 / (1 + np.exp(-np.clip(fwd + bwd, -50, 50)))

    def quality(self, texts: list[bytes]) -> np.ndarray:
        """Length-weighted mean of the lines' marginals, for each text."""
        out = np.full(len(texts), self.prior)
        for b, e in groups(list(map(len, texts)), CHUNK):
            x, n, per_text = line_features(texts[b:e])
            if len(x):
                p = self.marginals(with_neighbours(x, per_text), per_text)
                of = np.repeat(np.arange(e - b), per_text)
                weight = np.bincount(of, n, minlength=e - b)
                score = np.bincount(of, n * p, minlength=e - b) / np.maximum(weight, 1)
                out[b:e] = np.where(per_text > 0, score, out[b:e])
        return out


def train_chain(texts: list[bytes], y: list[int], steps: int = 150, rate: float = 0.1, l2: float = 1e-3) -> Chain:
    """Maximum likelihood by Adam; every text weighs the same, whatever its number of lines."""
    y = np.array(y, np.float64)
    prior = float(y.mean()) if len(y) else 0.5
    dims = 3 * N_FEATURES + 1
    chain = Chain(np.zeros(dims), (0.0, 0.0), np.zeros(dims), np.ones(dims), prior)
    if prior in (0.0, 1.0) or not len(y):
        chain.w[-1] = np.log((prior + 0.01) / (1.01 - prior))
        return chain
    x, _, per_text = line_features(texts)
    x3 = with_neighbours(x, per_text).astype(np.float64)
    chain.mean, chain.std = x3.mean(0), x3.std(0) + 1e-6
    chain.mean[-1], chain.std[-1] = 0, 1
    z = (x3 - chain.mean) / chain.std
    of = np.repeat(np.arange(len(y)), per_text)
    gold = y[of]
    weight = (np.where(y == 1, 0.5 / prior, 0.5 / (1 - prior)) / np.maximum(per_text, 1) / len(y))[of]
    pair = np.flatnonzero(of[1:] == of[:-1])
    theta, m, v = np.zeros(dims + 2), np.zeros(dims + 2), np.zeros(dims + 2)
    for step in range(1, steps + 1):
        chain.w, chain.t = theta[:-2], (theta[-2], theta[-1])
        u = z @ chain.w
        fwd, bwd = chain.messages(u, per_text)
        p = 1 / (1 + np.exp(-np.clip(fwd + bwd, -50, 50)))
        a, b = fwd[pair], (u + bwd)[pair + 1]
        logs = np.stack([np.full(len(pair), chain.t[0]), a, b, a + b + chain.t[1]])
        both = np.exp(logs - np.logaddexp.reduce(logs, axis=0))
        g = np.concatenate((z.T @ (weight * (gold - p)),
                            [np.sum(weight[pair] * ((1 - gold[pair]) - both[0])), np.sum(weight[pair] * (gold[pair] - both[3]))]))
        g -= l2 * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    chain.w, chain.t = theta[:-2], (theta[-2], theta[-1])
    return chain


def fit_quality(docs: DataFrame, labels: DataFrame, per_class: int = 1500, label: str = "quality") -> Chain:
    """Train on at most ``per_class`` labelled documents of either class."""
    rows = label_sample(docs, labels, label, per_class).select("doc_id", "text", "y").collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.text)))
    return train_chain([bytes(r.text) for r in rows], [r.y for r in rows])


def quality_scores(docs: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` of every whole text, 0 to 1."""
    def run(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "score": chain.quality(batch.column("text").to_pylist())}

    return arrow_map(id_text(docs, id_col, text_col), run, "doc_id long, score double")


def quality_filter(docs: DataFrame, chain: Chain, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``least`` or more; all columns pass, nothing is shuffled."""
    stage = uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter_stage(stage)
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(text_col).to_pylist()]
            yield batch.filter(pa.array(chain.quality(texts) >= least))

    return docs.mapInArrow(run, docs.schema)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality_scores(docs, chain).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
