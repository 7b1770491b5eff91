"""Document toxicity by a subsequence string-kernel SVM with Nyström landmarks.

A word is compared with a landmark by their common subsequences of three
letters, gaps allowed at a decay per place skipped: the cosine of the two
strings' weighted subsequences, to the fifth power (a power of a kernel is a
kernel, symmetric and 1 for equal strings). A sentence's kernel with a landmark
sums this over its distinct words, so an insult with inserted characters,
another ending or letters set apart still meets its landmark. Landmarks are
words and word beginnings of the training sentences; the inverse root of their
own kernel matrix turns sentences into Nyström vectors, on which a linear SVM is
trained. Labels belong to
documents: a toxic document counts through its most toxic sentence, chosen
anew in each training round. A document scores its highest sentence.

The decision is linear in a sentence's words, so each worker rates a distinct
word once and sentences are sums.

Defined results: null, empty and letter-less texts score as a sentence without
words; without labels of both classes the score is the share of label 1 (0 if
none); ids may repeat or be null (a null id is not held out); an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, id_text, table
from .labelled import held_out, label_sample

LETTERS = 64  # 26 letters, word begin and end, and 36 classes for any other letter
BEGIN, END, OTHER = 26, 27, 28
REACH = 6  # a subsequence spans at most this many places after its first letter
DECAY = 0.85
POWER = 5
FLOOR = 1e-6  # eigenvalues of the landmarks' kernel matrix below this count as zero
CACHE_WORDS = 500_000  # words remembered by a worker before it starts anew; affects speed only
GAP = -(1 << 18)  # code of what is no letter; any id with it stays negative

SENTENCE = re.compile(r"[.!?]+(?:\s+|$)|\n+")
APART = re.compile(r"(?<!\S)(?:\S\s){2,}\S(?!\S)")  # letters set apart: i d i o t
MARKS = re.compile(r"[^\w\n]+|_+")
# look-alike characters (fixed values)
_LOOKALIKE = str.maketrans("01345789@$!|", "oieastbgasii")


def sentences(text: str) -> list[list[str]]:
    """Words of every sentence, lower case, letters set apart put together."""
    text = text.lower()
    if APART.search(text):
        text = APART.sub(lambda m: "".join(m.group().split()), text)
    return [s.split() for s in SENTENCE.split(text)]


def _code_table() -> np.ndarray:
    code = np.full(0x3000, GAP, np.int32)
    for c in range(0x3000):
        if chr(c).isalpha():
            code[c] = c - 97 if 97 <= c < 123 else OTHER + c % (LETTERS - OTHER)
    code[[1, 2]] = BEGIN, END
    return code


CODE = _code_table()


def subsequences(marked: list[str]):
    """``(weight, id of the three-letter subsequence at each place)`` per span, and each place's word."""
    flat = ("\0" * REACH).join(marked) + "\0" * REACH
    point = np.frombuffer(flat.encode("utf-32-le", "replace"), "<u4")
    code = np.where(point < 0x3000, CODE[np.minimum(point, 0x2FFF)], (OTHER + point % (LETTERS - OTHER)).astype(np.int32))
    word = np.repeat(np.arange(len(marked)), np.fromiter(map(len, marked), np.int64, len(marked)) + REACH)
    n = len(code) - REACH
    spans = [(DECAY ** (d1 + d2 - 2), (code[:n] * LETTERS + code[d1:d1 + n]) * LETTERS + code[d1 + d2:d1 + d2 + n])
             for d1 in range(1, REACH) for d2 in range(1, REACH - d1 + 1)]
    return spans, word


def marked(words: list[str]) -> list[str]:
    """Words in letters only, look-alikes replaced, with begin and end marked as letters."""
    plain = MARKS.sub("", "\n".join(words).translate(_LOOKALIKE)).split("\n")
    return ["\1" + w + "\2" for w in plain]


def lengths(spans: list, word: np.ndarray, n: int) -> np.ndarray:
    """Euclidean length of each word's vector of weighted subsequences."""
    wide = LETTERS ** 3
    ids = np.concatenate([np.where(i >= 0, word[:len(i)] * wide + i, -1) for _, i in spans])
    weight = np.repeat([w for w, _ in spans], [len(i) for _, i in spans])
    order = np.flatnonzero(ids >= 0)
    order = order[np.argsort(ids[order], kind="stable")]
    ids, weight = ids[order], weight[order]
    first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))[:len(ids)])
    total = np.add.reduceat(weight, first) if len(first) else np.zeros(0)
    return np.sqrt(np.bincount(ids[first] // wide, total * total, minlength=n))


class WordKernel:
    """Kernel of words with the landmarks, given as marked strings (a word beginning has no end mark)."""

    def __init__(self, landmarks: list[str]):
        self.landmarks = landmarks
        spans, word = subsequences(landmarks)
        weight: dict[tuple[int, int], float] = {}
        for w, ids in spans:
            at = np.flatnonzero(ids >= 0)
            for i, k in zip(ids[at].tolist(), word[at].tolist()):
                weight[i, k] = weight.get((i, k), 0.0) + w
        own = lengths(spans, word, len(landmarks))
        entries = sorted(weight)
        self.of = np.array([k for _, k in entries], np.int64)
        self.value = np.array([weight[i, k] / own[k] for i, k in entries])
        self.count = np.zeros(LETTERS ** 3 + 1, np.int32)  # its last place takes what holds a gap
        np.add.at(self.count, np.array([i for i, _ in entries], np.int64), 1)
        self.begin = np.cumsum(self.count) - self.count

    def __call__(self, words: list[str]) -> np.ndarray:
        m = len(self.landmarks)
        spans, word = subsequences(words)
        cells, values = [], []
        for w, ids in spans:
            ids = np.maximum(ids, -1)
            at = np.flatnonzero(self.count[ids])
            ids = ids[at]
            times = self.count[ids]
            entry = np.repeat(self.begin[ids] - np.cumsum(times) + times, times) + np.arange(times.sum())
            cells.append(np.repeat(word[at], times) * m + self.of[entry])
            values.append(self.value[entry] * w)
        total = np.bincount(np.concatenate(cells), np.concatenate(values), minlength=len(words) * m)
        own = lengths(spans, word, len(words))
        return (total.reshape(-1, m) / np.where(own > 0, own, 1.0)[:, None]) ** POWER


class ToxicityModel:
    def __init__(self, kernel: WordKernel | None, beta: np.ndarray, bias: float, middle: float, scale: float, prior: float):
        self.kernel, self.beta, self.bias = kernel, beta, bias
        self.middle, self.scale, self.prior = middle, scale, prior
        self.known: dict[str, float] = {}

    def __getstate__(self):
        return {**self.__dict__, "known": {}}

    def margins(self, texts: list[str]) -> list[float]:
        """Margin of every text's highest sentence."""
        split = [sentences(t) for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        new = list({w for s in split for ws in s for w in ws}.difference(self.known))
        for at in range(0, len(new), 1 << 13):
            some = new[at:at + (1 << 13)]
            self.known.update(zip(some, (self.kernel(marked(some)) @ self.beta).tolist()))
        rate = self.known.__getitem__
        return [max(sum(map(rate, set(ws))) for ws in s) + self.bias for s in split]

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.kernel is None:
            return np.full(len(texts), self.prior)
        out = []
        for at in range(0, len(texts), 256):
            out += self.margins(texts[at:at + 256])
        z = np.clip((np.array(out) - self.middle) / self.scale, -30, 30)
        return 1 / (1 + np.exp(-z))


def pick_landmarks(docs: list[list[list[str]]], y: np.ndarray, n: int, least: float = 3.0) -> list[str]:
    """Words and word beginnings that mark toxic documents beyond chance, none of them close to an earlier one."""
    seen, total = [Counter(), Counter()], [1, 1]
    for label in (1, 0):  # distinct sentences: copies of a document say nothing new
        met: set[int] = set()
        for ws in (ws for s, own in zip(docs, y.tolist()) if own == label for ws in s):
            if (key := hash(frozenset(ws))) in met:
                continue
            met.add(key)
            parts = {w[:k] for w in marked(list(set(ws))) for k in {*range(5, 10), len(w)} if 5 <= len(w[:k]) <= 26}
            seen[label].update(parts if label else [w for w in parts if w in seen[1]])
        total[label] += len(met)
        if label:  # a word of two sentences at most marks nothing
            seen[1] = Counter({w: k for w, k in seen[1].items() if k > 2})
    n0, n1 = total
    score = {}
    for w, k in seen[1].items():
        p, q = k / n1, seen[0][w] / n0
        if p > q:
            score[w] = (p - q) / np.sqrt((p + 4 * q + 1 / n1) / n1)
    order = sorted(score, key=lambda w: (-score[w], -len(w), w))[:20 * n]
    taken: list[int] = []
    if order:
        near = WordKernel(order)(order)
        for k, w in enumerate(order):
            if len(taken) < n and (score[w] >= least or len(taken) < 8) and (not taken or near[k, taken].max() < 0.3):
                taken.append(k)
    return [order[k] for k in taken]


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by Newton steps on the active rows; ``y`` in -1, 1."""
    xb = np.hstack([x, np.ones((len(x), 1))])
    u = np.zeros(xb.shape[1])
    ridge = np.eye(len(u)) / c
    ridge[-1, -1] = 1e-6
    for _ in range(20):
        active = y * (xb @ u) < 1
        xa, wa = xb[active], weight[active, None]
        new = np.linalg.solve(ridge + xa.T @ (wa * xa), xa.T @ (wa[:, 0] * y[active]))
        if np.allclose(new, u, atol=1e-6):
            break
        u = new
    return u[:-1], float(u[-1])


def train_toxicity(texts: list[str], labels: list[int], landmarks: int = 64, rounds: int = 4, c: float = 20.0) -> ToxicityModel:
    y = np.array(labels, np.int64)
    prior = float(y.mean()) if len(y) else 0.0
    same: dict[str, str] = {}  # one object per distinct word
    docs = [[[same.setdefault(w, w) for w in ws] for ws in sentences(t)] for t in texts]
    names = pick_landmarks(docs, y, landmarks) if 0 < prior < 1 else []
    if not names:
        return ToxicityModel(None, np.zeros(0), 0.0, 0.0, 1.0, prior)
    kernel = WordKernel(names)
    words = sorted({w for s in docs for ws in s for w in ws}) or [""]
    place = {w: k for k, w in enumerate(words)}
    of_word = np.vstack([kernel(marked(words[s:s + (1 << 12)])).astype(np.float32) for s in range(0, len(words), 1 << 12)])
    flat = [ws for s in docs for ws in s]
    doc = np.repeat(np.arange(len(docs)), [len(s) for s in docs])
    x = np.zeros((len(flat), len(names)))
    for k, ws in enumerate(flat):
        if ws:
            x[k] = of_word[[place[w] for w in set(ws)]].sum(axis=0)
    del of_word, place, words
    value, vector = np.linalg.eigh(kernel(names))
    root = (vector / np.sqrt(np.where(value > FLOOR, value, np.inf))) @ vector.T
    z = x @ root
    margin = x.max(axis=1)
    negative = np.flatnonzero(y[doc] == 0)
    begin = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    for _ in range(rounds):
        best = np.maximum.reduceat(margin, begin)
        witness = np.flatnonzero((margin >= best[doc]) & (y[doc] == 1))
        witness = witness[np.unique(doc[witness], return_index=True)[1]]
        # a toxic document whose best sentence looks clean to the model so far teaches nothing yet
        rows = np.concatenate((witness, negative))
        sign = np.where(y[doc[rows]] == 1, 1.0, -1.0)
        share = np.where(sign > 0, 1 / max(1, len(witness)), 1 / max(1, len(negative)))
        u, bias = _svm(z[rows], sign, share * 1000, c)
        margin = z @ u + bias
    best, truth = np.maximum.reduceat(margin, begin), y
    order = np.argsort(best)
    right = np.cumsum(truth[order] == 0) + (truth.sum() - np.cumsum(truth[order] == 1))
    cut = np.concatenate((best[order], [best[order[-1]] + 1]))
    good = np.flatnonzero(right >= right.max() - 0.001 * len(right))  # the middle of all thresholds about as right
    middle = (cut[good[0]] + cut[good[-1] + 1]) / 2
    scale = max(1e-3, (np.median(best[truth == 1]) - np.median(best[truth == 0])) / 8)
    return ToxicityModel(kernel, root @ u, bias, float(middle), float(scale), prior)


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = 1000, label: str = "toxic") -> ToxicityModel:
    """Train on the sentences of at most ``per_class`` labelled documents of either class."""
    rows = label_sample(docs, labels, label, per_class).select("doc_id", "text", "y").collect()
    rows.sort(key=lambda r: (r.doc_id, bytes(r.text)))
    return train_toxicity([bytes(r.text).decode("utf-8", "replace") for r in rows], [r.y for r in rows])


def toxicity_scores(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` of every whole text, 0 to 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of landmarks, its size set by their number

    def run(batch: pa.RecordBatch) -> dict:
        texts = [t.decode("utf-8", "replace") for t in batch.column("text").to_pylist()]
        return {"doc_id": batch.column("doc_id"), "score": shared.value.scores(texts)}

    return arrow_map(id_text(docs, id_col, text_col), run, "doc_id long, score double")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity_scores(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
