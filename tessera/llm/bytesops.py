"""Vector operations on UTF-8 bytes shared by the text operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

CODE = np.random.default_rng(11).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, 1 << 20)
        _POWERS[:] = [np.cumprod(np.concatenate(([np.uint64(1)], np.full(size, np.uint64(x)))))
                      for x in (BASE, pow(BASE, -1, 1 << 64))]
    return _POWERS


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each ``data[start:end]``, the same for equal bytes at any place."""
    power, inverse = _powers(len(data) + 1)
    prefix = np.concatenate(([np.uint64(0)], np.cumsum(CODE[data] * power[:len(data)])))
    return mix((prefix[end] - prefix[start]) * inverse[start] + (end - start).astype(np.uint64))


def spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every run of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


def groups(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items of about ``limit`` in total (one item at least)."""
    begin = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)
