"""Tokenizer files and piece encoding inside tasks.

White space never joins the two sides of a token: the library's pre-tokenizers
cut at it and its added tokens hold none. So a text's ids are those of its
white-space-separated parts in order, and of the pieces that the tokenizer's
own pattern cuts a part into.

Texts of characters below U+0180 without a special string need no normaliser:
NFC leaves them as they are, and lower case is the same in every library. They
are cut into pieces here, and each distinct piece goes to the tokenizer's model
once per worker, thousands a call. A part with any other character or a special
string is one piece and goes through the whole tokenizer.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np

from .common import WORKER_CACHES

CACHE_PIECES = 300_000  # pieces of a generation that a worker remembers; affects speed only
CACHED_CHARS = 64  # longer pieces are not remembered, so the cache is bounded in bytes
SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"  # the pattern that pieces follow (fixed value)
_LOW = [chr(c) for c in range(0x180)]  # their classes and lower case are the same in every version of Unicode
_SPACE = re.compile(rb"[ \t\n\r\x0b\x0c]")
_PARTS = re.compile("[^ \t\n\r\x0b\x0c]+")
_PLAIN = re.compile("[\0-\u017f]*")
_WHOLE = "\n"  # begins the key of a piece for the whole tokenizer; no other piece holds white space
_STATE: dict[str, "Encoder"] = {}
WORKER_CACHES.append(_STATE)


def _piece_pattern() -> re.Pattern:
    """``SPLIT`` for lower-cased text of low characters; the alternatives differ in their first character, so order is free."""
    letter, number = ("".join(map(re.escape, (c for c in [*_LOW, "\u0307"] if unicodedata.category(c)[0] == k))) for k in "LN")
    space = "\t-\r \x85\xa0"
    return re.compile(f"[{letter}]+|[{number}]|'(?:s|t|re|ve|m|ll|d)|[^{space}{letter}{number}]+")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """A tokenizer file with its model apart and the pieces met so far (two generations)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.full = Tokenizer.from_file(path)
        self.full.no_truncation()
        self.full.no_padding()
        self.model = Tokenizer(self.full.model)
        self.model.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.findall = _piece_pattern().findall if _plain_steps(spec) else None
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _plain(self, text: str) -> bool:
        return bool(self.findall and _PLAIN.fullmatch(text)) and not any(s in text for s in self.special)

    def _pieces(self, raw: bytes) -> list[str]:
        text = raw.decode("utf-8", "replace")
        if self._plain(text):
            return self.findall(text.lower())
        out: list[str] = []
        for part in _PARTS.findall(text):
            if self._plain(part):
                out += self.findall(part.lower())
            else:
                out.append(_WHOLE + part)
        return out

    def _encode(self, pieces: list[str]) -> dict[str, bytes]:
        out: dict[str, bytes] = {}
        plain = [p for p in pieces if p[0] != _WHOLE]
        for at in range(0, len(plain), 1 << 12):
            some = plain[at:at + (1 << 12)]
            enc = self.model.encode(" ".join(some), add_special_tokens=False)
            raw = np.array(enc.ids, "<u4").tobytes()
            edge = (4 * np.searchsorted(np.array(enc.word_ids, np.int64), np.arange(len(some) + 1))).tolist()
            out.update((p, raw[s:e]) for p, s, e in zip(some, edge, edge[1:]))
        rest = [p for p in pieces if p[0] == _WHOLE]
        for at in range(0, len(rest), 1 << 12):
            some = rest[at:at + (1 << 12)]
            found = self.full.encode_batch_fast([p[1:] for p in some], add_special_tokens=False)
            out.update((p, np.array(enc.ids, "<u4").tobytes()) for p, enc in zip(some, found))
        return out

    def ids(self, texts: list[bytes]) -> list[bytes]:
        """For every text its ids as little-endian 32-bit bytes."""
        if len(self.known) > CACHE_PIECES:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        split = [self._pieces(t) for t in texts]
        new = set().union(*split).difference(known)
        again = new & older.keys()
        known.update((p, older[p]) for p in again)
        made = self._encode(list(new - again))
        known.update(made)
        out = [b"".join(map(known.__getitem__, pieces)) for pieces in split]
        for p in [p for p in made if len(p) > CACHED_CHARS]:
            del known[p]
        return out


def _plain_steps(spec: dict) -> bool:
    """Whether the file's steps are the ones that pieces are made by."""
    steps = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (steps == ["NFC", "Replace", "Lowercase"] and [c["type"] for c in cuts] == ["Split", "ByteLevel"]
            and cuts[0]["invert"] and cuts[0]["behavior"] == "Removed" and cuts[0]["pattern"].get("Regex") == SPLIT
            and not cuts[1]["use_regex"] and not spec.get("post_processor"))


def load(path: str) -> Encoder:
    """The tokenizer of a file, once per worker."""
    if path not in _STATE:
        _STATE[path] = Encoder(path)
    return _STATE[path]


def slices(text: bytes, limit: int) -> Iterator[bytes]:
    """``text`` in slices of about ``limit`` bytes that end at white space."""
    at = 0
    while len(text) - at > limit:
        cut = _SPACE.search(text, at + limit)
        if not cut:
            break
        yield text[at:cut.end()]
        at = cut.end()
    yield text[at:] if at else text


def encode_texts(path: str, texts: list[bytes], limit: int = 1 << 20) -> list[bytes]:
    """The ids of every text as little-endian 32-bit bytes; long texts are cut and joined in slices."""
    enc = load(path)
    if sum(map(len, texts)) <= 2 * limit:
        return enc.ids(texts)
    return [b"".join(enc.ids([s])[0] for s in slices(t, limit)) for t in texts]
