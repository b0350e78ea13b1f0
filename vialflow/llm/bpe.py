"""Byte-level BPE ids of whole texts, a batch's bytes at once.

The vocabulary's pre-tokeniser never joins characters across the cuts made here (before a
space that leads a word, around white-space runs, between an ASCII letter and a full stop or
comma), so a text's ids are its chunks' ids in order. Chunks are found and hashed by numpy over
the batch's bytes; each worker keeps the ids of chunks it has met (at most CACHE) and encodes
only new ones. Texts with white space outside ASCII, or with a special token's string, are
encoded by the library as they are.

The ids are those of the tokenizers library for the same file (a test compares them); new
chunks go through tiktoken, which merges by the same ranks and takes a tenth of the time on
single words. A chunk is recognised by a 64-bit hash and its length.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa

from . import words

U = np.uint64
CACHE = 1_500_000
BYTES = 2_000_000       # of text handled at once
LARGE = 4_000_000       # a longer text goes to the library whole
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_WIDE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_STOP = np.zeros(256, bool)
_STOP[[44, 46]] = True


def _byte_chars() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import tiktoken
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        of = _byte_chars()
        ranks = {bytes(of[c] for c in t): i for t, i in vocab.items() if t not in self.special}
        self.fast = tiktoken.Encoding("byte-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._clear()

    def _clear(self) -> None:
        self.keys, self.place = np.zeros(0, U), np.zeros(0, np.int64)
        self.ids = np.zeros(1 << 16, np.uint32)
        self.start, self.size = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.known = self.used = 0

    def _learn(self, keys: np.ndarray, new: list[str]) -> None:
        got = [self.fast.encode_ordinary(c) for c in new]
        size = np.fromiter(map(len, got), np.int64, len(got))
        total, n = int(size.sum()), self.known
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(new) > len(self.start):
            self.start, self.size = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.size))
        self.ids[self.used:self.used + total] = [i for x in got for i in x]
        self.size[n:n + len(new)] = size
        self.start[n:n + len(new)] = self.used + np.cumsum(size) - size
        self.used += total
        self.known += len(new)
        keys, place = np.concatenate([self.keys, keys]), np.concatenate([self.place, np.arange(n, n + len(new))])
        order = np.argsort(keys, kind="stable")
        self.keys, self.place = keys[order], place[order]

    def _chunks(self, raw: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where chunks begin in the texts' bytes (ASCII white space only)."""
        n = len(raw)
        space = _SPACE[raw]
        first = np.zeros(n + 1, bool)
        first[at] = True
        before = np.zeros(n, bool)
        before[1:] = space[:-1]
        begin = first[:-1].copy()
        begin |= space & ~before                                        # a white-space run
        after = np.zeros(n, bool)
        after[:-1] = ~space[1:] & ~first[1:-1]                          # a word follows in this text
        begin |= space & before & after                                 # the run's last character
        prior = np.zeros(n, np.uint8)
        prior[1:] = raw[:-1]
        begin |= ~space & before & (prior != 32)
        begin |= _STOP[raw] & _LETTER[prior]
        return np.flatnonzero(begin)

    def _encode(self, texts: list[bytes]) -> list[np.ndarray]:
        at = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        data = b"".join(texts)
        raw = np.frombuffer(data, np.uint8)
        if not len(raw):
            return [np.zeros(0, np.uint32)] * len(texts)
        s = self._chunks(raw, at)
        e = np.append(s[1:], len(raw))
        up, down = words._power(len(raw) + 1)
        total = np.zeros(len(raw) + 1, U)
        np.cumsum(words._BYTE[raw] * up[:len(raw)], out=total[1:])
        h = words.mix((total[e] - total[s]) * down[s] + (e - s).astype(U))
        keys, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        k = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), bool)
        inside = k < len(self.keys)
        new[inside] = self.keys[k[inside]] != keys[inside]
        if new.any():
            if self.known > CACHE:
                self._clear()
                new[:] = True
            f = first[new]
            self._learn(keys[new], [data[a:b].decode("utf-8", "replace") for a, b in zip(s[f].tolist(), e[f].tolist())])
            k = np.searchsorted(self.keys, keys)
        k = self.place[k][inverse]
        size = self.size[k]
        upto = np.concatenate(([0], np.cumsum(size)))
        flat = self.ids[np.repeat(self.start[k] - upto[:-1], size) + np.arange(upto[-1])]
        cut = upto[np.searchsorted(s, at)]
        return [flat[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, without special tokens around it. A special token's string
        inside a text is that token, as the library has it."""
        out: list[np.ndarray | None] = [None] * len(texts)
        plain = []
        for i, t in enumerate(texts):
            if any(s in t for s in self.special):
                out[i] = np.array(self.tok.encode(t, add_special_tokens=False).ids, np.uint32)
            elif len(t) > LARGE or (not t.isascii() and _WIDE.search(t)) or (t.isascii() and any(c in t for c in "\x1c\x1d\x1e\x1f")):
                out[i] = np.array(self.fast.encode_ordinary(t), np.uint32)
            else:
                plain.append(i)
        for i, x in zip(plain, self._encode([texts[i].encode("utf-8", "replace") for i in plain])):
            out[i] = x
        return out


_ready: dict[str, ByteBpe] = {}


def byte_bpe(path: str) -> ByteBpe:
    """The worker's tokenizer of this vocabulary."""
    if path not in _ready:
        _ready[path] = ByteBpe(path)
    return _ready[path]


def slices(texts: pa.Array, chars: int = BYTES):
    """Parts (first row, texts) of an Arrow text column of about so many characters each;
    nulls as empty texts."""
    at, got, n = 0, [], 0
    for i, t in enumerate(texts):
        t = t.as_py() or ""
        got.append(t)
        n += len(t)
        if n >= chars:
            yield at, got
            at, got, n = i + 1, [], 0
    if got:
        yield at, got
