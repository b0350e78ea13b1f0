"""Words of whole texts and their 64-bit hashes, computed on an Arrow batch's bytes at once.

A word is a run of bytes other than space and 0x09-0x0D; A-Z count as a-z. A word's hash is
a polynomial over its bytes (taken from prefix sums modulo 2**64), finished by a mixer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_LUT = np.arange(256, dtype=np.uint8)
_LUT[9:14] = 32
_LUT[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
SEGMENT = 1 << 20      # bytes hashed at once; a longer word makes a longer segment
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def mix(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x, U).copy()
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INV)):
            p = np.full(n, base, U)
            p[0] = 1
            _powers[i] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def _raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each begins and the last ends."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if texts.offset:
        texts = pa.concat_arrays([texts])
    _, off, data = texts.buffers()
    at = np.frombuffer(off, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def hashed(texts: pa.Array, heads: tuple[int, ...] = (), tail: int = 0) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of all words, in order, and the place of each text's first word (one more than
    texts). ``heads`` adds hashes of the words' first so many bytes, ``tail`` of the last."""
    raw, at = _raw(texts)
    out: list[list[np.ndarray]] = [[] for _ in range(1 + len(heads) + bool(tail))]
    starts: list[np.ndarray] = []
    pos, n = 0, len(raw)
    while pos < n:
        end = min(n, pos + SEGMENT)
        while end < n:      # to the end of the word or text
            stop = min(n, end + SEGMENT)
            gap = np.flatnonzero(_LUT[raw[end:stop]] == 32)
            cut = int(at[np.searchsorted(at, end)])
            here = end + int(gap[0]) if len(gap) else stop
            end = min(here, cut)
            if len(gap) or cut <= stop:
                break
        b = _LUT[raw[pos:end]]
        word = b != 32
        edge = np.zeros(len(b) + 1, bool)
        inner = at[np.searchsorted(at, pos):np.searchsorted(at, end, "right")] - pos
        edge[inner] = True
        edge[0] = edge[-1] = True
        begins = word.copy()
        begins[1:] &= ~word[:-1] | edge[1:-1]
        ends = word.copy()
        ends[:-1] &= ~word[1:] | edge[1:-1]
        s, e = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        up, down = _power(len(b) + 1)
        total = np.zeros(len(b) + 1, U)
        np.cumsum(_BYTE[b] * up[:len(b)], out=total[1:])
        out[0].append(mix((total[e] - total[s]) * down[s]))
        for i, h in enumerate(heads):
            out[1 + i].append(mix((total[np.minimum(s + h, e)] - total[s]) * down[s] + U(h)))
        if tail:
            t = np.maximum(e - tail, s)
            out[-1].append(mix((total[e] - total[t]) * down[t] + U(97)))
        starts.append(s + pos)
        pos = end
    first = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return [np.concatenate(x) if x else np.zeros(0, U) for x in out], np.searchsorted(first, at)


def shingles(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's k-word shingles; a shorter text is one shingle
    of all its words, a text without words has none."""
    (h,), at = hashed(texts)
    odd = [U(0x9E3779B97F4A7C15 * (2 * j + 1) % (1 << 64) | 1) for j in range(k)]
    if len(h) >= k:
        run = h[:len(h) - k + 1] * odd[0]
        for j in range(1, k):
            run = run + h[j:len(h) - k + 1 + j] * odd[j]
        run = mix(run)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= k:
            x = np.sort(run[a:b - k + 1])
            out.append(x[np.concatenate(([True], x[1:] != x[:-1]))])
        elif b > a:
            x = h[a:b] * np.array(odd[:b - a], U)
            out.append(mix(x.sum(keepdims=True, dtype=U) + U(b - a)))
        else:
            out.append(np.zeros(0, U))
    return out


def set_digest(x: np.ndarray) -> int:
    """64-bit digest of a set of hashes, as a signed long."""
    d = mix(mix(x * U(_BASE)).sum(keepdims=True, dtype=U) + U(len(x)))
    return int(d.view(np.int64)[0])
