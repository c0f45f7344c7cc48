"""Word and shingle hashes over UTF-8 bytes, vectorised with numpy.

A word is a maximal run of the bytes a table marks; a fold table maps bytes
before hashing (A-Z to a-z). Both act on single bytes below 0x80 only, so they
are exact on UTF-8."""

from __future__ import annotations

import numpy as np

U = np.uint64
_P = U(0x9E3779B97F4A7C15)

#: Everything but space and the control characters 0x09 to 0x0D.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: ASCII letters and digits, and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[0x80:] = True
for _a, _b in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)):
    ALNUM[_a:_b] = True

FOLD = np.arange(256, dtype=np.uint8)
FOLD[0x41:0x5B] += 0x20

_POW = np.ones(1, U)


def _powers(n: int) -> np.ndarray:
    global _POW
    if len(_POW) < n:
        with np.errstate(over="ignore"):
            full = np.full(max(n, 64), _P, U)
            full[0] = U(1)
            _POW = np.cumprod(full, dtype=U)
    return _POW


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def words(raw: np.ndarray, offsets: np.ndarray, word=NOT_SPACE):
    """Words of the texts ``raw[offsets[i]:offsets[i + 1]]``; ``word`` is a table
    of 256 flags, or a function from the bytes to their flags.

    Returns (first byte, end byte, hash, first word of each text and the end)."""
    base = int(offsets[0])
    b = raw[base:int(offsets[-1])]
    n = len(b)
    bounds = offsets - base
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U), np.zeros(len(offsets), np.int64)
    w = word(b) if callable(word) else word[b]
    new_text = np.zeros(n + 1, bool)
    new_text[bounds] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = w[:-1]
    starts = np.flatnonzero(w & (~before | new_text[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = w[1:]
    ends = np.flatnonzero(w & (~after | new_text[1:])) + 1
    if len(starts) == 0:
        return starts, ends, np.zeros(0, U), np.zeros(len(offsets), np.int64)
    lens = ends - starts
    first = np.zeros(len(lens), np.int64)
    np.cumsum(lens[:-1], out=first[1:])
    within = np.arange(int(lens.sum()), dtype=np.int64) - np.repeat(first, lens)
    with np.errstate(over="ignore"):
        v = (FOLD[b[w]].astype(U) + U(1)) * _powers(int(lens.max()) + 1)[within]
        h = mix(np.add.reduceat(v, first) + lens.astype(U) * U(0xD6E8FEB86659FD93))
    return starts + base, ends + base, h, np.searchsorted(starts, bounds, "left")


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each word on (the last k - 1 are absent)."""
    if len(h) < k:
        return np.zeros(0, U)
    out = np.zeros(len(h) - k + 1, U)
    with np.errstate(over="ignore"):
        for j in range(k):
            out = (out + h[j:len(h) - k + 1 + j]) * U(0xFF51AFD7ED558CCD)
            out ^= out >> U(29)
    return mix(out)


def shingle_sets(h: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingles of each text: sorted hashes, end to end, and
    their counts. A text with 1 to k - 1 words has its whole sequence as one."""
    every = windows(h, k)
    parts, sizes = [], np.zeros(len(first) - 1, np.int64)
    for i in range(len(first) - 1):
        s, e = int(first[i]), int(first[i + 1])
        if e - s >= k:
            u = np.unique(every[s:e - k + 1])
        elif e > s:
            u = windows(np.concatenate([h[s:e], np.full(k - (e - s), U(e - s), U)]), k)
        else:
            continue
        parts.append(u)
        sizes[i] = len(u)
    return (np.concatenate(parts) if parts else np.zeros(0, U)), sizes
