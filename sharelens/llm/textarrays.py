"""Word and line arithmetic on numpy arrays, for whole Arrow batches of texts at once.

A batch of texts is one byte buffer with offsets; words and lines are
``(start, end)`` pairs into it.  Hashes are 64-bit: a word (or line) hash is the
difference of a polynomial prefix sum over randomised byte values, so the cost
per byte is a few vector operations and no Python object is made per word.
Two equal words always hash alike; two different ones collide with odds of
about 2^-64 for each pair compared.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
BATCH_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (shift, multiply, shift), elementwise."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U64))
#: ASCII space and \t \n \v \f \r
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
#: continuation bytes of UTF-8 are not the start of a code point
LEAD = (np.arange(256) & 0xC0) != 0x80

_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^0..base^n and base^-0..base^-n, modulo 2^64."""
    if "p" not in _powers or len(_powers["p"]) <= n:
        size = max(n + 1, 1 << 16)
        for name, base in (("p", _BASE), ("q", _INV)):
            steps = np.full(size, base, U64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["p"], _powers["q"]


def encode(texts) -> tuple[np.ndarray, np.ndarray]:
    """Byte buffer and offsets (len + 1) of the texts; None counts as empty."""
    parts = [b"" if t is None else t.encode("utf-8", "replace") for t in texts]
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return np.frombuffer(b"".join(parts), np.uint8), offsets


def lower_ascii(buf: np.ndarray) -> np.ndarray:
    """A-Z to a-z, every other byte as it is."""
    upper = (buf >= 65) & (buf <= 90)
    return buf + (upper.astype(np.uint8) << 5)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of true bytes that stay within one text: start, end, text index."""
    n = len(inside)
    if n == 0:
        e = np.zeros(0, np.int64)
        return e, e, e
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = offsets[:-1][offsets[:-1] < n]
    begins[firsts] = inside[firsts]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    lasts = offsets[1:][offsets[1:] > 0] - 1
    ends[lasts] = inside[lasts]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def words(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+``: start, end, text index."""
    return runs(~SPACE[buf], offsets)


def lines(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pieces between newlines, empty ones included: start, end, text index."""
    cuts = np.flatnonzero(buf == 10)
    owner = np.searchsorted(offsets, cuts, "right") - 1
    start = np.concatenate([offsets[:-1], cuts + 1])
    end = np.concatenate([cuts, offsets[1:]])
    text = np.concatenate([np.arange(len(offsets) - 1), owner])
    a = np.lexsort((start, text))
    b = np.lexsort((end, np.concatenate([owner, np.arange(len(offsets) - 1)])))
    return start[a], end[b], text[a]


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte span."""
    n = len(buf)
    p, q = _power_table(n)
    prefix = np.zeros(n + 1, U64)
    np.cumsum(_BYTE[buf] * p[:n], out=prefix[1:])
    return mix((prefix[end] - prefix[start]) * q[start] + (end - start).astype(U64))


def windows(h: np.ndarray, text: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each k consecutive items of one text, and the index of its first item."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    first = np.flatnonzero(text[:n] == text[k - 1:])
    out = np.zeros(len(first), U64)
    for j in range(k):
        out = out * U64(_BASE) + h[first + j]
    return mix(out), first


def covered(first: np.ndarray, k: int, n: int) -> np.ndarray:
    """True for the items 0..n-1 inside any window [first, first + k)."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, first + k, -1)
    return np.cumsum(edge[:-1]) > 0


def groups_of_bytes(sizes, limit: int = BATCH_BYTES):
    """Slices [i, j) of consecutive rows, each of about ``limit`` bytes or one row."""
    i, total = 0, 0
    for j, s in enumerate(sizes):
        if total and total + s > limit:
            yield i, j
            i, total = j, 0
        total += s
    if i < len(sizes):
        yield i, len(sizes)
