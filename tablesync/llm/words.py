"""Words and word n-grams as 64-bit fingerprints, whole columns of text at a time.

A word is ``[^\\x20\\x09-\\x0D]+`` over the UTF-8 bytes, which is the same as over code points. A word's
fingerprint is a polynomial over random byte values modulo 2**64, mixed at the end; among n distinct words
two share one with a probability of about n**2 / 2**65.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np

CHUNK = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(4)
def _values(lower: bool) -> np.ndarray:
    v = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
    if lower:
        v[65:91] = v[97:123]
    return v


@lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    up = np.cumprod(np.full(CHUNK + 1, BASE, np.uint64)) * np.uint64(pow(BASE, -1, 1 << 64))
    down = np.cumprod(np.full(CHUNK + 1, pow(BASE, -1, 1 << 64), np.uint64)) * np.uint64(BASE)
    return up, down


class Words:
    """The words of a list of texts (bytes; None: no words).

    ``data``: all bytes, a line end after each text; ``start``, ``end``: of each word in it; ``first``: each
    text's first word, with the number of words at the end; ``doc``: each word's text.
    """

    def __init__(self, texts: list[bytes | None]):
        parts = [x or b"" for x in texts]
        self.data = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
        gap = SPACE[self.data]
        edge = np.empty(len(gap) + 1, bool)
        edge[0] = not gap[0] if len(gap) else False
        np.not_equal(gap[1:], gap[:-1], out=edge[1:-1]) if len(gap) else None
        edge[-1] = False
        at = np.flatnonzero(edge)
        self.start, self.end = at[0::2], at[1::2]
        over = np.cumsum([len(x) + 1 for x in parts])
        self.first = np.concatenate(([0], np.searchsorted(self.start, over))).astype(np.int64) if parts else np.zeros(1, np.int64)
        self.n = len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1, dtype=np.int64), self.counts)

    def hashes(self, lower: bool) -> np.ndarray:
        """Each word's fingerprint; ``lower``: A-Z count as a-z."""
        value, (up, down), out = _values(lower), _powers(), np.empty(self.n, np.uint64)
        k = 0
        while k < self.n:
            s = self.start[k]
            e = int(np.searchsorted(self.end, s + CHUNK, "right"))
            if e <= k or self.end[k] - s > CHUNK // 2:
                word = self.data[s : self.end[k]].tobytes()
                out[k] = int.from_bytes(hashlib.blake2b((word.lower() if lower else word), digest_size=8).digest(), "little")
                k += 1
                continue
            long = np.flatnonzero(self.end[k:e] - self.start[k:e] > CHUNK // 2)
            e = k + int(long[0]) if len(long) else e
            total = np.zeros(self.end[e - 1] - s + 1, np.uint64)
            np.cumsum(value[self.data[s : self.end[e - 1]]] * up[: len(total) - 1], out=total[1:])
            a, b = self.start[k:e] - s, self.end[k:e] - s
            out[k:e] = (total[b] - total[a]) * down[a]
            k = e
        return mix(out)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Fingerprints of all runs of ``n`` neighbouring words, across texts too (len(h) - n + 1 of them)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    out, have, q = np.zeros(len(h) - n + 1, np.uint64), 0, 0xA0761D6478BD642F | 1
    span, width = h, 1
    while n:
        if n & 1:
            out += span[have : have + len(out)] * np.uint64(pow(q, have, 1 << 64))
            have += width
        n >>= 1
        if n:
            span = span[: len(span) - width] + span[width:] * np.uint64(pow(q, width, 1 << 64))
            width *= 2
    return mix(out)


def inside(first: np.ndarray, n: int) -> np.ndarray:
    """Of the runs that ``grams`` returns, the places of those that lie in one text."""
    counts = np.diff(first)
    many = np.maximum(counts - n + 1, 0)
    if not many.sum():
        return np.zeros(0, np.int64)
    begin = np.repeat(first[:-1] - np.concatenate(([0], np.cumsum(many)[:-1])), many)
    return begin + np.arange(many.sum())
