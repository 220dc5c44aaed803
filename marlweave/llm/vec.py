"""Whole batches of texts as numpy arrays: words, word hashes and hashes of word sequences.

A word is a run of letters or digits of the lower-cased text (str.isalnum on each code point). All hashes are 64 bits
and the same in every process.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np

#: Multipliers of the 64-bit finalizer and the odd base of the polynomial hash.
MIX_A, MIX_B, BASE = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15
CHUNK = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(MIX_A)
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX_B)
    x ^= x >> np.uint64(31)
    return x


@cache
def alnum() -> np.ndarray:
    """Whether a code point is a letter or digit."""
    return np.fromiter((chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = pow(BASE, -1, 1 << 64)
    out = []
    for b in (BASE, inverse):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by a line feed, and the place where each text starts (and the end)."""
    ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
    data = np.frombuffer(("\n".join(texts) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32) if texts else np.empty(0, np.uint32)
    return data, np.concatenate([[0], ends]).astype(np.int64)


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of codes[start:end] for each span; the spans ascend and don't overlap."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        lo = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, lo + CHUNK, "right")))
        hi = int(ends[to - 1])
        size = 1 << max(10, int(hi - lo).bit_length())
        power, inverse = _powers(size)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((codes[lo:hi].astype(np.uint64) + np.uint64(1)) * power[: hi - lo], out=sums[1:])
        s, e = starts[at:to] - lo, ends[at:to] - lo
        out[at:to] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64))
        at = to
    return out


@dataclass
class Words:
    """The words of a batch: hash, text number and place (code points of the lower-cased batch)."""

    hashes: np.ndarray
    doc: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each text, the number of its first word; one more entry for the end

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of n consecutive words of one text, and the number of the first word of each."""
        m = len(self.hashes) - n + 1
        if m <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        at = np.flatnonzero(self.doc[:m] == self.doc[n - 1 :])
        h = np.zeros(m, np.uint64)
        for i in range(n):
            h *= np.uint64(BASE)
            h += self.hashes[i : i + m]
        return mix(h[at]), at


def words(texts: list[str]) -> Words:
    """The words of all texts. None counts as an empty text."""
    lowered = [t.lower() if t else "" for t in texts]
    codes, offsets = points(lowered)
    inside = alnum()[codes] if len(codes) else np.empty(0, bool)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    first = np.searchsorted(starts, offsets)
    doc = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(span_hashes(codes, starts, ends), doc, starts, ends, first)


def batches(texts: list[str], chars: int = 4_000_000):
    """Slices of a list of texts of about so many characters, so that long texts don't fill the memory."""
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= chars:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)
