"""Vectorised words over Arrow batches of UTF-8 texts.

A batch's texts lie back to back in one buffer; words are found and hashed
with array operations over pieces of about ``CHUNK`` bytes, so memory stays
near 60 bytes per byte of the largest piece (a piece holds at least one whole
text, whatever its length).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20

U64 = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _random64(n: int, seed: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, n, dtype=U64)


_BYTE = _random64(256, 11)
_BYTE[_SPACE] = 0
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_BASE = 0x9E3779B97F4A7C15 | 3  # odd, 3 modulo 4


@lru_cache(maxsize=4)
def _powers(n: int) -> np.ndarray:
    p = np.full(n, _BASE, U64)
    p[0] = 1
    return np.cumprod(p, dtype=U64)


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (each input bit reaches each output bit)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


@dataclass
class Words:
    """Words of the texts lo..hi of a batch, in order."""

    lo: int
    hi: int
    data: np.ndarray      # the piece's bytes
    offsets: np.ndarray   # of texts within data, hi - lo + 1 of them
    start: np.ndarray     # of words within data
    end: np.ndarray
    first: np.ndarray     # index of each text's first word, hi - lo + 1 of them

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def doc(self) -> np.ndarray:
        """Text number (from 0 in this piece) of each word."""
        return np.repeat(np.arange(self.hi - self.lo), self.count())

    def hashes(self, lower: bool = False, prefix: int = 0) -> np.ndarray:
        """A 64-bit hash of each word, or of its first ``prefix`` bytes; with ``lower``, A-Z count as a-z."""
        n, size = len(self.start), len(self.data)
        if not n:
            return np.zeros(0, U64)
        length = self.end - self.start
        # a segment runs up to the next word; what lies between adds 0
        rel = np.arange(size) - np.repeat(np.append(0, self.start), np.diff(np.append(np.append(0, self.start), size)))
        values = (_BYTE_LOWER if lower else _BYTE)[self.data]
        if prefix:
            values[rel >= prefix] = 0
            length = np.minimum(length, prefix)
        longest = 1 << int(length.max() - 1).bit_length()
        np.minimum(rel, longest - 1, out=rel)
        h = np.add.reduceat(values * _powers(longest)[rel], self.start)
        return mix(h + length.astype(U64) * U64(_BASE))


def pieces(texts: pa.Array, translate: np.ndarray | None = None) -> Iterator[Words]:
    """Cut a batch's texts (binary or string; null as empty) into pieces of words.

    ``translate``: a byte for each byte, applied before words are found.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = pa.types.is_large_binary(texts.type) or pa.types.is_large_string(texts.type)
    _, offs, buf = texts.buffers()
    n = len(texts)
    if not n:
        return
    off = np.frombuffer(offs, np.int64 if wide else np.int32)[texts.offset: texts.offset + n + 1].astype(np.int64)
    data = np.frombuffer(buf, np.uint8) if buf is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + CHUNK, side="right")) - 1)
        a, o = data[off[lo]: off[hi]], off[lo: hi + 1] - off[lo]
        if translate is not None:
            a = translate[a]
        inside = ~_SPACE[a]
        edge = np.zeros(len(a) + 1, bool)
        edge[o] = True
        before = np.empty(len(a), bool)
        if len(a):
            before[0] = False
            before[1:] = inside[:-1]
        start = np.flatnonzero(inside & (~before | edge[:-1]))
        after = np.empty(len(a), bool)
        if len(a):
            after[-1] = False
            after[:-1] = inside[1:]
        end = np.flatnonzero(inside & (~after | edge[1:])) + 1
        yield Words(lo, hi, a, o, start, end, np.searchsorted(start, o))
        lo = hi


def ngrams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on (len(h) - n + 1 of them).

    Windows across texts are included; callers drop them by position.
    """
    if len(h) < n:
        return np.zeros(0, U64)
    out, width = h, 1
    # doubling: a window of 2w from two windows of w
    parts, rest, at = [], n, 0
    while rest:
        if rest & 1:
            parts.append((out, at))
            at += width
        rest >>= 1
        if rest:
            out = mix(out[: len(out) - width] * U64(0xD6E8FEB86659FD93) + out[width:])
            width *= 2
    m = len(h) - n + 1
    total = np.zeros(m, U64)
    for k, (p, shift) in enumerate(parts):
        total = mix(total * U64(0xD6E8FEB86659FD93) + p[shift: shift + m] + U64(k))
    return total
