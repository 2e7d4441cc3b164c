"""Words and hashes of whole Arrow text columns, computed on their flat bytes.

A column of strings is one byte buffer with offsets. Word borders, per-document
counts and 64-bit hashes come from a few numpy passes over that buffer, without
a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that one numpy pass takes; a longer document gets a pass of its own.
SLICE_BYTES = 2 << 20

#: `[^\x20\x09-\x0D]`: every byte but ASCII white space.
SPACED = np.ones(256, dtype=bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False

#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` after lower-casing: digits, a-z and all bytes above ASCII.
LETTERED = np.zeros(256, dtype=bool)
LETTERED[0x30:0x3A] = True
LETTERED[0x61:0x7B] = True
LETTERED[0x80:] = True

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """Powers 0..n-1 of ``base`` modulo 2**64, kept while they do not get too long."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        known = np.full(max(n, 1), base, dtype=np.uint64)
        known[0] = 1
        np.multiply.accumulate(known, out=known)
        if n <= 4 * SLICE_BYTES:
            _powers[base] = known
    return known[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every bit depends on all others."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def join(*parts: np.ndarray) -> np.ndarray:
    """One hash of several, in order."""
    total = np.zeros(len(parts[0]), dtype=np.uint64)
    for p in parts:
        total = mix(total * np.uint64(_BASE) + p + np.uint64(1))
    return total


@dataclass
class Flat:
    """Consecutive texts: their bytes and where each begins (one offset more than texts)."""

    data: np.ndarray
    offsets: np.ndarray
    _sums: np.ndarray | None = None  #: running sums that hashes of byte ranges are taken from

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def per_text(self, positions: np.ndarray) -> np.ndarray:
        """How many of the sorted byte positions lie in each text."""
        return np.diff(np.searchsorted(positions, self.offsets))

    def spans(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of marked bytes that do not cross texts: starts, ends, first run of each text."""
        n = len(self.data)
        edge = np.zeros(n + 1, dtype=bool)
        edge[self.offsets] = True
        before = np.concatenate(([False], inside[:-1])) if n else inside
        after = np.concatenate((inside[1:], [False])) if n else inside
        starts = np.flatnonzero(inside & (~before | edge[:-1]))
        ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A 64-bit hash of each byte range."""
        if self._sums is None:
            terms = (self.data.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(self.data))
            self._sums = np.zeros(len(self.data) + 1, dtype=np.uint64)
            np.cumsum(terms, out=self._sums[1:])
        sums = self._sums
        raw = (sums[ends] - sums[starts]) * _power(_INVERSE, len(self.data) + 1)[starts]
        return mix(raw + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def flat(texts: pa.Array) -> Flat:
    """The bytes of a string column; null counts as empty."""
    if pa.types.is_null(texts.type):
        texts = texts.cast(pa.string())
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    size = np.int64 if wide else np.int32
    _, offsets, data = texts.buffers()
    if not len(texts):
        return Flat(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    at = np.frombuffer(offsets, dtype=size)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or at[-1] == at[0]:
        return Flat(np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64))
    return Flat(np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0])


def plain(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, Flat]]:
    """Cut a text column into runs of whole texts of at most ``limit`` bytes (or one longer text)."""
    whole = flat(texts)
    first = 0
    while first < len(whole):
        last = int(np.searchsorted(whole.offsets, whole.offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(whole))
        at = whole.offsets[first : last + 1]
        yield first, Flat(whole.data[at[0] : at[-1]], at - at[0])
        first = last


@dataclass
class Words:
    """Words of a run of texts: byte ranges, hashes, and the first word of each text."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def lowered(part: Flat) -> Flat:
    """The texts with A-Z in lower case."""
    return Flat(LOWER[part.data], part.offsets)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted different keys, a place where each occurs, and the number of each key's place among them."""
    order = np.argsort(keys)
    found = keys[order]
    fresh = np.concatenate(([True], found[1:] != found[:-1])) if len(keys) else np.zeros(0, dtype=bool)
    number = np.empty(len(keys), dtype=np.int64)
    number[order] = np.cumsum(fresh) - 1
    return found[fresh], order[fresh], number


def words(part: Flat, kind: np.ndarray = SPACED, lower: bool = False) -> Words:
    if lower:
        part = lowered(part)
    starts, ends, first = part.spans(kind[part.data])
    return Words(starts, ends, part.hashes(starts, ends), first)


def windows(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words within one text, and the position of their first word."""
    n = len(w.hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    text = w.text
    at = np.flatnonzero(text[:n] == text[size - 1 :])
    return join(*(w.hashes[at + k] for k in range(size))), at


def sum_per_text(flags: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``flags`` between consecutive entries of ``first``."""
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[first[1:]] - sums[first[:-1]]
