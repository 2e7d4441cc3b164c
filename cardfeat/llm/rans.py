"""Static range asymmetric numeral system over token ids, in interleaved lanes.

A block holds the ids of whole documents. Id number ``i`` belongs to lane
``i % lanes``; all lanes share one frequency table and one stream of 32-bit
words. Coding runs backwards, so that decoding runs forwards. Every ``every``
steps a checkpoint keeps the states of all lanes and the place in the stream,
from where decoding can start on its own, and a checksum of the ids up to the
next one. The block ends with a checksum of its bytes.

Layout, little-endian: magic, lanes, every, ids, documents, checkpoints, words
(4-byte numbers); document ids (8 bytes; those without id marked in a bit
map); ids per document (4); per checkpoint its word place (4) and checksum (4),
then the states (8 each lane); the words (4); the checksum (4).
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

MAGIC = b"cfr1"
#: Frequencies add up to two to this power; it must leave a place for every id that occurs.
SCALE = 20
LANES = 1024
#: Steps of all lanes between two checkpoints.
EVERY = 128
_LOW = np.uint64(1 << 31)
_HEAD = struct.Struct("<4s6I")


class CorruptBlock(ValueError):
    """A checksum does not fit."""


@dataclass
class Table:
    """Frequencies of ids that add up to ``2 ** SCALE``."""

    freq: np.ndarray

    def __post_init__(self):
        self.freq = self.freq.astype(np.uint64)
        self.cum = np.cumsum(self.freq) - self.freq
        self._symbols = None

    @property
    def symbols(self) -> np.ndarray:
        """The id of every slot."""
        if self._symbols is None:
            self._symbols = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._symbols

    def to_bytes(self) -> bytes:
        return zlib.compress(self.freq.astype("<u4").tobytes())

    @classmethod
    def from_bytes(cls, raw: bytes) -> Table:
        return cls(np.frombuffer(zlib.decompress(raw), dtype="<u4"))


def table(counts: np.ndarray) -> Table:
    """A table from the counts of all ids; each id that occurs gets one slot at least."""
    total = 1 << SCALE
    counts = counts.astype(np.int64)
    used = np.flatnonzero(counts)
    freq = np.zeros(len(counts), dtype=np.int64)
    if not len(used):
        return Table(freq)
    if len(used) > total:
        raise ValueError(f"{len(used)} different ids need a scale above {SCALE}")
    share = counts[used] / counts[used].sum() * (total - len(used))
    parts = np.floor(share).astype(np.int64)
    rest = total - len(used) - int(parts.sum())
    parts[np.argsort(parts - share, kind="stable")[:rest]] += 1
    freq[used] = parts + 1
    return Table(freq)


def encode(docs: list[int | None], sizes: list[int], ids: np.ndarray, t: Table) -> bytes:
    """One block of whole documents."""
    n = len(ids)
    lanes = min(LANES, max(1, n // 64))
    steps = -(-n // lanes)
    freq, cum = t.freq, t.cum
    state = np.full(lanes, _LOW, dtype=np.uint64)
    words: list[np.ndarray] = []
    points: list[tuple[int, int, np.ndarray]] = []
    written = 0
    for step in range(steps - 1, -1, -1):
        some = ids[step * lanes : (step + 1) * lanes]
        x = state[: len(some)]
        f = freq[some]
        full = x >= f << np.uint64(63 - SCALE)
        if full.any():
            out = (x[full] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            words.append(out)
            written += len(out)
            x[full] >>= np.uint64(32)
        d, m = np.divmod(x, f)
        state[: len(some)] = (d << np.uint64(SCALE)) + m + cum[some]
        if step % EVERY == 0:
            crc = zlib.crc32(ids[step * lanes : (step + EVERY) * lanes].astype("<u4").tobytes())
            points.append((written, crc, state.copy()))
    points.reverse()
    missing = np.array([d is None for d in docs], dtype=bool)
    out = [
        _HEAD.pack(MAGIC, lanes, EVERY, n, len(docs), len(points), written),
        np.array([d or 0 for d in docs], dtype="<i8").tobytes(),
        np.packbits(missing).tobytes(),
        np.array(sizes, dtype="<u4").tobytes(),
        np.array([[written - w, c] for w, c, _ in points], dtype="<u4").tobytes(),
        *(s.astype("<u8").tobytes() for _, _, s in points),
        *(w.astype("<u4").tobytes() for w in reversed(words)),
    ]
    body = b"".join(out)
    return body + struct.pack("<I", zlib.crc32(body))


@dataclass
class Block:
    """A parsed block, not decoded yet."""

    docs: list[int | None]
    sizes: np.ndarray
    lanes: int
    every: int
    n: int
    points: np.ndarray
    states: np.ndarray
    words: np.ndarray


def parse(raw: bytes) -> Block:
    if len(raw) < _HEAD.size + 4 or raw[:4] != MAGIC:
        raise CorruptBlock("not a block")
    if zlib.crc32(raw[:-4]) != struct.unpack("<I", raw[-4:])[0]:
        raise CorruptBlock("checksum of the block")
    _, lanes, every, n, docs, points, words = _HEAD.unpack_from(raw)
    at = _HEAD.size

    def take(kind: str, count: int) -> np.ndarray:
        nonlocal at
        found = np.frombuffer(raw, dtype=kind, count=count, offset=at)
        at += found.nbytes
        return found

    ids = take("<i8", docs).tolist()
    missing = np.unpackbits(take("u1", -(-docs // 8)))[:docs].tolist()
    return Block(
        [None if m else d for d, m in zip(ids, missing)],
        take("<u4", docs).astype(np.int64),
        lanes,
        every,
        n,
        take("<u4", 2 * points).reshape(-1, 2),
        take("<u8", points * lanes).reshape(points, lanes),
        take("<u4", words),
    )


def decode_segment(b: Block, number: int, t: Table) -> np.ndarray:
    """The ids between checkpoint ``number`` and the next; needs nothing of other segments."""
    x = b.states[number].astype(np.uint64)
    place = int(b.points[number, 0])
    first = number * b.every * b.lanes
    ids = np.empty(min(b.n - first, b.every * b.lanes), dtype=np.uint32)
    freq, cum, symbols, words = t.freq, t.cum, t.symbols, b.words
    low, scale = np.uint64((1 << SCALE) - 1), np.uint64(SCALE)
    for at in range(0, len(ids), b.lanes):
        live = min(b.lanes, len(ids) - at)
        y = x[:live]
        slot = y & low
        s = symbols[slot]
        ids[at : at + live] = s
        y = freq[s] * (y >> scale) + slot - cum[s]
        short = np.flatnonzero(y < _LOW)
        if len(short):
            y[short] = (y[short] << np.uint64(32)) | words[place : place + len(short)].astype(np.uint64)
            place += len(short)
        x[:live] = y
    if zlib.crc32(ids.astype("<u4").tobytes()) != b.points[number, 1]:
        raise CorruptBlock(f"checksum of segment {number}")
    return ids


def decode(raw: bytes, t: Table) -> tuple[Block, np.ndarray]:
    """A block and all its ids."""
    b = parse(raw)
    parts = [decode_segment(b, k, t) for k in range(len(b.points))]
    return b, np.concatenate(parts) if parts else np.zeros(0, np.uint32)
