"""Token ids of texts with a public byte-level tokenizer, one call for all new pieces of a batch.

Before its merges the tokenizer cuts a text at white space: of a run of white
space all but the last character stand alone, and the last one belongs to the
word that follows if it is a space. It also cuts where letters or digits end.
The same cuts are made here on the flat bytes, the latter only before ASCII
marks other than the apostrophe, and every different piece is encoded once. Texts with white space
outside ASCII, control separators or the mark of a special token go to the
tokenizer whole. Both ways give the ids that the tokenizer gives for the text.

Pieces are told apart by a 64-bit hash that includes their length.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

from cardfeat.llm.flat import Flat, distinct, slices

#: What keeps pieces from being encoded together.
_INNER = re.compile(r"\s")
#: Runs of Latin letters, with a space before or not: they are split no further before the merges.
_LETTERS = re.compile(r" ?[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+").fullmatch
#: Pieces that are remembered, some 40 bytes each; when there are more, those seen once are forgotten.
REMEMBERED = 1_500_000
#: Pieces that the tokenizer gets as one text.
_TOGETHER = 2048

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[b for b in range(0x21, 0x7F) if not _ALNUM[b] and b != 0x27]] = True
#: Second bytes of the Latin letters whose first byte is C3.
_LATIN = np.zeros(256, dtype=bool)
_LATIN[[b for b in range(0x80, 0xC0) if b not in (0x97, 0xB7)]] = True
#: Lead bytes of white space outside ASCII, and the ASCII separators that some libraries take for it.
_WIDE = np.zeros(256, dtype=bool)
_WIDE[[0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3]] = True
_WIDE_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def _byte_letters() -> dict[int, str]:
    """The visible character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the others for those from U+0100 on, in order.
    """
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {**{b: chr(b) for b in visible}, **{b: chr(0x100 + k) for k, b in enumerate(hidden)}}


def whole_texts(part: Flat) -> np.ndarray:
    """The texts that are not cut into pieces here."""
    raw = part.data.tobytes()
    found = set()
    if b"<|" in raw:
        found.update(t for t in range(len(part)) if b"<|" in raw[part.offsets[t] : part.offsets[t + 1]])
    wide = np.flatnonzero(_WIDE[part.data])
    if len(wide):
        for t in np.unique(np.searchsorted(part.offsets, wide, side="right") - 1).tolist():
            if _WIDE_SPACE.search(raw[part.offsets[t] : part.offsets[t + 1]].decode("utf-8", "replace")):
                found.add(t)
    return np.array(sorted(found), dtype=np.int64)


def cuts(part: Flat) -> np.ndarray:
    """Where the pieces of the texts begin."""
    n = len(part.data)
    if not n:
        return np.zeros(0, np.int64)
    space = _SPACE[part.data]
    first = np.zeros(n + 1, dtype=bool)
    first[part.offsets] = True
    first, last = first[:-1], first[1:]
    before = np.concatenate(([False], space[:-1])) & ~first
    after = np.concatenate((space[1:], [False])) | last
    blank = np.concatenate(([False], part.data[:-1] == 32))
    begin = first | (space & ~before) | (space & ~after) | (~space & before & ~blank)
    word = _ALNUM[part.data]
    word[1:] |= _LATIN[part.data[1:]] & (part.data[:-1] == 0xC3)
    begin[1:] |= _MARK[part.data[1:]] & word[:-1]
    return np.flatnonzero(begin)


class Encoder:
    """Encodes texts to arrays of ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        # the same model for pieces that need no splitting and are spelled in its letters
        self.merger = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.merger.pre_tokenizer = pre_tokenizers.Split(self.letters[10], "isolated")
        self.line_break = self._whole(["\n"])[0][0]
        self.known = np.zeros(0, dtype=np.uint64)  # sorted hashes of pieces
        self.begins = np.zeros(0, dtype=np.int64)
        self.sizes = np.zeros(0, dtype=np.int64)
        self.seen = np.zeros(0, dtype=bool)  # in more than one batch
        self.ids = np.zeros(0, dtype=np.int32)

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _cut(self, ids: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and sizes of pieces between line breaks."""
        found = np.array(ids, dtype=np.int32)
        at = np.flatnonzero(found == self.line_break)
        return found[found != self.line_break], np.diff(np.concatenate(([-1], at, [len(found)]))) - 1

    def _runs(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces that are runs of letters."""
        spelled = "\n".join(pieces).encode().decode("latin-1").translate(self.letters)
        return self._cut(self.merger.encode_batch_fast([spelled], add_special_tokens=False)[0].ids)

    def _together(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Pieces without inner white space: a line break between two is a token of its own."""
        ids, sizes = self._cut(self._whole(["\n".join(pieces)])[0])
        return (ids, sizes) if len(sizes) == len(pieces) else self._apart(pieces)

    def _apart(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self._whole(pieces)
        return np.array([i for f in found for i in f], dtype=np.int32), np.array([len(f) for f in found], dtype=np.int64)

    def _learn(self, pieces: list[str], hashes: np.ndarray) -> None:
        """Encode pieces not seen before and remember them."""
        kinds = ([], [], [])
        for k, p in enumerate(pieces):
            kinds[0 if _LETTERS(p) else 2 if len(p) < 2 or p[0] in "\t\n\r\x0b\x0c" or _INNER.search(p, 1) else 1].append(k)
        ids, sizes, order = [self.ids], [], []
        for encode, some in zip((self._runs, self._together, self._apart), kinds):
            for at in range(0, len(some), _TOGETHER):
                i, n = encode([pieces[k] for k in some[at : at + _TOGETHER]])
                ids.append(i)
                sizes.append(n)
            order.extend(some)
        sizes = np.concatenate(sizes)
        begins = len(self.ids) + np.cumsum(sizes) - sizes
        self.ids = np.concatenate(ids)
        known = np.concatenate((self.known, hashes[order]))
        by = np.argsort(known, kind="stable")
        self.known = known[by]
        self.begins = np.concatenate((self.begins, begins))[by]
        self.sizes = np.concatenate((self.sizes, sizes))[by]
        self.seen = np.concatenate((self.seen, np.zeros(len(sizes), dtype=bool)))[by]

    def _forget(self) -> None:
        """Keep the pieces that were seen again, unless these are too many as well."""
        keep = self.seen if self.seen.sum() <= REMEMBERED // 2 else np.zeros(len(self.seen), dtype=bool)
        begins, sizes = self.begins[keep], self.sizes[keep]
        ends = np.cumsum(sizes)
        self.ids = self.ids[np.arange(sizes.sum()) + np.repeat(begins - ends + sizes, sizes)]
        self.known, self.begins, self.sizes = self.known[keep], ends - sizes, sizes
        self.seen = np.zeros(len(sizes), dtype=bool)

    def encode(self, part: Flat) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin (one offset more than texts)."""
        if len(self.known) > REMEMBERED:
            self._forget()
        starts = cuts(part)
        ends = np.concatenate((starts[1:], [len(part.data)])).astype(np.int64)
        whole = whole_texts(part)
        text = np.searchsorted(part.offsets, starts, side="right") - 1
        if len(whole):
            cut = ~np.isin(text, whole)
            starts, ends, text = starts[cut], ends[cut], text[cut]
        hashes, one, at = distinct(part.hashes(starts, ends))
        place = np.searchsorted(self.known, hashes)
        old = np.zeros(len(hashes), dtype=bool)
        inside = place < len(self.known)
        old[inside] = self.known[place[inside]] == hashes[inside]
        self.seen[place[old]] = True
        if not old.all():
            raw = part.data.tobytes()
            new = one[~old]
            self._learn([raw[a:b].decode() for a, b in zip(starts[new].tolist(), ends[new].tolist())], hashes[~old])
            place = np.searchsorted(self.known, hashes)
        begins, sizes = self.begins[place][at], self.sizes[place][at]
        total = np.cumsum(sizes)
        ids = self.ids[np.arange(total[-1] if len(total) else 0) + np.repeat(begins - total + sizes, sizes)]
        counts = np.bincount(text, weights=sizes, minlength=len(part)).astype(np.int64)
        if len(whole):
            raw = part.data.tobytes()
            found = self._whole([raw[part.offsets[t] : part.offsets[t + 1]].decode() for t in whole.tolist()])
            offsets = np.concatenate(([0], np.cumsum(counts)))
            ids = np.insert(ids, np.repeat(offsets[whole], [len(f) for f in found]), [i for f in found for i in f])
            counts[whole] = [len(f) for f in found]
        return ids, np.concatenate(([0], np.cumsum(counts)))

    def encode_column(self, texts: pa.Array):
        """Runs of consecutive texts: number of the first, ids and offsets."""
        for first, part in slices(texts):
            yield first, *self.encode(part)
