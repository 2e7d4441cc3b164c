"""The same results by the plainest means, for small tables."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import xxhash
from tokenizers import Tokenizer

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LETTERED = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def table(sf_dir: str, name: str, columns: str) -> list[tuple]:
    return duckdb.connect().execute(f"SELECT {columns} FROM '{sf_dir}/{name}.parquet'").fetchall()


def low(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def base_spans(text: str | None) -> list[tuple[str, int, int]]:
    word = "|".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token", "api_key", "apikey"))
    found = [("assign", m) for m in re.finditer(rf"""({word})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text or "") if len(m[2]) >= 12]
    found += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 18]
    found += [("hex", m) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 16]
    order = ("assign", "access", "hex")
    return sorted(((k, m.start(), m.end()) for k, m in found), key=lambda s: (s[1], order.index(s[0])))


def fingerprint(text: str | None) -> int:
    w = SPACED.findall(low(text))
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) > 3 else [" ".join(w)] if w else []
    h = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], dtype=np.uint64)
    return sum(1 << b for b in range(64) if len(h) and 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h))


def components(prints: list[int], radius: int = 4) -> list[int]:
    """A component number for each fingerprint."""
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i in range(len(prints)):
            for j in range(i):
                if (prints[i] ^ prints[j]).bit_count() <= radius and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return label


def contamination(docs: list[tuple], items: list[tuple]) -> dict:
    windows: dict[tuple, set[str]] = {}
    for i, text in items:
        w = LETTERED.findall(low(text))
        n = min(13, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[p : p + n]), set()).add("" if i is None else str(i))
    sizes = {len(k) for k in windows}
    out = {}
    for i, text in docs:
        w = LETTERED.findall(low(text))
        hit, found = set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                if owners := windows.get(tuple(w[p : p + n])):
                    found |= owners
                    hit |= set(range(p, p + n))
        out[i] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), len(hit) > 0 and 20 * len(hit) >= len(w))
    return out


def longest_match(text: str | None, items: list[tuple]) -> tuple[int, str | None, int | None, int | None]:
    """Words of the longest match of a window or more, its item, and its first words in item and document."""
    w = LETTERED.findall(low(text))
    best = (0, None, None, None)
    for i, item in items:
        x = LETTERED.findall(low(item))
        n = min(13, len(x))
        places: dict[tuple, list[int]] = {}
        for q in range(len(x) - n + 1 if n else 0):
            places.setdefault(tuple(x[q : q + n]), []).append(q)
        for p in range(len(w) - n + 1 if n else 0):
            for q in places.get(tuple(w[p : p + n]), ()):
                size = n
                while p + size < len(w) and q + size < len(x) and w[p + size] == x[q + size]:
                    size += 1
                found = (size, "" if i is None else str(i), q, p)
                if best[1] is None or (-found[0], *found[1:]) < (-best[0], *best[1:]):
                    best = found
    return best


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    w = SPACED.findall(text)
    seen: set[str] = set()
    twice = 0
    for line in text.split("\n"):
        if SPACED.search(line):
            twice += line in seen
            seen.add(line)
    found = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if found[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), twice, len(covered)


def remaining_lines(docs: list[tuple], min_words: int = 50) -> list[tuple[str, int, int]]:
    """Text, lines and deleted lines of documents in their order."""
    split = [(t or "").split("\n") for _, t in docs]
    keys = [[line.strip(" \t\n\r\x0b\x0c") for line in ls] for ls in split]
    sizes = [[len(SPACED.findall(line)) for line in ls] for ls in split]

    def windows(k):
        for a in range(len(split[k])):
            total = 0
            for b in range(a, len(split[k])) if sizes[k][a] else ():
                total += sizes[k][b]
                if total >= min_words:
                    yield a, b
                    break

    first: dict[tuple, tuple[int, int, int]] = {}
    for k in range(len(docs)):
        for a, b in windows(k):
            first.setdefault(tuple(keys[k][a : b + 1]), (k, a, b))
    out = []
    for k in range(len(docs)):
        gone = set()
        for a, b in windows(k):
            k0, a0, b0 = first[tuple(keys[k][a : b + 1])]
            if (k0, a0) == (k, a):
                continue
            more = total = 0
            while b + more + 1 < len(keys[k]) and b0 + more + 1 < len(keys[k0]) and keys[k][b + more + 1] == keys[k0][b0 + more + 1]:
                total += sizes[k][b + more + 1]
                if total >= min_words:
                    break
                more += 1
            gone |= set(range(a, b + more + 1))
        out.append(("\n".join(line for n, line in enumerate(split[k]) if n not in gone), len(split[k]), len(gone)))
    return out


def token_places(docs: list[tuple]) -> list[tuple[int, int, int, int]]:
    """Id, place, number of ids and checksum of documents in their order."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    out, start = [], 0
    for (i, _), e in zip(docs, tokenizer.encode_batch([t or "" for _, t in docs], add_special_tokens=False)):
        ids = np.array([*e.ids, 0], dtype="<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out
