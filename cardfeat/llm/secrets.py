"""Secret scan: keyword automaton, anchored patterns near its hits, checksums.

One Aho-Corasick pass over the text in ASCII lower case finds keywords; only
where one begins is the pattern of its kind tried, anchored at that place.
Tokens that carry a checksum are reported only if it fits. Runs of hexadecimal
digits have no keyword; one linear pass over the text finds them.

Matches of a kind are leftmost and do not overlap; one that is too short still
takes its place. Spans are code points, end exclusive. Null texts count as
empty; rows are scanned one by one, so repeated rows get equal results. An
empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardfeat.llm.tables import small_batches

#: Kinds in the order in which spans that begin together are listed.
KINDS = ("assign", "access", "hex", "github", "npm")
BASE_KINDS = KINDS[:3]

_ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")
_CHECKED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{36})(?![A-Za-z0-9])")

#: Shortest value of an assignment, shortest access key.
MIN_VALUE, MIN_ACCESS = 12, 18

# Keywords in lower case by kind, and the digits of checksums in base 62.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "api_key", "apikey"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_automaton: list[ahocorasick.Automaton] = []


def keywords() -> ahocorasick.Automaton:
    """The automaton of all keywords, built once in a process; values are (kind, length)."""
    if not _automaton:
        made = ahocorasick.Automaton()
        for kind, some in KEYWORDS.items():
            for word in some:
                made.add_word(word, (kind, len(word)))
        made.make_automaton()
        _automaton.append(made)
    return _automaton[0]


def checksum_fits(body: str) -> bool:
    """Whether the last six of 36 characters are the CRC-32 of the others in base 62."""
    value, digits = zlib.crc32(body[:30].encode("ascii")), []
    for _ in range(6):
        value, d = divmod(value, 62)
        digits.append(BASE62[d])
    return "".join(reversed(digits)) == body[30:]


def _match(kind: str, text: str, at: int) -> tuple[int, bool] | None:
    """End of the kind's match at that place and whether it counts."""
    if kind == "assign":
        m = _ASSIGN.match(text, at)
        return m and (m.end(), len(m[2]) >= MIN_VALUE)
    if kind == "access":
        m = _ACCESS.match(text, at)
        return m and (m.end(), m.end() - at >= MIN_ACCESS)
    m = _CHECKED.match(text, at)
    return m and (m.end(), checksum_fits(m[1]))


def spans(text: str | None) -> list[tuple[str, int, int]]:
    """All secrets of a text: kind, start, end, in the order of starts and kinds."""
    if not text:
        return []
    lower = text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    found = []
    taken = dict.fromkeys(KEYWORDS, 0)
    hits = sorted({(end - size + 1, kind) for end, (kind, size) in keywords().iter(lower)})
    for at, kind in hits:
        if at >= taken[kind] and (m := _match(kind, text, at)):
            taken[kind] = m[0]
            if m[1]:
                found.append((kind, at, m[0]))
    found.extend(("hex", m.start(), m.end()) for m in _HEX.finditer(text))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document with its secrets, a list of (kind, start, end, value)."""
    item = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch.column(1):
                t = value.as_py()
                out.append([{"kind": k, "start": a, "end": b, "value": t[a:b]} for k, a, b in spans(t)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(item))], ["doc_id", "found"])

    schema = "doc_id bigint, found array<struct<kind: string, start: int, end: int, value: string>>"
    rows = small_batches(docs).select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(scan, schema)


def digest(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the hash of the base spans and all spans as text."""

    def of(*kinds: str):
        return F.filter("found", lambda s: s["kind"].isin(*kinds))

    def shown(some):
        return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select(
        "doc_id",
        *(F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(shown(of(*BASE_KINDS)).cast("binary"), 256).alias("base_sha256"),
        shown(F.col("found")).alias("spans"),
    )


def redacted(docs: DataFrame, key: str = "doc_id", text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The documents with every secret replaced by ``mark``; other columns stay as they are."""

    @F.udf("string", useArrow=True)
    def clean(value: str | None) -> str | None:
        if value is None:
            return None
        out, last = [], 0
        for _, a, b in spans(value):
            if b > last:
                if a >= last:
                    out += [value[last:a], mark]
                last = b
        return "".join([*out, value[last:]])

    return docs.withColumn(text, clean(F.col(text)))
