"""Removal of repeated runs of lines, found by winnowing over line hashes.

Lines are hashed without white space at their ends. A window is the shortest
run of lines from some line on that has ``min_words`` words. Its smallest line
hash (of lines with words; the first of equal ones) is its minimum, and the place
of a minimum is a fingerprint, however many windows it serves. Two places that share a
run of that many words share the windows in it, and so their fingerprints: windows whose
fingerprint stands at one place only are repeated nowhere. So texts are read twice, first
for their fingerprints, whose shared ones make a sieve of bounded size, then for the windows
that it lets through. These are joined on fingerprint and hash of the whole window, so a common line in other
surroundings meets nothing. All places but the first are
extended as far as any earlier place goes on with the same lines: along the
first place and, where that goes on otherwise, by the hashes of the longer runs,
of each of which the first place is taken. To the front a match reaches as far as
the windows before it match: if the line before agrees as well, the window that
begins there has a shared fingerprint too and is itself a repeated one.

Of every repeated run the first place, in the order of document id (null
first), text hash and line, stays; the lines of all others are deleted, also
within one document. Each deleted line keeps an earlier copy. Runs of fewer
words are left alone. Rows with equal id and text are one document and get
equal results. Null texts stay null; an empty table gives an empty result. A text's
cost grows with its lines: its runs, one at most for each line and way of
extending, are marked in one sweep.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardfeat.llm.flat import Flat, mix, slices, words
from cardfeat.llm.tables import small_batches
from cardfeat.operators.skew import broadcast_if_small
from cardfeat.session import stage

MIN_WORDS = 50
#: A sieve has 2**28 bits (32 MB) at most, in rows of as many bits as Spark's bitmaps have.
MAX_BITS, ROW_BITS = 28, 15
_BASE = 0x9E3779B97F4A7C15


def lines(part: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and number of words of every line, and the first line of each text."""
    w = words(part)
    breaks = np.flatnonzero(part.data == 10)
    of = np.searchsorted(part.offsets, breaks, side="right") - 1
    n = len(part)
    first = np.concatenate(([0], np.cumsum(part.per_text(breaks) + 1)))
    starts, ends = np.zeros(first[-1], np.int64), np.zeros(first[-1], np.int64)
    place = np.arange(len(breaks)) + of
    starts[place + 1], ends[place] = breaks + 1, breaks
    starts[first[:-1]], ends[first[1:] - 1] = part.offsets[:n], part.offsets[1:]
    a, b = np.searchsorted(w.starts, starts), np.searchsorted(w.starts, ends)
    some = b > a
    left, right = starts.copy(), starts.copy()
    left[some], right[some] = w.starts[a[some]], w.ends[b[some] - 1]
    return part.hashes(left, right), b - a, first


def _lowest(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Where the smallest hash from ``first`` to ``last`` stands, the first of equal ones."""
    best = np.arange(len(hashes))
    found = first.copy()
    length = last - first + 1
    size = 1
    while len(length) and size <= length.max():
        # ``best`` now has the place of the minimum of ``size`` hashes from each on; two such runs cover a window
        here = np.flatnonzero((length >= size) & (length < 2 * size))
        x, y = best[first[here]], best[last[here] - size + 1]
        found[here] = np.where(hashes[y] < hashes[x], y, x)
        if len(best) <= size:
            break
        x, y = best[:-size], best[size:]
        best = np.where(hashes[y] < hashes[x], y, x)
        size *= 2
    return found


@dataclass
class Runs:
    """The windows of a slice: line hashes, words up to each line's end, first and last line, and place of the minimum."""

    hashes: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    text: np.ndarray
    at: np.ndarray
    last: np.ndarray
    lowest: np.ndarray

    @property
    def fresh(self) -> np.ndarray:
        """The first window of each place of a minimum; the places never go back from one window to the next."""
        fresh = np.ones(len(self.at), dtype=bool)
        fresh[1:] = self.lowest[1:] != self.lowest[:-1]
        return fresh


def runs(part: Flat, min_words: int = MIN_WORDS) -> Runs:
    hashes, count, first = lines(part)
    text = np.repeat(np.arange(len(part)), np.diff(first))
    ends = np.cumsum(count)
    last = np.searchsorted(ends, ends - count + min_words, side="left")  # last line of each window
    at = np.flatnonzero((last < len(hashes)) & (count > 0))
    at = at[last[at] < first[text[at] + 1]]
    last = last[at]
    return Runs(hashes, ends, first, text, at, last, _lowest(np.where(count > 0, hashes, np.uint64(2**64 - 1)), at, last))


def fingerprints(part: Flat, min_words: int = MIN_WORDS) -> np.ndarray:
    """The hashes at the places of minima, each place once."""
    found = runs(part, min_words)
    return found.hashes[found.lowest[found.fresh]]


def windows(part: Flat, min_words: int = MIN_WORDS, shared: Sieve | None = None) -> dict[str, np.ndarray]:
    """Windows of a slice: text, first line, number of lines, fingerprint, hash, and longer runs.

    ``tail`` holds the hashes of the window with one, two … of the following lines, as far as these have fewer than
    ``min_words`` words together. With ``shared`` only windows whose fingerprint it lets through.
    """
    found = runs(part, min_words)
    hashes, ends, first, text, at, last = found.hashes, found.ends, found.first, found.text, found.at, found.last
    n, marks = len(hashes), hashes[found.lowest]
    if shared is not None:
        stays = shared.lets(marks)
        at, last, marks = at[stays], last[stays], marks[stays]
    power = np.full(n + 1, _BASE, dtype=np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    inverse = np.full(n + 1, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    inverse[0] = 1
    inverse = np.multiply.accumulate(inverse)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(hashes) * power[:n])))
    size = last - at + 1

    def run_hash(begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64))

    stop = np.searchsorted(ends, ends[last] + min_words, side="left")
    tail = np.minimum(stop, first[text[at] + 1]) - last - 1
    where = np.arange(tail.sum()) - np.repeat(np.cumsum(tail) - tail, tail) + np.repeat(last + 1, tail)
    return {
        "text": text[at],
        "start": at - first[text[at]],
        "size": size,
        "fingerprint": marks,
        "window": run_hash(at, last + 1),
        "tail": run_hash(np.repeat(at, tail), where + 1),
        "tail_size": tail,
    }


class Sieve:
    """Bits of hashes: lets all of them through, and few others."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def lets(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & np.uint64(8 * len(self.bits) - 1)
        return (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    @classmethod
    def of(cls, hashes: DataFrame, name: str) -> Sieve:
        """The sieve of a column of hashes: some 32 bits for each, ``MAX_BITS`` at most, set in Spark."""
        size = 1 << min(max(int(32 * hashes.count() - 1).bit_length(), ROW_BITS), MAX_BITS)
        at = F.col(name).bitwiseAND(F.lit(size - 1).cast("bigint"))
        part, bit = F.shiftright(at, ROW_BITS).alias("part"), at.bitwiseAND(F.lit((1 << ROW_BITS) - 1).cast("bigint")).alias("bit")
        bits = np.zeros((size >> ROW_BITS, 1 << (ROW_BITS - 3)), dtype=np.uint8)
        for row in hashes.select(part, bit).groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits")).collect():
            bits[row["part"]] = np.frombuffer(row["bits"], dtype=np.uint8)
        return cls(bits.ravel())


def shared_fingerprints(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Fingerprints that stand at two places or more, in one document or in several."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, part in slices(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(fingerprints(part, min_words).view(np.int64))], ["fingerprint"])

    found = docs.select("text").mapInArrow(run, "fingerprint bigint")
    return found.groupBy("fingerprint").agg(F.count("*").alias("places")).filter("places > 1").select("fingerprint")


def places(docs: DataFrame, min_words: int = MIN_WORDS, shared: Sieve | None = None) -> DataFrame:
    """Windows of all documents (``doc_id``, ``mark``, ``text``) with their fingerprints; with ``shared`` those it lets through."""
    names = ["doc_id", "mark", "fingerprint", "window", "start", "size", "tail"]
    sieve = None if shared is None else docs.sparkSession.sparkContext.broadcast(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(batch.column(2)):
                found = windows(part, min_words, None if sieve is None else sieve.value)
                rows = pa.array(found["text"] + first)
                offsets = np.concatenate(([0], np.cumsum(found["tail_size"]))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(rows),
                        batch.column(1).take(rows),
                        pa.array(found["fingerprint"].view(np.int64)),
                        pa.array(found["window"].view(np.int64)),
                        pa.array(found["start"].astype(np.int32)),
                        pa.array(found["size"].astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(found["tail"].view(np.int64))),
                    ],
                    names,
                )

    schema = "doc_id bigint, mark bigint, fingerprint bigint, window bigint, start int, size int, tail array<bigint>"
    return docs.select("doc_id", "mark", "text").mapInArrow(run, schema)


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Runs of lines [``start``, ``end``) of documents (``doc_id``, ``mark``) that occur earlier."""
    sieve = Sieve.of(stage(shared_fingerprints(docs, min_words), "shared"), "fingerprint")
    found = stage(places(docs, min_words, sieve), "windows")
    key = ["fingerprint", "window"]
    place = ["doc_id", "mark", "start"]
    first = found.groupBy(*key).agg(F.count("*").alias("n"), F.min(F.struct(*place, "tail")).alias("first"))
    first = broadcast_if_small(stage(first.filter("n > 1"), "repeated"))
    agree = F.zip_with("tail", "first.tail", lambda a, b: a.eqNullSafe(b))
    differs = F.array_position(agree, False)
    further = F.when(differs > 0, differs - 1).otherwise(F.least(F.size("tail"), F.size("first.tail"))).cast("int")
    same = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("mark") == F.col("first.mark")) & (F.col("start") == F.col("first.start"))
    later = found.join(first, key).filter(~same).withColumn("further", further)
    # runs that the first place does not have; if only one other place has the window, nobody else can
    apart = later.filter((F.col("n") > 2) & (F.col("further") < F.size("tail")))
    rest = F.posexplode(F.expr("slice(tail, further + 1, size(tail))")).alias("k", "run")
    apart = stage(apart.select("window", *place, (F.col("start") + F.col("size") + F.col("further")).alias("at"), rest), "apart")
    key = ["window", "run"]
    before = apart.groupBy(*key).agg(F.count("*").alias("n"), F.min(F.struct(*place)).alias("first"))
    before = broadcast_if_small(stage(before.filter("n > 1").drop("n"), "extended"))
    runs = later.select(*place, (F.col("start") + F.col("size") + F.col("further")).alias("end"))
    longer = apart.join(before, key).filter(~same).select(*place, (F.col("at") + F.col("k") + 1).alias("end"))
    return runs.union(longer.groupBy(*place).agg(F.max("end").alias("end")))


def without_runs(texts: pa.Array, runs: pa.Array) -> tuple[list[str | None], np.ndarray, np.ndarray]:
    """The texts without the lines of their runs, their lines, and how many of them went."""
    out, n_lines, n_deleted = [], np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    bounds = pc.list_value_length(runs).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(bounds)
    inside = runs.flatten()
    starts, stops = (inside.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    for k, text in enumerate(texts):
        if not text.is_valid:
            out.append(None)
            continue
        text = text.as_py()
        n_lines[k] = text.count("\n") + 1
        if bounds[k]:
            own = slice(ends[k] - bounds[k], ends[k])
            # the number of runs that are open at each line
            change = np.bincount(starts[own], minlength=n_lines[k] + 1) - np.bincount(stops[own], minlength=n_lines[k] + 1)
            gone = np.cumsum(change)[: n_lines[k]] > 0
            n_deleted[k] = np.count_nonzero(gone)
            text = "\n".join([line for line, less in zip(text.split("\n"), gone.tolist()) if not less])
        out.append(text)
    return out, n_lines, n_deleted


def delete_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, the remaining ``text``, ``n_lines`` and ``n_deleted``."""
    rows = small_batches(docs).select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("mark", F.xxhash64("text"))
    # one end for each line at most, the furthest
    ends = repeated_runs(rows, min_words).groupBy("doc_id", "mark", "start").agg(F.max("end").alias("end"))
    runs = ends.groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    runs = broadcast_if_small(stage(runs, "runs"))
    joined = rows.join(runs, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")), "left").select("doc_id", "text", "runs")

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, n_lines, n_deleted = without_runs(batch.column(1), batch.column(2))
            columns = [batch.column(0), pa.array(left, pa.string()), pa.array(n_lines), pa.array(n_deleted)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "n_lines", "n_deleted"])

    return joined.mapInArrow(sweep, "doc_id bigint, text string, n_lines bigint, n_deleted bigint")
