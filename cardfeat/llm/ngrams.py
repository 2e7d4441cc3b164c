"""Hashed word n-gram counts of a corpus by class, and mean log ratios of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardfeat.llm.flat import Flat, Words, join, plain, slices, words
from cardfeat.llm.tables import small_batches

#: Buckets of hashed words and word pairs.
BUCKETS = 1 << 15
#: Log ratios are added up as whole numbers of this fraction, so that sums do not depend on any order.
UNIT = 1 << 16


def buckets(w: Words, size: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words and all pairs of neighbours, and the text of each."""
    text = w.text
    shift = np.uint64(64 - (size.bit_length() - 1))
    at = np.flatnonzero(text[:-1] == text[1:]) if len(text) else np.zeros(0, np.int64)
    pairs = join(w.hashes[at], w.hashes[at + 1]) if len(at) else np.zeros(0, np.uint64)
    return (
        np.concatenate((w.hashes >> shift, pairs >> shift)).astype(np.int64),
        np.concatenate((text, text[at])),
    )


def class_counts(rows: DataFrame, classes: int, size: int = BUCKETS) -> np.ndarray:
    """Counts (class, bucket) over all rows of (text, _class), added up before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((classes, size), dtype=np.int64)
        for batch in batches:
            kind = np.asarray(batch.column(1))
            for first, part in slices(batch.column(0)):
                found, text = buckets(words(part, lower=True), size)
                total += np.bincount(kind[first + text] * size + found, minlength=classes * size).reshape(classes, size)
        at = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int64()), *(pa.array(total[c, at], pa.int64()) for c in range(classes))],
            ["_bucket", *(f"_n{c}" for c in range(classes))],
        )

    names = [f"_n{c}" for c in range(classes)]
    schema = "_bucket bigint, " + ", ".join(f"{n} bigint" for n in names)
    sums = small_batches(rows).select("text", F.col("_class").cast("int")).mapInArrow(count, schema)
    # at most one row per bucket: bounded by ``size``
    found = sums.groupBy("_bucket").agg(*(F.sum(n).alias(n) for n in names)).toPandas()
    total = np.zeros((classes, size), dtype=np.int64)
    total[:, found["_bucket"].to_numpy()] = found[names].to_numpy().T
    return total


def log_ratios(wanted: np.ndarray, base: np.ndarray, prior: float = 10.0) -> np.ndarray:
    """Logarithm of p(bucket | wanted) / p(bucket | base) in units; all zero if either has no words.

    Both multinomials are smoothed with ``prior`` counts per bucket, spread as the base is.
    """
    if not wanted.sum() or not base.sum():
        return np.zeros(len(base), dtype=np.int64)
    q = (base + prior) / (base.sum() + prior * len(base))
    p = (wanted + prior * len(base) * q) / (wanted.sum() + prior * len(base))
    return np.rint(np.log(p / q) * UNIT).astype(np.int64)


def mean_ratios(w: Words, table: np.ndarray, texts: int) -> np.ndarray:
    """Mean log ratio of each text's words and pairs; 0 without words."""
    found, text = buckets(w, len(table))
    sums = np.zeros(texts, dtype=np.int64)
    np.add.at(sums, text, table[found])
    counts = np.bincount(text, minlength=texts)
    return sums / (np.maximum(counts, 1) * UNIT)


def text_slices(batch: pa.RecordBatch, name: str = "text") -> Iterator[tuple[int, Flat]]:
    return slices(plain(batch.column(batch.schema.get_field_index(name))))
