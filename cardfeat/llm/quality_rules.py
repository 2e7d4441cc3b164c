"""Quality rules: counts of each text, and a log-likelihood ratio against the raw corpus.

Hashed words and word pairs of trusted texts and of the whole corpus give two
multinomials. A text's score is the mean logarithm of their ratio over its
n-grams, so that length does not matter; a text stays if it passes the base
rules and scores at least ``threshold``.

Null texts have no words and fail the base rules. Rows are judged one by one,
so repeated rows and repeated ids get equal verdicts. Without any trusted text
all scores are 0. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardfeat.llm.flat import SPACED, Flat, Words, distinct, join, mix, slices, sum_per_text, windows, words
from cardfeat.llm.ngrams import class_counts, log_ratios, mean_ratios, text_slices
from cardfeat.llm.tables import one_label, with_label

#: A text whose n-grams are on average this much likelier in the raw corpus (natural logarithm) is rejected.
THRESHOLD = -0.08
MIN_WORDS = 50
#: Percent of words that may lie in repeated three-word windows.
MAX_REPEATED = 50

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def line_counts(part: Flat, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines with a word, and how many of them are different."""
    starts, ends, first = part.spans(part.data != 10)
    text = np.repeat(np.arange(len(part)), np.diff(first))
    worded = np.searchsorted(w.starts, ends) > np.searchsorted(w.starts, starts)
    starts, ends, text = starts[worded], ends[worded], text[worded]
    keys = join(part.hashes(starts, ends), text.astype(np.uint64))
    _, once, _ = distinct(keys)
    return np.bincount(text, minlength=len(part)), np.bincount(text[once], minlength=len(part))


def repeated_words(w: Words, texts: int, size: int = 3) -> np.ndarray:
    """Per text: words inside windows of ``size`` words that occur twice or more in it."""
    keys, at = windows(w, size)
    covered = np.zeros(len(w.hashes), dtype=bool)
    if len(keys):
        keys = mix(keys + w.text[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(keys)
        same = keys[order[1:]] == keys[order[:-1]]
        again = at[order[np.concatenate((same, [False])) | np.concatenate(([False], same))]]
        for k in range(size):
            covered[again + k] = True
    return sum_per_text(covered, w.first)


def text_counts(part: Flat, w: Words) -> dict[str, np.ndarray]:
    """The base counts of each text of a slice."""
    inside = SPACED[part.data] & ((part.data & 0xC0) != 0x80)
    lines, different = line_counts(part, w)
    return {
        "n_words": w.counts,
        "word_chars": sum_per_text(inside, part.offsets),
        "n_symbols": part.per_text(np.flatnonzero(_SYMBOL[part.data])),
        "n_dup_lines": lines - different,
        "n_repeat_words": repeated_words(w, len(part)),
    }


def target_ratios(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """Log ratios between the texts labelled good (quality 1, not toxic) and all texts.

    Every document and every labelled document is counted.
    """
    good = F.when((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0), 1)
    trusted = with_label(docs, one_label(labels, good)).select("text", F.lit(1).alias("_class"))
    counts = class_counts(docs.select("text", F.lit(0).alias("_class")).unionAll(trusted), 2)
    return log_ratios(counts[1], counts[0])


def judge(part: Flat, table: np.ndarray, threshold: float = THRESHOLD) -> dict[str, np.ndarray]:
    """Counts, score and verdict of each text of a slice."""
    w = words(part)
    out = text_counts(part, w)
    out["score"] = mean_ratios(words(part, lower=True), table, len(part))
    out["base_failed"] = (out["n_words"] < MIN_WORDS) | (100 * out["n_repeat_words"] > MAX_REPEATED * out["n_words"])
    out["kept"] = ~out["base_failed"] & (out["score"] >= threshold)
    return out


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: counts, ``score``, ``base_failed`` and ``kept``."""
    table = target_ratios(docs, labels)

    def rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(batch.column(1)):
                out = judge(part, table, threshold)
                columns = [pa.array(out[c], pa.int64()) for c in COUNTS]
                columns += [pa.array(out["base_failed"]), pa.array(out["kept"]), pa.array(out["score"], pa.float64())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(part)), *columns], ["doc_id", *COUNTS, "base_failed", "kept", "score"]
                )

    schema = ", ".join(f"{c} bigint" for c in ("doc_id", *COUNTS)) + ", base_failed boolean, kept boolean, score double"
    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(rules, schema)


def drop_rejected(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    table = target_ratios(docs, labels)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [judge(part, table, threshold)["kept"] for _, part in text_slices(batch)]
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    return docs.mapInArrow(keep, docs.schema)
