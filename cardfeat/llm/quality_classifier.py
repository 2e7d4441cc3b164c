"""Quality classifier: random Fourier features of document statistics, ridge, isotonic calibration.

A document becomes a short vector of statistics. Random cosines approximate a
Gaussian kernel over the scaled statistics; each partition adds up its normal
equations, the sums of all partitions give the ridge weights. Scores are
calibrated by isotonic regression on rows that the fit did not see.

Labels are learnt only from rows that ``learn`` selects. Null texts count as
empty and are scored like any other text. Rows are scored one by one, so
repeated rows get equal scores; a label that is listed twice counts once, with
its smaller value. Without labels, or with labels of one kind only, every
document gets the share of label 1 (one half without any). An empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardfeat.llm.flat import Flat, Words, distinct, join, slices, sum_per_text, words
from cardfeat.llm.quality_rules import line_counts, repeated_words
from cardfeat.llm.tables import SMALL_KEYS, small_batches
from cardfeat.operators.skew import broadcast_if_small
from cardfeat.session import stage

#: Random cosines, width of the kernel over scaled statistics, and weight of the ridge penalty per row.
COSINES = 256
GAMMA = 0.08
RIDGE = 1e-4
SEED = 17
#: Scores are calibrated on a grid of this many steps between the lowest and highest useful raw score.
GRID = 2000
PREDICT_AT = 0.3
#: One labelled row in so many calibrates instead of fitting.
CALIBRATE = 4

STATISTICS = (
    "log_words", "log_lines", "word_length", "long_words", "upper", "digits", "stops", "shouts", "symbols", "bars",
    "high_bytes", "different_words", "repeated_words", "repeated_lines", "line_words", "top_symbol_words", "neighbours", "capitals",
)


def _bytes(*groups: str | range) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for g in groups:
        out[[ord(c) if isinstance(c, str) else c for c in g]] = True
    return out


_UPPER, _DIGIT = _bytes(range(0x41, 0x5B)), _bytes(range(0x30, 0x3A))
_STOP, _SHOUT, _SYMBOL, _BAR, _HIGH = _bytes(".,;:"), _bytes("!?"), _bytes("#*$%&<>{}[]=+~^@\\/"), _bytes("|"), _bytes(range(0x80, 0x100))


def statistics(part: Flat, w: Words | None = None) -> np.ndarray:
    """One row of statistics for each text of a slice; ``w`` are its words, if they are known already."""
    w = words(part) if w is None else w
    n = len(part)
    count = w.counts
    size = np.maximum(np.diff(part.offsets), 1).astype(float)
    some = np.maximum(count, 1).astype(float)
    lines, different_lines = line_counts(part, w)
    length = w.ends - w.starts
    last = part.data[w.ends - 1] if len(w.ends) else part.data[:0]
    first = part.data[w.starts] if len(w.starts) else part.data[:0]
    text = w.text
    per_text = distinct(join(w.hashes, text.astype(np.uint64)))[1]
    same = np.concatenate(([False], (w.hashes[1:] == w.hashes[:-1]) & (text[1:] == text[:-1]))) if len(text) else np.zeros(0, bool)

    def share(kind: np.ndarray) -> np.ndarray:
        return part.per_text(np.flatnonzero(kind[part.data])) / size

    def of_words(flags: np.ndarray) -> np.ndarray:
        return sum_per_text(flags, w.first) / some

    return np.stack(
        [
            np.log1p(count),
            np.log1p(lines),
            sum_per_text(length, w.first) / some,
            of_words(length > 20),
            share(_UPPER),
            share(_DIGIT),
            share(_STOP),
            share(_SHOUT),
            share(_SYMBOL),
            share(_BAR),
            share(_HIGH),
            np.bincount(text[per_text], minlength=n) / some,
            repeated_words(w, n) / some,
            (lines - different_lines) / np.maximum(lines, 1),
            np.log1p(count / np.maximum(lines, 1)),
            of_words(_SYMBOL[last]),
            of_words(same),
            of_words(_UPPER[first]),
        ],
        axis=1,
    ).astype(np.float32)


def with_statistics(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document ``doc_id`` and its vector ``stats``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(batch.column(1)):
                values = statistics(part)
                offsets = np.arange(len(part) + 1, dtype=np.int32) * len(STATISTICS)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(part)), column], ["doc_id", "stats"])

    rows = small_batches(docs).select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, stats array<float>")


@dataclass
class Cosines:
    """Random Fourier features of scaled statistics."""

    mean: np.ndarray
    scale: np.ndarray

    def __post_init__(self):
        rng = np.random.default_rng(SEED)
        self.weights = rng.normal(0.0, np.sqrt(2 * GAMMA), (len(self.mean), COSINES))
        self.phase = rng.uniform(0, 2 * np.pi, COSINES)

    def of(self, stats: np.ndarray) -> np.ndarray:
        scaled = np.clip((stats - self.mean) / self.scale, -8, 8)
        waves = np.cos(scaled @ self.weights + self.phase) * np.sqrt(2 / COSINES)
        return np.concatenate((waves, np.ones((len(stats), 1))), axis=1)


@dataclass
class Model:
    cosines: Cosines
    weights: np.ndarray
    knots: np.ndarray  #: raw scores
    values: np.ndarray  #: calibrated scores at the knots

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.cosines.of(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.knots, self.values), 0.0, 1.0)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, len(STATISTICS)).astype(np.float64)


def normal_equations(rows: DataFrame, cosines: Cosines) -> tuple[np.ndarray, np.ndarray, int]:
    """Sums of feature products and of features times labels over rows (``stats``, ``label``).

    Each partition gives one row per feature; sums are taken in the order of partitions, so they can be repeated.
    """
    size = COSINES + 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, target = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            x, y = cosines.of(_matrix(batch.column(0))), np.asarray(batch.column(1)).astype(float)
            gram += x.T @ x
            target += x.T @ y
        if gram.any():
            sums = [row.tobytes() for row in np.concatenate((gram, target[:, None]), axis=1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(size, dtype=np.int32)), pa.array(np.full(size, TaskContext.get().partitionId(), np.int32)), pa.array(sums, pa.binary())],
                ["feature", "part", "sums"],
            )

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        total = np.zeros(size + 1)
        for raw in table.column("sums"):
            total = total + np.frombuffer(raw.as_buffer(), dtype=np.float64)
        return pa.table({"feature": table.column("feature").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    partials = rows.select("stats", "label").mapInArrow(partial, "feature int, part int, sums binary")
    found = partials.groupBy("feature").applyInArrow(add, "feature int, sums binary").collect()  # a row per feature
    both = np.zeros((size, size + 1))
    for row in found:
        both[row["feature"]] = np.frombuffer(bytes(row["sums"]))
    return both[:, :size], both[:, size], round(both[size - 1, size - 1])


def isotonic(y: np.ndarray, weight: np.ndarray, share: float) -> np.ndarray:
    """Non-decreasing means of ``y`` in its order, by pooling neighbours.

    Every pool is then joined by one row of the common share, which keeps small pools off 0 and 1.
    """
    sums: list[float] = []
    weights: list[float] = []
    sizes: list[int] = []
    for value, w in zip(y.tolist(), weight.tolist()):
        sums.append(value * w)
        weights.append(w)
        sizes.append(1)
        while len(sums) > 1 and sums[-2] * weights[-1] >= sums[-1] * weights[-2]:
            sums[-2:] = [sums[-2] + sums[-1]]
            weights[-2:] = [weights[-2] + weights[-1]]
            sizes[-2:] = [sizes[-2] + sizes[-1]]
    pooled = (np.array(sums) + share) / (np.array(weights) + 1)
    return np.repeat(np.maximum.accumulate(pooled), sizes)


def fit(rows: DataFrame) -> Model:
    """Fit on rows (``doc_id``, ``stats``, ``label``), a fixed part of which calibrates."""
    moments = rows.agg(
        *(F.avg(F.col("stats")[k].cast("double")).alias(f"m{k}") for k in range(len(STATISTICS))),
        *(F.stddev_pop(F.col("stats")[k].cast("double")).alias(f"s{k}") for k in range(len(STATISTICS))),
        F.avg("label").alias("share"),
        F.count("*").alias("n"),
    ).first()
    share = 0.5 if moments["share"] is None else float(moments["share"])
    if share in (0.0, 1.0) or not moments["n"]:
        cosines = Cosines(np.zeros(len(STATISTICS)), np.ones(len(STATISTICS)))
        return Model(cosines, np.zeros(COSINES + 1), np.array([0.0, 1.0]), np.array([share, share]))
    scale = np.array([moments[f"s{k}"] for k in range(len(STATISTICS))])
    # rounded, since sums over partitions differ in their last digits
    mean = np.round([moments[f"m{k}"] for k in range(len(STATISTICS))], 6)
    cosines = Cosines(mean, np.where(scale > 1e-6, np.round(scale, 6), 1.0))
    held = F.pmod(F.crc32(F.concat(F.lit("calibrate "), F.col("doc_id").cast("string")).cast("binary")), F.lit(CALIBRATE)) == 0
    gram, target, n = normal_equations(rows.filter(~held), cosines)
    if not n:
        gram, target, n = normal_equations(rows, cosines)
    penalty = np.eye(len(gram)) * RIDGE * n
    penalty[-1, -1] = 1e-9
    model = Model(cosines, np.linalg.solve(gram + penalty, target), np.array([0.0, 1.0]), np.array([0.0, 1.0]))

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = np.rint(np.clip(model.raw(_matrix(batch.column(0))), -0.5, 1.5) * GRID)
            yield pa.RecordBatch.from_arrays([pa.array(step.astype(np.int32)), batch.column(1)], ["step", "label"])

    steps = rows.filter(held).select("stats", "label").mapInArrow(raw, "step int, label int")
    # at most 2 * GRID + 1 rows
    found = steps.groupBy("step").agg(F.sum("label").alias("good"), F.count("*").alias("n")).orderBy("step").toPandas()
    if len(found) < 2:
        return model
    x, weight = found["step"].to_numpy() / GRID, found["n"].to_numpy().astype(float)
    values = isotonic(found["good"].to_numpy() / weight, weight, share)
    # a small slope keeps the order of raw scores where neighbours were pooled
    values = 0.98 * values + 0.01 * (x + 0.5)
    return Model(cosines, model.weights, np.concatenate(([-0.6], x, [1.6])), np.concatenate(([values[0]], values, [values[-1]])))


def quality_scores(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and ``score`` (0 to 1).

    ``learn`` is a condition on ``doc_id``: labels of other documents are never read.
    """
    stats = stage(with_statistics(docs, key, text), "statistics")
    wanted = labels.filter(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).filter(learn)
    label = wanted.groupBy(F.col("doc_id").alias("_key")).agg(F.min("quality").cast("int").alias("label"))
    rows = stats.join(broadcast_if_small(label, SMALL_KEYS), F.col("doc_id") == F.col("_key")).select("doc_id", "stats", "label")
    model = fit(stage(rows, "labelled"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = model.score(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], ["doc_id", "score"])

    return stats.mapInArrow(score, "doc_id bigint, score double")
