"""Soft-membership mixing: domain posteriors and document rates that meet target weights.

A softmax regression over hashed words, word beginnings and text statistics,
fitted on a bounded sample of the labelled documents, gives every document a
posterior over the domains. Rates are then fitted by projected-gradient least
squares: with ``a = tokens * posterior`` for each document, the residual of the
expected domain totals against their targets, each counted by its domain's
supply, is summed over all partitions. A document's share in it is the gradient
by its rate (for each token); the sum of all gradient steps so far moves its rate
away from one, and the rate is that point projected on what is not negative. So
the rates that meet the targets are those with the least change per token, a
sum of steps has one number for each domain, and documents need only their
posterior. Step lengths come from the change of the residual over the step
before (spectral, after Barzilai and Borwein); a step is halved while the
residual is larger than in all of the last ``KEPT`` rounds, and the best rates
of all rounds are returned. A small penalty on the sum of steps keeps a domain
with next to no tokens from moving all rates; totals miss their targets by some
ten-thousandth of all tokens for it.

The first domain sets the scale: its target is ``EPOCHS`` times its supply, the
others follow by weight but are never wanted more than they are there.

Null and empty texts have no tokens, the posterior of a text without words, and
a rate like any other. Rows are treated one by one: repeated rows get equal
rates and decisions. Without labels every document belongs to the first domain.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardfeat.llm.flat import LETTERED, Flat, lowered, mix, slices, words
from cardfeat.llm.quality_classifier import STATISTICS, statistics
from cardfeat.llm.tables import cut_rows, one_label, small_batches, with_label
from cardfeat.session import stage

#: Domains of the labels table and their wanted shares of the expected tokens.
TARGETS = {"clean": 0.9, "poor": 0.07, "toxic": 0.03}
EPOCHS = 1.05
#: Labelled documents that the classifier is fitted on at most, taken by a hash of their id.
SAMPLE = 8_000
BUCKETS = 1 << 15
#: Bytes of the word beginnings that are features beside the words.
BEGINNINGS = (4, 5)
STEPS, BATCH = 1_200, 64
SEED = 29
ROUNDS, CLOSE, HALVINGS = 60, 1e-6, 4
#: Rounds whose residuals a new one is held against.
KEPT = 8
#: Penalty on the steps, as a share of all tokens.
RIDGE = 1e-4
#: Expected tokens are added up as whole numbers of this fraction, so that no order matters.
UNIT = 1 << 10


def label_domain() -> Column:
    """The domain of a row of the labels table, as its number in TARGETS."""
    return F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 0)


def features(part: Flat) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words per text, hashed features with their texts, and statistics of the texts of a slice."""
    low = lowered(part)
    w = words(low, LETTERED)
    hashes = [w.hashes] + [mix(low.hashes(w.starts, np.minimum(w.starts + k, w.ends)) + np.uint64(k)) for k in BEGINNINGS]
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    found = (np.concatenate(hashes) >> shift).astype(np.int64)
    spaced = words(part)
    return spaced.counts, found, np.tile(w.text, len(hashes)), statistics(part, spaced).astype(np.float64)


@dataclass
class Memberships:
    """A softmax regression of texts into domains."""

    weights: np.ndarray  #: (bucket, domain)
    dense: np.ndarray  #: (statistic and constant, domain)
    mean: np.ndarray
    scale: np.ndarray

    @property
    def domains(self) -> int:
        return self.dense.shape[1]

    def scaled(self, stats: np.ndarray) -> np.ndarray:
        return np.concatenate((np.clip((stats - self.mean) / self.scale, -6, 6), np.ones((len(stats), 1))), axis=1)

    def of(self, part: Flat) -> tuple[np.ndarray, np.ndarray]:
        """Words and posteriors of the texts of a slice."""
        tokens, found, text, stats = features(part)
        n = len(part)
        size = np.maximum(np.bincount(text, minlength=n), 1)
        logs = self.scaled(stats) @ self.dense
        for k in range(self.domains):
            logs[:, k] += np.bincount(text, weights=self.weights[found, k], minlength=n) * 10 / size
        # rounded, so that equal texts agree however their slice was cut
        return tokens, np.round(_softmax(logs), 9)


def _softmax(logs: np.ndarray) -> np.ndarray:
    odds = np.exp(logs - logs.max(axis=1, keepdims=True))
    return odds / odds.sum(axis=1, keepdims=True)


def fit_memberships(found: list[np.ndarray], values: list[np.ndarray], stats: np.ndarray, labels: np.ndarray, domains: int) -> Memberships:
    """Fit by adaptive gradient steps over shuffled batches; the same rows give the same weights."""
    model = Memberships(np.zeros((BUCKETS, domains)), np.zeros((stats.shape[1] + 1, domains)), stats.mean(axis=0), stats.std(axis=0) + 1e-6)
    x = model.scaled(stats)
    squares, dense_squares = np.full(model.weights.shape, 1e-2), np.full(model.dense.shape, 1e-2)
    rng = np.random.default_rng(SEED)
    order = np.zeros(0, dtype=np.int64)
    for _ in range(STEPS):
        if not len(order):
            order = rng.permutation(len(labels))
        some, order = order[:BATCH], order[BATCH:]
        if len(some):
            buckets = np.concatenate([found[i] for i in some])
            value = np.concatenate([values[i] for i in some])
            row = np.repeat(np.arange(len(some)), [len(found[i]) for i in some])
            logs = x[some] @ model.dense
            for k in range(domains):
                logs[:, k] += np.bincount(row, weights=model.weights[buckets, k] * value, minlength=len(some))
            off = _softmax(logs)
            off[np.arange(len(some)), labels[some]] -= 1
            slope = np.stack([np.bincount(buckets, weights=off[row, k] * value, minlength=BUCKETS) for k in range(domains)], axis=1)
            squares += slope**2
            model.weights -= 0.5 * slope / np.sqrt(squares)
            dense = x[some].T @ off
            dense_squares += dense**2
            model.dense -= 0.1 * dense / np.sqrt(dense_squares)
    return model


def label_sample(docs: DataFrame, labels: DataFrame, domain: Column) -> DataFrame:
    """At most about SAMPLE labelled documents (``doc_id``, ``text``, ``_value``), chosen by a hash of the id.

    Where ids repeat so often that there are more rows, each label keeps a share by its ids, or 100 rows.
    """
    labelled = one_label(labels, domain)
    share = SAMPLE / max(labelled.count(), 1)
    if share < 1:
        labelled = labelled.filter(F.pmod(F.xxhash64("_key"), F.lit(1 << 20)) < int(share * (1 << 20)))
    ids = {r["_value"]: r["n"] for r in labelled.groupBy("_value").agg(F.count("*").alias("n")).collect()}
    limits = {value: max(100, SAMPLE * n // sum(ids.values())) for value, n in ids.items()}
    return cut_rows(with_label(docs, labelled, columns=("doc_id", "text")), "_value", limits, F.xxhash64("doc_id", "text"))


def learn_memberships(docs: DataFrame, labels: DataFrame, domains: int = len(TARGETS), domain: Column | None = None) -> Memberships:
    """Fit the classifier on a bounded sample of the labelled documents."""
    rows = label_sample(small_batches(docs), labels, label_domain() if domain is None else domain)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(batch.column(1)):
                _, found, text, stats = features(part)
                keys, count = np.unique(text * BUCKETS + found, return_counts=True)
                cut = np.searchsorted(keys, np.arange(len(part) + 1) * BUCKETS)
                size = np.maximum(np.bincount(text, minlength=len(part)), 1)
                out = [[], [], []]
                for t in range(len(part)):
                    some = slice(cut[t], cut[t + 1])
                    out[0].append((keys[some] % BUCKETS).astype("<i4").tobytes())
                    out[1].append((count[some] * 10 / size[t]).astype("<f4").tobytes())
                    out[2].append(stats[t].tobytes())
                columns = [batch.column(0).slice(first, len(part)), batch.column(2).slice(first, len(part)), *(pa.array(o, pa.binary()) for o in out)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "label", "found", "value", "stats"])

    # about SAMPLE rows, of some kilobytes each
    sample = rows.mapInArrow(vectors, "doc_id bigint, label int, found binary, value binary, stats binary").collect()
    sample.sort(key=lambda r: (r["doc_id"], r["label"], bytes(r["found"])))
    width = len(STATISTICS)
    if not sample:
        model = Memberships(np.zeros((BUCKETS, domains)), np.zeros((width + 1, domains)), np.zeros(width), np.ones(width))
        model.dense[-1, 1:] = -50.0
        return model
    return fit_memberships(
        [np.frombuffer(bytes(r["found"]), "<i4") for r in sample],
        [np.frombuffer(bytes(r["value"]), "<f4").astype(float) for r in sample],
        np.stack([np.frombuffer(bytes(r["stats"])) for r in sample]),
        np.array([r["label"] for r in sample]),
        domains,
    )


@dataclass
class Mix:
    """A fitted mix: the classifier and the steps that take rates from one to their final value."""

    memberships: Memberships
    steps: np.ndarray  #: sum of all gradient steps, a number for each domain
    targets: np.ndarray
    totals: np.ndarray  #: expected domain totals at the final rates

    def rates(self, posterior: np.ndarray) -> np.ndarray:
        return _rates(posterior, self.steps)


def _rates(posterior: np.ndarray, steps: np.ndarray) -> np.ndarray:
    return np.maximum(1.0 - posterior @ steps, 0.0)


def _posterior(column: pa.Array, domains: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, domains)


def with_memberships(docs: DataFrame, memberships: Memberships, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document ``doc_id``, a ``mark`` of its text, ``n_tokens`` and ``posterior``."""
    domains = memberships.domains
    shared = docs.sparkSession.sparkContext.broadcast(memberships)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, part in slices(batch.column(2)):
                tokens, posterior = shared.value.of(part)
                offsets = pa.array(np.arange(len(part) + 1, dtype=np.int32) * domains)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(part)),
                        batch.column(1).slice(first, len(part)),
                        pa.array(tokens, pa.int64()),
                        pa.ListArray.from_arrays(offsets, pa.array(posterior.ravel())),
                    ],
                    ["doc_id", "mark", "n_tokens", "posterior"],
                )

    rows = small_batches(docs).select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("mark"), "text").mapInArrow(
        run, "doc_id bigint, mark bigint, n_tokens bigint, posterior array<double>"
    )


def beside_memberships(docs: DataFrame, memberships: Memberships, tokens: str, posterior: str) -> DataFrame:
    """The documents with their words and posteriors as two more columns."""
    learned = docs.sparkSession.sparkContext.broadcast(memberships)
    text = "text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            column = batch.column(batch.schema.get_field_index(text)).cast(pa.string())
            parts = [learned.value.of(part) for _, part in slices(column)]
            counts, p = np.concatenate([c for c, _ in parts]), np.concatenate([p for _, p in parts])
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(p) + 1) * p.shape[1], pa.int32()), pa.array(p.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts.astype(np.int64)), lists], [*batch.schema.names, tokens, posterior])

    schema = T.StructType([*docs.schema.fields, T.StructField(tokens, T.LongType()), T.StructField(posterior, T.ArrayType(T.DoubleType()))])
    return small_batches(docs).mapInArrow(run, schema)


def _totals(rows: DataFrame, steps: np.ndarray, domains: int) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens of each domain at the rates after ``steps``, and second moments of documents with a rate above zero."""
    width = domains + domains * domains

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, dtype=np.int64)
        for batch in batches:
            tokens, p = np.asarray(batch.column(0)).astype(float), _posterior(batch.column(1), domains)
            rate = _rates(p, steps)
            square = (p[:, :, None] * p[:, None, :] * (tokens * (rate > 0))[:, None, None]).reshape(len(p), -1)
            values = np.concatenate((p * (rate * tokens)[:, None], square), axis=1)
            total += np.rint(values * UNIT).astype(np.int64).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(total)], ["k", "v"])

    found = rows.select("n_tokens", "posterior").mapInArrow(add, "k int, v bigint").groupBy("k").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(width)
    for row in found:  # one row per number
        out[row["k"]] = row["v"] / UNIT
    return out[:domains], out[domains:].reshape(domains, domains)


def fit_mix(rows: DataFrame, memberships: Memberships, weights: list[float], epochs: float = EPOCHS) -> Mix:
    """Fit the rates of the documents in ``rows`` (``n_tokens``, ``posterior``)."""
    domains = len(weights)
    steps = np.zeros(domains)
    totals, moments = _totals(rows, steps, domains)
    share = np.array(weights, dtype=float)
    targets = np.minimum(share / share[0] * totals[0] * epochs, totals)
    targets[0] = totals[0] * epochs
    every = totals.sum()
    scale = totals + RIDGE * every

    def residual(at: np.ndarray, found: np.ndarray) -> np.ndarray:
        return found - targets - RIDGE * every * at

    def size(miss: np.ndarray) -> float:
        return float((miss**2 / np.maximum(scale, 1.0)).sum())

    miss = residual(steps, totals)
    sizes, best, length = [size(miss)], (steps, totals), None
    for _ in range(ROUNDS):
        if np.abs(miss).max() <= CLOSE * every:
            break
        gradient = miss / np.maximum(scale, 1.0)
        exact = length is None
        if exact:  # the length that is best if no more rates are cut
            length = miss @ gradient / (gradient @ (moments + np.eye(domains) * RIDGE * every) @ gradient)
        step = length * gradient
        for _ in range(HALVINGS):
            moved, changed = _totals(rows, steps + step, domains)
            after = residual(steps + step, moved)
            if size(after) < max(sizes[-KEPT:]):
                break
            step = step / 2
        else:  # no step gets closer
            if exact:
                break
            length = None
            continue
        bend = step @ (miss - after)
        length = (step**2 * scale).sum() / bend if bend > 0 else None
        steps, totals, moments, miss = steps + step, moved, changed, after
        sizes.append(size(miss))
        if sizes[-1] == min(sizes):
            best = steps, totals
    steps, totals = best
    return Mix(memberships, steps, targets, totals)


def _drawn() -> Column:
    """A fixed number in [0, 1) for each document and text."""
    return F.pmod(F.xxhash64("doc_id", "mark"), F.lit(1 << 40)) / F.lit(float(1 << 40))


def mix_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """One row per document: ``n_tokens``, a posterior ``p_<domain>`` each, ``domain``, ``rate`` and ``copies``.

    ``copies`` rounds the rate up or down by a fixed draw, so that its expectation is the rate.
    """
    targets = TARGETS if targets is None else targets
    names = list(targets)
    memberships = learn_memberships(docs, labels, len(names))
    rows = stage(with_memberships(docs, memberships), "memberships")
    mix = fit_mix(rows, memberships, list(targets.values()))

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rates = mix.rates(_posterior(batch.column(3), len(names)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rates)], [*batch.schema.names, "rate"])

    schema = "doc_id bigint, mark bigint, n_tokens bigint, posterior array<double>, rate double"
    rated = rows.mapInArrow(rate, schema)
    best = F.array_position("posterior", F.array_max("posterior")).cast("int")
    return rated.select(
        "doc_id",
        "n_tokens",
        *(F.col("posterior")[k].alias(f"p_{name}") for k, name in enumerate(names)),
        F.element_at(F.array(*map(F.lit, names)), best).alias("domain"),
        "rate",
        F.floor(F.col("rate") + _drawn()).cast("bigint").alias("copies"),
    )


def sample_mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None) -> DataFrame:
    """The documents drawn at their rates, at most once each, with all their columns."""
    targets = TARGETS if targets is None else targets
    memberships = learn_memberships(docs, labels, len(targets))
    free, taken = [], set(docs.columns)
    for name in ("tokens", "posterior"):
        while name in taken:
            name += "_"
        free.append(name)
    # every text is scored once; its scores stand beside the row
    scored = stage(beside_memberships(docs, memberships, *free), "memberships")
    tokens, posterior = (F.col(f"`{name}`") for name in free)
    mix = fit_mix(scored.select(tokens.alias("n_tokens"), posterior.alias("posterior")), memberships, list(targets.values()))
    steps = mix.steps
    drawn = F.pmod(F.xxhash64(F.col("doc_id").cast("bigint"), F.xxhash64(F.col("text").cast("string"))), F.lit(1 << 40)) / F.lit(float(1 << 40))
    draw = "draw"
    while draw in scored.columns:
        draw += "_"
    marked = scored.withColumn(draw, drawn)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rates = _rates(_posterior(batch.column(batch.num_columns - 2), len(steps)), steps)
                yield batch.filter(pa.array(rates + np.asarray(batch.column(batch.num_columns - 1)) >= 1.0))

    return marked.mapInArrow(keep, marked.schema).select(*(F.col(f"`{c}`") for c in docs.columns))
