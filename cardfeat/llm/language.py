"""Language identification by a small byte convolutional network, trained here in numpy.

Bytes are embedded, filters of several widths slide over windows of a fixed
length, each filter keeps its largest value, and a softmax over those gives the
languages. For prediction the embedding and the filters are multiplied out into
tables per pair of neighbouring bytes, which gives the same sums with fewer
look-ups. All windows of a text are scored and averaged by their length.

A text that is null or has no letter is ``und`` with score 0; so is every text
when nothing could be learnt. Rows are scored one by one, so repeated rows get
equal results. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardfeat.llm.flat import Flat, slices
from cardfeat.llm.tables import cut_rows, small_batches

#: Documents of each language that training reads at most, and windows taken from each.
SAMPLE, CROPS = 1200, 3
#: Bytes in a window, size of the embedding, filters of each width.
WINDOW, EMBED, FILTERS = 256, 8, 12
WIDTHS = (2, 3, 4)
STEPS, BATCH, RATE = 1_200, 64, 0.004
SEED = 5
UNKNOWN = "und"
_SUB = 512

_ASCII_LETTER = np.zeros(256, dtype=bool)
_ASCII_LETTER[0x41:0x5B] = _ASCII_LETTER[0x61:0x7B] = True
_PAD = max(WIDTHS)


@dataclass
class Network:
    """Weights: byte embedding, taps of the filters by width, biases, output layer."""

    languages: list[str]
    embed: np.ndarray
    taps: dict[int, np.ndarray]  #: (width, EMBED, FILTERS)
    bias: dict[int, np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str]) -> Network:
        rng = np.random.default_rng(SEED)
        return cls(
            languages,
            rng.normal(0, 0.5, (256, EMBED)),
            {w: rng.normal(0, 1 / np.sqrt(w * EMBED), (w, EMBED, FILTERS)) for w in WIDTHS},
            {w: np.zeros(FILTERS) for w in WIDTHS},
            rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))),
            np.zeros(len(languages)),
        )

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, *self.taps.values(), *self.bias.values(), self.out, self.out_bias]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _gradients(net: Network, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean cross entropy over windows ``x`` (bytes, padded) with labels ``y``."""
    n = len(x)
    pooled, where = [], []
    for w in WIDTHS:
        tables = (net.embed @ net.taps[w].transpose(1, 0, 2).reshape(EMBED, -1)).reshape(256, w, FILTERS).astype(np.float32)
        sums = sum(tables[x[:, j : j + WINDOW], j] for j in range(w))
        at = sums.argmax(axis=1)
        where.append(at)
        pooled.append(np.take_along_axis(sums, at[:, None], axis=1)[:, 0] + net.bias[w])
    hidden = np.concatenate(pooled, axis=1)
    active = np.maximum(hidden, 0)
    p = _softmax(active @ net.out + net.out_bias)
    p[np.arange(n), y] -= 1
    p /= n
    back = (p @ net.out.T) * (hidden > 0)
    d_embed = np.zeros_like(net.embed)
    d_taps, d_bias = [], []
    rows = np.arange(n)[:, None]
    for k, w in enumerate(WIDTHS):
        d = back[:, k * FILTERS : (k + 1) * FILTERS]
        taps = np.zeros_like(net.taps[w])
        for j in range(w):
            byte = x[rows, where[k] + j]  # (n, FILTERS)
            taps[j] = np.einsum("nfe,nf->ef", net.embed[byte], d)
            np.add.at(d_embed, byte, d[..., None] * net.taps[w][j].T[None])
        d_taps.append(taps)
        d_bias.append(d.sum(axis=0))
    return [d_embed, *d_taps, *d_bias, active.T @ p, p.sum(axis=0)]


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str]) -> Network:
    """Adam over shuffled batches; the same input gives the same weights."""
    net = Network.fresh(languages)
    rng = np.random.default_rng(SEED)
    weights = net.parameters()
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    order = np.zeros(0, dtype=np.int64)
    for step in range(1, STEPS + 1):
        if len(order) < BATCH:
            order = np.concatenate((order, rng.permutation(len(windows))))
        some, order = order[:BATCH], order[BATCH:]
        rate = RATE * (1 - step / (STEPS + 1))
        for w, g, m, v in zip(weights, _gradients(net, windows[some], labels[some]), first, second):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return net


class Predictor:
    """The network with its filters multiplied out into tables over pairs of bytes."""

    def __init__(self, net: Network):
        self.net = net
        self.tables: dict[int, list[tuple[int, np.ndarray]]] = {}
        for w in WIDTHS:
            single = [net.embed @ net.taps[w][j] for j in range(w)]
            made = []
            for j in range(0, w - 1, 2):
                made.append((j, (single[j][:, None] + single[j + 1][None]).reshape(65536, FILTERS).astype(np.float32)))
            if w % 2:  # the last tap ignores the byte after it
                made.append((w - 1, np.repeat(single[w - 1], 256, axis=0).astype(np.float32)))
            self.tables[w] = made

    def windows(self, x: np.ndarray) -> np.ndarray:
        """Language probabilities of padded windows."""
        pairs = x[:, :-1].astype(np.uint16) << 8 | x[:, 1:]
        pooled = []
        for w in WIDTHS:
            sums = None
            for j, table in self.tables[w]:
                part = table.take(pairs[:, j : j + WINDOW], axis=0)
                sums = part if sums is None else np.add(sums, part, out=sums)
            pooled.append(sums.max(axis=1) + self.net.bias[w])
        return _softmax(np.maximum(np.concatenate(pooled, axis=1), 0) @ self.net.out + self.net.out_bias)

    def texts(self, part: Flat) -> np.ndarray:
        """Mean probabilities over all windows of each text, weighted by their bytes."""
        sizes = np.diff(part.offsets)
        count = -(-sizes // WINDOW)
        text = np.repeat(np.arange(len(part)), count)
        number = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
        start = part.offsets[text] + number * WINDOW
        size = np.minimum(part.offsets[text + 1] - start, WINDOW)
        data = np.concatenate((part.data, np.zeros(WINDOW + _PAD, np.uint8)))
        reach = np.arange(WINDOW + _PAD)
        total = np.zeros((len(part), len(self.net.languages)))
        for at in range(0, len(text), _SUB):
            some = slice(at, at + _SUB)
            x = data[start[some, None] + reach]
            x[reach >= size[some, None]] = 0
            np.add.at(total, text[some], self.windows(x) * size[some, None])
        return total / np.maximum(sizes, 1)[:, None]


def _lettered(part: Flat) -> np.ndarray:
    """Which texts have a letter."""
    found = part.per_text(np.flatnonzero(_ASCII_LETTER[part.data])) > 0
    for t in np.flatnonzero(~found & (np.diff(part.offsets) > 0)).tolist():
        found[t] = any(map(str.isalpha, part.data[part.offsets[t] : part.offsets[t + 1]].tobytes().decode("utf-8", "replace")))
    return found


def _sample(docs: DataFrame, learn: Column) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Training windows: up to SAMPLE documents of each language, CROPS pieces of varied length of each."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & learn).select("doc_id", "text", "lang")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return [], np.zeros((0, WINDOW + _PAD), np.uint8), np.zeros(0, np.int64)
    scale = 1 << 30
    limits = [x for lang in languages for x in (F.lit(lang), F.lit(min(scale, int(scale * 1.1 * SAMPLE / counts[lang]) + 1)))]
    mark = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.length("text")), F.lit(scale))
    chosen = known.select("text", "lang", mark.alias("mark")).filter(F.col("mark") < F.create_map(*limits)[F.col("lang")])
    # rows that share id and length share a mark
    chosen = cut_rows(chosen, "lang", dict.fromkeys(languages, int(1.1 * SAMPLE)), F.xxhash64("mark", "text"))

    def crop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces = []
            for text, mark in zip(batch.column(0), batch.column(2).to_pylist()):
                raw = text.as_buffer().to_pybytes()
                rng = np.random.default_rng(mark)
                out = b""
                for k in range(CROPS):
                    size = WINDOW if k == 0 else int(rng.integers(8, WINDOW))
                    at = int(rng.integers(0, max(1, len(raw) - size + 1)))
                    out += raw[at : at + size].ljust(WINDOW + _PAD, b"\0")
                pieces.append(out)
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(2), pa.array(pieces, pa.binary())], ["lang", "mark", "pieces"])

    rows = chosen.mapInArrow(crop, "lang string, mark bigint, pieces binary").toPandas()  # about 1.1 * SAMPLE rows per language
    rows["pieces"] = rows["pieces"].map(bytes)
    rows = rows.sort_values(["lang", "mark", "pieces"], kind="stable").groupby("lang", sort=False).head(SAMPLE)
    windows = np.frombuffer(b"".join(rows["pieces"]), dtype=np.uint8).reshape(-1, WINDOW + _PAD)
    labels = np.repeat(rows["lang"].map(languages.index).to_numpy().astype(np.int64), CROPS)
    return languages, windows, labels


def identify(docs: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per document: ``doc_id``, ``lang_pred`` and ``score``.

    The network learns from rows that ``learn`` (a condition on ``doc_id``) selects and that have a language.
    """
    rows = small_batches(docs).select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    languages, windows, labels = _sample(rows, learn)
    net = train(windows, labels, languages) if languages else None
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(shared.value) if shared.value else None
        for batch in batches:
            for first, part in slices(batch.column(1)):
                known = _lettered(part) if predictor else np.zeros(len(part), bool)
                names, scores = np.full(len(part), UNKNOWN, dtype=object), np.zeros(len(part))
                if known.any():
                    p = predictor.texts(part)
                    best = p.argmax(axis=1)
                    names[known] = np.array(predictor.net.languages, dtype=object)[best[known]]
                    scores[known] = np.clip(p[np.arange(len(p)), best], 0, 1)[known]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(part)), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"]
                )

    return rows.select("doc_id", "text").mapInArrow(predict, "doc_id bigint, lang_pred string, score double")
