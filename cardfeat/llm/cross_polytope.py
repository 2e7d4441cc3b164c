"""Near-duplicate vectors by cross-polytope hashing.

A vector is turned by three rounds of random signs and a fast Hadamard transform;
its hash is the axis, with its sign, that it then lies closest to. ``k`` such hashes
name a bucket; every vector also probes the next closest buckets. Candidates are pairs
of which one has its bucket where the other has or probes it, and every candidate's
cosine is taken in double precision. A pair counts in the first table that finds it, so
links are counted without ever being listed: a comparison leaves one row per linked
vector, with its number of links and the smallest vector of its component there.

Equal vectors are one vector with a weight. Buckets of more than ``HOT`` vectors are
dealt into blocks by a hash, and pairs of blocks are compared in different tasks. The
work on a bucket grows with the square of its different vectors, as verified counts
need; rows and memory do not.

Vectors are compared if labels are equal and lengths too. Null labels (and NaN), null
or empty vectors, null, NaN or infinite components and zero vectors link with nothing:
such a row is a component of its own. Rows with a null id count as vectors but name no
component; the id of a component without any other is null. Repeated rows link with
each other. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardfeat.llm.components import components
from cardfeat.llm.simhash import forest
from cardfeat.llm.tables import SMALL_KEYS
from cardfeat.operators.joins import lookup
from cardfeat.operators.skew import broadcast_if_small
from cardfeat.session import stage

COSINE = 0.98
#: Tables, probed buckets beside a vector's own, vectors wanted in a bucket (which sets the hashes per bucket).
TABLES, PROBES, BUCKET_ROWS = 4, 2, 8
SEED = 11
#: A bucket of more vectors is cut into blocks: an eighth of it, within bounds of rows and bytes.
HOT, MAX_BLOCK, BLOCK_BYTES = 1024, 16384, 8 << 20
#: Cosines computed at a time; share of them above which masks beat lists; distance from the threshold that is looked at again.
_CELLS, _DENSE, _CLOSE = 1 << 19, 16, 1e-9

_BUCKET = ["table", "label", "dim", "code"]


def hadamard(rows: np.ndarray) -> np.ndarray:
    """The Hadamard transform of each row; their length is a power of two."""
    n, size = rows.shape
    half = 1
    while half < size:
        pairs = rows.reshape(n, size // (2 * half), 2, half)
        rows = np.stack((pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]), axis=2).reshape(n, size)
        half *= 2
    return rows / np.sqrt(size)


def scaled(rows: np.ndarray) -> np.ndarray:
    """Doubles of the same direction, brought near 1 by powers of two."""
    rows = rows.astype(np.float64)
    exponent = np.frexp(np.abs(rows).max(axis=1, initial=0))[1]
    return np.ldexp(rows, -exponent[:, None])


def unit(rows: np.ndarray) -> np.ndarray:
    rows = scaled(rows)
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def bucket_codes(rows: np.ndarray, k: int, tables: int = TABLES, probes: int = PROBES) -> np.ndarray:
    """Buckets of unit vectors, (rows, tables, 1 + probes): their own first, then the next closest; -1 for none."""
    n, dim = rows.shape
    size = 1 << max(1, (dim - 1).bit_length())
    padded = np.zeros((n, size))
    padded[:, :dim] = rows
    signs = np.random.default_rng([SEED, size]).choice([-1.0, 1.0], (tables, k, 3, size))
    near = min(size, probes + 1)
    factor = (2 * size) ** np.arange(k, dtype=np.int64)
    out = np.empty((n, tables, 1 + probes), dtype=np.int64)
    for table in range(tables):
        axes, losses = [], []
        for j in range(k):
            turned = padded
            for flip in signs[table, j]:
                turned = hadamard(turned * flip)
            height = np.abs(turned)
            best = np.argsort(-height, axis=1, kind="stable")[:, :near]
            axes.append(2 * best + (np.take_along_axis(turned, best, 1) < 0))
            top = np.take_along_axis(height, best, 1) ** 2
            losses.append(top[:, :1] - top)
        own = sum(axes[j][:, 0] * factor[j] for j in range(k))
        # other buckets differ in one hash; the least loss of closeness comes first
        loss = np.concatenate([x[:, 1:] for x in losses], axis=1)
        other = np.concatenate([own[:, None] + (axes[j][:, 1:] - axes[j][:, :1]) * factor[j] for j in range(k)], axis=1)
        order = np.argsort(loss, axis=1, kind="stable")[:, :probes]
        found = np.take_along_axis(other, order, 1)
        out[:, table, 0] = own
        out[:, table, 1 : 1 + found.shape[1]] = found
        out[:, table, 1 + found.shape[1] :] = -1  # fewer axes than probes
    return out


class Block:
    """Vectors of a bucket, those that have it as their own first."""

    def __init__(self, node, weight, own, vectors, codes):
        order = np.argsort(~own, kind="stable")
        self.node, self.weight, self.codes = node[order], weight[order], codes[order]
        self.raw = scaled(vectors[order])
        self.unit = self.raw / np.sqrt((self.raw * self.raw).sum(axis=1))[:, None]
        self.own = int(own.sum())

    def __len__(self) -> int:
        return len(self.node)


def _collide(a: np.ndarray, b: np.ndarray, table: int) -> np.ndarray:
    """Whether pairs of codes (..., table, bucket) meet in a table: own with own or own with probed."""
    a, b = a[..., table, :], b[..., table, :]
    hit = a[..., 0] == b[..., 0]
    for p in range(1, a.shape[-1]):
        hit = hit | (a[..., 0] == b[..., p]) | (b[..., 0] == a[..., p])
    return hit


def _counted_before(a: np.ndarray, b: np.ndarray, table: int, code: int) -> np.ndarray:
    """Whether the pair is counted in an earlier table, or in this one in a smaller bucket."""
    before = np.zeros(np.broadcast_shapes(a.shape[:-2], b.shape[:-2]), dtype=bool)
    for t in range(table):
        before |= _collide(a, b, t)
    a, b = a[..., table, :], b[..., table, :]
    for x, y in ((a, b), (b, a)):  # x is probed here; its own bucket is smaller and y probes it
        back = np.zeros_like(before)
        for p in range(1, x.shape[-1]):
            back |= x[..., 0] == y[..., p]
        before |= back & (x[..., 0] < code)
    return before


class Links:
    """Links among the vectors of one or two blocks of a bucket."""

    def __init__(self, blocks: list[Block], table: int, code: int, cosine: float):
        self.blocks, self.table, self.code, self.cosine = blocks, table, code, cosine
        self.shift = np.cumsum([0] + [len(b) for b in blocks])
        self.label = np.arange(self.shift[-1])
        self.count = np.zeros(self.shift[-1], dtype=np.int64)
        if len(blocks) == 1:
            self._compare(0, slice(0, blocks[0].own), 0, slice(0, len(blocks[0])), True)
        else:
            a, b = blocks
            self._compare(0, slice(0, a.own), 1, slice(0, len(b)), False)
            self._compare(0, slice(a.own, len(a)), 1, slice(0, b.own), False)

    def _compare(self, p: int, rows: slice, q: int, columns: slice, triangle: bool) -> None:
        a, b = self.blocks[p], self.blocks[q]
        width = columns.stop - columns.start
        if not width:
            return
        step = max(1, _CELLS // width)
        right, right_codes, right_weight = b.unit[columns].T, b.codes[columns], b.weight[columns]
        at_q = np.arange(columns.start, columns.stop) + self.shift[q]
        for first in range(rows.start, rows.stop, step):
            last = min(first + step, rows.stop)
            cosines = a.unit[first:last] @ right
            near = cosines >= self.cosine
            x, y = np.nonzero(np.abs(cosines - self.cosine) < _CLOSE)
            if len(x):
                u, v = a.raw[x + first], b.raw[y + columns.start]
                near[x, y] = (u * v).sum(axis=1) / (np.sqrt((u * u).sum(axis=1)) * np.sqrt((v * v).sum(axis=1))) >= self.cosine
            if triangle:
                near &= np.arange(first, last)[:, None] < at_q[None, :]
            many = np.count_nonzero(near)
            if not many:
                continue
            at_p = np.arange(first, last) + self.shift[p]
            codes = a.codes[first:last]
            if many * _DENSE > near.size:
                near &= ~_counted_before(codes[:, None], right_codes[None], self.table, self.code)
                self.count[at_p] += near @ right_weight
                self.count[at_q] += a.weight[first:last] @ near
                x, y = np.nonzero(near & (self.label[at_p][:, None] != self.label[at_q][None, :]))
            else:
                x, y = np.nonzero(near)
                fresh = ~_counted_before(codes[x], right_codes[y], self.table, self.code)
                x, y = x[fresh], y[fresh]
                np.add.at(self.count, at_p[x], right_weight[y])
                np.add.at(self.count, at_q[y], a.weight[first:last][x])
            if len(x):
                nodes = np.arange(len(self.label))
                self.label = forest(np.concatenate((nodes, at_p[x])), np.concatenate((self.label, at_q[y])), len(nodes))

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Linked vectors, the smallest place each is connected with, their numbers of links."""
        node = np.concatenate([b.node for b in self.blocks])
        linked = np.flatnonzero(self.count)
        return node[linked], node[self.label[linked]], self.count[linked]


_FOUND = "u bigint, v bigint, links bigint"


def _batch(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
    if parts:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*parts)], ["u", "v", "links"])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column, all of one length, as rows of numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _code_matrix(column: pa.Array, buckets: int) -> np.ndarray:
    codes = _matrix(column, TABLES * buckets).reshape(-1, TABLES, buckets)
    return codes.astype(np.int32) if len(codes) and codes.max() < 1 << 31 else codes


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows of equal keys, two or more; singles are left out."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = (table if rest is None else pa.concat_tables([rest, table])).combine_chunks()
        changed = np.zeros(table.num_rows - 1, dtype=bool)
        for key in keys:
            column = table[key].chunk(0)
            changed |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        edges = np.concatenate(([0], np.flatnonzero(changed) + 1, [table.num_rows]))
        wide = np.flatnonzero(np.diff(edges[:-1]) > 1)  # the last run may go on
        for k in wide:
            yield table.slice(edges[k], edges[k + 1] - edges[k])
        rest = table.slice(edges[-2])
    if rest is not None and rest.num_rows > 1:
        yield rest


def _block(run: pa.Table) -> Block:
    run = run.combine_chunks()
    column = {name: run[name].chunk(0) for name in run.column_names}
    dim = column["dim"][0].as_py()
    return Block(
        column["node"].to_numpy(), column["weight"].to_numpy(), column["own"].to_numpy(zero_copy_only=False),
        _matrix(column["embedding"], dim), _code_matrix(column["codes"], 1 + PROBES),
    )


def _within(rows: DataFrame, cosine: float) -> DataFrame:
    """Links inside buckets that fit into one comparison."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for run in _runs(batches, _BUCKET):
            if not pc.any(run["own"]).as_py():
                continue
            found = Links([_block(run)], run["table"][0].as_py(), run["code"][0].as_py(), cosine).rows()
            if len(found[0]):
                out.append(found)
                held += len(found[0])
            if held > 10_000:
                yield from _batch(out)
                out, held = [], 0
        yield from _batch(out)

    columns = [*_BUCKET, "node", "weight", "own", "embedding", "codes"]
    return rows.select(*columns).repartition(*_BUCKET).sortWithinPartitions(*_BUCKET).mapInArrow(compare, _FOUND)


def _between(rows: DataFrame, cosine: float) -> DataFrame:
    """Links inside buckets that are cut into ``blocks``: a block is packed into one row and meets all blocks of its bucket."""
    schema = rows.schema
    label, element = (schema["label"].dataType.simpleString(), schema["embedding"].dataType.simpleString())
    keys = [*_BUCKET, "blocks", "block"]
    lists = {"node": "array<bigint>", "weight": "array<bigint>", "own": "array<boolean>", "embedding": f"array<{element}>", "codes": "array<array<bigint>>"}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.Table] = []

        def packed(run: pa.Table) -> pa.RecordBatch:
            run = run.combine_chunks()
            columns = [run[k].chunk(0)[:1] for k in keys]
            for name in lists:
                values = run[name].chunk(0)
                columns.append(pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values))
            return pa.RecordBatch.from_arrays(columns, [*keys, *lists])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            changed = np.zeros(max(table.num_rows - 1, 0), dtype=bool)
            for key in keys:
                column = table[key].chunk(0) if table.num_rows else pa.array([])
                changed |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False) if len(column) > 1 else False
            edges = np.concatenate(([0], np.flatnonzero(changed) + 1, [table.num_rows]))
            for a, b in zip(edges, edges[1:]):
                run = table.slice(a, b - a)
                if rest and any(rest[-1][k][0] != run[k][0] for k in keys):
                    yield packed(pa.concat_tables(rest))
                    rest = []
                rest.append(run)
        if rest:
            yield packed(pa.concat_tables(rest))

    packed_schema = f"table int, label {label}, dim int, code bigint, blocks int, block int, " + ", ".join(f"{n} {t}" for n, t in lists.items())
    dealt = rows.select(*keys, *lists).repartition(*keys).sortWithinPartitions(*keys)
    blocks = stage(dealt.mapInArrow(pack, packed_schema), "blocks")
    other = blocks.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = [*_BUCKET, "low", "high"]
    sent = other.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})

    def one(batch: pa.RecordBatch, at: int) -> Block:
        inside = {name: batch.column(name)[at : at + 1].flatten() for name in lists}
        dim = batch.column("dim")[at].as_py()
        return Block(
            inside["node"].to_numpy(), inside["weight"].to_numpy(), inside["own"].to_numpy(zero_copy_only=False),
            _matrix(inside["embedding"], dim), _code_matrix(inside["codes"], 1 + PROBES),
        )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, first = None, None
        for batch in batches:
            for at in range(batch.num_rows):
                key = tuple(batch.column(k)[at].as_py() for k in pairs)
                block = one(batch, at)
                if key[-1] == key[-2]:
                    work = [block]
                elif key == before:
                    work = [first, block]
                else:
                    before, first = key, block
                    continue
                found = Links(work, key[0], key[3], cosine).rows()
                if len(found[0]):
                    yield from _batch([found])

    sent = sent.select(*pairs, "block", *lists).repartition(*pairs).sortWithinPartitions(*pairs, "block")
    return sent.mapInArrow(compare, _FOUND)


def _valid(dtype: T.DataType):
    label = F.col("label").isNotNull()
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        label &= ~F.isnan("label")
    finite = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    return label & F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))


def _with_codes(vectors: DataFrame, k: int) -> DataFrame:
    """The vectors with their buckets, ``codes``, of all tables."""
    kinds = {f.name: f.dataType.simpleString() for f in vectors.schema.fields}

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("embedding")
            sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
            codes = np.zeros((batch.num_rows, TABLES * (1 + PROBES)), dtype=np.int64)
            for dim in np.unique(sizes):
                at = np.flatnonzero(sizes == dim)
                codes[at] = bucket_codes(unit(_matrix(column.take(pa.array(at)), int(dim))), k).reshape(len(at), -1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(codes) + 1) * codes.shape[1], pa.int32()), pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "codes"])

    narrow = vectors.select("node", "weight", "label", "embedding")
    return narrow.mapInArrow(hashed, f"node bigint, weight bigint, label {kinds['label']}, embedding {kinds['embedding']}, codes array<bigint>")


def _memberships(coded: DataFrame) -> DataFrame:
    """A row per vector and bucket, its own (``own``) or probed."""
    buckets = coded.select("*", F.size("embedding").alias("dim"), F.posexplode("codes").alias("at", "code")).filter("code >= 0")
    table = F.floor(F.col("at") / (1 + PROBES)).cast("int")
    return buckets.withColumns({"table": table, "own": F.col("at") % (1 + PROBES) == 0}).drop("at")


def _hashes(vectors: DataFrame) -> int:
    """Hashes per bucket name, so that vectors without likes make buckets of some ``BUCKET_ROWS``."""
    n, dim = vectors.agg(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(1))).first()
    axes = 2 << max(1, (dim - 1).bit_length())
    return max(1, int(np.ceil(np.log(max(n / BUCKET_ROWS, 1)) / np.log(axes))))


def linked_vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", cosine: float = COSINE) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    rows = rows.select(F.col(f"`{key}`").cast("bigint").alias("vec_id"), F.col(f"`{label}`").alias("label"), F.col(f"`{vector}`").alias("embedding"))
    valid = _valid(rows.schema["label"].dataType)
    # equal vectors are told apart from others by 128 bits
    prints = {f"h{k}": F.when(valid, F.xxhash64(F.lit(k), "label", "embedding")) for k in range(2)}
    named = rows.withColumns(prints)
    alike = named.filter("h0 IS NOT NULL").groupBy("h0", "h1").agg(
        F.count("*").alias("weight"), F.min("vec_id").alias("least"), F.first("label").alias("label"), F.first("embedding").alias("embedding")
    )
    vectors = stage(alike.withColumn("node", F.monotonically_increasing_id()), "vectors")
    buckets = _memberships(stage(_with_codes(vectors, _hashes(vectors)), "hashed-vectors"))
    sizes = buckets.groupBy(*_BUCKET).agg(F.count("*").alias("n")).filter(F.col("n") > HOT)
    rows_of_block = F.least(F.lit(MAX_BLOCK), F.greatest(F.lit(HOT), F.col("n") / 8), F.greatest(F.lit(HOT), F.lit(BLOCK_BYTES) / (8 * F.col("dim"))))
    hot = stage(sizes.withColumn("blocks", F.ceil(F.col("n") / rows_of_block).cast("int")).drop("n"), "hot-buckets")
    if hot.isEmpty():
        found = _within(buckets, cosine)
    else:
        listed = broadcast_if_small(hot, SMALL_KEYS)
        block = F.pmod(F.xxhash64("node", F.lit(SEED)), F.col("blocks")).cast("int").alias("block")
        large = buckets.join(listed, _BUCKET).select("*", block)
        found = _within(buckets.join(listed, _BUCKET, "left_anti"), cosine).union(_between(large, cosine))
    found = stage(found, "found")

    # u is linked with v or is the smallest of its component there
    joined = components(found.filter("u != v").select("u", "v")).select(F.col("u").alias("node"), F.col("v").alias("root"))
    links = found.groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    nodes = vectors.select("h0", "h1", "node", "weight", "least").join(links, "node", "left").join(joined, "node", "left")
    nodes = stage(nodes.withColumn("root", F.coalesce("root", "node")), "nodes")
    many = nodes.filter("links IS NOT NULL").groupBy("root").agg(F.min("least").alias("component_id"))
    linked = lookup(nodes.filter("links IS NOT NULL"), stage(many, "roots"), ["root"])
    alone = nodes.filter("links IS NULL").withColumn("component_id", F.col("least"))
    of_vector = linked.unionByName(alone).select(
        "h0", "h1", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    )
    judged = lookup(named.select("vec_id", "h0", "h1"), stage(of_vector, "links"), ["h0", "h1"])
    component = F.when(F.col("h0").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return judged.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
