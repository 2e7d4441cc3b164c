"""SimHash near-duplicates: tiled exact comparison of 64-bit fingerprints.

Different fingerprints are sorted by their population counts (all 64 bits, the
upper half, the first quarter of each half) and cut into tiles. Two tiles are
compared by exclusive-or and bit counts unless the population counts of some
level differ by more than the radius everywhere, in which case no two of their
fingerprints can be linked. A comparison gives back a spanning forest of its
links rather than all pairs, so a large group of near copies stays linear.

A text without words (null, empty, white space) has fingerprint zero and is
linked like any other. Rows with a null id get a component but never name one,
unless a component has no other ids: then its id is null. Repeated rows and ids
share a fingerprint and a component. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardfeat.llm.components import components
from cardfeat.llm.tables import SMALL_KEYS, small_batches
from cardfeat.operators.joins import lookup
from cardfeat.operators.skew import broadcast_if_small
from cardfeat.session import stage

SHINGLE = 4
RADIUS = 4
SEED = 42
#: Fingerprints in a tile: a 48th of all within these bounds, so that there are enough pairs
#: of tiles for all cores and not more of them than the shuffle can carry.
MIN_TILE, MAX_TILE, TILES = 1024, 32768, 48
#: Squares of pairs of tiles, as tasks of their own; beyond so many pairs a square holds several.
SQUARES = 4096
#: Shingles that are hashed at a time, and links that are kept before they are reduced to a forest.
_CHUNK = 1 << 15
_KEPT_LINKS = 1 << 20
_CELLS = 1 << 18


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """SimHash of the word shingles of a text, as an unsigned number."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(found) - size + 1)
    first = starts[:n].tolist()
    last = ends[size - 1 :].tolist() if len(found) >= size else [len(joined)]
    digest, ones = xxhash.xxh64_digest, np.zeros(64, dtype=np.int64)
    for at in range(0, n, _CHUNK):
        raw = b"".join([digest(joined[s:e], SEED) for s, e in zip(first[at : at + _CHUNK], last[at : at + _CHUNK])])
        bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8)).reshape(-1, 64)
        whole = len(bits) // 255 * 255
        if whole:  # a byte holds the sum of 255 bits
            ones += bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        ones += bits[whole:].sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def with_fingerprints(docs: DataFrame, name: str, text: str = "text", size: int = SHINGLE) -> DataFrame:
    """The documents with a column of signed 64-bit fingerprints."""

    @F.pandas_udf("bigint")
    def hashed(texts: pd.Series) -> pd.Series:
        values = np.array([fingerprint(t, size) for t in texts], dtype=np.uint64)
        return pd.Series(values.view(np.int64))

    return small_batches(docs).withColumn(name, hashed(F.col(f"`{text}`").cast("string")))


def levels(prints: np.ndarray) -> np.ndarray:
    """Population counts of all bits, of both halves and of the four quarters, one row each."""
    quarters = [np.bitwise_count((prints >> np.uint64(s)) & np.uint64(0xFFFF)).astype(np.int32) for s in (48, 32, 16, 0)]
    a, b, c, d = quarters
    return np.stack([a + b + c + d, a + b, c + d, a, b, c, d])


def forest(u: np.ndarray, v: np.ndarray, nodes: int) -> np.ndarray:
    """The smallest node that each node is linked to."""
    label = np.arange(nodes)
    while True:
        a, b = label[u], label[v]
        open_ = a != b
        if not open_.any():
            return label
        np.minimum.at(label, np.maximum(a, b)[open_], np.minimum(a, b)[open_])
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label = jumped


def tile_links(a: np.ndarray, b: np.ndarray, radius: int, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles (or within one), as pairs of fingerprints."""
    nodes = a if same else np.concatenate((a, b))
    shift = 0 if same else len(a)
    kept_u, kept_v, size = [], [], 0
    step, width = max(1, _CELLS // 8192), 8192

    def reduce() -> None:
        nonlocal kept_u, kept_v, size
        if kept_u:
            label = forest(np.concatenate(kept_u), np.concatenate(kept_v), len(nodes))
            linked = np.flatnonzero(label != np.arange(len(nodes)))
            kept_u, kept_v, size = [linked], [label[linked]], 0

    for i in range(0, len(a), step):
        rows = a[i : i + step, None]
        for j in range(i if same else 0, len(b), width):
            near = np.bitwise_count(rows ^ b[None, j : j + width]) <= radius
            x, y = np.nonzero(near)
            x, y = x + i, y + j
            if same:
                x, y = x[y > x], y[y > x]
            if len(x):
                kept_u.append(x)
                kept_v.append(y + shift)
                size += len(x)
                if size > _KEPT_LINKS:
                    reduce()
    reduce()
    if not kept_u:
        return nodes[:0], nodes[:0]
    return nodes[kept_u[0]], nodes[kept_v[0]]


def _tiles(prints: DataFrame, radius: int) -> DataFrame:
    """Tiles (id, range of population counts per level, fingerprints) of a table of different ``fp``."""
    n = prints.count()
    size = min(max(n // TILES, MIN_TILE), MAX_TILE)
    half, part = F.shiftrightunsigned("fp", 32), F.shiftrightunsigned("fp", 48)
    third = F.shiftrightunsigned("fp", 16).bitwiseAND(F.lit(0xFFFF).cast("bigint"))
    ordered = prints.select("fp", F.bit_count("fp").alias("_p"), F.bit_count(half).alias("_h"), F.bit_count(part).alias("_q"), F.bit_count(third).alias("_r"))
    keys = ["_p", "_h", "_q", "_r", "fp"]
    ordered = ordered.repartitionByRange(max(1, -(-n // size)), *keys).sortWithinPartitions(*keys).select("fp")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 24
        rest = np.zeros(0, dtype=np.uint64)

        def tile(values: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            counts = levels(values)
            number += 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([counts.min(axis=1)], pa.list_(pa.int32())),
                    pa.array([counts.max(axis=1)], pa.list_(pa.int32())),
                    pa.array([values.tobytes()], pa.binary()),
                ],
                ["tile", "lo", "hi", "prints"],
            )

        for batch in batches:
            rest = np.concatenate((rest, np.asarray(batch.column(0)).view(np.uint64)))
            while len(rest) >= 2 * size:
                yield tile(rest[:size])
                rest = rest[size:]
        if len(rest):
            yield tile(rest)

    return stage(ordered.mapInArrow(cut, "tile bigint, lo array<int>, hi array<int>, prints binary"), "tiles")


def _pairs(tiles: DataFrame, radius: int) -> DataFrame:
    """Pairs of tiles that may hold linked fingerprints, found by an equal-key join on the bit count.

    Tiles are in the order of the bit count, so a later tile begins where an
    earlier one ends or above; it is wanted if that is at most ``radius`` above.
    """
    ranges = tiles.select("tile", "lo", "hi")
    first = ranges.select(F.col("tile").alias("a"), F.col("lo").alias("alo"), F.col("hi").alias("ahi")).withColumn(
        "key", F.explode(F.sequence(F.col("ahi")[0], F.col("ahi")[0] + radius))
    )
    second = ranges.select(F.col("tile").alias("b"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"), F.col("lo")[0].alias("key"))

    def gap(level):
        return sum((F.greatest(F.lit(0), F.col("blo")[k] - F.col("ahi")[k], F.col("alo")[k] - F.col("bhi")[k]) for k in level), F.lit(0))

    close = (gap(range(1, 3)) <= radius) & (gap(range(3, 7)) <= radius)
    other = first.join(second, "key").filter((F.col("a") < F.col("b")) & close).select("a", "b")
    return other.union(ranges.select(F.col("tile").alias("a"), F.col("tile").alias("b")))


def _cells(tiles: DataFrame, pairs: DataFrame) -> DataFrame:
    """The pairs dealt into squares of tiles: a row per square and tile in it, with the square's pairs.

    A square of G x G pairs needs 2 G tiles, so a tile travels once per row of squares, not once
    per pair. There are at least ``SQUARES`` squares if there are as many pairs.
    """
    side = max(1, int((pairs.count() / SQUARES) ** 0.5))
    number = tiles.select("tile", (F.row_number().over(Window.orderBy("tile")) - 1).alias("n"))  # a row per tile
    first, second = (number.select(F.col("tile").alias(x), F.floor(F.col("n") / side).alias(f"n{x}")) for x in "ab")
    dealt = pairs.join(F.broadcast(first), "a").join(F.broadcast(second), "b")
    squares = dealt.groupBy(F.col("na").alias("row"), F.col("nb").alias("column")).agg(F.collect_list(F.struct("a", "b")).alias("pairs"))
    needed = F.array_distinct(F.flatten(F.transform("pairs", lambda p: F.array(p["a"], p["b"]))))
    wanted = stage(squares.withColumn("tile", F.explode(needed)), "squares")
    sent = wanted.join(tiles.select("tile", "prints"), "tile")
    return sent.repartition(max(1, squares.count()), "row", "column").sortWithinPartitions("row", "column", "tile")


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (u, v) that connect all fingerprints ``fp`` at most ``radius`` bits apart."""
    tiles = _tiles(prints, radius)
    cells = _cells(tiles, stage(_pairs(tiles, radius), "pairs"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, held, pairs = None, {}, []

        def done() -> Iterator[pa.RecordBatch]:
            for pair in pairs:
                a, b = pair["a"], pair["b"]
                u, v = tile_links(held[a], held[b], radius, a == b)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        for batch in batches:
            for row, column, listed, tile, raw in zip(*(batch.column(k) for k in range(5))):
                place = row.as_py(), column.as_py()
                if place != square:
                    yield from done()
                    square, held, pairs = place, {}, listed.as_py()
                held[tile.as_py()] = np.frombuffer(raw.as_py(), dtype=np.uint64)
        yield from done()

    return cells.select("row", "column", "pairs", "tile", "prints").mapInArrow(compare, "u bigint, v bigint")


def classes(rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Each different ``fp`` of (``id``, ``fp``) with its component: a fingerprint ``root`` and the smallest id."""
    prints = stage(rows.groupBy("fp").agg(F.min("id").alias("least")), "prints")
    roots = components(links(prints, radius)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    named = stage(prints.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "named")
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    # a component may hold a third of all fingerprints
    return lookup(named, stage(smallest, "smallest"), ["root"], "inner").select("fp", "root", "component_id")


def simhash_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (hex) and ``component_id``."""
    rows = docs.select(F.col(f"`{key}`").cast("bigint").alias("id"), F.col(f"`{text}`").alias("text"))
    rows = stage(with_fingerprints(rows, "fp", size=size).select("id", "fp"), "fingerprints")
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    # one fingerprint may stand for a third of all rows, such as that of texts without words
    return lookup(rows, stage(classes(rows, radius), "classes"), ["fp"], "inner").select(F.col("id").alias("doc_id"), shown, "component_id")


def drop_near_copies(docs: DataFrame, key: str = "doc_id", size: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component, that with the smallest id (null last), with all columns.

    Of repeated rows of that id one stays, the smallest by fingerprint and then by all columns.
    """
    print_, columns = "_fingerprint", docs.columns
    while print_ in columns:
        print_ += "_"
    whole = stage(with_fingerprints(docs, print_, size=size), "printed")
    rows = whole.select(F.col(key).alias("id"), F.col(print_).alias("fp"))
    counted = rows.groupBy("id", "fp").agg(F.count("*").alias("n"))
    counted = stage(lookup(counted, stage(classes(rows, radius), "classes"), ["fp"], "inner"), "counted")
    ranked = counted.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp")).alias("best"))
    stays = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("fp") == F.col("best.fp"))
    judged = stage(lookup(counted, stage(ranked, "ranked"), ["root"], "inner").select("id", "fp", "n", stays.alias("stays")), "judged")

    def listed(some: DataFrame):
        keys = broadcast_if_small(some.select(F.col("id").alias("_id"), F.col("fp").alias("_fp")), SMALL_KEYS)
        return keys, whole[key].eqNullSafe(keys["_id"]) & (whole[print_] == keys["_fp"])

    kept = whole.join(*listed(judged.filter("NOT stays OR n > 1")), "left_anti").select(*columns)
    twice = judged.filter("stays AND n > 1")
    if twice.isEmpty():
        return kept
    again = whole.join(*listed(twice), "left_semi")
    one = again.groupBy(key, print_).agg(F.min(F.struct(*columns)).alias("_row")).select("_row.*")
    return kept.unionByName(one)
