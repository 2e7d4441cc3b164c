"""Keeping groups with very many rows out of per-group buffers and single tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardfeat.session import stage

#: Above this many rows a group may not be held in one buffer; a task may keep
#: some hundred such buffers at a time. It also bounds the hot keys: a log of N
#: rows has fewer than N / HOT_ROWS of them.
HOT_ROWS = 50_000
#: A lookup table of at most this many rows is sent to every executor.
SMALL_LOOKUP = 100_000
#: Hot keys carry next to nothing else, so more of them may be sent.
SMALL_KEYS = 1_000_000


#: Whatever its rows, a table that is sent has at most so many bytes, as measured on its rows.
SMALL_BYTES = 32 << 20
#: What a value takes in a row besides itself: its slot, its length and offset, padding.
_SLOT = 24


def _added(sizes: list[Column]) -> Column:
    """The sum of the sizes, added in pairs so that a wide table does not make a deep expression."""
    sizes = sizes or [F.lit(0).cast("bigint")]
    while len(sizes) > 1:
        sizes = [a + b for a, b in zip(sizes[::2], sizes[1::2])] + sizes[len(sizes) & ~1 :]
    return sizes[0]


def value_bytes(value: Column, dtype: T.DataType) -> Column:
    """About how many bytes a value takes, by its own length."""
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        size = F.octet_length(value) + _SLOT
    elif isinstance(dtype, T.StructType):
        size = _added([value_bytes(value[f.name], f.dataType) for f in dtype.fields]) + _SLOT
    elif isinstance(dtype, T.ArrayType):
        if isinstance(dtype.elementType, (T.StringType, T.BinaryType, T.StructType, T.ArrayType, T.MapType)):
            sizes = F.transform(value, lambda x: value_bytes(x, dtype.elementType))
            size = F.aggregate(sizes, F.lit(_SLOT).cast("bigint"), lambda a, x: a + x)
        else:
            size = F.size(value).cast("bigint") * 8 + _SLOT
    elif isinstance(dtype, T.MapType):
        size = value_bytes(F.map_keys(value), T.ArrayType(dtype.keyType)) + value_bytes(F.map_values(value), T.ArrayType(dtype.valueType))
    else:
        size = F.lit(16 if isinstance(dtype, T.DecimalType) else 8)
    return F.coalesce(size.cast("bigint"), F.lit(8).cast("bigint"))


def measured(table: DataFrame, rows: int = SMALL_LOOKUP) -> tuple[int, int]:
    """Rows and bytes of a table; counts no further than one row above ``rows``.

    Only the sizes of the rows travel, not the rows.
    """
    size = _added([value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in table.schema.fields])
    n, total = table.select(size.alias("size")).limit(rows + 1).agg(F.count("*"), F.sum("size")).first()
    return n, total or 0


def is_small(table: DataFrame, rows: int = SMALL_LOOKUP) -> bool:
    """Whether a table has at most ``rows`` rows and ``SMALL_BYTES`` bytes."""
    n, size = measured(table, rows)
    return n <= rows and size <= SMALL_BYTES


def sent_or_shuffled(table: DataFrame, rows: int = SMALL_LOOKUP) -> tuple[DataFrame, bool]:
    """The table with the hint that its measured size calls for, and whether it is sent.

    A table over ``SMALL_BYTES`` is kept from being sent by Spark's own guess, which does not
    look into strings and arrays.
    """
    n, size = measured(table, rows)
    if n <= rows and size <= SMALL_BYTES:
        return F.broadcast(table), True
    return (table.hint("merge") if size > SMALL_BYTES else table), False


def broadcast_if_small(table: DataFrame, rows: int = SMALL_LOOKUP) -> DataFrame:
    """The table marked for broadcast, or as it is when it has more rows or bytes."""
    return sent_or_shuffled(table, rows)[0]


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int = HOT_ROWS) -> DataFrame | None:
    """The keys with more than ``limit`` rows, or None when there are none.

    One counting job over the key columns; the counts are combined before they
    are shuffled, so hot keys do not hurt it. Keys that are found are written
    down, since several joins read them.
    """
    hot = stage(df.groupBy(*keys).count().filter(F.col("count") > limit).select(*keys), "hot-keys")
    return None if hot.isEmpty() else hot


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys and rows of hot keys; their union is ``df``."""
    listed = broadcast_if_small(hot, SMALL_KEYS)
    return df.join(listed, list(keys), "left_anti"), df.join(listed, list(keys), "left_semi")


def gathered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows with those of a key side by side, for an aggregate whose buffers are wider than its rows.

    Where a key's rows lie scattered over many tasks, an aggregate sends a buffer for nearly every
    row. Here the rows themselves move first, and a buffer per key after them. They are dealt by
    a hash of the key, not by the key, so the aggregate still combines per task: adaptive execution
    may cut the part of a hot key into several, whose buffers then meet.
    """
    return df.withColumn("_deal", F.xxhash64(*keys)).hint("rebalance", F.col("_deal")).drop("_deal")
