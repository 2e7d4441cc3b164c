"""Choosing the narrowest column type that holds the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Widest exponents are compared as decimals so that 64-bit limits stay exact.
_INTEGERS = ((T.ByteType(), 8), (T.ShortType(), 16), (T.IntegerType(), 32), (T.LongType(), 64))
_FLOAT_LIMIT = 3.4028234663852886e38


def _narrow_integer(low: int, high: int) -> T.DataType | None:
    for dtype, bits in _INTEGERS:
        half = 2 ** (bits - 1)
        if low > -half and high < half - 1:
            return dtype
    return None


def column_ranges(df: DataFrame) -> dict[str, tuple]:
    """Smallest and largest value of every numeric column, in one pass."""
    numeric = [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType))
    ]
    if not numeric:
        return {}
    row = df.agg(*(f(c).alias(f"{n}:{c}") for c in numeric for n, f in (("min", F.min), ("max", F.max)))).first()
    return {c: (row[f"min:{c}"], row[f"max:{c}"]) for c in numeric}


def narrowed_types(df: DataFrame, keep_double: bool = True) -> dict[str, T.DataType]:
    """The new type of every column that can be stored narrower.

    Bounds are strict on both sides, so a column that reaches the limit of a
    type moves to the next wider one. A column without values stays as it is.
    Doubles stay doubles unless ``keep_double`` is off, since a float drops
    digits that sums need.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    chosen: dict[str, T.DataType] = {}
    for name, (low, high) in column_ranges(df).items():
        if low is None:
            continue
        if isinstance(types[name], (T.FloatType, T.DoubleType)):
            if not keep_double and -_FLOAT_LIMIT < low and high < _FLOAT_LIMIT:
                chosen[name] = T.FloatType()
        elif narrow := _narrow_integer(low, high):
            chosen[name] = narrow
    return {n: t for n, t in chosen.items() if t != types[n]}


def narrow(df: DataFrame, keep_double: bool = True) -> DataFrame:
    """Cast every column to the narrowest type that holds its range."""
    return df.withColumns({n: F.col(n).cast(t) for n, t in narrowed_types(df, keep_double).items()})
