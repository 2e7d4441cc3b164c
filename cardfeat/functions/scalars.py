"""Row-level expressions shared by cleaning and feature building."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; a zero divisor gives null."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def value_map(column: Column, mapping: Mapping[str, int]) -> Column:
    """Replace values by a mapping; anything unmapped becomes null."""
    first, *rest = mapping.items()
    chain = F.when(column == first[0], first[1])
    for value, code in rest:
        chain = chain.when(column == value, code)
    return chain


def yes_no(column: Column) -> Column:
    return value_map(column, {"Y": 1, "N": 0})


def sentinel_to_null(column: Column, sentinels: Sequence[int]) -> Column:
    return F.when(~column.isin(*sentinels), column)


def cap(column: Column, limit: float) -> Column:
    """The smaller of value and limit; null stays null."""
    return F.when(column > limit, F.lit(limit)).otherwise(column)


def below(column: Column, threshold: float) -> Column:
    """1 below the threshold, else 0; null counts as 0."""
    return F.coalesce((column < threshold).cast("int"), F.lit(0))


def row_mean(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns) / F.lit(float(len(columns)))


def row_std(columns: Sequence[Column]) -> Column:
    """Sample standard deviation across columns of one row."""
    mean = row_mean(columns)
    squares = reduce(lambda a, b: a + b, [F.pow(c - mean, F.lit(2.0)) for c in columns])
    return F.sqrt(squares / F.lit(float(len(columns) - 1)))


def joined_digits(columns: Sequence[Column]) -> Column:
    """Write small integers side by side and read the result as one integer."""
    return F.concat(*(c.cast("int").cast("string") for c in columns)).cast("int")
