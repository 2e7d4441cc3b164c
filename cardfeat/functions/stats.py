"""Per-group statistics as aggregate columns.

Every statistic here has a partial form, so a group is combined on the map
side and a hot key costs one small buffer per task. Distinct counts and
medians need the values themselves and live in ``operators.rollup``.

Sums of doubles depend on the order in which tasks deliver their parts. With
``digits`` set, the whole parts and the fractions (to ``SUM_DIGITS`` decimals)
are added up apart, both as whole numbers, so that a rerun or a retried task
gives the same sum and mean to the last bit; spreads are rounded to ``digits``.
This holds while the whole parts add up to less than 2^53 (some 10^16); beyond,
a sum is right to the accuracy of doubles. Nothing overflows below 2^43 (some
10^13) terms. Infinite terms give an infinite sum, both infinities none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

Aggregate = Callable[[Column], Column]


#: Decimals kept of the terms of a stable sum.
SUM_DIGITS = 9


def _stable(value: Column, digits: int | None) -> Column:
    return value if digits is None else F.round(value, digits)


#: Bits of the low limb of a fraction: 2**43 limbs fit into a bigint.
LIMB = 20


def _exact_sum(column: Column) -> Column:
    """The sum of doubles on a grid of ``SUM_DIGITS`` decimals: the same for any order of the terms.

    Whole parts are added up as doubles, which is exact up to 2**53. What the grid has beside them is
    a whole number of units; its high and its low part are added up apart, so neither can overflow.
    """
    whole = F.rint(column)
    scale = 10.0**SUM_DIGITS
    # very large and infinite terms have nothing beside their whole part
    units = F.when(F.abs(column) < 1e15, (F.rint(column * scale) - whole * scale).cast("bigint"))
    high, low = F.sum(F.shiftright(units, LIMB)), F.sum(units.bitwiseAND(F.lit((1 << LIMB) - 1).cast("bigint")))
    # both parts are exact; together they stay so below 2**53 units, and else are one rounding off
    rest = F.coalesce(high * float(1 << LIMB) + low, F.lit(0.0))
    return F.nanvl(F.round(F.sum(whole) + rest / scale, SUM_DIGITS), F.lit(None))


def _sum(column: Column, fractional: bool, digits: int | None) -> Column:
    return F.sum(column) if not fractional or digits is None else _exact_sum(column)


def total(column: Column, fractional: bool, digits: int | None = None) -> Column:
    """Sum, 0 for a group without values."""
    zero = F.lit(0.0) if fractional else F.lit(0).cast("bigint")
    return F.coalesce(_sum(column, fractional, digits), zero)


def mean(column: Column, fractional: bool, digits: int | None = None) -> Column:
    return F.try_divide(_sum(column, fractional, digits).cast("double"), F.count(column).cast("double"))


def skew(column: Column, digits: int | None = None) -> Column:
    """Bias-corrected skew: null below three values, 0 for equal values."""
    n = F.count(column)
    size = n.cast("double")
    corrected = F.skewness(column) * F.sqrt(size * (size - 1.0)) / (size - 2.0)
    return (
        F.when(n < 3, F.lit(None).cast("double"))
        .when(F.max(column) == F.min(column), F.lit(0.0))
        .otherwise(F.nanvl(_stable(corrected, digits), F.lit(None)))
    )


def statistic(name: str, column: Column, dtype: T.DataType, digits: int | None = None) -> Column:
    """The aggregate column for a statistic's name."""
    fractional = isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType))
    if fractional:
        column = column.cast("double")
    match name:
        case "sum":
            return total(column, fractional, digits)
        case "mean":
            return mean(column, fractional, digits)
        case "min":
            return F.min(column)
        case "max":
            return F.max(column)
        case "std":
            return F.nanvl(_stable(F.stddev_samp(column), digits), F.lit(None))
        case "var":
            return F.nanvl(_stable(F.var_samp(column), digits), F.lit(None))
        case "skew":
            return skew(column, digits)
        case "ptp":
            return F.max(column) - F.min(column)
        case "count":
            return F.count(column)
    raise ValueError(f"unknown statistic {name!r}")
