"""Spreads that come out the same, bit for bit, whatever the order of the rows.

Sums of squares and cubes of doubles depend on the order of their terms. Here the
order is that of the values themselves: an ordinary group is sorted and gone through
twice, once for the mean and once around it. A hot group is first counted per value,
its values are dealt out by a hash, each deal is taken like a group, and the deals
are merged in the order of their numbers. No part holds more than its share of a group.
Which way a group goes depends on its size alone; the two agree up to the last bits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPREADS = ("std", "var", "skew")
#: Deals of a hot group; a billion different values make deals of some 250,000.
DEALS = 4096
_MOMENTS = "struct<n:double,mean:double,m2:double,m3:double>"


def _struct(n: Column, mean: Column, m2: Column, m3: Column) -> Column:
    return F.struct(n.alias("n"), mean.alias("mean"), m2.alias("m2"), m3.alias("m3")).cast(_MOMENTS)


def _added(values: Column, term) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + term(x))


def moments(values: Column) -> Column:
    """Count, mean and centred sums of squares and cubes of a sorted array of (v, n)."""
    n = _added(values, lambda x: x["n"])
    first = F.struct(n.alias("n"), F.try_divide(_added(values, lambda x: x["v"] * x["n"]), n).alias("mean"))

    # `transform` over one element binds the mean, so that it is not worked out for every term
    def around(head: Column) -> Column:
        step = lambda x: x["v"] - head["mean"]
        left = F.try_divide(_added(values, lambda x: x["n"] * step(x)), head["n"])
        m2 = _added(values, lambda x: x["n"] * step(x) * step(x))
        m3 = _added(values, lambda x: x["n"] * step(x) * step(x) * step(x))
        return F.struct(head["n"].alias("n"), head["mean"].alias("mean"), left.alias("left"), m2.alias("m2"), m3.alias("m3"))

    # a mean is off by a rounding; what it leaves over is taken out of the sums around it
    def corrected(m: Column) -> Column:
        m2 = m["m2"] - m["n"] * m["left"] * m["left"]
        m3 = m["m3"] - 3.0 * m["left"] * m["m2"] + 2.0 * m["n"] * m["left"] * m["left"] * m["left"]
        return _struct(m["n"], m["mean"] + m["left"], m2, m3)

    return F.transform(F.transform(F.array(first), around), corrected)[0]


def merged(parts: Column) -> Column:
    """The moments of all parts of a non-empty sorted array of (part, moments), merged from the first to the last."""

    def join(a: Column, part: Column) -> Column:
        b = part["moments"]
        n, gap = a["n"] + b["n"], b["mean"] - a["mean"]
        mean = a["mean"] + gap * b["n"] / n
        m2 = a["m2"] + b["m2"] + gap * gap * a["n"] * b["n"] / n
        m3 = a["m3"] + b["m3"] + gap * gap * gap * a["n"] * b["n"] * (a["n"] - b["n"]) / (n * n)
        m3 = m3 + 3.0 * gap * (a["n"] * b["m2"] - b["n"] * a["m2"]) / n
        return _struct(n, mean, m2, m3)

    return F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), parts[0]["moments"], join)


def spread(stat: str, m: Column, constant: Column) -> Column:
    """Sample standard deviation, variance or corrected skew from moments; ``constant``: all values are equal."""
    n = m["n"]
    if stat == "skew":
        corrected = F.try_divide(F.sqrt(n * (n - 1.0)) * F.sqrt(n) * m["m3"], (n - 2.0) * F.pow(m["m2"], F.lit(1.5)))
        found = F.when(n < 3, F.lit(None).cast("double")).when(constant, F.lit(0.0)).otherwise(corrected)
    else:
        var = F.when(n >= 2, F.when(constant, F.lit(0.0)).otherwise(m["m2"] / (n - 1.0)))
        found = var if stat == "var" else F.sqrt(var)
    return F.nanvl(found, F.lit(None))


def _constant(column: Column) -> Column:
    return F.min(column) == F.max(column)


def of_small_groups(df: DataFrame, keys: Sequence[str], columns: dict[str, dict[str, str]]) -> DataFrame:
    """Spreads per key from its sorted values; ``columns``: column to statistic to result name."""
    held = []
    for column in columns:
        value = F.col(column).cast("double")
        held.append(F.array_sort(F.collect_list(F.when(value.isNotNull(), F.struct(value.alias("v"), F.lit(1.0).alias("n"))))).alias(f"_v_{column}"))
        held.append(_constant(value).alias(f"_c_{column}"))
    values = df.groupBy(*keys).agg(*held)
    found = values.select(*keys, *(moments(F.col(f"_v_{c}")).alias(f"_m_{c}") for c in columns), *(f"_c_{c}" for c in columns))
    return found.select(*keys, *(spread(s, F.col(f"_m_{c}"), F.col(f"_c_{c}")).alias(n) for c, names in columns.items() for s, n in names.items()))


def of_large_groups(df: DataFrame, keys: Sequence[str], column: str, names: dict[str, str], deals: int = DEALS) -> DataFrame:
    """The same of one column for keys with very many rows; a key without values has no row."""
    keys = list(keys)
    rows = df.select(*keys, F.col(column).cast("double").alias("v")).filter("v IS NOT NULL")
    cells = rows.groupBy(*keys, "v").agg(F.count("*").cast("double").alias("n"))
    deal = F.pmod(F.xxhash64("v", F.lit(17)), F.lit(deals)).alias("part")
    dealt = cells.groupBy(*keys, deal).agg(
        moments(F.array_sort(F.collect_list(F.struct("v", "n")))).alias("moments"), F.min("v").alias("low"), F.max("v").alias("high")
    )
    whole = dealt.groupBy(*keys).agg(
        merged(F.array_sort(F.collect_list(F.struct("part", "moments")))).alias("m"), (F.min("low") == F.max("high")).alias("same")
    )
    return whole.select(*keys, *(spread(s, F.col("m"), F.col("same")).alias(n) for s, n in names.items()))
