"""Declarative per-key rollups.

A :class:`Rollup` says which statistics of which columns to take; the result
has one column ``<prefix><column>_<statistic>`` for each. One aggregate does all
statistics that combine on the map side, another one those that need a group's
values, so the rows are read twice at most. Rows with a null key belong to no
group; NaN counts as missing.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardfeat.functions.scalars import ratio
from cardfeat.functions.stats import SUM_DIGITS, Aggregate, statistic
from cardfeat.operators.clean import drop_null_keys, nan_to_null
from cardfeat.operators.quantiles import exact_quantiles
from cardfeat.operators.skew import HOT_ROWS, split_hot
from cardfeat.operators.spreads import SPREADS, of_large_groups, of_small_groups
from cardfeat.session import stage

DISTINCT, MEDIAN = "nunique", "median"


@dataclass(frozen=True)
class Measure:
    """One statistic of one column; ``custom`` is a user-supplied aggregate."""

    column: str
    stat: str
    custom: Aggregate | None = field(default=None, compare=False)


@dataclass(frozen=True)
class Rollup:
    """``repeatable`` takes std, var and skew from each group's values in their order, not from
    sums in the order of the tasks: slower, but equal bits on every run without any rounding."""

    prefix: str
    measures: tuple[Measure, ...]
    size: str | None = None
    digits: int | None = None
    repeatable: bool = False

    def name(self, measure: Measure) -> str:
        return f"{self.prefix}{measure.column}_{measure.stat}"

    @property
    def columns(self) -> list[str]:
        return [self.size] * bool(self.size) + [self.name(m) for m in self.measures]

    def with_prefix(self, prefix: str, size: str | None = None) -> Rollup:
        return replace(self, prefix=prefix, size=size)


def take(stats: str, *columns: str) -> tuple[Measure, ...]:
    """The named statistics (separated by blanks) of every given column."""
    return tuple(Measure(c, s) for c in columns for s in stats.split())


def custom(name: str, column: str, aggregate: Aggregate) -> Measure:
    return Measure(column, name, aggregate)


def held_stats(spec: Rollup) -> tuple[str, ...]:
    """Statistics that need the values of a group."""
    return (DISTINCT, MEDIAN, *(SPREADS if spec.repeatable else ()))


def _spread_columns(spec: Rollup) -> dict[str, dict[str, str]]:
    """Column to statistic to result name."""
    found: dict[str, dict[str, str]] = {}
    for m in spec.measures:
        if spec.repeatable and m.stat in SPREADS and m.custom is None:
            found.setdefault(m.column, {})[m.stat] = spec.name(m)
    return found


def _mergeable(df: DataFrame, spec: Rollup) -> list[Column]:
    """Aggregates that combine on the map side."""
    types = {f.name: f.dataType for f in df.schema.fields}
    columns = [F.count(F.lit(1)).alias(spec.size)] if spec.size else []
    for m in spec.measures:
        if m.stat in held_stats(spec) and m.custom is None:
            continue
        made = m.custom(F.col(m.column)) if m.custom else statistic(m.stat, F.col(m.column), types[m.column], spec.digits)
        columns.append(made.alias(spec.name(m)))
    return columns


def _held(spec: Rollup, stat: str) -> list[Measure]:
    return [m for m in spec.measures if m.stat == stat and m.custom is None]


def _joined(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Aggregates over the same keys, side by side; their partitioning is reused."""
    return reduce(lambda a, b: a.join(b, list(keys), "left"), parts)


def _small_groups(df: DataFrame, spec: Rollup, keys: Sequence[str]) -> DataFrame:
    """Distinct counts and medians from buffers that hold a group's values.

    They get an aggregate of their own over their own few columns: Spark sorts
    the rows of such an aggregate, and next to it the others would lose their
    generated code.
    """
    held = [F.size(F.collect_set(m.column)).cast("bigint").alias(spec.name(m)) for m in _held(spec, DISTINCT)]
    middle = (lambda c: F.median(c)) if spec.digits is None else (lambda c: F.round(F.median(c), SUM_DIGITS))
    held += [middle(m.column).alias(spec.name(m)) for m in _held(spec, MEDIAN)]
    parts = [df.groupBy(*keys).agg(*held)] if held else []
    if spreads := _spread_columns(spec):
        parts.append(of_small_groups(df, keys, spreads))
    return _joined(parts, keys)


def _distinct_counts(df: DataFrame, keys: Sequence[str], names: dict[str, str]) -> DataFrame:
    """Distinct values per key; ``names``: column to result name.

    One aggregate over all columns would hold a row as wide as all of them for every value of
    each. Here the rows are written once and every column is read back on its own, so a task
    holds pairs of key and value of one column. Their counts travel as rows, since a join of
    the columns' counts would hold those of all columns in one task.
    """
    keys = list(keys)
    rows = stage(df.select(*keys, *(c for c in names if c not in keys)), "distinct") if len(names) > 1 else df
    pairs = [rows.select(*keys, F.col(c).alias("_value")).distinct() for c in names]
    marked = [p.select(*keys, F.lit(k).alias("_which"), F.col("_value").isNotNull().alias("_is")) for k, p in enumerate(pairs)]
    counted = reduce(DataFrame.unionByName, marked).groupBy(*keys, "_which").agg(F.count_if("_is").alias("_n"))
    return counted.groupBy(*keys).agg(*(F.max(F.when(F.col("_which") == k, F.col("_n"))).alias(n) for k, n in enumerate(names.values())))


def _large_groups(df: DataFrame, spec: Rollup, keys: Sequence[str]) -> DataFrame:
    """Distinct counts and medians spread over (key, value) before they meet."""
    keys = list(keys)
    distinct = {m.column: spec.name(m) for m in _held(spec, DISTINCT)}
    parts = [_distinct_counts(df, keys, distinct)] if distinct else []
    for m in _held(spec, MEDIAN):
        digits = None if spec.digits is None else SUM_DIGITS
        found = exact_quantiles(df, keys, m.column, [0.5], digits).select(*keys, F.col("quantiles")[0].alias(spec.name(m)))
        if not parts:
            parts.append(df.select(*keys).distinct())
        parts.append(found)
    for column, names in _spread_columns(spec).items():
        if not parts:
            parts.append(df.select(*keys).distinct())
        parts.append(of_large_groups(df, keys, column, names))
    return _joined(parts, keys)


def roll_up(
    df: DataFrame,
    spec: Rollup,
    keys: Sequence[str] = ("card_id",),
    hot_rows: int = HOT_ROWS,
    share: str | None = None,
) -> DataFrame:
    """Apply ``spec`` per key.

    Specs with distinct counts, medians or repeatable spreads first take all other statistics and
    the rows of each key, and write them down; keys with more than ``hot_rows``
    rows, if any, then take the spread-out way for the rest. Both ways give the
    same.

    ``share`` names two more columns: ``<share>_mean``, the key's part of all
    rows, those without a key included, and ``<share>_sum``, that times its rows.
    """
    keys = list(keys)
    needed = list(dict.fromkeys([*keys, *(m.column for m in spec.measures)]))
    df = nan_to_null(df.select(*needed))
    keyed = drop_null_keys(df, keys)
    order = [*keys, *spec.columns]
    held = [spec.name(m) for s in held_stats(spec) for m in _held(spec, s)]
    if not held and not share:
        return keyed.groupBy(*keys).agg(*_mergeable(df, spec)).select(*order)
    rows = "_rows"
    base = stage((df if share else keyed).groupBy(*keys).agg(*_mergeable(df, spec), F.count(F.lit(1)).alias(rows)), "rollup")
    if share:
        part = ratio(F.col(rows), base.agg(F.sum(rows)).scalar())
        order += [f"{share}_mean", f"{share}_sum"]
        base = drop_null_keys(base, keys).withColumn(f"{share}_mean", part)
        base = base.withColumn(f"{share}_sum", F.col(f"{share}_mean") * F.col(rows))
    if not held:
        return base.select(*order)
    hot = base.filter(F.col(rows) > hot_rows).select(*keys)
    if hot.isEmpty():
        return base.join(_small_groups(keyed, spec, keys), keys, "left").select(*order)
    ordinary, large = split_hot(keyed, keys, hot)
    found = [part(rows_, spec, keys).select(*keys, *held) for part, rows_ in ((_small_groups, ordinary), (_large_groups, large))]
    return base.join(found[0].unionByName(found[1]), keys, "left").select(*order)


def two_level(
    df: DataFrame,
    key: str,
    group: str,
    inner: Iterable[Measure],
    outer: str,
    digits: int | None = None,
    with_group: bool = False,
) -> DataFrame:
    """Statistics per (key, group), then statistics of those per key.

    Columns are named ``<column>_<inner>_<outer>``. ``with_group`` also takes
    the outer statistics of the grouping column itself. Null groups are left
    out.
    """
    first = roll_up(df, Rollup("", tuple(inner), digits=digits), [key, group])
    fields = [f for f in first.schema.fields if f.name != key and (with_group or f.name != group)]
    return first.groupBy(key).agg(
        *(statistic(s, F.col(f.name), f.dataType, digits).alias(f"{f.name}_{s}") for f in fields for s in outer.split())
    )


def successive_means(
    df: DataFrame, pairs: Sequence[tuple[str, str]], key: str = "card_id", digits: int | None = None
) -> DataFrame:
    """Mean of ``value`` per (key, group), then mean, min, max and std per key,
    for several (group, value) pairs over one scan.

    All groupings share one scan and one shuffle. A key counts when its first
    grouping has a value; later pairs may be null.
    """
    groups = list(dict.fromkeys(g for g, _ in pairs))
    values = list(dict.fromkeys(v for _, v in pairs))
    types = {f.name: f.dataType for f in df.schema.fields}
    # one copy of a row per grouping; the value columns travel untouched
    copies = F.array(
        *(F.struct(F.lit(i).alias("which"), F.col(g).cast("string").alias("group")) for i, g in enumerate(groups))
    )
    long = (
        drop_null_keys(df, [key])
        .select(key, *values, F.explode(copies).alias("copy"))
        .select(key, "copy.which", "copy.group", *values)
        .filter(F.col("group").isNotNull())
    )
    means = [statistic("mean", F.col(v), types[v], digits).alias(v) for v in values]
    first = long.groupBy(key, "which", "group").agg(*means)
    columns = []
    for group, value in pairs:
        mine = F.when(F.col("which") == groups.index(group), F.col(value))
        for stat in ("mean", "min", "max", "std"):
            columns.append(statistic(stat, mine, T.DoubleType(), digits).alias(f"{group}_{value}_{stat}"))
    base = F.max((F.col("which") == 0).cast("int")).alias("_base")
    return first.groupBy(key).agg(*columns, base).filter(F.col("_base") == 1).drop("_base")


def mean_of_group_means(
    df: DataFrame, key: str, group: str, value: str, prefix: str, digits: int | None = None
) -> DataFrame:
    """Average of a key's per-group means, and that average divided by the
    number of groups whose mean is not zero. Null groups are left out; a group
    without values counts as a mean of 0.
    """
    first = roll_up(df, Rollup("", take("mean", value), digits=digits), [key, group])
    m = F.coalesce(F.col(f"{value}_mean"), F.lit(0.0))
    average = statistic("mean", m, T.DoubleType(), digits)
    out = first.groupBy(key).agg(average.alias(f"{prefix}sum_cal"), F.count_if(m != 0).alias("_nonzero"))
    return out.withColumn(f"{prefix}mean_cal", ratio(F.col(f"{prefix}sum_cal"), F.col("_nonzero"))).drop("_nonzero")
