"""Exact quantiles with linear interpolation that no single task has to hold.

Spark's ``percentile`` keeps every distinct value of a group in one buffer.
Here passes over the column narrow down the wanted ranks:

1. rows are counted per (group, bucket), buckets being ordered ranges of
   values; combined on the map side, this shuffles next to nothing;
2. running counts over the buckets tell which buckets hold a wanted rank;
3. a bucket with more than ``CELL_ROWS`` rows is cut into equal parts between
   its own smallest and largest value, and so on until none is larger or all
   its values are equal;
4. only rows of the last cells are counted by value and ordered.

The result does not depend on how well the buckets fit the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardfeat.operators.clean import drop_null_keys, nan_to_null
from cardfeat.operators.skew import SMALL_LOOKUP, broadcast_if_small
from cardfeat.session import stage

# Buckets per e-fold of the absolute value. Even values within a few percent of
# each other (times, ids) spread over many; a group never has more than this times
# the e-folds it spans.
_STEPS = 16384
_UNIT = 1e9  # values below 1 / _UNIT share the bucket around zero


#: Rows that one task may order, and the parts into which a larger cell is cut.
CELL_ROWS = 100_000
_PARTS = 4096


def _bucket(value: Column) -> Column:
    """A non-decreasing whole-number function of a double."""
    large = F.lit(float(1 << 62))
    place = F.signum(value) * F.log1p(F.abs(value) * _UNIT) * _STEPS
    return F.floor(F.greatest(F.least(place, large), -large))


def _counted(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, smallest and largest value of every cell."""
    value = F.col("_value")
    return rows.groupBy(*keys, "_cell").agg(
        F.count(F.lit(1)).alias("_size"), F.min(value).alias("_low"), F.max(value).alias("_high")
    )


def _first_ranks(rows: DataFrame, keys: Sequence[str], probabilities: Sequence[float]) -> DataFrame:
    """The cells of the wanted ranks, and each rank inside its cell."""
    group = Window.partitionBy(*keys)
    running = group.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    placed = _counted(rows, keys).withColumns(
        {"_end": F.sum("_size").over(running), "_total": F.sum("_size").over(group)}
    )
    position = [F.lit(float(p)) * (F.col("_total") - 1).cast("double") for p in probabilities]
    wanted = F.array(
        *(
            F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"), rank.alias("rank"), (h - F.floor(h)).alias("part"))
            for i, h in enumerate(position)
            for side, rank in (("low", F.floor(h)), ("high", F.ceil(h)))
        )
    )
    start = F.col("_end") - F.col("_size")
    inside = F.filter(wanted, lambda w: (w["rank"] >= start) & (w["rank"] < F.col("_end")))
    found = placed.select(*keys, "_cell", "_size", "_low", "_high", start.alias("_start"), F.explode(inside).alias("w"))
    rank = (F.col("w.rank") - F.col("_start")).alias("_rank")
    return found.select(*keys, "_cell", "_size", "_low", "_high", "w.i", "w.side", "w.part", rank)


def _too_large() -> Column:
    return (F.col("_size") > CELL_ROWS) & (F.col("_low") < F.col("_high"))


def _narrowed(rows: DataFrame, ranks: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows and ranks with every cell that is too large cut into parts; other rows are dropped."""
    cells = broadcast_if_small(ranks.select(*keys, "_cell", "_size", "_low", "_high").distinct(), SMALL_LOOKUP)
    # halves, since the whole range may be more than the largest double
    width = F.col("_high") / 2 - F.col("_low") / 2
    share = (F.col("_value") / 2 - F.col("_low") / 2) / width
    part = F.when(_too_large(), F.least(F.floor(share * _PARTS), F.lit(_PARTS - 1))).otherwise(F.lit(0).cast("bigint"))
    # infinite ends: the finite values form one part between them
    part = F.when(F.isnan(share) | F.isnan(width), F.lit(_PARTS // 2).cast("bigint")).otherwise(part)
    part = F.when(F.col("_value") == F.col("_low"), F.lit(-1).cast("bigint")).otherwise(part)
    part = F.when(F.col("_value") == F.col("_high"), F.lit(_PARTS).cast("bigint")).otherwise(part)
    part = F.when(_too_large(), part).otherwise(F.lit(0).cast("bigint"))
    rows = stage(rows.join(cells, [*keys, "_cell"]).select(*keys, "_value", F.concat("_cell", F.array(part)).alias("_cell")), "cells")
    parent = F.slice("_cell", 1, F.size("_cell") - 1)
    order = Window.partitionBy(*keys, "_parent").orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)
    placed = _counted(rows, keys).withColumn("_parent", parent).withColumn("_end", F.sum("_size").over(order))
    old = ranks.select(*keys, F.col("_cell").alias("_parent"), "i", "side", "part", F.col("_rank").alias("_in_parent"))
    start = F.col("_end") - F.col("_size")
    found = placed.join(old, [*keys, "_parent"]).filter((F.col("_in_parent") >= start) & (F.col("_in_parent") < F.col("_end")))
    rank = (F.col("_in_parent") - start).alias("_rank")
    return rows, found.select(*keys, "_cell", "_size", "_low", "_high", "i", "side", "part", rank)


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float], digits: int | None = None
) -> DataFrame:
    """One row per group with an array ``quantiles``, in the order asked for.

    Null keys, null values and NaN are left out; a group without values has no
    row. ``digits`` rounds the interpolated values: a rank a hair below a whole
    number then still gives the number itself.
    """
    keys = list(keys)
    v = F.col("_value")
    rows = nan_to_null(drop_null_keys(df, keys).select(*keys, F.col(value).cast("double").alias("_value")))
    rows = rows.filter(v.isNotNull()).withColumn("_cell", F.array(_bucket(v)))
    ranks = stage(_first_ranks(rows, keys, probabilities), "ranks")
    while not ranks.filter(_too_large()).isEmpty():
        rows, ranks = _narrowed(rows, ranks, keys)
        ranks = stage(ranks, "ranks")
    cell = [*keys, "_cell"]
    ordered = Window.partitionBy(*cell).orderBy("_value").rowsBetween(Window.unboundedPreceding, 0)
    inside = (
        rows.join(broadcast_if_small(ranks.select(*cell).distinct(), SMALL_LOOKUP), cell, "left_semi")
        .groupBy(*cell, "_value")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_upto", F.sum("_rows").over(ordered))
    )
    holds_rank = (F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_rows"))
    found = inside.join(ranks.drop("_size", "_low", "_high"), cell).filter(holds_rank)
    pieces = []
    for i in range(len(probabilities)):
        mine = F.col("i") == i
        low = F.max(F.when(mine & (F.col("side") == "low"), F.col("_value")))
        high = F.max(F.when(mine & (F.col("side") == "high"), F.col("_value")))
        part = F.max(F.when(mine, F.col("part")))
        between = F.when(low == high, low).otherwise(low + (high - low) * part)
        pieces.append(between if digits is None else F.round(between, digits))
    return found.groupBy(*keys).agg(F.array(*pieces).alias("quantiles"))


def table_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: Sequence[str] = (),
    digits: int | None = None,
) -> DataFrame:
    """Quantiles of several columns: rows ``(by…, metric, quantiles)``."""
    long = df.select(
        *by,
        F.explode(
            F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns))
        ).alias("cell"),
    ).select(*by, "cell.metric", "cell.value")
    return exact_quantiles(long, [*by, "metric"], "value", probabilities, digits)
