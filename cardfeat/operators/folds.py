"""Reproducible folds and out-of-fold statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardfeat.functions.stats import total
from cardfeat.operators.joins import lookup
from cardfeat.operators.positions import number_by
from cardfeat.session import materialize

SEED = 15


def fold_of(key: Column, folds: int, seed: int = SEED) -> Column:
    """Fold number from a hash of key and seed: the same on every run, whatever
    the partitioning, and free of any shuffle."""
    digest = F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(seed))))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(folds))


def add_fold(df: DataFrame, folds: int, key: str = "card_id", seed: int = SEED) -> DataFrame:
    return df.withColumn("fold", fold_of(F.col(key), folds, seed))


def add_equal_folds(df: DataFrame, folds: int, key: str = "card_id", seed: int = SEED) -> DataFrame:
    """Folds whose sizes differ by one row at most: the rank of the hashed key, modulo the folds.

    The keys are numbered by a range split of their hashes, so this costs a shuffle, which
    :func:`add_fold` does not. Every row of a table with distinct keys gets its own rank.
    """
    digest = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    ranked = number_by(df.withColumn("_hash", digest), ["_hash", key], "_rank")
    return ranked.withColumn("fold", F.pmod(F.col("_rank"), F.lit(folds))).drop("_hash", "_rank")


def out_of_fold_means(df: DataFrame, feature: str, target: str, name: str, digits: int | None = None) -> DataFrame:
    """Predict each train row by the target mean of its feature value over the
    other folds, and each test row by the mean over all folds.

    ``df`` holds a ``fold`` column; test rows have a null target. Sums per
    (value, fold) are taken once and subtracted.
    """
    rounded = (lambda c: c) if digits is None else (lambda c: F.round(c, digits))
    cell = materialize(
        df.filter(F.col(target).isNotNull())
        .groupBy(feature, "fold")
        .agg(rounded(total(F.col(target).cast("double"), True, digits)).alias("_sum"), F.count(target).alias("_n"))
    )
    whole = cell.groupBy(feature).agg(
        rounded(total(F.col("_sum"), True, digits)).alias("_all_sum"),
        F.sum("_n").alias("_all_n"),
    )
    held_out = lookup(lookup(df, whole, [feature]), cell, [feature, "fold"])
    is_train = F.col(target).isNotNull()
    top = F.when(is_train, rounded(F.col("_all_sum") - F.col("_sum"))).otherwise(F.col("_all_sum"))
    bottom = F.when(is_train, F.col("_all_n") - F.col("_n")).otherwise(F.col("_all_n"))
    return held_out.withColumn(name, F.try_divide(top, bottom.cast("double"))).select(*df.columns, name)
