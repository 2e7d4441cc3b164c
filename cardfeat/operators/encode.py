"""Turning categories into numbers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardfeat.functions.scalars import joined_digits
from cardfeat.functions.stats import total
from cardfeat.operators.joins import lookup, spread_lookup
from cardfeat.operators.positions import number_by
from cardfeat.operators.skew import HOT_ROWS, SMALL_LOOKUP, is_small
from cardfeat.session import materialize

#: A table cannot have more columns than this; one-hot needs one per value.
MAX_ONE_HOT = 5_000


def dummy_name(column: str, value: object) -> str:
    return f"{column}_{value}".replace(".", "_")


def seen_values(df: DataFrame, column: str, most: int = MAX_ONE_HOT) -> list:
    """The sorted distinct values of a column that is to become one-hot."""
    values = [r[0] for r in df.select(column).dropna().distinct().limit(most + 1).collect()]
    if len(values) > most:
        raise ValueError(f"{column} has over {most} values; one-hot makes a column of each")
    return sorted(values)


def one_hot(
    df: DataFrame, domains: Mapping[str, Sequence] | Sequence[str], keep: bool = False, most: int = MAX_ONE_HOT
) -> DataFrame:
    """One 0/1 column per value; null gives 0 everywhere.

    With declared domains the plan is fixed; given only column names, the
    values are read from the data first, and more than ``most`` of them are an
    error.
    """
    if not isinstance(domains, Mapping):
        domains = {c: seen_values(df, c, most) for c in domains}
    dummies = {
        dummy_name(c, v): F.when(F.col(c) == F.lit(v), 1).otherwise(0) for c, values in domains.items() for v in values
    }
    out = df.withColumns(dummies)
    return out if keep else out.drop(*domains)


def dense_index(df: DataFrame, column: str, name: str, small: int = SMALL_LOOKUP) -> tuple[DataFrame, bool]:
    """Distinct values with their 0-based position in sorted order, and
    whether there are at most ``small`` of them.

    The values are written to the checkpoint folder, so the rows are read for
    them only once. A small set is numbered in one task. A larger one is
    range-partitioned and numbered there (:func:`number_by`); above 2^31 values
    the positions are bigint.
    """
    values = materialize(df.select(column).dropna().distinct())
    if is_small(values, small):
        return values.withColumn(name, F.row_number().over(Window.orderBy(column)) - 1), True
    indexed = number_by(values, [column], name)
    # positions fit into an int unless there are more values than ints
    return indexed.withColumn(name, F.col(name).cast("int")) if values.count() <= 1 << 31 else indexed, False


def index_column(
    df: DataFrame, column: str, name: str, small: int = SMALL_LOOKUP, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Add the dense index of a column's values; null stays null."""
    index, few = dense_index(df, column, name, small)
    if few:
        return df.join(F.broadcast(index), column, "left")
    return spread_lookup(df, index, [column], "left", hot_rows)


def sparse_one_hot(df: DataFrame, column: str, name: str | None = None, small: int = SMALL_LOOKUP) -> tuple[DataFrame, DataFrame]:
    """One sparse vector of 0 and 1 per row, however many values the column has.

    Returns the rows with the vector ``<column>_one_hot`` in place of the column, and the values
    with their position in it (in sorted order). Null gives a vector of zeros. The vector
    goes into :func:`cardfeat.operators.models.cross_validate` as one of its ``vectors``.
    """
    name = name or f"{column}_one_hot"
    position = f"_{name}_position"
    index, few = dense_index(df, column, position, small)
    many = index.count()
    placed = df.join(F.broadcast(index), column, "left") if few else spread_lookup(df, index, [column], "left")
    # Spark's encoder drops the last of the values it is told of: the one that stands for null
    told = {"ml_attr": {"type": "nominal", "num_vals": many + 1, "name": position}}
    known = F.coalesce(F.col(position), F.lit(many)).cast("double").alias(position, metadata=told)
    rest = [c for c in df.columns if c != column]
    encoder = OneHotEncoder(inputCols=[position], outputCols=[name], dropLast=True)
    placed = placed.select(*rest, known)
    return encoder.fit(placed).transform(placed).drop(position), index.withColumnRenamed(position, "position")


def label_encode(
    df: DataFrame, columns: Sequence[str], small: int = SMALL_LOOKUP, missing: str | None = None
) -> DataFrame:
    """Replace each column by the index of its text among all its values.

    Text order counts, so '10' comes before '2'. Give it train and test rows
    together. Null stays null, unless ``missing`` names a text that stands for
    it and gets a code like any other.
    """
    order = df.columns
    for c in columns:
        text = F.col(c).cast("string")
        text = text if missing is None else F.coalesce(text, F.lit(missing))
        df = index_column(df.withColumn(c, text), c, "_index", small)
        df = df.drop(c).withColumnRenamed("_index", c)
    return df.select(*order)


def combination_index(
    df: DataFrame, columns: Sequence[str], name: str = "feature_comb_index", small: int = SMALL_LOOKUP
) -> DataFrame:
    """Index of the number made of several small integers side by side."""
    coded = df.withColumn("_code", joined_digits([F.col(c) for c in columns]))
    return index_column(coded, "_code", name, small).select(*df.columns, name)


def target_means(train: DataFrame, column: str, target: Column, digits: int | None = None) -> DataFrame:
    """Mean of the target per value."""
    added = total(target.cast("double"), True, digits)
    added = added if digits is None else F.round(added, digits)
    return train.groupBy(column).agg(F.try_divide(added, F.count(target).cast("double")).alias(f"{column}_bp"))


def target_encode(df: DataFrame, train: DataFrame, columns: Sequence[str], target: Column) -> DataFrame:
    """Add ``<column>_bp``, the train mean of the target for the row's value.

    Values unseen in train get null.
    """
    order = [*df.columns, *(f"{c}_bp" for c in columns)]
    for c in columns:
        df = lookup(df, materialize(target_means(train, c, target)), [c])
    return df.select(*order)
