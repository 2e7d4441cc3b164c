"""Table-level cleaning and projection."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardfeat.functions.scalars import sentinel_to_null, yes_no

#: What a missing category is filled with, and the numbers that
#: stand for a missing installment count.
CATEGORY_FILL = {"category_2": 1.0, "category_3": "A"}
INSTALLMENT_SENTINELS = (-1, 999)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Spark counts NaN as the largest number; here it means missing."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    return df.select(*(F.nanvl(c, F.lit(None)).alias(c) if c in floats else c for c in df.columns))


def encode_flags(df: DataFrame, columns: Iterable[str] = ("authorized_flag", "category_1")) -> DataFrame:
    return df.withColumns({c: yes_no(F.col(c)) for c in columns})


def fill_missing(df: DataFrame, values: dict = CATEGORY_FILL) -> DataFrame:
    return df.na.fill(values)


def clear_sentinels(
    df: DataFrame, column: str = "installments", sentinels: Sequence[int] = INSTALLMENT_SENTINELS
) -> DataFrame:
    return df.withColumn(column, sentinel_to_null(F.col(column), sentinels))


def drop_null_keys(df: DataFrame, keys: Sequence[str] = ("card_id",)) -> DataFrame:
    """Rows whose keys are all set, as plain filters that reach the scan."""
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def without(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Every column that is not on the list; unknown names are ignored."""
    dropped = set(columns)
    return df.select(*(c for c in df.columns if c not in dropped))


def columns_with(df: DataFrame, part: str, first: int | None = None) -> list[str]:
    """Columns whose name holds ``part``, optionally only the first few."""
    return [c for c in df.columns if part in c][:first]
