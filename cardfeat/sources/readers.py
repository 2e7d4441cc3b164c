"""Reading card tables from CSV or Parquet."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardfeat.functions.calendar import DayLike, day_lag, parse_month
from cardfeat.operators.clean import nan_to_null
from cardfeat.sources.schemas import schema

#: Fixed value: the day from which a card's age is counted.
BASE_DAY = "2018-02-01"


def read_csv(
    spark: SparkSession, path: str, types: str | T.StructType, columns: Sequence[str] | None = None, mode: str = "FAILFAST"
) -> DataFrame:
    """A CSV file with a header, read with declared types.

    ``types`` is the name of a known table, a DDL string or a struct. With
    ``columns`` only those are parsed. A field that does not fit its type, or a
    line with too few or too many, fails the read; ``mode="PERMISSIVE"`` makes
    nulls of them.
    """
    if isinstance(types, str):
        types = schema(types) if " " not in types else T.StructType.fromDDL(types)
    # the header line is checked against the schema, so names cannot slip
    df = spark.read.schema(types).csv(path, header=True, enforceSchema=False, mode=mode)
    return nan_to_null(df.select(*columns) if columns else df)


def read_csv_inferred(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """A CSV file with types guessed from a pass over it; for exploration."""
    return nan_to_null(spark.read.csv(path, header=True, inferSchema=True, mode=mode))


def read_csv_renamed(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """A CSV file whose header is replaced by the given names."""
    return read_csv_inferred(spark, path).toDF(*names)


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return nan_to_null(df.select(*columns) if columns else df)


def typed(df: DataFrame, types: str | T.StructType) -> DataFrame:
    """The columns of a declared schema, cast to its types."""
    fields = (schema(types) if " " not in types else T.StructType.fromDDL(types)) if isinstance(types, str) else types
    return nan_to_null(df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in fields)))


def capped(df: DataFrame, rows: int, order_by: Sequence[str]) -> DataFrame:
    """The first rows in a given order: a repeatable debug sample."""
    return df.orderBy(*order_by).limit(rows)


#: Rows of a head at most; they pass through the driver.
MAX_HEAD = 100_000


def read_head(read: Callable[[str], DataFrame], path: str, rows: int) -> DataFrame:
    """The first rows of a table, as its files have them, in the order of their paths.

    ``read`` makes a scan of a path, such as ``spark.read.parquet``. One file after the other is
    read from its front, and Spark opens no further split than it takes to fill the head, so the
    cost does not grow with the table. The rows themselves pass through the driver, which is why
    there is a bound. Columns that stand in folder names only are not seen.
    """
    if rows > MAX_HEAD:
        raise ValueError(f"a head has at most {MAX_HEAD} rows; take `capped` for more")
    whole, found = read(path), []
    for file in sorted(whole.inputFiles()):
        if len(found) >= rows:
            break
        found += read(unquote(file)).limit(rows - len(found)).collect()
    return whole.sparkSession.createDataFrame(found, whole.schema)


def card_profile(cards: DataFrame, base: DayLike = BASE_DAY) -> DataFrame:
    """Parse the first active month and add year, month and age in days."""
    month = F.col("first_active_month")
    parsed = cards.withColumn("first_active_month", parse_month(month))
    return parsed.withColumns({"year": F.year(month), "month": F.month(month), "elapsed_time": day_lag(base, month)})
