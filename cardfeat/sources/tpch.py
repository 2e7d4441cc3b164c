"""Card tables derived from the order tables (`lineitem orders part supplier nation customer`).

A customer plays the card, a supplier the merchant and an order line the
transaction; the purchase date decides between the history and the new period.
Every line that has an order is used. A dimension is joined only when one of
its columns is asked for; the joins are left joins on unique keys, so leaving
one out never changes the rows. No join carries a broadcast hint: part and
supplier grow with the data, so the choice stays with Spark's size statistics
and, beyond them, with adaptive skew handling.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardfeat.functions.calendar import month_number

#: First day of the new period; also the base day of every lag.
PERIOD_START = "2001-01-01"

HISTORY, NEW = "history", "new"

_PART = {"merchant_category_id", "subsector_id"}
_SUPPLIER = {"city_id", "state_id"}


#: Column types per table; declared, so that building a plan reads no footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


#: A file up to this size is one split.
ONE_SPLIT = 128 << 20


def spread(df: DataFrame, path: str, column: str) -> DataFrame:
    """Deal out the rows of a table that is a single file of one split.

    At most ``ONE_SPLIT`` bytes ever move; any larger table is left alone.
    """
    spark = df.sparkSession
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = file.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(file)
    return df.repartition(column) if status.isFile() and status.getLen() <= ONE_SPLIT else df


_c = F.col
_TRANSACTION_COLUMNS: dict[str, Callable[[], Column]] = {
    "card_id": lambda: _c("o_custkey"),
    "tx_id": lambda: F.concat_ws("-", *(_c(n).cast("string") for n in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))),
    "authorized_flag": lambda: F.when(_c("o_orderstatus") == "F", "N").otherwise("Y"),
    "category_1": lambda: F.when(_c("l_linestatus") == "O", "Y").otherwise("N"),
    "category_2": lambda: F.when(_c("l_linenumber") <= 5, _c("l_linenumber").cast("double")),
    "category_3": lambda: F.when(_c("l_discount") >= 0.095, F.lit(None).cast("string"))
    .when(_c("l_returnflag") == "A", "A")
    .when(_c("l_returnflag") == "N", "B")
    .otherwise("C"),
    "city_id": lambda: _c("s_nationkey"),
    "state_id": lambda: _c("n_regionkey"),
    "installments": lambda: F.when(_c("l_quantity") >= 50, 999).otherwise(F.floor(_c("l_quantity") / 5).cast("int") - 1),
    "merchant_category_id": lambda: _c("p_size"),
    "merchant_id": lambda: F.when(_c("l_tax") < 0.075, _c("l_suppkey")),
    "month_lag": lambda: month_number(_c("o_orderdate")) - F.lit(2000 * 12 + 12),
    "purchase_amount": lambda: (_c("l_extendedprice") - 30000) / 10000,
    "purchase_date": lambda: _c("o_orderdate"),
    "subsector_id": lambda: F.when(_c("p_size") % 10 != 0, _c("p_size") % 10),
}


def transactions(
    spark: SparkSession, sf_dir: str, period: str | None = None, columns: Iterable[str] | None = None
) -> DataFrame:
    """The transaction log, or one period of it, with the wanted columns."""
    wanted = list(columns) if columns is not None else list(_TRANSACTION_COLUMNS)
    orders = table(spark, sf_dir, "orders")
    start = F.to_timestamp_ntz(F.lit(f"{PERIOD_START} 00:00:00"))
    if period == HISTORY:
        orders = orders.filter(F.col("o_orderdate") < start)
    elif period == NEW:
        orders = orders.filter(F.col("o_orderdate") >= start)
    elif period is not None:
        raise ValueError(f"unknown period {period!r}")
    lines = spread(table(spark, sf_dir, "lineitem"), f"{sf_dir}/lineitem.parquet", "l_orderkey")
    df = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    if _PART & set(wanted):
        df = df.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    if _SUPPLIER & set(wanted):
        places = table(spark, sf_dir, "supplier").join(
            table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left"
        )
        df = df.join(places, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return df.select(*(_TRANSACTION_COLUMNS[name]().alias(name) for name in wanted))


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merchant dimension, one row per supplier."""
    df = table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"), "left"
    )
    key, balance = F.col("s_suppkey"), F.col("s_acctbal")
    letters = F.lit("ABCDE")
    columns = [
        key.alias("merchant_id"),
        (key % 7).alias("merchant_group_id"),
        (key % 40).alias("merchant_category_id"),
        (key % 9).alias("subsector_id"),
        (balance / 1000).alias("numerical_1"),
        (balance / 500).alias("numerical_2"),
        F.when(key % 2 == 0, "Y").otherwise("N").alias("category_1"),
        F.when(key % 6 != 0, (key % 6).cast("double")).alias("category_2"),
        F.when(key % 3 == 0, "Y").otherwise("N").alias("category_4"),
        letters.substr((key % 5 + 1).cast("int"), F.lit(1)).alias("most_recent_sales_range"),
        letters.substr(((key + 2) % 5 + 1).cast("int"), F.lit(1)).alias("most_recent_purchases_range"),
    ]
    for months, base, modulus in ((3, 300, 4), (6, 600, 7), (12, 1200, 13)):
        columns += [
            (balance / base).alias(f"avg_sales_lag{months}"),
            (balance / (base + 10)).alias(f"avg_purchases_lag{months}"),
            (key % modulus).cast("int").alias(f"active_months_lag{months}"),
        ]
    return df.select(*columns, F.col("s_nationkey").alias("city_id"), F.col("n_regionkey").alias("state_id"))


def cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and test cards in one table, told apart by ``split``."""
    key = F.col("c_custkey")
    month = F.concat(F.lit("19"), (95 + key % 5).cast("string"), F.lit("-0"), (1 + key % 9).cast("string"))
    return table(spark, sf_dir, "customer").select(
        key.alias("card_id"),
        F.when(key % 3 == 2, "test").otherwise("train").alias("split"),
        F.when(key % 97 != 0, month).alias("first_active_month"),
        (1 + key % 5).cast("int").alias("feature_1"),
        (1 + F.col("c_nationkey") % 3).cast("int").alias("feature_2"),
        F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), 1).otherwise(0).alias("feature_3"),
        F.when(key % 3 == 2, F.lit(None).cast("double"))
        .when(F.col("c_acctbal") < -800, F.lit(-33.219281))
        .otherwise((F.col("c_acctbal") - 4500) / 1000)
        .alias("target"),
    )


def card_reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference month and last month lag of every card with history."""
    log = transactions(spark, sf_dir, HISTORY, ["card_id", "purchase_date", "month_lag"])
    return (
        log.filter(F.col("card_id").isNotNull())
        .groupBy("card_id")
        .agg(
            F.trunc(F.max("purchase_date").cast("date"), "month").alias("reference_date"),
            F.max("month_lag").alias("category_month_lag"),
        )
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event stream as a card log; its timestamps carry a time of day."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("tx_id"),
        F.col("user_id").alias("card_id"),
        F.col("ts").alias("purchase_date"),
        F.col("value").alias("purchase_amount"),
    )
