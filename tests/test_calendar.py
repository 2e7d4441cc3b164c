import datetime as dt

from pyspark.sql import functions as F

from cardfeat.functions import calendar as cal
from cardfeat.plans import features as feat


def ask(spark, when, *columns):
    df = spark.createDataFrame([(when,)], "ts timestamp_ntz")
    return list(df.select(*(c.alias(str(i)) for i, c in enumerate(columns))).first())


def at(*parts):
    return dt.datetime(*parts)


def test_negative_lag_rounds_down(spark):
    ts = F.col("ts")
    got = ask(spark, at(2018, 2, 2), cal.day_lag("2018-02-01", ts), cal.month_diff("2018-02-01", ts, F.lit(1)))
    assert got == [-1, 0]


def test_holiday(spark):
    distance = cal.holiday_distance("2017-12-25", F.col("ts"))
    cases = {
        at(2017, 12, 25, 10): 0,
        at(2017, 12, 24, 10): 0,
        at(2017, 12, 23, 23, 59): 1,
        at(2017, 9, 1): 100,
        None: None,
    }
    assert {when: ask(spark, when, distance)[0] for when in cases} == cases


def test_weekdays(spark):
    columns = cal.weekday(F.col("ts")), cal.is_weekend(F.col("ts"))
    assert ask(spark, at(2024, 1, 1), *columns) == [0, 0]
    assert ask(spark, at(2024, 1, 7), *columns) == [6, 1]


def test_day_lag_is_wide(spark):
    assert ask(spark, None, cal.approximate_days(F.lit(-13).cast("tinyint"))) == [390]


def test_epoch_keeps_microseconds(spark):
    assert ask(spark, at(1970, 1, 2, 0, 0, 0, 250000), cal.epoch_seconds(F.col("ts"))) == [86400.25]


def test_bad_month_is_null(rows):
    df = rows([("2017-06",), ("garbage",), (None,)], "m string")
    assert [r[0] for r in df.select(cal.parse_month(F.col("m"))).collect()] == [dt.date(2017, 6, 1), None, None]


def test_reference_lags(rows):
    day = dt.date(2018, 3, 1)
    ddl = (
        "reference_date date, category_month_lag int, hist_purchase_date_max date, hist_purchase_date_min date, "
        "new_purchase_date_max date, new_purchase_date_min date"
    )
    row = (day, 1, dt.date(2018, 1, 20), dt.date(2017, 3, 1), dt.date(2018, 4, 30), dt.date(2018, 3, 2))
    got = feat.reference_lags(rows([row], ddl)).first()
    assert [got[f"reference_day_lag{t}"] for t in ("", "2", "3", "4")] == [40, 365, -60, -1]
    assert [got[f"reference_month_diff{t}"] for t in ("", "2", "3", "4")] == [2, 13, 2, 13]
    own = feat.reference_lags(rows([row], ddl), fixed=True).first()
    assert [own[f"reference_month_diff{t}"] for t in ("", "2", "3", "4")] == [2, 13, -1, 0]


def test_zero_divisor_gives_null(rows):
    df = feat.with_price(rows([(5.0, 0), (5.0, 2), (5.0, None)], "purchase_amount double, installments int"))
    assert [r["price"] for r in df.collect()] == [None, 2.5, None]


def test_parse_timestamp(rows):
    df = rows([("2017-06-25 15:33:07",), ("25.6.2017",), (None,)], "t string")
    got = [r[0] for r in df.select(cal.parse_timestamp(F.col("t"))).collect()]
    assert got == [dt.datetime(2017, 6, 25, 15, 33, 7), None, None]
