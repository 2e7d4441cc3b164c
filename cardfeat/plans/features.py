"""Feature columns: per transaction before a rollup, per card after it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardfeat.functions import calendar as cal
from cardfeat.functions.scalars import ratio, row_std
from cardfeat.operators.clean import clear_sentinels, encode_flags, fill_missing
from cardfeat.operators.encode import one_hot
from cardfeat.operators.joins import enrich
from cardfeat.operators.rollup import Rollup, roll_up
from cardfeat.operators.skew import gathered
from cardfeat.plans import specs
from cardfeat.sources.readers import BASE_DAY

#: Fixed value: the later base day of the duration rollups.
LATE_BASE_DAY = "2018-04-30"


# ---- per transaction -------------------------------------------------------


def coded(log: DataFrame) -> DataFrame:
    """Flags as 0/1, categories one-hot, the purchase time in seconds."""
    df = one_hot(encode_flags(log), specs.DOMAINS)
    return df.withColumn("purchase_epoch", cal.epoch_seconds(F.col("purchase_date")))


def with_lags(df: DataFrame, base: cal.DayLike = BASE_DAY) -> DataFrame:
    ts, lag = F.col("purchase_date"), F.col("month_lag")
    return df.withColumns(
        {
            "purchase_date2": ts,
            "day_lag": cal.approximate_days(lag),
            "purchase_day_lag": cal.day_lag(base, ts),
            "month_diff": cal.month_diff(base, ts, lag),
            "trans_dayofweek": cal.weekday(ts),
            "purchase_day_dayofmonth": F.dayofmonth(ts),
            "purchase_day_month": cal.shifted_month(ts, lag),
        }
    )


def with_calendar(df: DataFrame) -> DataFrame:
    ts = F.col("purchase_date")
    return df.withColumns(
        {
            "month": F.month(ts),
            "day": F.dayofmonth(ts),
            "weekofyear": F.weekofyear(ts),
            "weekday": cal.weekday(ts),
            "weekend": cal.is_weekend(ts),
        }
    )


def with_duration(df: DataFrame, base: cal.DayLike | None = None) -> DataFrame:
    """Amount times and over the months passed; with ``base`` these are counted anew."""
    if base is not None:
        df = df.withColumn("month_diff", cal.month_diff(base, F.col("purchase_date"), F.col("month_lag")))
    amount, months = F.col("purchase_amount"), F.col("month_diff")
    return df.withColumns({"duration": amount * months, "amount_month_ratio": ratio(amount, months)})


def with_price(df: DataFrame) -> DataFrame:
    return df.withColumn("price", ratio(F.col("purchase_amount"), F.col("installments")))


def with_holidays(df: DataFrame, holidays: Mapping[str, str] = specs.HOLIDAYS, period: int = 100) -> DataFrame:
    ts = F.col("purchase_date")
    return df.withColumns({name: cal.holiday_distance(day, ts, period) for name, day in holidays.items()})


# ---- rollups with their own preparation ------------------------------------


def basic_rollup(log: DataFrame, prefix: str, digits: int | None = None) -> DataFrame:
    return roll_up(coded(log), specs.basic(prefix, digits))


def notebook_rollup(log: DataFrame, spec: Rollup) -> DataFrame:
    flagged = encode_flags(log, ["authorized_flag"])
    return roll_up(flagged.withColumn("purchase_epoch", cal.epoch_seconds(F.col("purchase_date"))), spec)


def merchant_rollup(
    log: DataFrame, merchants: DataFrame, base: cal.DayLike = BASE_DAY, digits: int | None = None
) -> DataFrame:
    joined = enrich(log, merchants, "merchant_id")
    ready = one_hot(coded(joined), specs.MERCHANT_DOMAINS).withColumn(
        "purchase_day_lag", cal.day_lag(base, F.col("purchase_date"))
    )
    return roll_up(ready, specs.merchant_new(digits), share="new_card_percentage")


def share_rollup(log: DataFrame, base: cal.DayLike = BASE_DAY, digits: int | None = None) -> DataFrame:
    ready = coded(gathered(log, ["card_id"])).withColumn("purchase_day_lag", cal.day_lag(base, F.col("purchase_date")))
    return roll_up(ready, specs.share_hist(digits), share="history_card_percentage")


def lag_rates(rolled: DataFrame, prefix: str, with_amount_rate: bool = False) -> DataFrame:
    """Days between first and last purchase, distinct days among them, and
    optionally the mean amount per second of the span."""
    lag = f"{prefix}purchase_day_lag"
    out = rolled.withColumn(f"{lag}_elapse", F.col(f"{lag}_max") - F.col(f"{lag}_min") + 1)
    out = out.withColumn(f"{lag}_rate", ratio(F.col(f"{lag}_nunique"), F.col(f"{lag}_elapse")))
    if with_amount_rate:
        rate = ratio(F.col(f"{prefix}purchase_amount_mean"), F.col(f"{prefix}purchase_epoch_ptp"))
        out = out.withColumn(f"{prefix}purchase_amount_mean_time_rate", rate)
    return out


def full_new_rollup(log: DataFrame, base: cal.DayLike = BASE_DAY, digits: int | None = None) -> DataFrame:
    rolled = roll_up(with_lags(coded(gathered(log, ["card_id"])), base), specs.full_new(digits))
    return lag_rates(rolled, "new_", with_amount_rate=True)


def full_hist_rollup(
    log: DataFrame,
    base: cal.DayLike = BASE_DAY,
    holidays: Mapping[str, str] = specs.HOLIDAYS,
    rolled_holidays: Sequence[str] = specs.ROLLED_HOLIDAYS,
    digits: int | None = None,
) -> DataFrame:
    """The widest history rollup: categories filled, sentinels cleared, then
    lags, calendar, price, holiday and duration columns."""
    cleaned = clear_sentinels(fill_missing(gathered(log, ["card_id"])))
    df = with_calendar(with_lags(coded(cleaned), base))
    df = with_holidays(with_duration(with_price(df)), holidays)
    return lag_rates(roll_up(df, specs.full_hist(digits, tuple(rolled_holidays))), "hist_")


def authorized_rollup(log: DataFrame, spec: Rollup, prefix: str = "hist") -> DataFrame:
    """The same spec over authorized and over unauthorized rows, side by side.

    The log is grouped once by card and flag; the two rows a card may have then
    become columns ``<prefix>auth_*`` and ``<prefix>unauth_*``. A card without
    rows of one kind has nulls there.
    """
    plain = spec.with_prefix("", spec.size and "card_id_size")
    rolled = roll_up(log, plain, ["card_id", "authorized_flag"])
    return rolled.groupBy("card_id").agg(
        *(
            F.max(F.when(F.col("authorized_flag") == flag, F.col(c))).alias(f"{prefix}{tag}_{c}")
            for flag, tag in ((1, "auth"), (0, "unauth"))
            for c in plain.columns
        )
    )


# ---- per card --------------------------------------------------------------


def amount_time_average(df: DataFrame) -> DataFrame:
    rate = ratio(F.col("hist_purchase_amount_max"), F.col("hist_purchase_day_lag_min"))
    return df.withColumn("purchase_amount_time_average", rate)


def cross_period(df: DataFrame, hist: str = "hist_", new: str = "new_", prefix: str = "au_") -> DataFrame:
    """Eighteen combinations of a card's two periods.

    ``total``, ``mean``, ``max`` and ``min`` are plain sums of the two periods'
    figures, so a ``*_mean`` is the sum of two means.
    """

    def both(figure: str):
        return F.col(f"{new}{figure}") + F.col(f"{hist}{figure}")

    def new_over_hist(figure: str):
        return ratio(F.col(f"{new}{figure}"), F.col(f"{hist}{figure}"))

    sums = {
        "purchase_amount_total": "purchase_amount_sum",
        "installments_total": "installments_sum",
        **{
            f: f
            for f in (
                "purchase_amount_mean", "purchase_amount_max", "purchase_amount_min",
                "installments_mean", "installments_max", "month_diff_mean",
                "month_lag_mean", "month_lag_max", "month_lag_min", "category_1_mean",
            )
        },
    }
    ratios = {
        "purchase_amount_ratio": "purchase_amount_sum",
        "installments_ratio": "installments_sum",
        "month_diff_ratio": "month_diff_mean",
    }
    out = df.withColumns(
        {f"{prefix}{n}": both(f) for n, f in sums.items()} | {f"{prefix}{n}": new_over_hist(f) for n, f in ratios.items()}
    )
    return out.withColumns(
        {
            f"{prefix}price_{kind}": ratio(
                F.col(f"{prefix}purchase_amount_{kind}"), F.col(f"{prefix}installments_{kind}")
            )
            for kind in ("total", "mean", "max")
        }
    )


def buy_offsets(df: DataFrame, new: str = "n_", hist: str = "h_") -> DataFrame:
    """Whole days from a card's first active month to its first and last purchase."""
    start = F.col("first_active_month")
    return df.withColumns(
        {
            f"{p}{name}_buy": cal.whole_days(F.col(f"{p}purchase_date_{end}"), start)
            for p in (new, hist)
            for name, end in (("first", "min"), ("last", "max"))
        }
    )


def feature_summary(df: DataFrame, features: Sequence[str] = ("feature_1", "feature_2", "feature_3")) -> DataFrame:
    """Sum and mean of the encoded features; largest, smallest and standard
    deviation of the raw ones (the last is named ``feature_var``)."""
    raw = [F.col(c) for c in features]
    total = F.col(f"{features[0]}_bp")
    for c in features[1:]:
        total = total + F.col(f"{c}_bp")
    return df.withColumns(
        {
            "feature_sum": total,
            "feature_mean": total / F.lit(float(len(features))),
            "feature_max": F.greatest(*raw),
            "feature_min": F.least(*raw),
            "feature_var": row_std([c.cast("double") for c in raw]),
        }
    )


def reference_lags(df: DataFrame, fixed: bool = False) -> DataFrame:
    """Days and months from a card's last and first purchases to its reference date.

    The published formulas take the months of the third and fourth lag from the
    first and second; ``fixed`` uses their own.
    """
    sources = ["hist_purchase_date_max", "hist_purchase_date_min", "new_purchase_date_max", "new_purchase_date_min"]
    tags = ["", "2", "3", "4"]
    lags = {t: cal.day_lag(F.col("reference_date"), F.col(s)) for t, s in zip(tags, sources)}
    out = df.withColumns({f"reference_day_lag{t}": lag for t, lag in lags.items()})
    months_from = dict(zip(tags, tags if fixed else ["", "2", "", "2"]))
    return out.withColumns(
        {
            f"reference_month_diff{t}": cal.floor_months(F.col(f"reference_day_lag{s}")) + F.col("category_month_lag")
            for t, s in months_from.items()
        }
    )


def average_gaps(df: DataFrame) -> DataFrame:
    """Days between purchases, new-to-history ratios of value and frequency,
    and ratio and product of the two periods' values."""
    span = lambda p: cal.whole_days(F.col(f"{p}purchase_date_max"), F.col(f"{p}purchase_date_min"))
    out = df.withColumns({f"{p}purchase_date_diff": span(p) for p in ("hist_", "new_")})
    value_new, value_hist = F.col("new_purchase_amount_sum"), F.col("hist_purchase_amount_sum")
    return out.withColumns(
        {
            "hist_purchase_date_average": ratio(F.col("hist_purchase_date_diff"), F.col("hist_card_id_count")),
            "new_purchase_date_average": ratio(F.col("new_purchase_date_diff"), F.col("new_card_id_count")),
            "value_new_hist": ratio(value_new, value_hist),
            "frequency_new_hist": ratio(F.col("new_card_id_count"), F.col("hist_card_id_count")),
            "value_product": value_new * value_hist,
        }
    )
