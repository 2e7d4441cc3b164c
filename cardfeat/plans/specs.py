"""The composite rollups, as data.

Column names follow the transaction tables; ``*_1_0`` and the like are one-hot
columns of ``category_2`` and ``category_3``. Fixed values: the columns and
statistics of every rollup here, which name the result's columns.
"""

from __future__ import annotations

from cardfeat.operators.rollup import Rollup, take

# The categories that become one-hot columns.
CATEGORY_2 = [1.0, 2.0, 3.0, 4.0, 5.0]
CATEGORY_3 = ["A", "B", "C"]
RANGES = ["A", "B", "C", "D", "E"]
DOMAINS = {"category_2": CATEGORY_2, "category_3": CATEGORY_3}
MERCHANT_DOMAINS = {
    "category_1_X": ["N", "Y"],
    "category_2_X": CATEGORY_2,
    "category_4": ["N", "Y"],
    "most_recent_sales_range": RANGES,
    "most_recent_purchases_range": RANGES,
}

# Holidays by name.
HOLIDAYS = {
    "Christmas_Day_2017": "2017-12-25",
    "Mothers_Day_2017": "2017-06-04",
    "fathers_day_2017": "2017-08-13",
    "Children_day_2017": "2017-10-12",
    "Valentine_Day_2017": "2017-06-12",
    "Black_Friday_2017": "2017-11-24",
    "Mothers_Day_2018": "2018-05-13",
}
#: The holidays whose distances are rolled up; the others stay row columns.
ROLLED_HOLIDAYS = ("Christmas_Day_2017", "Children_day_2017", "Black_Friday_2017", "Mothers_Day_2018")

# Transaction columns each family of rollups starts from. Naming them keeps
# dimension joins that only feed unused columns out of the plan.
RAW_BASIC = (
    "card_id", "authorized_flag", "category_1", "category_2", "category_3", "installments",
    "merchant_id", "month_lag", "purchase_amount", "purchase_date",
)
RAW_FULL = (*RAW_BASIC, "city_id", "state_id")
RAW_MERCHANT = (*RAW_FULL, "merchant_category_id", "subsector_id")
RAW_NOTEBOOK = (
    "card_id", "authorized_flag", "city_id", "installments", "merchant_id", "month_lag", "purchase_amount", "purchase_date",
)

FLAG_DUMMIES = [f"category_2_{int(v)}_0" for v in CATEGORY_2] + [f"category_3_{v}" for v in CATEGORY_3]
MERCHANT_DUMMIES = (
    ["category_1_X_N", "category_1_X_Y"]
    + [f"category_2_X_{int(v)}_0" for v in CATEGORY_2]
    + ["category_4_N", "category_4_Y"]
    + [f"most_recent_{kind}_range_{v}" for kind in ("sales", "purchases") for v in RANGES]
)
MERCHANT_MEASURES = ["numerical_1", "numerical_2"] + [
    f"{measure}_lag{months}"
    for months in (3, 6, 12)
    for measure in ("avg_sales", "avg_purchases", "active_months")
]

FIVE = "sum max min std mean"
SPREAD = "min max mean std"

_MONEY = take(FIVE, "purchase_amount", "installments")
_CATEGORIES = take("mean", "category_1", *FLAG_DUMMIES)
_SPAN = take("ptp", "purchase_epoch")

# Basic: flags, categories, money, span.
_BASIC = (
    take("sum mean", "authorized_flag")
    + _CATEGORIES
    + take("nunique", "merchant_id")
    + _MONEY
    + _SPAN
    + take("min max", "month_lag")
)

# First exploration: medians instead of means.
_NOTEBOOK = (
    take("sum mean", "authorized_flag")
    + take("nunique", "merchant_id", "city_id")
    + take("sum median max min std", "purchase_amount", "installments")
    + take("min max", "month_lag")
)

# Full: basic plus lags and calendar columns.
_FULL = (
    take("sum mean", "authorized_flag")
    + _CATEGORIES
    + take("nunique", "merchant_id", "city_id", "state_id", "purchase_day_lag")
    + _MONEY
    + take("ptp", "purchase_amount")
    + _SPAN
    + take(SPREAD, "month_lag", "day_lag", "purchase_day_lag", "trans_dayofweek", "purchase_day_dayofmonth", "month_diff")
    + take("min max", "purchase_date2")
)


def notebook_new(digits: int | None = None) -> Rollup:
    return Rollup("new_", _NOTEBOOK, "new_transactions_count", digits)


def notebook_hist(digits: int | None = None) -> Rollup:
    return Rollup("hist_", _NOTEBOOK + _SPAN, "hist_transactions_count", digits)


def basic(prefix: str, digits: int | None = None) -> Rollup:
    return Rollup(prefix, _BASIC, f"{prefix}transactions_count", digits)


def merchant_new(digits: int | None = None) -> Rollup:
    """New transactions joined with their merchants."""
    measures = (
        take("sum", "category_1")
        + _CATEGORIES
        + take("nunique", "merchant_id", "merchant_group_id", "purchase_day_lag")
        + take("nunique", "city_id", "city_id_X", "state_id", "state_id_X", "subsector_id", "subsector_id_X")
        + take("nunique", "merchant_category_id", "merchant_category_id_X")
        + _MONEY
        + _SPAN
        + take("min max sum mean", "month_lag")
        + take(FIVE, *MERCHANT_MEASURES)
        + take("mean", *MERCHANT_DUMMIES)
        + take(SPREAD, "purchase_day_lag")
    )
    return Rollup("new_", measures, "new_transactions_count", digits)


def share_hist(digits: int | None = None) -> Rollup:
    measures = (
        take("mean sum", "authorized_flag")
        + _CATEGORIES
        + take("nunique", "merchant_id", "city_id", "merchant_category_id", "subsector_id", "state_id")
        + _MONEY
        + _SPAN
        + take(SPREAD, "month_lag", "purchase_day_lag")
        + take("nunique", "purchase_day_lag")
    )
    return Rollup("hist_", measures, "hist_transactions_count", digits)


def full_new(digits: int | None = None) -> Rollup:
    return Rollup("new_", _FULL, "new_transactions_count", digits)


def full_hist(digits: int | None = None, holidays: tuple[str, ...] = ROLLED_HOLIDAYS) -> Rollup:
    measures = (
        _FULL
        + take("mean min max", "month")
        + take("mean min", "day")
        + take("mean", "weekday", "weekend")
        + take("mean max min var sum", "price")
        + take("mean sum", *holidays)
        + take("mean min max var skew", "duration", "amount_month_ratio")
    )
    return Rollup("hist_", measures, "hist_transactions_count", digits)


def first_last(prefix: str) -> Rollup:
    return Rollup(prefix, take("min max", "purchase_date"))


def frequency(prefix: str, with_value: bool, digits: int | None = None) -> Rollup:
    value = take("sum", "purchase_amount") if with_value else ()
    return Rollup(prefix, value, f"{prefix}card_id_count", digits)


def duration_ratio(prefix: str, digits: int | None = None) -> Rollup:
    return Rollup(prefix, take("mean min max", "duration", "amount_month_ratio"), None, digits)


def combination_parts(prefix: str, digits: int | None = None) -> Rollup:
    """What the cross-period combinations need of each period."""
    measures = (
        take("sum mean max min", "purchase_amount")
        + take("sum mean max", "installments")
        + take("mean", "month_diff", "category_1")
        + take("mean max min", "month_lag")
    )
    return Rollup(prefix, measures, f"{prefix}card_id_size", digits)


def month_money() -> tuple:
    return take("count sum mean min max std", "purchase_amount", "installments")


def month_lags() -> tuple:
    return take("max min mean std", "purchase_day_lag")
