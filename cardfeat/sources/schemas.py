"""Column types of the card tables. Their names and types."""

from __future__ import annotations

from pyspark.sql import types as T

_TRANSACTIONS = (
    "card_id string, authorized_flag string, category_1 string, category_2 double, category_3 string, "
    "city_id smallint, state_id smallint, installments smallint, merchant_category_id smallint, "
    "merchant_id string, month_lag tinyint, purchase_amount float, purchase_date timestamp_ntz, subsector_id smallint"
)
_CARDS = "card_id string, first_active_month string, feature_1 smallint, feature_2 smallint, feature_3 smallint"
_MERCHANTS = (
    "merchant_id string, merchant_group_id int, merchant_category_id smallint, subsector_id smallint, "
    "numerical_1 float, numerical_2 float, category_1 string, category_2 float, category_4 string, "
    "most_recent_sales_range string, most_recent_purchases_range string, "
    "avg_sales_lag3 double, avg_purchases_lag3 double, active_months_lag3 smallint, "
    "avg_sales_lag6 double, avg_purchases_lag6 double, active_months_lag6 smallint, "
    "avg_sales_lag12 double, avg_purchases_lag12 double, active_months_lag12 smallint, "
    "city_id smallint, state_id smallint"
)

#: DDL per logical table.
SCHEMAS: dict[str, str] = {
    "historical_transactions": _TRANSACTIONS,
    "new_merchant_transactions": _TRANSACTIONS,
    "merchants": _MERCHANTS,
    "train": f"{_CARDS}, target double",
    "test": _CARDS,
    "reference_dates": "card_id string, reference_date date, category_month_lag int",
    "predictions": "card_id string, target double",
}


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(SCHEMAS[name])
