"""DuckDB SQL with the same results as the registered queries.

Written from the meaning of each operator, not from the Spark code: the
queries share only column names and the tables they read.
"""

from __future__ import annotations

_VIEWS = """
tx_all AS (
  SELECT o.o_custkey AS card_id,
    concat_ws('-', l.l_orderkey::VARCHAR, l.l_linenumber::VARCHAR, l.l_partkey::VARCHAR, l.l_suppkey::VARCHAR) AS tx_id,
    CASE WHEN o.o_orderstatus = 'F' THEN 'N' ELSE 'Y' END AS authorized_flag,
    CASE WHEN l.l_linestatus = 'O' THEN 'Y' ELSE 'N' END AS category_1,
    CASE WHEN l.l_linenumber <= 5 THEN l.l_linenumber::DOUBLE END AS category_2,
    CASE WHEN l.l_discount >= 0.095 THEN NULL WHEN l.l_returnflag = 'A' THEN 'A'
         WHEN l.l_returnflag = 'N' THEN 'B' ELSE 'C' END AS category_3,
    s.s_nationkey AS city_id, n.n_regionkey AS state_id,
    CASE WHEN l.l_quantity >= 50 THEN 999 ELSE floor(l.l_quantity / 5)::INT - 1 END AS installments,
    p.p_size AS merchant_category_id,
    CASE WHEN l.l_tax >= 0.075 THEN NULL ELSE l.l_suppkey END AS merchant_id,
    (year(o.o_orderdate) * 12 + month(o.o_orderdate) - (2000 * 12 + 12))::INT AS month_lag,
    (l.l_extendedprice - 30000) / 10000 AS purchase_amount,
    o.o_orderdate AS purchase_date,
    CASE WHEN p.p_size % 10 = 0 THEN NULL ELSE p.p_size % 10 END AS subsector_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey),
hist AS (SELECT * FROM tx_all WHERE purchase_date < TIMESTAMP '2001-01-01'),
fresh AS (SELECT * FROM tx_all WHERE purchase_date >= TIMESTAMP '2001-01-01'),
merchants AS (
  SELECT s_suppkey AS merchant_id, s_suppkey % 7 AS merchant_group_id, s_suppkey % 40 AS merchant_category_id,
    s_suppkey % 9 AS subsector_id, s_acctbal / 1000 AS numerical_1, s_acctbal / 500 AS numerical_2,
    CASE WHEN s_suppkey % 2 = 0 THEN 'Y' ELSE 'N' END AS category_1,
    CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE (s_suppkey % 6)::DOUBLE END AS category_2,
    CASE WHEN s_suppkey % 3 = 0 THEN 'Y' ELSE 'N' END AS category_4,
    substr('ABCDE', (s_suppkey % 5)::INT + 1, 1) AS most_recent_sales_range,
    substr('ABCDE', ((s_suppkey + 2) % 5)::INT + 1, 1) AS most_recent_purchases_range,
    s_acctbal / 300 AS avg_sales_lag3, s_acctbal / 310 AS avg_purchases_lag3, (s_suppkey % 4)::INT AS active_months_lag3,
    s_acctbal / 600 AS avg_sales_lag6, s_acctbal / 610 AS avg_purchases_lag6, (s_suppkey % 7)::INT AS active_months_lag6,
    s_acctbal / 1200 AS avg_sales_lag12, s_acctbal / 1210 AS avg_purchases_lag12, (s_suppkey % 13)::INT AS active_months_lag12,
    s_nationkey AS city_id, n_regionkey AS state_id
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
cards AS (
  SELECT c_custkey AS card_id, CASE WHEN c_custkey % 3 = 2 THEN 'test' ELSE 'train' END AS split,
    CASE WHEN c_custkey % 97 = 0 THEN NULL
         ELSE concat('19', (95 + c_custkey % 5)::VARCHAR, '-0', (1 + c_custkey % 9)::VARCHAR) END AS first_active_month,
    (1 + c_custkey % 5)::INT AS feature_1, (1 + c_nationkey % 3)::INT AS feature_2,
    CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 1 ELSE 0 END AS feature_3,
    CASE WHEN c_custkey % 3 = 2 THEN NULL WHEN c_acctbal < -800 THEN -33.219281::DOUBLE
         ELSE (c_acctbal - 4500) / 1000 END AS target
  FROM customer),
profile AS (
  SELECT * EXCLUDE (first_active_month), strptime(first_active_month || '-01', '%Y-%m-%d')::DATE AS first_active_month
  FROM cards),
card_reference AS (
  SELECT card_id, date_trunc('month', max(purchase_date))::DATE AS reference_date, max(month_lag) AS category_month_lag
  FROM hist WHERE card_id IS NOT NULL GROUP BY card_id),
event_log AS (SELECT event_id AS tx_id, user_id AS card_id, ts AS purchase_date, value AS purchase_amount FROM events)
"""

ORACLE: dict[str, str] = {}


def _add(name: str, body: str, **ctes: str) -> None:
    parts = [_VIEWS.strip(), *(f"{n} AS ({sql})" for n, sql in ctes.items())]
    ORACLE[name] = "WITH " + ",\n".join(parts) + "\n" + body


# ---- aggregates as text ----------------------------------------------------

_WHOLE, _FRACTION = "whole", "fraction"


def _real_sum(col: str) -> str:
    """A sum of doubles on a grid of nine decimals."""
    return f"round(sum(round_even({col} * 1e9, 0) / 1e9), 9)"


def _stat(stat: str, col: str, kind: str = _WHOLE) -> str:
    whole = kind == _WHOLE
    total = f"sum({col})" if whole else _real_sum(col)
    return {
        "sum": f"CAST(coalesce(sum({col}), 0) AS BIGINT)" if whole else f"coalesce({total}, 0.0)",
        "mean": f"CAST({total} AS DOUBLE) / NULLIF(count({col}), 0)",
        "min": f"min({col})",
        "max": f"max({col})",
        "std": f"round(stddev_samp({col}), 6)",
        "var": f"round(var_samp({col}), 6)",
        "skew": f"CASE WHEN count({col}) < 3 THEN NULL WHEN max({col}) = min({col}) THEN 0.0 ELSE round(skewness({col}), 6) END",
        "ptp": f"max({col}) - min({col})",
        "count": f"count({col})",
        "nunique": f"count(DISTINCT {col})",
        "median": f"round(median({col}), 9)",
    }[stat]


def _stats(prefix: str, stats: str, columns: str, kind: str = _WHOLE) -> list[str]:
    return [f"{_stat(s, c, kind)} AS {prefix}{c}_{s}" for c in columns.split() for s in stats.split()]


def _group(source: str, items: list[str], key: str = "card_id", where: str = "") -> str:
    extra = f" AND {where}" if where else ""
    return f"SELECT {key}, {', '.join(items)} FROM {source} WHERE {key} IS NOT NULL{extra} GROUP BY {key}"


_YES_NO = "CASE {0} WHEN 'Y' THEN 1 WHEN 'N' THEN 0 END"
_FLAGS = f"{_YES_NO.format('authorized_flag')} AS authorized_flag, {_YES_NO.format('category_1')} AS category_1"
_DUMMIES = ", ".join(
    [f"CASE WHEN category_2 = {v}.0 THEN 1 ELSE 0 END AS category_2_{v}_0" for v in range(1, 6)]
    + [f"CASE WHEN category_3 = '{v}' THEN 1 ELSE 0 END AS category_3_{v}" for v in "ABC"]
)
_DUMMY_NAMES = " ".join([f"category_2_{v}_0" for v in range(1, 6)] + [f"category_3_{v}" for v in "ABC"])


def _coded(source: str) -> str:
    return (
        f"SELECT * REPLACE ({_FLAGS}), {_DUMMIES}, "
        f"epoch_us(purchase_date) / 1e6 AS purchase_epoch FROM {source}"
    )


_DAYS = "CAST(date_diff('day', purchase_date::DATE, DATE '2001-01-01') AS INT)"


def _lagged(source: str) -> str:
    return (
        f"SELECT *, purchase_date AS purchase_date2, month_lag * -30 AS day_lag, {_DAYS} AS purchase_day_lag, "
        f"CAST(floor({_DAYS} / 30.0) AS BIGINT) + month_lag AS month_diff, "
        "CAST(isodow(purchase_date) - 1 AS INT) AS trans_dayofweek, "
        f"CAST(day(purchase_date) AS INT) AS purchase_day_dayofmonth FROM {source}"
    )


_MONEY_STATS = "sum max min std mean"


def _money(prefix: str, stats: str = _MONEY_STATS) -> list[str]:
    return _stats(prefix, stats, "purchase_amount", _FRACTION) + _stats(prefix, stats, "installments")


def _basic(prefix: str) -> list[str]:
    return (
        [f"count(*) AS {prefix}transactions_count"]
        + _stats(prefix, "sum mean", "authorized_flag")
        + _stats(prefix, "mean", f"category_1 {_DUMMY_NAMES}")
        + _stats(prefix, "nunique", "merchant_id")
        + _money(prefix)
        + _stats(prefix, "ptp", "purchase_epoch")
        + _stats(prefix, "min max", "month_lag")
    )


_LAG_COLUMNS = "month_lag day_lag purchase_day_lag trans_dayofweek purchase_day_dayofmonth month_diff"


def _full(prefix: str) -> list[str]:
    return (
        [f"count(*) AS {prefix}transactions_count"]
        + _stats(prefix, "sum mean", "authorized_flag")
        + _stats(prefix, "mean", f"category_1 {_DUMMY_NAMES}")
        + _stats(prefix, "nunique", "merchant_id city_id state_id purchase_day_lag")
        + _money(prefix)
        + _stats(prefix, "ptp", "purchase_amount purchase_epoch")
        + _stats(prefix, "min max mean std", _LAG_COLUMNS)
        + _stats(prefix, "min max", "purchase_date2")
    )


def _rates(prefix: str) -> str:
    lag = f"{prefix}purchase_day_lag"
    elapse = f"{lag}_max - {lag}_min + 1"
    return f"{elapse} AS {lag}_elapse, {lag}_nunique / NULLIF(CAST({elapse} AS DOUBLE), 0) AS {lag}_rate"


# ---- scans, sources, sinks -------------------------------------------------

_TYPED = (
    "SELECT card_id, tx_id, authorized_flag, category_1, category_2, category_3, city_id::SMALLINT AS city_id, "
    "state_id::SMALLINT AS state_id, installments::SMALLINT AS installments, "
    "merchant_category_id::SMALLINT AS merchant_category_id, merchant_id, month_lag::SMALLINT AS month_lag, "
    "purchase_amount, purchase_date, subsector_id::SMALLINT AS subsector_id FROM "
)
_add("scan_typed", _TYPED + "tx_all")
_add(
    "scan_inferred",
    "SELECT card_id::INT AS card_id, * EXCLUDE (card_id, merchant_id), merchant_id::INT AS merchant_id, "
    "'card_id int, tx_id string, authorized_flag string, category_1 string, category_2 double, category_3 string, city_id int, "
    "state_id int, installments int, merchant_category_id int, merchant_id int, month_lag int, purchase_amount double, "
    "purchase_date timestamp, subsector_id int' AS column_types FROM tx_all",
)
_add("scan_subset", "SELECT card_id, category_1, installments, purchase_amount, city_id FROM fresh")
_add("scan_capped", "SELECT * FROM fresh ORDER BY tx_id LIMIT 1000")
_add("scan_head", "SELECT * FROM lineitem LIMIT 1000")
_add(
    "zip_by_position",
    "SELECT c_custkey AS card_id, c_acctbal AS balance, CASE WHEN row_number() OVER () <= 100 THEN 'train' ELSE 'test' END AS split FROM customer",
)
_add("scan_renamed", "SELECT card_id::INT AS card_id, target AS target0 FROM cards WHERE split = 'train'")
_add(
    "card_profile",
    "SELECT *, CAST(year(first_active_month) AS INT) AS year, CAST(month(first_active_month) AS INT) AS month, "
    "CAST(date_diff('day', first_active_month, DATE '2001-01-01') AS INT) AS elapsed_time FROM profile",
)
_FREQ_HIST = _group("hist", ["count(*) AS hist_card_id_count"] + _stats("hist_", "sum", "purchase_amount", _FRACTION))
_FREQ_NEW = _group("fresh", ["count(*) AS new_card_id_count"] + _stats("new_", "sum", "purchase_amount", _FRACTION))
_add("attach_by_key", "SELECT card_id, split, target, h.* EXCLUDE (card_id) FROM cards LEFT JOIN h USING (card_id)", h=_FREQ_HIST)
_add("csv_round_trip", "SELECT * FROM cards")
_HIST_MEAN = _group("hist", [f"{_stat('mean', 'purchase_amount', _FRACTION)} AS target"])
_NEW_MEAN = _group("fresh", [f"{_stat('mean', 'purchase_amount', _FRACTION)} AS target"])
_add("template_fill", "SELECT c.card_id, p.target FROM cards c LEFT JOIN p USING (card_id) WHERE c.split = 'test'", p=_NEW_MEAN)


def _narrow_whole(log: str, source: str, col: str, held: str) -> str:
    steps = " ".join(
        f"WHEN min({col})::HUGEINT > -{2 ** (bits - 1)} AND max({col})::HUGEINT < {2 ** (bits - 1) - 1} THEN '{name}'"
        for bits, name in ((8, "tinyint"), (16, "smallint"), (32, "int"), (64, "bigint"))
    )
    return (
        f"SELECT '{log}' AS log, '{col}' AS column_name, CASE {steps} ELSE '{held}' END AS narrow_type, count({col}) AS filled_rows, "
        f"round(sum({col}::DOUBLE), 3) AS total FROM {source}"
    )


def _narrow_real(log: str, source: str, col: str) -> str:
    limit = "3.4028234663852886e38::DOUBLE"
    return (
        f"SELECT '{log}' AS log, '{col}' AS column_name, CASE WHEN min({col}) > -{limit} AND max({col}) < {limit} THEN 'float' "
        f"ELSE 'double' END AS narrow_type, count({col}) AS filled_rows, "
        f"round(sum({col}::FLOAT::DOUBLE), 3) AS total FROM {source}"
    )


_LOGS = (("history", "hist"), ("new", "fresh"))
_add(
    "type_narrowing",
    " UNION ALL ".join(
        [_narrow_whole(*log, c, "bigint") for log in _LOGS for c in ("card_id", "merchant_id")]
        + [
            _narrow_whole(*log, c, "int")
            for log in _LOGS
            for c in ("city_id", "state_id", "installments", "merchant_category_id", "month_lag", "subsector_id")
        ]
        + [_narrow_real(*log, c) for log in _LOGS for c in ("category_2", "purchase_amount")]
    ),
)

# ---- projections, filters, cleaning ----------------------------------------

_add("drop_list_projection", "SELECT card_id, split, feature_1, feature_2 FROM cards")
_add("outlier_flag", "SELECT card_id, target, CASE WHEN target < -30 THEN 1 ELSE 0 END AS outliers FROM cards")
_RISK = _group(
    "hist", ["1.0::DOUBLE - CAST(count(*) FILTER (WHERE authorized_flag = 'Y') AS DOUBLE) / count(authorized_flag) AS risk"]
)
_add(
    "score_split",
    "SELECT card_id, risk, CASE WHEN risk >= 0.3::DOUBLE THEN -33.5::DOUBLE END AS target "
    "FROM cards LEFT JOIN risks USING (card_id) WHERE split = 'test'",
    risks=_RISK,
)
_add("null_key_drop", "SELECT tx_id, card_id, merchant_id FROM tx_all WHERE merchant_id IS NOT NULL")
_add("null_fill", "SELECT tx_id, coalesce(category_2, 1.0) AS category_2, coalesce(category_3, 'A') AS category_3 FROM hist")
_CLEAR = "CASE WHEN installments IN (-1, 999) THEN NULL ELSE installments END"
_add("sentinel_to_null", f"SELECT tx_id, {_CLEAR} AS installments FROM hist")
_add("flag_map", f"SELECT tx_id, {_FLAGS} FROM tx_all")
_add("amount_cap", "SELECT tx_id, least(purchase_amount, 0.8::DOUBLE) AS purchase_amount FROM hist")

# ---- joins -----------------------------------------------------------------

_add(
    "rollup_left_join",
    "SELECT p.*, CAST(year(first_active_month) AS INT) AS year, CAST(month(first_active_month) AS INT) AS month, "
    "CAST(date_diff('day', first_active_month, DATE '2001-01-01') AS INT) AS elapsed_time, "
    "h.* EXCLUDE (card_id), n.* EXCLUDE (card_id) FROM profile p LEFT JOIN h USING (card_id) LEFT JOIN n USING (card_id)",
    hc=_coded("hist"),
    nc=_coded("fresh"),
    h=_group("hc", _basic("hist_")),
    n=_group("nc", _basic("new_")),
)
_CLASH = "category_1 category_2 city_id state_id merchant_category_id subsector_id".split()
_JOINED = (
    "SELECT t.*, m.merchant_group_id, m.numerical_1, m.numerical_2, m.category_4, m.most_recent_sales_range, "
    "m.most_recent_purchases_range, "
    + ", ".join(f"m.{k}_lag{n}" for n in (3, 6, 12) for k in ("avg_sales", "avg_purchases", "active_months"))
    + ", "
    + ", ".join(f"m.{c} AS {c}_X" for c in _CLASH)
    + " FROM fresh t JOIN merchants m ON t.merchant_id = m.merchant_id"
)
_add(
    "merchant_inner_suffix",
    "SELECT tx_id, card_id, merchant_id, merchant_group_id, category_1, category_1_X, category_2, category_2_X, city_id, "
    "city_id_X, state_id, state_id_X, merchant_category_id, merchant_category_id_X, subsector_id, subsector_id_X, category_4, "
    "most_recent_sales_range, most_recent_purchases_range, avg_sales_lag3, active_months_lag12 FROM joined",
    joined=_JOINED,
)
_add(
    "prediction_inner_join",
    "SELECT a.card_id, a.target AS target0, b.target AS target1 FROM a JOIN b USING (card_id)",
    a=_HIST_MEAN,
    b=_NEW_MEAN,
)
_FEATURES = ("feature_1", "feature_2", "feature_3")
_ENCODED = (
    "SELECT cards.*, "
    + ", ".join(
        f"(SELECT CAST(count(*) FILTER (WHERE t.target < -30) AS DOUBLE) / count(*) FROM cards t "
        f"WHERE t.split = 'train' AND t.{f} = cards.{f}) AS {f}_bp"
        for f in _FEATURES
    )
    + " FROM cards"
)
_add(
    "target_encoding",
    "SELECT card_id, feature_1, feature_2, feature_3, feature_1_bp, feature_2_bp, feature_3_bp FROM encoded",
    encoded=_ENCODED,
)

# ---- statistics ------------------------------------------------------------

_add(
    "stats_basic",
    _group(
        "cleared",
        ["count(*) AS transactions_count"]
        + _money("", "sum mean min max count")
        + _stats("", "min max", "purchase_date"),
    ),
    cleared=f"SELECT * REPLACE ({_CLEAR} AS installments) FROM hist",
)
_add("stats_std_var_median", _group("hist", _money("", "std var median")))
_add("skew_corrected", _group("hist", _money("", "skew") + _stats("", "skew", "month_lag")))
for _name in ("repeatable_spreads", "repeatable_spreads_dealt"):
    _add(_name, _group("hist", _money("", "std var skew") + _stats("", "std var skew", "month_lag")))
_NUNIQUE = (
    "merchant_id city_id state_id merchant_category_id subsector_id installments category_1 category_2 category_3 "
    "month_lag purchase_date"
)
for _name in ("nunique_multi", "nunique_spread"):
    _add(_name, _group("hist", _stats("", "nunique", _NUNIQUE)))
_add(
    "ptp",
    _group("e", _stats("", "ptp", "purchase_amount purchase_epoch") + ["max(purchase_amount) - min(purchase_amount) AS purchase_amount_spread"]),
    e="SELECT *, epoch_us(purchase_date) / 1e6 AS purchase_epoch FROM event_log",
)
#: Of all rows, those without a card included.
_SHARE = "CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM {0})"


def _shares(source: str, prefix: str) -> list[str]:
    share = _SHARE.format(source)
    return [f"{share} AS {prefix}_mean", f"{share} * count(*) AS {prefix}_sum"]


_add("share_of_total", _group("hist", ["count(*) AS hist_transactions_count"] + _shares("hist", "history_card_percentage")))
_add(
    "share_with_null_keys",
    _group("keyed", ["count(*) AS rows_of_card"] + _shares("keyed", "all_part")),
    keyed="SELECT CASE WHEN merchant_id IS NOT NULL THEN card_id END AS card_id FROM tx_all",
)
_FINITE = "FILTER (WHERE isfinite(amount))"
for _name in ("stats_missing_values", "stats_missing_values_spread"):
    _add(
        _name,
        _group(
            "holed",
            [
                "count(DISTINCT amount + 0.0) AS amount_nunique",
                "round(median(amount), 9) AS amount_median",
                "CASE WHEN bool_or(isinf(amount)) THEN 'infinity'::DOUBLE "
                f"ELSE coalesce(round(sum(round_even(amount * 1e9, 0) / 1e9) {_FINITE}, 9), 0.0) END AS amount_sum",
                f"CASE WHEN NOT bool_or(isinf(amount)) THEN round(stddev_samp(amount) {_FINITE}, 6) END AS amount_std",
                "count(amount) AS amount_count",
            ],
        ),
        holed="SELECT card_id, CASE WHEN installments = 1 AND month_lag = 0 THEN 'infinity'::DOUBLE WHEN installments = 2 THEN -0.0::DOUBLE "
        "WHEN installments = 3 THEN 0.0::DOUBLE WHEN installments IN (0, 4) THEN NULL ELSE purchase_amount END AS amount FROM tx_all",
    )
_add(
    "subsector_mean_of_means",
    f"SELECT card_id, {_real_sum('m')} / count(*) AS new_sum_cal, "
    f"{_real_sum('m')} / count(*) / NULLIF(count(*) FILTER (WHERE m <> 0), 0) AS new_mean_cal FROM means GROUP BY card_id",
    means=f"SELECT card_id, subsector_id, coalesce({_stat('mean', 'purchase_amount', _FRACTION)}, 0.0) AS m "
    "FROM fresh WHERE card_id IS NOT NULL AND subsector_id IS NOT NULL GROUP BY card_id, subsector_id",
)


def _successive(group: str, value: str, kind: str) -> str:
    name = f"{group}_{value}"
    inner = f"SELECT card_id, {_stat('mean', value, kind)} AS {name} FROM fresh WHERE card_id IS NOT NULL AND {group} IS NOT NULL GROUP BY card_id, {group}"
    return f"SELECT card_id, {', '.join(_stats('', 'mean min max std', name, _FRACTION))} FROM ({inner}) GROUP BY card_id"


_add(
    "successive_aggregates",
    "SELECT * FROM s1 LEFT JOIN s2 USING (card_id) LEFT JOIN s3 USING (card_id) LEFT JOIN s4 USING (card_id)",
    s1=_successive("category_1", "purchase_amount", _FRACTION),
    s2=_successive("installments", "purchase_amount", _FRACTION),
    s3=_successive("city_id", "purchase_amount", _FRACTION),
    s4=_successive("category_1", "installments", _WHOLE),
)


def _per_month(inner: list[tuple[str, str, str, str]], outer: str) -> tuple[str, str]:
    """Inner statistics as (column, statistic, kind of column, kind of result)."""
    first = ", ".join(f"{_stat(s, c, k)} AS {c}_{s}" for c, s, k, _ in inner)
    second = _stats("", outer, "month_lag") + [x for c, s, _, r in inner for x in _stats("", outer, f"{c}_{s}", r)]
    return first, f"SELECT card_id, {', '.join(second)} FROM monthly GROUP BY card_id"


_MONTH_MONEY = [
    ("purchase_amount", s, _FRACTION, _WHOLE if s == "count" else _FRACTION) for s in "count sum mean min max std".split()
] + [
    ("installments", s, _WHOLE, _FRACTION if s in ("mean", "std") else _WHOLE) for s in "count sum mean min max std".split()
]
_first, _second = _per_month(_MONTH_MONEY, "mean std")
_add(
    "per_month_two_level",
    _second,
    monthly=f"SELECT card_id, month_lag, {_first} FROM hist WHERE card_id IS NOT NULL AND month_lag IS NOT NULL GROUP BY card_id, month_lag",
)
_MONTH_LAGS = [("purchase_day_lag", s, _WHOLE, _FRACTION if s in ("mean", "std") else _WHOLE) for s in "max min mean std".split()]
_first, _second = _per_month(_MONTH_LAGS, "mean min max")
_add(
    "per_month_lags",
    _second,
    lagged=_lagged("hist"),
    monthly=f"SELECT card_id, month_lag, {_first} FROM lagged WHERE card_id IS NOT NULL AND month_lag IS NOT NULL GROUP BY card_id, month_lag",
)
_GRID = (0.011, 0.05, 0.25, 0.5, 0.75, 0.95, 0.989)


def _quantiles(col: str) -> str:
    return ", ".join(f"round(quantile_cont({col}::DOUBLE, {p}), 9) AS q_{str(p).replace('.', '_')}" for p in _GRID)


_add(
    "quantile_grid",
    " UNION ALL ".join(f"SELECT '{c}' AS metric, {_quantiles(c)} FROM hist" for c in ("purchase_amount", "installments", "month_lag")),
)
_add("table_shape", "SELECT split, count(*) AS n_rows, 7 AS n_columns FROM cards GROUP BY split")
_add(
    "category_cardinality",
    "SELECT " + ", ".join(f"count(DISTINCT {f}) AS {f}_categories" for f in _FEATURES) + " FROM cards",
)
_add(
    "describe_table",
    " UNION ALL ".join(
        f"SELECT '{c}' AS metric, count({c}) AS value_count, {_real_sum(c + '::DOUBLE')} / count({c}) AS value_mean, "
        f"round(stddev_samp({c}), 6) AS value_std, min({c})::DOUBLE AS value_min, max({c})::DOUBLE AS value_max, "
        f"round(quantile_cont({c}::DOUBLE, 0.25), 9) AS p25, round(quantile_cont({c}::DOUBLE, 0.5), 9) AS p50, "
        f"round(quantile_cont({c}::DOUBLE, 0.75), 9) AS p75 FROM fresh"
        for c in ("purchase_amount", "installments", "month_lag")
    ),
)

# ---- composite rollups -----------------------------------------------------


def _parts(prefix: str) -> list[str]:
    return (
        [f"count(*) AS {prefix}card_id_size"]
        + _stats(prefix, "sum mean max min", "purchase_amount", _FRACTION)
        + _stats(prefix, "sum mean max", "installments")
        + _stats(prefix, "mean", "month_diff category_1")
        + _stats(prefix, "mean max min", "month_lag")
    )


_add(
    "auth_split_rollup",
    "SELECT * FROM a FULL JOIN u USING (card_id)",
    hc=_coded("hist"),
    hl=_lagged("hc"),
    a=_group("hl", _parts("histauth_"), where="authorized_flag = 1"),
    u=_group("hl", _parts("histunauth_"), where="authorized_flag = 0"),
)


def _notebook(prefix: str) -> list[str]:
    return (
        [f"count(*) AS {prefix}transactions_count"]
        + _stats(prefix, "sum mean", "authorized_flag")
        + _stats(prefix, "nunique", "merchant_id city_id")
        + _money(prefix, "sum median max min std")
        + _stats(prefix, "min max", "month_lag")
    )


_add("rollup_notebook_new", _group("c", _notebook("new_")), c=_coded("fresh"))
_add("rollup_notebook_hist", _group("c", _notebook("hist_") + _stats("hist_", "ptp", "purchase_epoch")), c=_coded("hist"))
_add("rollup_basic_new", _group("c", _basic("new_")), c=_coded("fresh"))
_add("rollup_basic_hist", _group("c", _basic("hist_")), c=_coded("hist"))
_MERCHANT_DUMMIES = (
    [f"CASE WHEN category_1_X = '{v}' THEN 1 ELSE 0 END AS category_1_X_{v}" for v in "NY"]
    + [f"CASE WHEN category_2_X = {v}.0 THEN 1 ELSE 0 END AS category_2_X_{v}_0" for v in range(1, 6)]
    + [f"CASE WHEN category_4 = '{v}' THEN 1 ELSE 0 END AS category_4_{v}" for v in "NY"]
    + [
        f"CASE WHEN most_recent_{k}_range = '{v}' THEN 1 ELSE 0 END AS most_recent_{k}_range_{v}"
        for k in ("sales", "purchases")
        for v in "ABCDE"
    ]
)
_MERCHANT_REAL = "numerical_1 numerical_2 " + " ".join(f"avg_{k}_lag{n}" for n in (3, 6, 12) for k in ("sales", "purchases"))
_add(
    "rollup_merchant_new",
    _group(
        "ready",
        ["count(*) AS new_transactions_count"]
        + _shares("ready", "new_card_percentage")
        + _stats("new_", "sum mean", "category_1")
        + _stats("new_", "mean", _DUMMY_NAMES)
        + _stats(
            "new_",
            "nunique",
            "merchant_id merchant_group_id purchase_day_lag city_id city_id_X state_id state_id_X subsector_id "
            "subsector_id_X merchant_category_id merchant_category_id_X",
        )
        + _money("new_")
        + _stats("new_", "ptp", "purchase_epoch")
        + _stats("new_", "min max sum mean", "month_lag")
        + _stats("new_", _MONEY_STATS, _MERCHANT_REAL, _FRACTION)
        + _stats("new_", _MONEY_STATS, "active_months_lag3 active_months_lag6 active_months_lag12")
        + _stats("new_", "mean", " ".join(x.split(" AS ")[1] for x in _MERCHANT_DUMMIES))
        + _stats("new_", "min max mean std", "purchase_day_lag"),
    ),
    joined=_JOINED,
    c=_coded("joined"),
    ready=f"SELECT *, {_DAYS} AS purchase_day_lag, {', '.join(_MERCHANT_DUMMIES)} FROM c",
)
_add(
    "rollup_share_hist",
    _group(
        "ready",
        ["count(*) AS hist_transactions_count"]
        + _shares("hist", "history_card_percentage")
        + _stats("hist_", "mean sum", "authorized_flag")
        + _stats("hist_", "mean", f"category_1 {_DUMMY_NAMES}")
        + _stats("hist_", "nunique", "merchant_id city_id merchant_category_id subsector_id state_id purchase_day_lag")
        + _money("hist_")
        + _stats("hist_", "ptp", "purchase_epoch")
        + _stats("hist_", "min max mean std", "month_lag purchase_day_lag"),
    ),
    c=_coded("hist"),
    ready=_lagged("c"),
)
_FULL_NEW = {
    "nc": _coded("fresh"),
    "nl": _lagged("nc"),
    "nr": _group("nl", _full("new_")),
    "n": f"SELECT *, {_rates('new_')}, new_purchase_amount_mean / NULLIF(new_purchase_epoch_ptp, 0) "
    "AS new_purchase_amount_mean_time_rate FROM nr",
}
_add("rollup_full_new", "SELECT * FROM n", **_FULL_NEW)


def _to_holiday(day: str, ts: str = "purchase_date", period: int = 100) -> str:
    days = f"CAST(floor((epoch_us(TIMESTAMP '{day}') - epoch_us({ts})) / 86400000000.0) AS BIGINT)"
    return f"CASE WHEN {ts} IS NOT NULL THEN greatest(least({days}, {period}), 0) END"


_HOLIDAYS = {
    "Christmas_Day_2000": "2000-12-25",
    "Children_day_2000": "2000-10-12",
    "Black_Friday_2000": "2000-11-24",
    "Mothers_Day_2001": "2001-05-13",
}
_FULL_HIST = {
    "filled": f"SELECT * REPLACE ({_CLEAR} AS installments, coalesce(category_2, 1.0) AS category_2, "
    "coalesce(category_3, 'A') AS category_3) FROM hist",
    "hc": _coded("filled"),
    "hl": _lagged("hc"),
    "hready": "SELECT *, CAST(month(purchase_date) AS INT) AS month, CAST(day(purchase_date) AS INT) AS day, "
    "CAST(isodow(purchase_date) - 1 AS INT) AS weekday, CASE WHEN isodow(purchase_date) >= 6 THEN 1 ELSE 0 END AS weekend, "
    "purchase_amount / NULLIF(installments::DOUBLE, 0) AS price, purchase_amount * month_diff AS duration, "
    "purchase_amount / NULLIF(month_diff::DOUBLE, 0) AS amount_month_ratio, "
    + ", ".join(f"{_to_holiday(day)} AS {name}" for name, day in _HOLIDAYS.items())
    + " FROM hl",
    "hr": _group(
        "hready",
        _full("hist_")
        + _stats("hist_", "mean min max", "month")
        + _stats("hist_", "mean min", "day")
        + _stats("hist_", "mean", "weekday weekend")
        + _stats("hist_", "mean max min var sum", "price", _FRACTION)
        + _stats("hist_", "mean sum", " ".join(_HOLIDAYS))
        + _stats("hist_", "mean min max var skew", "duration amount_month_ratio", _FRACTION),
    ),
    "h": f"SELECT *, {_rates('hist_')} FROM hr",
}
_add("rollup_full_hist", "SELECT * FROM h", **_FULL_HIST)
_add(
    "feature_table",
    "SELECT card_id, split, feature_3, target, CASE WHEN target < -30 THEN 1 ELSE 0 END AS outliers, "
    "CAST(year(first_active_month) AS INT) AS year, CAST(month(first_active_month) AS INT) AS month, "
    "CAST(date_diff('day', first_active_month, DATE '2001-01-01') AS INT) AS elapsed_time, "
    + ", ".join(f"CASE WHEN feature_1 = {v + 1} THEN 1 ELSE 0 END AS feature_1_{v}" for v in range(5))
    + ", "
    + ", ".join(f"CASE WHEN feature_2 = {v + 1} THEN 1 ELSE 0 END AS feature_2_{v}" for v in range(3))
    + ", hist_purchase_amount_max / NULLIF(hist_purchase_day_lag_min::DOUBLE, 0) AS purchase_amount_time_average, "
    "h.* EXCLUDE (card_id, hist_purchase_date2_min, hist_purchase_date2_max), "
    "n.* EXCLUDE (card_id, new_purchase_date2_min, new_purchase_date2_max) "
    "FROM profile LEFT JOIN h USING (card_id) LEFT JOIN n USING (card_id)",
    **_FULL_HIST,
    **_FULL_NEW,
)
_ENDS_HIST = _group("hist", _stats("hist_", "min max", "purchase_date"))
_ENDS_NEW = _group("fresh", _stats("new_", "min max", "purchase_date"))
_add("first_last_purchase", "SELECT * FROM h FULL JOIN n USING (card_id)", h=_ENDS_HIST, n=_ENDS_NEW)
_add(
    "freq_value",
    "SELECT card_id, hist_card_id_count, hist_purchase_amount_sum, new_card_id_count "
    "FROM cards LEFT JOIN h USING (card_id) LEFT JOIN n USING (card_id)",
    h=_FREQ_HIST,
    n=_FREQ_NEW,
)
_MONTHS_LATE = "CAST(floor(date_diff('day', purchase_date::DATE, DATE '2001-04-01') / 30.0) AS BIGINT) + month_lag"


def _durations(source: str) -> str:
    return (
        f"SELECT card_id, purchase_amount * ({_MONTHS_LATE}) AS duration, "
        f"purchase_amount / NULLIF(CAST({_MONTHS_LATE} AS DOUBLE), 0) AS amount_month_ratio FROM {source}"
    )


_add(
    "duration_ratio_rollup",
    "SELECT * FROM h FULL JOIN n USING (card_id)",
    hd=_durations("hist"),
    nd=_durations("fresh"),
    h=_group("hd", _stats("hist_", "mean min max", "duration amount_month_ratio", _FRACTION)),
    n=_group("nd", _stats("new_", "mean min max", "duration amount_month_ratio", _FRACTION)),
)


def _lag_figures(prefix: str) -> list[str]:
    return (
        _stats(prefix, "min max nunique", "purchase_day_lag")
        + _stats(prefix, "mean max", "purchase_amount", _FRACTION)
        + _stats(prefix, "ptp", "purchase_epoch")
    )


def _lag_source(source: str) -> str:
    return f"SELECT card_id, purchase_amount, {_DAYS} AS purchase_day_lag, epoch_us(purchase_date) / 1e6 AS purchase_epoch FROM {source}"


_add(
    "lag_rate_ratios",
    f"SELECT card_id, h.* EXCLUDE (card_id), n.* EXCLUDE (card_id), {_rates('hist_')}, {_rates('new_')}, "
    "new_purchase_amount_mean / NULLIF(new_purchase_epoch_ptp, 0) AS new_purchase_amount_mean_time_rate, "
    "hist_purchase_amount_max / NULLIF(hist_purchase_day_lag_min::DOUBLE, 0) AS purchase_amount_time_average "
    "FROM cards LEFT JOIN h USING (card_id) LEFT JOIN n USING (card_id)",
    hs=_lag_source("hist"),
    ns=_lag_source("fresh"),
    h=_group("hs", _lag_figures("hist_")),
    n=_group("ns", _lag_figures("new_")),
)


def _combos(hist: str = "hist_", out: str = "au_") -> str:
    plus = {
        "purchase_amount_total": "purchase_amount_sum",
        "installments_total": "installments_sum",
    } | {
        f: f
        for f in (
            "purchase_amount_mean purchase_amount_max purchase_amount_min installments_mean installments_max "
            "month_diff_mean month_lag_mean month_lag_max month_lag_min category_1_mean"
        ).split()
    }
    over = {
        "purchase_amount_ratio": "purchase_amount_sum",
        "installments_ratio": "installments_sum",
        "month_diff_ratio": "month_diff_mean",
    }
    items = [f"new_{f} + {hist}{f} AS {out}{n}" for n, f in plus.items()]
    items += [f"new_{f}::DOUBLE / NULLIF({hist}{f}::DOUBLE, 0) AS {out}{n}" for n, f in over.items()]
    return ", ".join(items)


def _prices(out: str = "au_") -> str:
    return ", ".join(
        f"{out}purchase_amount_{k}::DOUBLE / NULLIF({out}installments_{k}::DOUBLE, 0) AS {out}price_{k}"
        for k in ("total", "mean", "max")
    )


_PERIOD_PARTS = {
    "hc": _coded("hist"),
    "hl": _lagged("hc"),
    "nc": _coded("fresh"),
    "nl": _lagged("nc"),
    "n": _group("nl", _parts("new_")),
}
_add(
    "cross_period_combos",
    f"SELECT *, {_prices()} FROM combos",
    **_PERIOD_PARTS,
    h=_group("hl", _parts("hist_")),
    combos=f"SELECT card_id, {_combos()} FROM cards LEFT JOIN h USING (card_id) LEFT JOIN n USING (card_id)",
)
_add(
    "cross_period_auth",
    f"SELECT *, {_prices('au_')}, {_prices('unau_')} FROM combos",
    **_PERIOD_PARTS,
    a=_group("hl", _parts("histauth_"), where="authorized_flag = 1"),
    u=_group("hl", _parts("histunauth_"), where="authorized_flag = 0"),
    combos=f"SELECT card_id, {_combos('histauth_', 'au_')}, {_combos('histunauth_', 'unau_')} FROM cards "
    "LEFT JOIN a USING (card_id) LEFT JOIN u USING (card_id) LEFT JOIN n USING (card_id)",
)


def _whole_days(later: str, earlier: str) -> str:
    return f"CAST(floor((epoch_us({later}) - epoch_us({earlier})) / 86400000000.0) AS BIGINT)"


_START = "first_active_month::TIMESTAMP"
_add(
    "buy_offsets",
    f"SELECT card_id, {_whole_days('new_purchase_date_min', _START)} AS n_first_buy, "
    f"{_whole_days('new_purchase_date_max', _START)} AS n_last_buy, {_whole_days('hist_purchase_date_min', _START)} AS h_first_buy, "
    f"{_whole_days('hist_purchase_date_max', _START)} AS h_last_buy "
    "FROM profile LEFT JOIN h USING (card_id) LEFT JOIN n USING (card_id)",
    h=_ENDS_HIST,
    n=_ENDS_NEW,
)
_add(
    "rowwise_feature_stats",
    "SELECT card_id, feature_1_bp + feature_2_bp + feature_3_bp AS feature_sum, "
    "(feature_1_bp + feature_2_bp + feature_3_bp) / 3.0::DOUBLE AS feature_mean, "
    "greatest(feature_1, feature_2, feature_3) AS feature_max, least(feature_1, feature_2, feature_3) AS feature_min, "
    "round((SELECT stddev_samp(v) FROM (VALUES (feature_1), (feature_2), (feature_3)) t(v)), 6) AS feature_var FROM encoded",
    encoded=_ENCODED,
)
_add(
    "average_gap_ratios",
    "SELECT card_id, hist_purchase_date_diff, new_purchase_date_diff, "
    "hist_purchase_date_diff / hist_card_id_count::DOUBLE AS hist_purchase_date_average, "
    "new_purchase_date_diff / new_card_id_count::DOUBLE AS new_purchase_date_average, "
    "new_purchase_amount_sum / NULLIF(hist_purchase_amount_sum, 0) AS value_new_hist, "
    "new_card_id_count / hist_card_id_count::DOUBLE AS frequency_new_hist, "
    "new_purchase_amount_sum * hist_purchase_amount_sum AS value_product FROM spans",
    h=_ENDS_HIST,
    n=_ENDS_NEW,
    hf=_FREQ_HIST,
    nf=_FREQ_NEW,
    spans=f"SELECT *, {_whole_days('hist_purchase_date_max', 'hist_purchase_date_min')} AS hist_purchase_date_diff, "
    f"{_whole_days('new_purchase_date_max', 'new_purchase_date_min')} AS new_purchase_date_diff FROM cards "
    "LEFT JOIN h USING (card_id) LEFT JOIN n USING (card_id) LEFT JOIN hf USING (card_id) LEFT JOIN nf USING (card_id)",
)

# ---- set operations, calendar ----------------------------------------------

_add("union_train_test", "SELECT card_id, feature_1, feature_2, feature_3, target FROM cards")
_add("distinct_sorted", "SELECT DISTINCT installments, subsector_id FROM tx_all ORDER BY installments, subsector_id")
_add(
    "calendar_parts",
    "SELECT tx_id, CAST(year(purchase_date) AS INT) AS year, CAST(month(purchase_date) AS INT) AS month, "
    "CAST(day(purchase_date) AS INT) AS day, CAST(hour(purchase_date) AS INT) AS hour, "
    "CAST(week(purchase_date) AS INT) AS weekofyear, CAST(isodow(purchase_date) - 1 AS INT) AS weekday, "
    "CASE WHEN isodow(purchase_date) >= 6 THEN 1 ELSE 0 END AS weekend, "
    "CAST(month(purchase_date) + month_lag AS INT) AS purchase_day_month FROM tx_all",
)
_add("day_month_lags", "SELECT tx_id, month_lag, day_lag, purchase_day_lag, month_diff FROM lagged", lagged=_lagged("tx_all"))
_add(
    "holiday_distance",
    f"SELECT tx_id, {_to_holiday('2024-01-15')} AS days_to_holiday, "
    f"{_to_holiday('2024-01-15', period=7)} AS days_to_holiday_7 FROM event_log",
)
_ENDS = {"": "hist_purchase_date_max", "2": "hist_purchase_date_min", "3": "new_purchase_date_max", "4": "new_purchase_date_min"}
_LAGS = "SELECT *, " + ", ".join(
    f"CAST(date_diff('day', {c}::DATE, reference_date) AS INT) AS reference_day_lag{t}" for t, c in _ENDS.items()
) + " FROM cards LEFT JOIN h USING (card_id) LEFT JOIN n USING (card_id) LEFT JOIN card_reference USING (card_id)"


def _reference(months_from: dict[str, str]) -> str:
    months = ", ".join(
        f"CAST(floor(reference_day_lag{s} / 30.0) AS BIGINT) + category_month_lag AS reference_month_diff{t}"
        for t, s in months_from.items()
    )
    days = ", ".join(f"reference_day_lag{t}" for t in months_from)
    return f"SELECT card_id, reference_date, {days}, {months} FROM lags"


_LAG_PARTS = {"h": _ENDS_HIST, "n": _ENDS_NEW, "lags": _LAGS}
_add("reference_lags", _reference({"": "", "2": "2", "3": "", "4": "2"}), **_LAG_PARTS)
_add("reference_lags_fixed", _reference({t: t for t in _ENDS}), **_LAG_PARTS)

# ---- encoding and scores ---------------------------------------------------

_add("one_hot", f"SELECT tx_id, {_DUMMIES} FROM tx_all")
_add(
    "one_hot_seen",
    "SELECT card_id, "
    + ", ".join(
        f"CASE WHEN {f} = {v} THEN 1 ELSE 0 END AS {f}_{v}" for f, top in (("feature_1", 5), ("feature_2", 3)) for v in range(1, top + 1)
    )
    + " FROM cards",
)


def _index(source: str, col: str) -> str:
    return f"SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INT) AS i FROM (SELECT DISTINCT {col} AS v FROM {source} WHERE {col} IS NOT NULL)"


_add(
    "label_encode",
    "SELECT tx_id, a.i AS installments, b.i AS merchant_category_id FROM tx_all "
    "LEFT JOIN a ON installments::VARCHAR = a.v LEFT JOIN b ON merchant_category_id::VARCHAR = b.v",
    a=_index("tx_all", "installments::VARCHAR"),
    b=_index("tx_all", "merchant_category_id::VARCHAR"),
)
_add(
    "one_hot_sparse",
    "SELECT v AS merchant_id, i AS position, count(*) AS n FROM a JOIN fresh ON merchant_id = v GROUP BY ALL",
    a=_index("fresh", "merchant_id"),
)
_add(
    "lasting_codes",
    "SELECT tx_id, merchant_id::VARCHAR AS merchant_id, code FROM tx_all LEFT JOIN coded ON merchant_id::VARCHAR = v "
    "UNION ALL SELECT NULL, '-' || merchant_id, NULL FROM merchants",
    a=_index("hist", "merchant_id::VARCHAR"),
    b=_index("(SELECT merchant_id FROM fresh WHERE merchant_id::VARCHAR NOT IN (SELECT v FROM a))", "merchant_id::VARCHAR"),
    coded="SELECT v, i::BIGINT AS code FROM a UNION ALL SELECT v, i + (SELECT count(*) FROM a) FROM b",
)
_add("label_encode_spread", "SELECT card_id, i AS label FROM cards LEFT JOIN a ON card_id::VARCHAR = v", a=_index("cards", "card_id::VARCHAR"))
_add(
    "label_encode_missing",
    "SELECT tx_id, a.i AS category_3, b.i AS subsector_id FROM tx_all JOIN a ON coalesce(category_3, 'nan') = a.v "
    "JOIN b ON coalesce(subsector_id::VARCHAR, 'nan') = b.v",
    a=_index("tx_all", "coalesce(category_3, 'nan')"),
    b=_index("tx_all", "coalesce(subsector_id::VARCHAR, 'nan')"),
)
_COMB = "CAST(concat(feature_1, feature_2, feature_3) AS INT)"
_add(
    "feature_comb_index",
    f"SELECT card_id, feature_1, feature_2, feature_3, i AS feature_comb_index FROM cards JOIN a ON {_COMB} = v",
    a=_index("cards", _COMB),
)


def _score(col: str, grid: str, ascending: bool) -> str:
    steps = " ".join(f"WHEN {col} <= {grid}_{i} THEN {i if ascending else 9 - i}" for i in range(1, 8))
    return f"CASE {steps} ELSE {8 if ascending else 1} END"


def _rfm(name: str, tag: str, recency: str, frequency: str, value: str) -> None:
    grid = ", ".join(
        f"round(quantile_cont({c}::DOUBLE, {p}), 9) AS g{i}_{j}"
        for i, c in enumerate((recency, frequency, value))
        for j, p in enumerate(_GRID, start=1)
    )
    _add(
        name,
        f"SELECT card_id, r{tag}_quantile, f{tag}_quantile, v{tag}_quantile, "
        f"r{tag}_quantile + f{tag}_quantile + v{tag}_quantile AS rfm{tag}_score, code AS rfm{tag}_code, "
        f"CAST(dense_rank() OVER (PARTITION BY split ORDER BY code) - 1 AS INT) AS rfm{tag}_index FROM coded",
        **_LAG_PARTS,
        hf=_FREQ_HIST,
        nf=_FREQ_NEW,
        table_=f"SELECT card_id, split, {recency}, {frequency}, {value} FROM lags LEFT JOIN hf USING (card_id) LEFT JOIN nf USING (card_id)",
        grid=f"SELECT split, {grid} FROM table_ GROUP BY split",
        scored=f"SELECT card_id, split, {_score(recency, 'g0', True)} AS r{tag}_quantile, "
        f"{_score(frequency, 'g1', False)} AS f{tag}_quantile, {_score(value, 'g2', False)} AS v{tag}_quantile "
        "FROM table_ JOIN grid USING (split)",
        coded=f"SELECT *, CAST(r{tag}_quantile * 100 + f{tag}_quantile * 10 + v{tag}_quantile AS INT) AS code FROM scored",
    )


_rfm("rfm_hist", "", "reference_day_lag", "hist_card_id_count", "hist_purchase_amount_sum")
_rfm("rfm_new", "new", "reference_day_lag3", "new_card_id_count", "new_purchase_amount_sum")

# ---- folds, blends, routing ------------------------------------------------


def _fold(k: int) -> str:
    return f"CAST(CAST('0x' || substr(md5(card_id::VARCHAR || '|15'), 1, 8) AS BIGINT) % {k} AS BIGINT)"


_add("equal_folds", "SELECT c_custkey AS card_id, (row_number() OVER (ORDER BY md5(concat(c_custkey, '|15')), c_custkey) - 1) % 10 AS fold FROM customer")
_add("kfold_assign", f"SELECT card_id, {_fold(10)} AS fold FROM cards")


def _held_out(feature: str) -> str:
    """Target mean of the feature value over other folds (all folds for test)."""
    cells = f"FROM folded t WHERE t.{feature} = folded.{feature} AND t.target IS NOT NULL"
    whole = f"(SELECT round(sum(t.target), 6) {cells})"
    own = f"(SELECT round(sum(t.target), 6) {cells} AND t.fold = folded.fold)"
    n_whole, n_own = f"(SELECT count(*) {cells})", f"(SELECT count(*) {cells} AND t.fold = folded.fold)"
    return (
        f"CASE WHEN target IS NOT NULL THEN round({whole} - {own}, 6) / NULLIF(({n_whole} - {n_own})::DOUBLE, 0) "
        f"ELSE {whole} / NULLIF({n_whole}::DOUBLE, 0) END"
    )


_OOF = {
    "folded": f"SELECT *, {_fold(5)} AS fold FROM cards",
    "base": "SELECT *, " + ", ".join(f"{_held_out(f)} AS oof{i}" for i, f in enumerate(_FEATURES, start=1)) + " FROM folded",
    "train": "SELECT * FROM base WHERE split = 'train'",
}
_add("oof_target_means", "SELECT card_id, split, fold, oof1, oof2, oof3 FROM base", **_OOF)
_add("rmse", "SELECT " + ", ".join(f"round(sqrt(avg(pow(oof{i} - target, 2))), 6) AS rmse{i}" for i in (1, 2, 3)) + " FROM train", **_OOF)


def _two_weights(alpha: float) -> str:
    """Weights of two columns and the intercept from centred moments."""
    n = "count(*)"
    a, b = f"({n} * var_pop(oof1) + {alpha})", f"({n} * var_pop(oof2) + {alpha})"
    c = f"({n} * covar_pop(oof1, oof2))"
    ay, by = f"({n} * covar_pop(oof1, target))", f"({n} * covar_pop(oof2, target))"
    return f"({b} * {ay} - {c} * {by}) / ({a} * {b} - {c} * {c}) AS w1, ({a} * {by} - {c} * {ay}) / ({a} * {b} - {c} * {c}) AS w2"


_MEANS = "avg(oof1) AS m1, avg(oof2) AS m2, avg(target) AS my"
_add(
    "ridge_stack",
    "SELECT base.card_id, base.split, round(CASE WHEN base.target IS NOT NULL "
    "THEN f.b + f.w1 * oof1 + f.w2 * oof2 ELSE t.b + t.w1 * oof1 + t.w2 * oof2 END, 6) AS stacked "
    "FROM base JOIN fits f ON f.fold = base.fold CROSS JOIN tested t",
    **_OOF,
    held=f"SELECT k.fold, {_two_weights(1.0)}, {_MEANS} FROM (SELECT DISTINCT fold FROM train) k JOIN train ON train.fold <> k.fold GROUP BY k.fold",
    fits="SELECT *, my - w1 * m1 - w2 * m2 AS b FROM held",
    tested="SELECT avg(w1) AS w1, avg(w2) AS w2, avg(b) AS b FROM fits",
)


def _determinant(m: list[list[str]]) -> str:
    (a, b, c), (d, e, f), (g, h, i) = m
    return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"


def _three_weights() -> str:
    """Cramer's rule on the moments m11 … m33 and y1 … y3."""
    matrix = [[f"m{min(i, j)}{max(i, j)}" for j in (1, 2, 3)] for i in (1, 2, 3)]
    swapped = [[[f"y{r + 1}" if c == k else matrix[r][c] for c in range(3)] for r in range(3)] for k in range(3)]
    return ", ".join(f"{_determinant(m)} / {_determinant(matrix)} AS w{k}" for k, m in enumerate(swapped, start=1))


_MOMENTS = ", ".join(
    [f"count(*) * covar_pop(oof{i}, oof{j}) + {float(i == j)} AS m{i}{j}" for i in (1, 2, 3) for j in range(i, 4)]
    + [f"count(*) * covar_pop(oof{i}, target) AS y{i}, avg(oof{i}) AS a{i}" for i in (1, 2, 3)]
    + ["avg(target) AS ay"]
)
_add(
    "ridge_stack_three",
    "SELECT base.card_id, base.split, round(CASE WHEN base.target IS NOT NULL "
    "THEN f.b + f.w1 * oof1 + f.w2 * oof2 + f.w3 * oof3 ELSE t.b + t.w1 * oof1 + t.w2 * oof2 + t.w3 * oof3 END, 6) AS stacked "
    "FROM base JOIN fits f ON f.fold = base.fold CROSS JOIN tested t",
    **_OOF,
    held=f"SELECT k.fold, {_MOMENTS} FROM (SELECT DISTINCT fold FROM train) k JOIN train ON train.fold <> k.fold GROUP BY k.fold",
    solved=f"SELECT *, {_three_weights()} FROM held",
    fits="SELECT *, ay - w1 * a1 - w2 * a2 - w3 * a3 AS b FROM solved",
    tested="SELECT avg(w1) AS w1, avg(w2) AS w2, avg(w3) AS w3, avg(b) AS b FROM fits",
)
_add(
    "ols_blend",
    "SELECT round(w1, 6) AS coef_1, round(w2, 6) AS coef_2, round(my - w1 * m1 - w2 * m2, 6) AS intercept FROM fit",
    **_OOF,
    fit=f"SELECT {_two_weights(0.0)}, {_MEANS} FROM train",
)
_add(
    "outlier_route",
    "SELECT c.card_id, CASE WHEN risk >= 0.3::DOUBLE THEN -33.219281::DOUBLE ELSE p.target END AS target "
    "FROM cards c LEFT JOIN risks USING (card_id) LEFT JOIN p USING (card_id) WHERE c.split = 'test'",
    risks=_RISK,
    p=_HIST_MEAN,
)
_add(
    "weighted_blend",
    "SELECT a.card_id, a.target * 0.73839798::DOUBLE + b.target * 0.26555364::DOUBLE AS target FROM a JOIN b USING (card_id)",
    a=_HIST_MEAN,
    b=_NEW_MEAN,
)
_add("average_blend", "SELECT card_id, oof1 * 0.5::DOUBLE + oof2 * 0.5::DOUBLE AS target FROM base", **_OOF)
_add(
    "impute_flags",
    "SELECT card_id, "
    + ", ".join(
        f"coalesce({c}::DOUBLE, -9999.0) AS {c}, CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS {c}_is_null"
        for c in ("elapsed_time", "new_card_id_count", "new_purchase_amount_sum")
    )
    + " FROM (SELECT *, date_diff('day', first_active_month, DATE '2001-01-01') AS elapsed_time FROM profile) "
    "LEFT JOIN nf USING (card_id)",
    nf=_FREQ_NEW,
)


# ---- whole flows, from the twins of their parts ------------------------------


def _part(name: str) -> str:
    return f"({ORACLE[name]})"


_add(
    "merchant_feature_table",
    f"SELECT c.*, m.* EXCLUDE (card_id), s.* EXCLUDE (card_id) FROM cards c LEFT JOIN {_part('rollup_merchant_new')} m USING (card_id) "
    f"LEFT JOIN {_part('rollup_share_hist')} s USING (card_id)",
)
_add(
    "rfm_feature_table",
    "SELECT c.card_id, c.split, i.feature_comb_index, l.* EXCLUDE (card_id), a.* EXCLUDE (card_id), f.hist_card_id_count, "
    "f.hist_purchase_amount_sum, f.new_card_id_count, h.* EXCLUDE (card_id), n.* EXCLUDE (card_id) FROM cards c "
    f"LEFT JOIN {_part('feature_comb_index')} i USING (card_id) LEFT JOIN {_part('reference_lags')} l USING (card_id) "
    f"LEFT JOIN {_part('successive_aggregates')} a USING (card_id) LEFT JOIN {_part('freq_value')} f USING (card_id) "
    f"LEFT JOIN {_part('rfm_hist')} h USING (card_id) LEFT JOIN {_part('rfm_new')} n USING (card_id)",
)

# ---- what must hold of the learners -------------------------------------------

_add(
    "learner_cover",
    f"SELECT learner, card_id, split, {_fold(5)} AS fold, CAST(1 AS BIGINT) AS n, TRUE AS scored FROM cards, "
    "(SELECT unnest(['boosted', 'forest', 'outliers']) AS learner)",
)
_add(
    "patience_cover",
    f"SELECT learner, card_id, split, {_fold(5)} AS fold, CAST(1 AS BIGINT) AS n, TRUE AS scored, TRUE AS in_time FROM cards, "
    "(SELECT unnest(['patient', 'patient_outliers']) AS learner)",
)
_add(
    "tree_splits",
    "SELECT unnest(range(1, 6)) AS fold, CAST(100 AS BIGINT) AS trees, CAST(24 AS BIGINT) AS inputs, TRUE AS splits_fit, "
    "TRUE AS leaves_fit, TRUE AS rows_fit",
)
_add("importance_totals", "SELECT unnest(range(1, 6)) AS fold, CAST(24 AS BIGINT) AS inputs, CAST(1 AS DOUBLE) AS total")
_add(
    "importance_ranking",
    "SELECT feature, fold, round(importance, 9) AS importance, round(mean_importance, 9) AS mean_importance FROM per JOIN top USING (feature)",
    folded=f"SELECT *, {_fold(10)} AS fold FROM cards",
    per=" UNION ALL ".join(f"SELECT '{c}' AS feature, fold, avg({c}::DOUBLE) AS importance FROM folded GROUP BY fold" for c in _FEATURES),
    top="SELECT feature, avg(importance) AS mean_importance FROM per GROUP BY feature ORDER BY mean_importance DESC, feature LIMIT 2",
)
