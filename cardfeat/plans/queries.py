"""The registered queries: every operator over the order-derived card tables.

Each takes ``(spark, sf_dir)`` and reads whole tables. ``DIGITS`` rounds sums
of doubles once, so results do not depend on task order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardfeat.functions import calendar as cal
from cardfeat.functions.scalars import below, cap
from cardfeat.functions.scoring import GRID
from cardfeat.functions.stats import SUM_DIGITS
from cardfeat.operators import blend, clean, encode, folds, joins, models, narrow, positions, rfm, rollup, skew
from cardfeat.operators.dictionary import Dictionary
from cardfeat.operators.quantiles import exact_quantiles, table_quantiles
from cardfeat.operators.trees import split_counts
from cardfeat.plans import assemble
from cardfeat.plans import features as feat
from cardfeat.plans import specs
from cardfeat.plans.assemble import OUTLIER_TARGET
from cardfeat.session import materialize, scratch_path
from cardfeat.sources import readers, sinks
from cardfeat.sources.tpch import HISTORY, NEW, PERIOD_START, card_reference, cards, event_log, merchants, transactions

DIGITS = 6
LATE_BASE = "2001-04-01"
FOLDS, STACK_FOLDS = 10, 5
FEATURES = ["feature_1", "feature_2", "feature_3"]
EVENT_HOLIDAY = "2024-01-15"
HOLIDAYS = {
    "Christmas_Day_2000": "2000-12-25",
    "Mothers_Day_2000": "2000-05-14",
    "fathers_day_2000": "2000-08-13",
    "Children_day_2000": "2000-10-12",
    "Valentine_Day_2000": "2000-06-12",
    "Black_Friday_2000": "2000-11-24",
    "Mothers_Day_2001": "2001-05-13",
}
ROLLED_HOLIDAYS = ("Christmas_Day_2000", "Children_day_2000", "Black_Friday_2000", "Mothers_Day_2001")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


def _r(column, digits: int = DIGITS):
    return F.round(column, digits)


def _spec(prefix: str, *measures, size: str | None = None) -> rollup.Rollup:
    return rollup.Rollup(prefix, tuple(m for group in measures for m in group), size, DIGITS)


# ---- scans, sources, sinks -------------------------------------------------

TYPED = (
    "card_id bigint, tx_id string, authorized_flag string, category_1 string, category_2 double, category_3 string, "
    "city_id smallint, state_id smallint, installments smallint, merchant_category_id smallint, merchant_id bigint, "
    "month_lag smallint, purchase_amount double, purchase_date timestamp_ntz, subsector_id smallint"
)


@query
def scan_typed(spark, d):
    """The whole log through CSV, read with declared types."""
    path = sinks.scratch_path(spark, "typed-transactions")
    log = readers.typed(transactions(spark, d), TYPED)
    sinks.write_csv(log, path)
    return readers.read_csv(spark, path, log.schema)


@query
def scan_inferred(spark, d):
    """The whole log through CSV with the types that were inferred, which a last column names."""
    path = sinks.scratch_path(spark, "transactions")
    sinks.write_csv(transactions(spark, d), path)
    found = readers.read_csv_inferred(spark, path)
    return found.withColumn("column_types", F.lit(", ".join(f"{c} {t}" for c, t in found.dtypes)))


@query
def scan_subset(spark, d):
    return transactions(spark, d, NEW, ["card_id", "category_1", "installments", "purchase_amount", "city_id"])


@query
def scan_capped(spark, d):
    return readers.capped(transactions(spark, d, NEW), 1000, ["tx_id"])


@query
def scan_head(spark, d):
    """The first lines of the order lines' files, without reading the rest."""
    return readers.read_head(spark.read.parquet, f"{d}/lineitem.parquet", 1000)


@query
def zip_by_position(spark, d):
    """Two scans side by side, row by row, and the first hundred rows marked as train."""
    ids, balances = (spark.read.parquet(f"{d}/customer.parquet").select(F.col(c).alias(n)) for c, n in (("c_custkey", "card_id"), ("c_acctbal", "balance")))
    marks = positions.split_at(spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("card_id")), 100)
    return positions.zip_files(ids, balances).join(marks, "card_id")


@query
def scan_renamed(spark, d):
    path = sinks.scratch_path(spark, "predictions")
    sinks.write_csv(cards(spark, d).filter(F.col("split") == "train").select("card_id", "target"), path)
    return readers.read_csv_renamed(spark, path, ["card_id", "target0"])


@query
def card_profile(spark, d):
    return readers.card_profile(cards(spark, d), PERIOD_START)


@query
def attach_by_key(spark, d):
    """Key and label joined onto a feature table by card, never by position."""
    feature_table = rollup.roll_up(
        transactions(spark, d, HISTORY, ["card_id", "purchase_amount"]), specs.frequency("hist_", True, DIGITS)
    )
    labels = cards(spark, d).select("card_id", "split", "target")
    return joins.attach(labels, [feature_table])


@query
def csv_round_trip(spark, d):
    path = sinks.scratch_path(spark, "cards")
    sinks.write_csv(cards(spark, d), path)
    types = "card_id bigint, split string, first_active_month string, feature_1 int, feature_2 int, feature_3 int, target double"
    return readers.read_csv(spark, path, types)


@query
def template_fill(spark, d):
    template = cards(spark, d).filter(F.col("split") == "test")
    log = transactions(spark, d, NEW, ["card_id", "purchase_amount"])
    predictions = rollup.roll_up(log, _spec("", rollup.take("mean", "purchase_amount"))).select(
        "card_id", F.col("purchase_amount_mean").alias("target")
    )
    return sinks.fill_template(template, predictions)


@query
def type_narrowing(spark, d):
    """Per log and column: the narrowed type and what it holds."""
    return joins.stack_rows(*(_narrowed(spark, d, period) for period in (HISTORY, NEW)))


def _narrowed(spark, d, period):
    log = transactions(spark, d, period).drop("tx_id")
    small = narrow.narrow(log, keep_double=False)
    numeric = list(narrow.column_ranges(log))
    types = dict(small.dtypes)
    sums = small.agg(
        *(F.count(c).alias(f"rows_{c}") for c in numeric), *(F.sum(F.col(c).cast("double")).alias(f"sum_{c}") for c in numeric)
    )
    cells = (
        F.struct(
            F.lit(period).alias("log"),
            F.lit(c).alias("column_name"),
            F.lit(types[c]).alias("narrow_type"),
            F.col(f"rows_{c}").alias("filled_rows"),
            _r(F.col(f"sum_{c}"), 3).alias("total"),
        )
        for c in numeric
    )
    return sums.select(F.explode(F.array(*cells)).alias("r")).select("r.*")


# ---- projections, filters, cleaning ----------------------------------------


@query
def drop_list_projection(spark, d):
    kept = clean.without(cards(spark, d), ["first_active_month", "target"])
    first_two = clean.columns_with(kept, "feature_", 2)
    return kept.drop(*(c for c in FEATURES if c not in first_two))


@query
def outlier_flag(spark, d):
    return cards(spark, d).select("card_id", "target", below(F.col("target"), OUTLIER_TARGET).alias("outliers"))


def _risk(spark, d):
    """Share of unauthorized purchases: a deterministic outlier probability."""
    log = clean.encode_flags(transactions(spark, d, HISTORY, ["card_id", "authorized_flag"]), ["authorized_flag"])
    means = rollup.roll_up(log, _spec("", rollup.take("mean", "authorized_flag")))
    return means.select("card_id", (F.lit(1.0) - F.col("authorized_flag_mean")).alias("risk"))


@query
def score_split(spark, d):
    """Test cards above the cut get a constant, the others none, in one table."""
    test = cards(spark, d).filter(F.col("split") == "test").select("card_id").join(_risk(spark, d), "card_id", "left")
    test = materialize(test)  # both halves read it
    risky = F.coalesce(F.col("risk") >= blend.OUTLIER_PROBABILITY, F.lit(False))  # a card without history is not
    return joins.stack_rows(test.filter(risky).withColumn("target", F.lit(-33.5)), test.filter(~risky))


@query
def null_key_drop(spark, d):
    return clean.drop_null_keys(transactions(spark, d, None, ["tx_id", "card_id", "merchant_id"]), ["merchant_id"])


@query
def null_fill(spark, d):
    return clean.fill_missing(transactions(spark, d, HISTORY, ["tx_id", "category_2", "category_3"]))


@query
def sentinel_to_null(spark, d):
    return clean.clear_sentinels(transactions(spark, d, HISTORY, ["tx_id", "installments"]))


@query
def flag_map(spark, d):
    return clean.encode_flags(transactions(spark, d, None, ["tx_id", "authorized_flag", "category_1"]))


@query
def amount_cap(spark, d):
    log = transactions(spark, d, HISTORY, ["tx_id", "purchase_amount"])
    return log.withColumn("purchase_amount", cap(F.col("purchase_amount"), 0.8))


# ---- joins -----------------------------------------------------------------


@query
def rollup_left_join(spark, d):
    """Every card with its basic history and new-period rollups."""
    profile = readers.card_profile(cards(spark, d), PERIOD_START)
    return joins.attach(
        profile,
        [
            feat.basic_rollup(transactions(spark, d, HISTORY, specs.RAW_BASIC), "hist_", DIGITS),
            feat.basic_rollup(transactions(spark, d, NEW, specs.RAW_BASIC), "new_", DIGITS),
        ],
    )


@query
def merchant_inner_suffix(spark, d):
    return joins.enrich(transactions(spark, d, NEW), merchants(spark, d), "merchant_id").select(
        "tx_id", "card_id", "merchant_id", "merchant_group_id", "category_1", "category_1_X", "category_2", "category_2_X",
        "city_id", "city_id_X", "state_id", "state_id_X", "merchant_category_id", "merchant_category_id_X",
        "subsector_id", "subsector_id_X", "category_4", "most_recent_sales_range", "most_recent_purchases_range",
        "avg_sales_lag3", "active_months_lag12",
    )


def _amount_predictions(spark, d, period):
    log = transactions(spark, d, period, ["card_id", "purchase_amount"])
    spec = _spec("", rollup.take("mean", "purchase_amount"))
    return rollup.roll_up(log, spec).withColumnRenamed("purchase_amount_mean", "target")


@query
def prediction_inner_join(spark, d):
    first, second = (_amount_predictions(spark, d, p) for p in (HISTORY, NEW))
    return first.withColumnRenamed("target", "target0").join(second.withColumnRenamed("target", "target1"), "card_id")


def _with_outliers(spark, d):
    return cards(spark, d).withColumn("outliers", below(F.col("target"), OUTLIER_TARGET))


def _encoded(spark, d):
    table = _with_outliers(spark, d)
    train = table.filter(F.col("split") == "train")
    return encode.target_encode(table, train, FEATURES, F.col("outliers"))


@query
def target_encoding(spark, d):
    return _encoded(spark, d).select("card_id", *FEATURES, *(f"{c}_bp" for c in FEATURES))


# ---- statistics ------------------------------------------------------------


@query
def stats_basic(spark, d):
    log = clean.clear_sentinels(transactions(spark, d, HISTORY, ["card_id", "purchase_amount", "installments", "purchase_date"]))
    return rollup.roll_up(
        log,
        _spec(
            "",
            rollup.take("sum mean min max count", "purchase_amount", "installments"),
            rollup.take("min max", "purchase_date"),
            size="transactions_count",
        ),
    )


@query
def stats_std_var_median(spark, d):
    log = transactions(spark, d, HISTORY, ["card_id", "purchase_amount", "installments"])
    return rollup.roll_up(log, _spec("", rollup.take("std var median", "purchase_amount", "installments")))


@query
def skew_corrected(spark, d):
    log = transactions(spark, d, HISTORY, ["card_id", "purchase_amount", "installments", "month_lag"])
    return rollup.roll_up(log, _spec("", rollup.take("skew", "purchase_amount", "installments", "month_lag")))


def _repeatable(spark, d, hot_rows):
    """Spreads from each card's values in their order; rounded here only to be compared with SQL."""
    log = transactions(spark, d, HISTORY, ["card_id", "purchase_amount", "installments", "month_lag"])
    spec = rollup.Rollup("", rollup.take("std var skew", "purchase_amount", "installments", "month_lag"), repeatable=True)
    rolled = rollup.roll_up(log, spec, hot_rows=hot_rows)
    return rolled.select("card_id", *(_r(F.col(c)).alias(c) for c in spec.columns))


@query
def repeatable_spreads(spark, d):
    return _repeatable(spark, d, skew.HOT_ROWS)


@query
def repeatable_spreads_dealt(spark, d):
    """The same with every card treated as one with very many rows."""
    return _repeatable(spark, d, 0)


NUNIQUE = [
    "merchant_id", "city_id", "state_id", "merchant_category_id", "subsector_id", "installments",
    "category_1", "category_2", "category_3", "month_lag", "purchase_date",
]


@query
def nunique_multi(spark, d):
    return rollup.roll_up(transactions(spark, d, HISTORY, ["card_id", *NUNIQUE]), _spec("", rollup.take("nunique", *NUNIQUE)))


@query
def nunique_spread(spark, d):
    """The same counts with every card treated as one with very many rows."""
    log = transactions(spark, d, HISTORY, ["card_id", *NUNIQUE])
    return rollup.roll_up(log, _spec("", rollup.take("nunique", *NUNIQUE)), hot_rows=0)


@query
def ptp(spark, d):
    """Ranges of amount and time; the last one shows a user-supplied aggregate."""
    log = event_log(spark, d).withColumn("purchase_epoch", cal.epoch_seconds(F.col("purchase_date")))
    spread = rollup.custom("spread", "purchase_amount", lambda c: F.max(c) - F.min(c))
    return rollup.roll_up(log, _spec("", rollup.take("ptp", "purchase_amount", "purchase_epoch"), (spread,)))


@query
def share_of_total(spark, d):
    log = transactions(spark, d, HISTORY, ["card_id"])
    return rollup.roll_up(log, _spec("hist_", size="hist_transactions_count"), share="history_card_percentage")


@query
def share_with_null_keys(spark, d):
    """Shares of all rows when some rows belong to no card."""
    log = transactions(spark, d, None, ["card_id", "merchant_id"])
    keyed = log.select(F.when(F.col("merchant_id").isNotNull(), F.col("card_id")).alias("card_id"))
    return rollup.roll_up(keyed, _spec("all_", size="rows_of_card"), share="all_part")


def _holes(spark, d):
    """Amounts of which some are NaN, infinite, negative zero or null."""
    log = transactions(spark, d, None, ["card_id", "purchase_amount", "installments", "month_lag"])
    kind = F.col("installments")
    amount = F.col("purchase_amount")
    holed = (
        F.when(kind == 0, F.lit(float("nan")))
        .when((kind == 1) & (F.col("month_lag") == 0), F.lit(float("inf")))
        .when(kind == 2, F.lit(-0.0))
        .when(kind == 3, F.lit(0.0))
        .when(kind == 4, F.lit(None).cast("double"))
        .otherwise(amount)
    )
    return log.select("card_id", holed.alias("amount"))


@query
def stats_missing_values(spark, d):
    return rollup.roll_up(_holes(spark, d), _spec("", rollup.take("nunique median sum std count", "amount")))


@query
def stats_missing_values_spread(spark, d):
    """The same with every card treated as one with very many rows."""
    return rollup.roll_up(_holes(spark, d), _spec("", rollup.take("nunique median sum std count", "amount")), hot_rows=0)


@query
def subsector_mean_of_means(spark, d):
    log = transactions(spark, d, NEW, ["card_id", "subsector_id", "purchase_amount"])
    return rollup.mean_of_group_means(log, "card_id", "subsector_id", "purchase_amount", "new_", DIGITS)


PAIRS = [
    ("category_1", "purchase_amount"),
    ("installments", "purchase_amount"),
    ("city_id", "purchase_amount"),
    ("category_1", "installments"),
]


@query
def successive_aggregates(spark, d):
    log = transactions(spark, d, NEW, ["card_id", "category_1", "installments", "purchase_amount", "city_id"])
    return rollup.successive_means(log, PAIRS, digits=DIGITS)


@query
def per_month_two_level(spark, d):
    log = transactions(spark, d, HISTORY, ["card_id", "month_lag", "purchase_amount", "installments"])
    return rollup.two_level(log, "card_id", "month_lag", specs.month_money(), "mean std", DIGITS, with_group=True)


@query
def per_month_lags(spark, d):
    log = transactions(spark, d, HISTORY, ["card_id", "month_lag", "purchase_date"])
    log = log.withColumn("purchase_day_lag", cal.day_lag(PERIOD_START, F.col("purchase_date")))
    return rollup.two_level(log, "card_id", "month_lag", specs.month_lags(), "mean min max", DIGITS, with_group=True)


@query
def quantile_grid(spark, d):
    log = transactions(spark, d, HISTORY, ["purchase_amount", "installments", "month_lag"])
    grid = table_quantiles(log, log.columns, GRID, digits=SUM_DIGITS)
    return grid.select(
        "metric", *(F.col("quantiles")[i].alias(f"q_{str(p).replace('.', '_')}") for i, p in enumerate(GRID))
    )


@query
def table_shape(spark, d):
    """Rows per split, and columns, of the card table."""
    table = cards(spark, d)
    return table.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_columns", F.lit(len(table.columns)))


@query
def category_cardinality(spark, d):
    return cards(spark, d).agg(*(F.count_distinct(c).alias(f"{c}_categories") for c in FEATURES))


@query
def describe_table(spark, d):
    log = transactions(spark, d, NEW, ["purchase_amount", "installments", "month_lag"])
    columns = log.columns
    long = log.select(
        F.explode(F.array(*(F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns))).alias("r")
    ).select("r.*")
    spec = rollup.Rollup("", rollup.take("count mean std min max", "value"), None, DIGITS)
    basics = rollup.roll_up(long, spec, ["metric"])
    middle = exact_quantiles(long, ["metric"], "value", (0.25, 0.5, 0.75), SUM_DIGITS)
    return basics.join(middle, "metric").select(
        "metric", *(F.col(f"value_{s}").alias(f"value_{s}") for s in ("count", "mean", "std", "min", "max")),
        *(F.col("quantiles")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))),
    )


# ---- composite rollups -----------------------------------------------------


@query
def auth_split_rollup(spark, d):
    log = feat.with_lags(feat.coded(transactions(spark, d, HISTORY, specs.RAW_BASIC)), PERIOD_START)
    return feat.authorized_rollup(log, specs.combination_parts("hist_", DIGITS))


@query
def rollup_notebook_new(spark, d):
    return feat.notebook_rollup(transactions(spark, d, NEW, specs.RAW_NOTEBOOK), specs.notebook_new(DIGITS))


@query
def rollup_notebook_hist(spark, d):
    return feat.notebook_rollup(transactions(spark, d, HISTORY, specs.RAW_NOTEBOOK), specs.notebook_hist(DIGITS))


@query
def rollup_basic_new(spark, d):
    return feat.basic_rollup(transactions(spark, d, NEW, specs.RAW_BASIC), "new_", DIGITS)


@query
def rollup_basic_hist(spark, d):
    return feat.basic_rollup(transactions(spark, d, HISTORY, specs.RAW_BASIC), "hist_", DIGITS)


@query
def rollup_merchant_new(spark, d):
    return feat.merchant_rollup(transactions(spark, d, NEW, specs.RAW_MERCHANT), merchants(spark, d), PERIOD_START, DIGITS)


@query
def rollup_share_hist(spark, d):
    return feat.share_rollup(transactions(spark, d, HISTORY, specs.RAW_MERCHANT), PERIOD_START, DIGITS)


@query
def rollup_full_new(spark, d):
    return feat.full_new_rollup(transactions(spark, d, NEW, specs.RAW_FULL), PERIOD_START, DIGITS)


@query
def rollup_full_hist(spark, d):
    return feat.full_hist_rollup(transactions(spark, d, HISTORY, specs.RAW_FULL), PERIOD_START, HOLIDAYS, ROLLED_HOLIDAYS, DIGITS)


def _first_last(spark, d):
    return [
        rollup.roll_up(transactions(spark, d, period, ["card_id", "purchase_date"]), specs.first_last(prefix))
        for period, prefix in ((HISTORY, "hist_"), (NEW, "new_"))
    ]


@query
def first_last_purchase(spark, d):
    hist, new = _first_last(spark, d)
    return hist.join(new, "card_id", "full")


def _frequency(spark, d):
    hist = rollup.roll_up(
        transactions(spark, d, HISTORY, ["card_id", "purchase_amount"]), specs.frequency("hist_", True, DIGITS)
    )
    new = rollup.roll_up(transactions(spark, d, NEW, ["card_id", "purchase_amount"]), specs.frequency("new_", True, DIGITS))
    return hist, new


@query
def freq_value(spark, d):
    hist, new = _frequency(spark, d)
    return joins.attach(cards(spark, d).select("card_id"), [hist, new.drop("new_purchase_amount_sum")])


@query
def duration_ratio_rollup(spark, d):
    columns = ["card_id", "purchase_date", "month_lag", "purchase_amount"]
    parts = [
        rollup.roll_up(feat.with_duration(transactions(spark, d, p, columns), LATE_BASE), specs.duration_ratio(x, DIGITS))
        for p, x in ((HISTORY, "hist_"), (NEW, "new_"))
    ]
    return parts[0].join(parts[1], "card_id", "full")


@query
def lag_rate_ratios(spark, d):
    """The ratios that follow a rollup, over all cards."""
    measures = (
        rollup.take("min max nunique", "purchase_day_lag"),
        rollup.take("mean max", "purchase_amount"),
        rollup.take("ptp", "purchase_epoch"),
    )
    out = cards(spark, d).select("card_id")
    for period, prefix in ((HISTORY, "hist_"), (NEW, "new_")):
        log = transactions(spark, d, period, ["card_id", "purchase_date", "purchase_amount"]).withColumns(
            {
                "purchase_day_lag": cal.day_lag(PERIOD_START, F.col("purchase_date")),
                "purchase_epoch": cal.epoch_seconds(F.col("purchase_date")),
            }
        )
        rolled = feat.lag_rates(rollup.roll_up(log, _spec(prefix, *measures)), prefix, with_amount_rate=prefix == "new_")
        out = joins.attach(out, [rolled])
    return feat.amount_time_average(out)


@query
def cross_period_combos(spark, d):
    parts = [
        rollup.roll_up(
            feat.with_lags(feat.coded(transactions(spark, d, p, specs.RAW_BASIC)), PERIOD_START), specs.combination_parts(x, DIGITS)
        )
        for p, x in ((HISTORY, "hist_"), (NEW, "new_"))
    ]
    joined = joins.attach(cards(spark, d).select("card_id"), parts)
    made = feat.cross_period(joined)
    return made.select("card_id", *(c for c in made.columns if c.startswith("au_")))


@query
def cross_period_auth(spark, d):
    """The combinations with authorized and with unauthorized history."""
    hist, new = (
        feat.with_lags(feat.coded(transactions(spark, d, p, specs.RAW_BASIC)), PERIOD_START) for p in (HISTORY, NEW)
    )
    parts = [
        feat.authorized_rollup(hist, specs.combination_parts("hist_", DIGITS)),
        rollup.roll_up(new, specs.combination_parts("new_", DIGITS)),
    ]
    made = joins.attach(cards(spark, d).select("card_id"), parts)
    made = feat.cross_period(feat.cross_period(made, "histauth_", "new_", "au_"), "histunauth_", "new_", "unau_")
    return made.select("card_id", *(c for c in made.columns if c.startswith(("au_", "unau_"))))


@query
def buy_offsets(spark, d):
    hist, new = _first_last(spark, d)
    profile = readers.card_profile(cards(spark, d), PERIOD_START).select("card_id", "first_active_month")
    hist = hist.withColumnsRenamed({c: c.replace("hist_", "h_") for c in hist.columns})
    new = new.withColumnsRenamed({c: c.replace("new_", "n_") for c in new.columns})
    return feat.buy_offsets(joins.attach(profile, [hist, new])).select(
        "card_id", "n_first_buy", "n_last_buy", "h_first_buy", "h_last_buy"
    )


@query
def rowwise_feature_stats(spark, d):
    made = feat.feature_summary(_encoded(spark, d))
    return made.select(
        "card_id", "feature_sum", "feature_mean", "feature_max", "feature_min", _r(F.col("feature_var")).alias("feature_var")
    )


@query
def average_gap_ratios(spark, d):
    parts = [_summary(spark, d, HISTORY, "hist_"), _summary(spark, d, NEW, "new_")]
    made = feat.average_gaps(joins.attach(cards(spark, d).select("card_id"), parts))
    return made.select(
        "card_id", "hist_purchase_date_diff", "new_purchase_date_diff", "hist_purchase_date_average",
        "new_purchase_date_average", "value_new_hist", "frequency_new_hist", "value_product",
    )


# ---- set operations, calendar ----------------------------------------------


@query
def union_train_test(spark, d):
    table = cards(spark, d).select("card_id", *FEATURES, "target", "split")
    train = table.filter(F.col("split") == "train").drop("split")
    test = table.filter(F.col("split") == "test").drop("split", "target")
    return joins.stack_rows(train, test)


@query
def distinct_sorted(spark, d):
    return transactions(spark, d, None, ["installments", "subsector_id"]).distinct().orderBy("installments", "subsector_id")


@query
def calendar_parts(spark, d):
    ts = F.col("purchase_date")
    return transactions(spark, d, None, ["tx_id", "purchase_date", "month_lag"]).select(
        "tx_id",
        F.year(ts).alias("year"),
        F.month(ts).alias("month"),
        F.dayofmonth(ts).alias("day"),
        F.hour(ts).alias("hour"),
        F.weekofyear(ts).alias("weekofyear"),
        cal.weekday(ts).alias("weekday"),
        cal.is_weekend(ts).alias("weekend"),
        cal.shifted_month(ts, F.col("month_lag")).alias("purchase_day_month"),
    )


@query
def day_month_lags(spark, d):
    log = feat.with_lags(transactions(spark, d, None, ["tx_id", "purchase_date", "month_lag"]), PERIOD_START)
    return log.select("tx_id", "month_lag", "day_lag", "purchase_day_lag", "month_diff")


@query
def holiday_distance(spark, d):
    ts = F.col("purchase_date")
    return event_log(spark, d).select(
        "tx_id",
        cal.holiday_distance(EVENT_HOLIDAY, ts).alias("days_to_holiday"),
        cal.holiday_distance(EVENT_HOLIDAY, ts, 7).alias("days_to_holiday_7"),
    )


def _summary(spark, d, period, prefix):
    """First and last purchase, count and value of a card, in one rollup."""
    log = transactions(spark, d, period, ["card_id", "purchase_date", "purchase_amount"])
    measures = specs.first_last(prefix).measures + specs.frequency(prefix, True).measures
    return rollup.roll_up(log, _spec(prefix, measures, size=f"{prefix}card_id_count"))


def _with_reference(spark, d):
    parts = [_summary(spark, d, HISTORY, "hist_"), _summary(spark, d, NEW, "new_"), card_reference(spark, d)]
    return joins.attach(cards(spark, d), parts)


LAG_COLUMNS = [f"reference_{kind}{tag}" for tag in ("", "2", "3", "4") for kind in ("day_lag", "month_diff")]


@query
def reference_lags(spark, d):
    return feat.reference_lags(_with_reference(spark, d)).select("card_id", "reference_date", *LAG_COLUMNS)


@query
def reference_lags_fixed(spark, d):
    return feat.reference_lags(_with_reference(spark, d), fixed=True).select("card_id", "reference_date", *LAG_COLUMNS)


# ---- encoding and scores ---------------------------------------------------


@query
def one_hot(spark, d):
    return encode.one_hot(transactions(spark, d, None, ["tx_id", "category_2", "category_3"]), specs.DOMAINS)


@query
def one_hot_seen(spark, d):
    """One-hot with the values read from the data."""
    return encode.one_hot(cards(spark, d).select("card_id", "feature_1", "feature_2"), ["feature_1", "feature_2"])


@query
def one_hot_sparse(spark, d):
    """One sparse vector per new transaction; the vectors' sum, entry by entry, per merchant."""
    log = transactions(spark, d, NEW, ["tx_id", "merchant_id"])
    vectors, values = encode.sparse_one_hot(log, "merchant_id")
    total = vectors.agg(Summarizer.sum(F.col("merchant_id_one_hot")).alias("total"))
    entries = total.select(F.posexplode(vector_to_array("total")).alias("position", "n"))
    return values.join(entries, "position").select("merchant_id", "position", F.col("n").cast("bigint").alias("n"))


@query
def lasting_codes(spark, d):
    """Codes fitted on the history's merchants, appended to by the new period's; a merchant of neither has none."""
    known = Dictionary(spark, scratch_path(spark, "merchant-codes"))
    for period in (HISTORY, NEW):
        log = transactions(spark, d, period, ["tx_id", "merchant_id"]).withColumn("merchant_id", F.col("merchant_id").cast("string"))
        known.append(log, "merchant_id")
    every = transactions(spark, d, None, ["tx_id", "merchant_id"]).withColumn("merchant_id", F.col("merchant_id").cast("string"))
    unseen = merchants(spark, d).select(F.lit(None).cast("string").alias("tx_id"), F.concat(F.lit("-"), F.col("merchant_id")).alias("merchant_id"))
    return known.encode(every.unionByName(unseen), "merchant_id", "code")


@query
def label_encode(spark, d):
    """Index of the text among all texts: '10' before '2'."""
    return encode.label_encode(
        transactions(spark, d, None, ["tx_id", "installments", "merchant_category_id"]), ["installments", "merchant_category_id"]
    )


@query
def label_encode_spread(spark, d):
    """The same index built for more values than one task should sort."""
    return encode.label_encode(cards(spark, d).select("card_id", F.col("card_id").alias("label")), ["label"], small=0)


@query
def label_encode_missing(spark, d):
    """Missing text gets a code of its own."""
    log = transactions(spark, d, None, ["tx_id", "category_3", "subsector_id"])
    return encode.label_encode(log, ["category_3", "subsector_id"], missing="nan")


@query
def feature_comb_index(spark, d):
    return encode.combination_index(cards(spark, d).select("card_id", *FEATURES), FEATURES)


def _rfm_input(spark, d):
    """Written out once: the scores read it for the grid, the codes and the result."""
    return materialize(
        feat.reference_lags(_with_reference(spark, d)).select(
            "card_id", "split", "reference_day_lag", "reference_day_lag3", "hist_card_id_count",
            "hist_purchase_amount_sum", "new_card_id_count", "new_purchase_amount_sum",
        )
    )


@query
def rfm_hist(spark, d):
    scored = rfm.rfm_scores(_rfm_input(spark, d), "reference_day_lag", "hist_card_id_count", "hist_purchase_amount_sum")
    return scored.select("card_id", "r_quantile", "f_quantile", "v_quantile", "rfm_score", "rfm_code", "rfm_index")


@query
def rfm_new(spark, d):
    scored = rfm.rfm_scores(
        _rfm_input(spark, d), "reference_day_lag3", "new_card_id_count", "new_purchase_amount_sum", tag="new"
    )
    return scored.select(
        "card_id", "rnew_quantile", "fnew_quantile", "vnew_quantile", "rfmnew_score", "rfmnew_code", "rfmnew_index"
    )


# ---- folds, blends, routing ------------------------------------------------


def _base_predictions(spark, d, k):
    table = folds.add_fold(cards(spark, d), k)
    for i, feature in enumerate(FEATURES, start=1):
        table = folds.out_of_fold_means(table, feature, "target", f"oof{i}", DIGITS)
    return table


@query
def kfold_assign(spark, d):
    return folds.add_fold(cards(spark, d).select("card_id"), FOLDS)


@query
def equal_folds(spark, d):
    return folds.add_equal_folds(cards(spark, d).select("card_id"), FOLDS)


@query
def oof_target_means(spark, d):
    return _base_predictions(spark, d, STACK_FOLDS).select("card_id", "split", "fold", "oof1", "oof2", "oof3")


@query
def rmse(spark, d):
    table = _base_predictions(spark, d, STACK_FOLDS).filter(F.col("split") == "train")
    return table.agg(*(_r(blend.rmse(F.col(f"oof{i}"), F.col("target"))).alias(f"rmse{i}") for i in (1, 2, 3)))


@query
def ridge_stack(spark, d):
    """Two base predictions, so that a closed form in SQL can follow."""
    table = _base_predictions(spark, d, STACK_FOLDS)
    stacked = blend.ridge_stack(table, ["oof1", "oof2"], "target")
    return stacked.select("card_id", "split", _r(F.col("stacked")).alias("stacked"))


@query
def ridge_stack_three(spark, d):
    """Three base predictions and the error of the stack."""
    stacked = blend.ridge_stack(_base_predictions(spark, d, STACK_FOLDS), ["oof1", "oof2", "oof3"], "target")
    return stacked.select("card_id", "split", _r(F.col("stacked")).alias("stacked"))


@query
def ols_blend(spark, d):
    train = _base_predictions(spark, d, STACK_FOLDS).filter(F.col("split") == "train")
    return train.agg(*blend.two_column_blend("oof1", "oof2", "target")).select(
        *(_r(F.col(c)).alias(c) for c in ("coef_1", "coef_2", "intercept"))
    )


@query
def outlier_route(spark, d):
    table = cards(spark, d).filter(F.col("split") == "test").select("card_id")
    scored = joins.attach(table, [_risk(spark, d), _amount_predictions(spark, d, HISTORY)])
    return scored.select("card_id", blend.route_outliers(F.col("risk"), F.col("target")).alias("target"))


@query
def weighted_blend(spark, d):
    first, second = (_amount_predictions(spark, d, p) for p in (HISTORY, NEW))
    return blend.blend_tables(first, second)


@query
def average_blend(spark, d):
    table = _base_predictions(spark, d, STACK_FOLDS)
    return table.select("card_id", blend.weighted({"oof1": 0.5, "oof2": 0.5}).alias("target"))


# ---- from logs to submission ------------------------------------------------


@query
def feature_table(spark, d):
    """All rollups, ratios and encoded features of every card."""
    return assemble.feature_table(
        cards(spark, d),
        transactions(spark, d, HISTORY, specs.RAW_FULL),
        transactions(spark, d, NEW, specs.RAW_FULL),
        PERIOD_START,
        HOLIDAYS,
        ROLLED_HOLIDAYS,
        {"feature_1": range(5), "feature_2": range(3)},
        DIGITS,
    )


@query
def stacked_submission(spark, d):
    """Three learners, stacked; the test cards' scores in template form."""
    scores = assemble.stacked_scores(materialize(_model_table(spark, d)), MODEL_FEATURES, n_folds=FOLDS)
    template = cards(spark, d).filter(F.col("split") == "test")
    return sinks.fill_template(template, scores.select("card_id", F.col("stacked").alias("target")))


@query
def routed_submission(spark, d):
    template = cards(spark, d).filter(F.col("split") == "test")
    scores = assemble.routed_scores(_model_table(spark, d), MODEL_FEATURES, STACK_FOLDS)
    return sinks.fill_template(template, scores)


@query
def wide_submission(spark, d):
    """The whole feature table to folds, learner and template."""
    template = cards(spark, d).filter(F.col("split") == "test")
    scores = assemble.wide_scores(feature_table(spark, d), n_folds=STACK_FOLDS).scores
    return sinks.fill_template(template, scores.select("card_id", F.col("prediction").alias("target")))


@query
def merchant_feature_table(spark, d):
    return assemble.merchant_feature_table(
        cards(spark, d),
        transactions(spark, d, HISTORY, specs.RAW_MERCHANT),
        transactions(spark, d, NEW, specs.RAW_MERCHANT),
        merchants(spark, d),
        PERIOD_START,
        DIGITS,
    )


@query
def rfm_feature_table(spark, d):
    """Combination index, two-level aggregates, frequency, reference lags and RFM scores of every card."""
    new = transactions(spark, d, NEW, ["card_id", "category_1", "installments", "purchase_amount", "city_id"])
    parts = [_summary(spark, d, HISTORY, "hist_"), _summary(spark, d, NEW, "new_"), card_reference(spark, d)]
    table = assemble.rfm_feature_table(cards(spark, d), new, parts, PAIRS, DIGITS)
    rfm_columns = [f"{part}{tag}_quantile" for tag in ("", "new") for part in "rfv"]
    rfm_columns += [f"rfm{tag}_{part}" for tag in ("", "new") for part in ("score", "code", "index")]
    two_level_columns = [f"{g}_{v}_{s}" for g, v in PAIRS for s in ("mean", "min", "max", "std")]
    frequency = ["hist_card_id_count", "hist_purchase_amount_sum", "new_card_id_count"]
    return table.select(
        "card_id", "split", "feature_comb_index", "reference_date", *two_level_columns, *frequency, *LAG_COLUMNS, *rfm_columns
    )


# ---- learners --------------------------------------------------------------

def _model_table(spark, d):
    """Card features, frequency and value of both periods, and the lags."""
    profile = readers.card_profile(_with_reference(spark, d), PERIOD_START)
    return feat.reference_lags(profile).withColumn("outliers", below(F.col("target"), OUTLIER_TARGET))


MODEL_FEATURES = [
    *FEATURES, "elapsed_time", "hist_card_id_count", "hist_purchase_amount_sum", "new_card_id_count",
    "new_purchase_amount_sum", "reference_day_lag", "reference_day_lag2", "reference_day_lag3", "reference_day_lag4",
]


@query
def impute_flags(spark, d):
    columns = ["elapsed_time", "new_card_id_count", "new_purchase_amount_sum"]
    table = models.impute_with_flags(_model_table(spark, d).select("card_id", *columns), columns)
    return table


@query
def gbt_oof(spark, d):
    return models.cross_validate(_model_table(spark, d), MODEL_FEATURES, "target", models.boosted, STACK_FOLDS).scores


@query
def rf_oof(spark, d):
    return models.cross_validate(_model_table(spark, d), MODEL_FEATURES, "target", models.forest, FOLDS).scores


@query
def outlier_classifier(spark, d):
    run = models.cross_validate(_model_table(spark, d), MODEL_FEATURES, "outliers", models.outlier_classifier, STACK_FOLDS)
    return run.scores


#: With a tree's weight of 0.1 instead of 0.005 a twentieth of the rounds goes as far.
PATIENT = dict(step=0.1, rounds=500, patience=8, chunk=8)
#: The same with half the patience, where only the rule itself is looked at.
IMPATIENT = {**PATIENT, "patience": 4, "chunk": 4}


def _patient():
    return models.patient(**PATIENT)


@query
def patient_oof(spark, d):
    """Boosting that ends once the held-out fold has not got better for some rounds."""
    return models.cross_validate(_model_table(spark, d), MODEL_FEATURES, "target", _patient, STACK_FOLDS, parallelism=STACK_FOLDS).scores


def _cover(table, name: str, label: str, learner, parallelism: int = 4):
    """What must hold of any learner's scores: every card once, in its fold, with a score, probabilities in range."""
    run = models.cross_validate(table, MODEL_FEATURES, label, learner, STACK_FOLDS, parallelism=parallelism)
    in_range = F.col("prediction").isNotNull() & (F.lit(label == "target") | F.col("prediction").between(0, 1))
    cover = run.scores.groupBy("card_id", "split", "fold").agg(F.count("*").alias("n"), F.bool_and(in_range).alias("scored"))
    return cover.withColumn("learner", F.lit(name)), run


@query
def learner_cover(spark, d):
    table = materialize(_model_table(spark, d))
    learners = {"boosted": ("target", models.boosted), "forest": ("target", models.forest), "outliers": ("outliers", models.outlier_classifier)}
    return joins.stack_rows(*(_cover(table, name, *how)[0] for name, how in learners.items()))


@query
def patience_cover(spark, d):
    """The same of the learners with patience, and that each of their runs ended as soon as it could."""
    table, parts = materialize(_model_table(spark, d)), []
    for name, label, learner in (("patient", "target", models.patient), ("patient_outliers", "outliers", models.patient_classifier)):
        cover, run = _cover(table, name, label, lambda learner=learner: learner(**IMPATIENT), STACK_FOLDS)
        waited = [(k, len(m.errors) - m.rounds, len(m.errors), m.errors[m.rounds - 1] <= min(m.errors)) for k, m in enumerate(run.models)]
        waited = spark.createDataFrame(waited, "fold bigint, waited int, run int, best boolean")
        in_time = F.col("best") & ((F.col("run") == IMPATIENT["rounds"]) | F.col("waited").between(IMPATIENT["patience"], IMPATIENT["patience"] + IMPATIENT["chunk"] - 1))
        parts.append(cover.join(F.broadcast(waited.select("fold", in_time.alias("in_time"))), "fold"))  # a row per fold
    return joins.stack_rows(*parts)


@query
def importance_totals(spark, d):
    """The importances of every fold's model: one of each input, adding up to 1."""
    table = materialize(_model_table(spark, d))
    run = models.cross_validate(table, MODEL_FEATURES, "target", models.forest, STACK_FOLDS)
    sums = run.importances().groupBy("fold").agg(F.count_distinct("feature").alias("inputs"), F.sum("importance").alias("total"))
    return sums.select(F.col("fold").cast("bigint").alias("fold"), "inputs", _r(F.col("total")).alias("total"))


@query
def tree_splits(spark, d):
    """The node tables of every fold's forest: trees, inputs, and how inner nodes, leaves and rows fit together."""
    run = models.cross_validate(_model_table(spark, d), MODEL_FEATURES, "target", models.forest, STACK_FOLDS)
    nodes = materialize(run.nodes())
    inner = F.col("feature").isNotNull()
    per_tree = nodes.groupBy("fold", "tree").agg(F.count_if(inner).alias("inner"), F.count_if(~inner).alias("leaves"))
    shape = per_tree.groupBy("fold").agg(
        F.count("*").alias("trees"), F.sum("inner").alias("inner"), F.bool_and(F.col("leaves") == F.col("inner") + 1).alias("leaves_fit")
    )
    side = nodes.select("fold", "tree", F.col("node").alias("below"), F.col("rows").alias("rows_below"))
    parents = nodes.filter(inner).select("fold", "tree", "node", "rows", F.explode(F.array("left", "right")).alias("below"))
    sums = parents.join(side, ["fold", "tree", "below"]).groupBy("fold", "tree", "node", "rows").agg(F.sum("rows_below").alias("sum"))
    fit = sums.groupBy("fold").agg(F.bool_and(F.col("sum") == F.col("rows")).alias("rows_fit"))
    counts = split_counts(nodes, run.inputs).groupBy("fold").agg(F.count("*").alias("inputs"), F.sum("importance").alias("splits"))
    joined = shape.join(counts, "fold").join(fit, "fold", "left")
    return joined.select(
        F.col("fold").cast("bigint").alias("fold"), "trees", "inputs", (F.col("splits") == F.col("inner")).alias("splits_fit"),
        "leaves_fit", F.coalesce("rows_fit", F.lit(True)).alias("rows_fit"),
    )


@query
def split_importance(spark, d):
    """Features by the number of nodes that split on them, averaged over folds; the strongest with their counts per fold."""
    run = models.cross_validate(_model_table(spark, d), MODEL_FEATURES, "target", models.boosted, STACK_FOLDS)
    table = materialize(run.importances("split"))
    top = models.mean_importance(table)
    return joins.keep_listed(table, top, "feature").join(top.withColumnRenamed("importance", "mean_importance"), "feature")


@query
def importance_ranking(spark, d):
    """Tables per fold, appended; features by their mean, the strongest kept in all folds.

    A feature's mean in a fold stands for its importance, so that SQL can follow.
    """
    table = materialize(folds.add_fold(cards(spark, d), FOLDS).select("fold", *FEATURES))

    def of(fold):
        means = [F.struct(F.lit(c).alias("feature"), F.avg(F.col(c).cast("double")).alias("importance")) for c in FEATURES]
        row = table.filter(F.col("fold") == fold).agg(F.explode(F.array(*means)).alias("r"))
        return row.select("r.feature", "r.importance", F.lit(fold).alias("fold"))

    appended = joins.stack_rows(*(of(k) for k in range(FOLDS)))
    top = models.mean_importance(appended, 2)
    best = joins.keep_listed(appended, top, "feature").join(top.withColumnRenamed("importance", "mean_importance"), "feature")
    return best.select("feature", F.col("fold").cast("bigint").alias("fold"), *(_r(F.col(c), 9).alias(c) for c in ("importance", "mean_importance")))


@query
def feature_importance(spark, d):
    run = models.cross_validate(_model_table(spark, d), MODEL_FEATURES, "target", models.boosted, STACK_FOLDS)
    table = run.importances()
    top = models.mean_importance(table)
    best = joins.keep_listed(table, top, "feature")
    return best.join(top.withColumnRenamed("importance", "mean_importance"), "feature")
