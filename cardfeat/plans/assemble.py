"""From the logs to one row per card, and from there to a submission."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardfeat.functions.calendar import DayLike
from cardfeat.functions.scalars import below
from cardfeat.operators import blend, encode, folds, models, rfm
from cardfeat.operators.clean import columns_with, without
from cardfeat.operators.joins import attach
from cardfeat.operators.rollup import successive_means
from cardfeat.plans import features as feat
from cardfeat.plans import specs
from cardfeat.session import materialize, stage
from cardfeat.sources.readers import BASE_DAY, card_profile

#: Fixed value: targets below this are outliers.
OUTLIER_TARGET = -30.0
#: Columns that are inputs of features or labels, not features.
NOT_FEATURES = (
    "hist_purchase_date2_min", "hist_purchase_date2_max", "new_purchase_date2_min", "new_purchase_date2_max",
    "first_active_month",
)

Learner = Callable[[], models.Estimator]


def feature_table(
    cards: DataFrame,
    hist: DataFrame,
    new: DataFrame,
    base: DayLike = BASE_DAY,
    holidays: Mapping[str, str] = specs.HOLIDAYS,
    rolled_holidays: Sequence[str] = specs.ROLLED_HOLIDAYS,
    domains: Mapping[str, Sequence] | None = None,
    digits: int | None = None,
) -> DataFrame:
    """Every card with its full rollups, encoded and one-hot features.

    ``cards`` holds train and test rows, told apart by ``split``. The first two
    ``feature_`` columns are label-encoded over both and then made one-hot;
    ``domains`` declares their codes and keeps the plan fixed.
    """
    profile = card_profile(cards, base).withColumn("outliers", below(F.col("target"), OUTLIER_TARGET))
    categories = columns_with(cards, "feature_", 2)
    coded = encode.one_hot(encode.label_encode(profile, categories), domains or categories)
    rollups = [
        feat.full_hist_rollup(hist, base, holidays, rolled_holidays, digits),
        feat.full_new_rollup(new, base, digits),
    ]
    return without(feat.amount_time_average(attach(coded, rollups)), NOT_FEATURES)


def merchant_feature_table(
    cards: DataFrame, hist: DataFrame, new: DataFrame, merchants: DataFrame, base: DayLike = BASE_DAY, digits: int | None = None
) -> DataFrame:
    """Every card with the merchant-enriched rollup of its new period and the shares of its history."""
    return attach(cards, [feat.merchant_rollup(new, merchants, base, digits), feat.share_rollup(hist, base, digits)])


def rfm_feature_table(
    cards: DataFrame,
    new: DataFrame,
    summaries: Sequence[DataFrame],
    pairs: Sequence[tuple[str, str]],
    digits: int | None = None,
) -> DataFrame:
    """Every card with its combination index, two-level aggregates of the new
    period, frequency, reference lags and both RFM scores.

    ``summaries`` are tables per card: first and last purchase, count and value
    of both periods, and the reference month.
    """
    coded = encode.combination_index(cards, columns_with(cards, "feature_"))
    lagged = feat.reference_lags(attach(coded, summaries))
    # the scores read it for both grids, the codes and the result
    table = stage(attach(lagged, [successive_means(new, pairs, digits=digits)]), "rfm-table")
    scored = rfm.rfm_scores(table, "reference_day_lag", "hist_card_id_count", "hist_purchase_amount_sum")
    return rfm.rfm_scores(scored, "reference_day_lag3", "new_card_id_count", "new_purchase_amount_sum", tag="new")


def wide_scores(
    table: DataFrame, learner: Learner = models.boosted, n_folds: int = 5, label: str = "target"
) -> models.CrossValidated:
    """Train on every number of a feature table and score all cards."""
    table = stage(table, "features")
    features = models.numeric_columns(table, ["card_id", label, "outliers"])
    return models.cross_validate(table, features, label, learner, n_folds)


STACK_LEARNERS: tuple[Learner, ...] = (
    models.boosted,
    models.forest,
    lambda: models.boosted(depth=3, step=0.2, seed=models.SAMPLING_SEED + 1),
)


def stacked_scores(
    table: DataFrame, features: Sequence[str], learners: Sequence[Learner] = STACK_LEARNERS, n_folds: int = 10
) -> DataFrame:
    """Train and test predictions of several learners, stacked by a ridge.

    Returns ``card_id split oof1… target stacked``; the base scores are joined
    on the card, never by position.
    """
    scored = table.select("card_id", "split", "target")
    names = [f"oof{i}" for i in range(1, len(learners) + 1)]
    for name, learner in zip(names, learners):
        run = models.cross_validate(table, features, "target", learner, n_folds, name)
        scored = scored.join(run.scores.select("card_id", name), "card_id")
    # the ridge reads the scores for its sums and again for the result
    return blend.ridge_stack(materialize(folds.add_fold(scored, 5)), names, "target")


def routed_scores(
    table: DataFrame,
    features: Sequence[str],
    n_folds: int = 5,
    classifier: Learner = models.outlier_classifier,
    regressor: Learner = models.boosted,
) -> DataFrame:
    """Test predictions with outliers routed around the regressor.

    A classifier scores every card; the regressor learns from the train cards
    that are no outliers; test cards at or above the cut get the outlier score.
    """
    table = materialize(table)
    risk = models.cross_validate(table, features, "outliers", classifier, n_folds, "risk")
    normal = models.cross_validate(
        table, features, "target", regressor, n_folds, "prediction", train_filter=F.col("outliers") == 0
    )
    test = table.filter(F.col("split") == "test").select("card_id")
    parts = [risk.scores.select("card_id", "risk"), normal.scores.select("card_id", "prediction")]
    return attach(test, parts).select(
        "card_id", blend.route_outliers(F.col("risk"), F.col("prediction")).alias("target")
    )
