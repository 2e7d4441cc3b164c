"""Cross-validated tree learners on ``pyspark.ml``.

Each learner is fitted once per fold. Train cards get the prediction of the
model that did not see them, test cards the average over the folds. The
prepared table is written to the checkpoint folder before the fold loop, so
that every fit starts from finished vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from contextvars import copy_context
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardfeat.operators.folds import add_fold
from cardfeat.operators.patience import PatientBoosting, PatientClassifier
from cardfeat.operators.trees import node_table, split_counts
from cardfeat.session import materialize

#: Fixed values of the learners that have a counterpart in Spark: minimum rows
#: per leaf, share of features and rows per tree, seed of the row sampling.
MIN_ROWS, FEATURE_SHARE, ROW_SHARE, SAMPLING_SEED = 30, "0.9", 0.9, 11
MISSING = -9999.0


def impute_with_flags(df: DataFrame, columns: Sequence[str], fill: float = MISSING) -> DataFrame:
    """Fill nulls with a value outside the data and say so in ``<c>_is_null``.

    Spark's trees refuse missing values; a far-off fill lets them split the
    missing rows away, as learners with native nulls do.
    """
    new = {}
    for c in columns:
        new[c] = F.coalesce(F.col(c).cast("double"), F.lit(fill))
        new[f"{c}_is_null"] = F.col(c).isNull().cast("int")
    return df.withColumns(new)


def boosted(label: str = "target", rounds: int = 50, depth: int = 5, step: float = 0.1, **extra) -> GBTRegressor:
    settings = dict(
        featuresCol="features", labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=step,
        minInstancesPerNode=MIN_ROWS, featureSubsetStrategy=FEATURE_SHARE, subsamplingRate=ROW_SHARE, seed=SAMPLING_SEED,
        validationIndicatorCol="held_out",
    )
    return GBTRegressor(**{**settings, **extra})


def forest(label: str = "target", trees: int = 100, depth: int = 7, **extra) -> RandomForestRegressor:
    settings = dict(
        featuresCol="features", labelCol=label, numTrees=trees, maxDepth=depth,
        minInstancesPerNode=MIN_ROWS, featureSubsetStrategy="0.5", subsamplingRate=ROW_SHARE, seed=SAMPLING_SEED,
        # a row keeps its node in every tree, or each level would walk all trees from their roots
        cacheNodeIds=True,
    )
    return RandomForestRegressor(**{**settings, **extra})


def outlier_classifier(label: str = "outliers", rounds: int = 50, depth: int = 5, **extra) -> GBTClassifier:
    settings = dict(
        featuresCol="features", labelCol=label, maxIter=rounds, maxDepth=depth, stepSize=0.1,
        featureSubsetStrategy="0.64", subsamplingRate=0.8, seed=SAMPLING_SEED,
        validationIndicatorCol="held_out",
    )
    return GBTClassifier(**{**settings, **extra})


def patient(label: str = "target", **settings) -> PatientBoosting:
    """Boosting until the held-out fold stops getting better, as far as 10,000 rounds."""
    shares = dict(min_rows=MIN_ROWS, feature_share=FEATURE_SHARE, row_share=ROW_SHARE, seed=SAMPLING_SEED)
    return PatientBoosting(label, **{**shares, **settings})


def patient_classifier(label: str = "outliers", **settings) -> PatientClassifier:
    shares = dict(min_rows=1, feature_share="0.64", row_share=0.8, seed=SAMPLING_SEED)
    return PatientClassifier(label, **{**shares, **settings})


def predicted(model: Model) -> Column:
    """The score column of a fitted model's output: P(1) for a classifier."""
    if model.hasParam("probabilityCol"):
        return vector_to_array(F.col("probability"))[1]
    return F.col("prediction")


def numeric_columns(df: DataFrame, but: Sequence[str]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in set(but)]


def vector_size(df: DataFrame, column: str) -> int:
    """The length of a vector column, as Spark's encoders note it."""
    return df.schema[column].metadata["ml_attr"]["num_attrs"]


def input_names(df: DataFrame, features: Sequence[str], vectors: Sequence[str] = ()) -> list[str]:
    """The name of every entry of the feature vector."""
    named = [n for c in features for n in (c, f"{c}_is_null")]
    return named + [f"{v}_{k}" for v in vectors for k in range(vector_size(df, v))]


def prepare(
    df: DataFrame, features: Sequence[str], label: str, folds: int, key: str = "card_id", vectors: Sequence[str] = ()
) -> DataFrame:
    """Key, split, label, fold and feature vector, written out once; ``vectors`` are vector columns among the features."""
    filled = impute_with_flags(df, features)
    inputs = [n for c in features for n in (c, f"{c}_is_null")] + list(vectors)
    assembled = VectorAssembler(inputCols=inputs, outputCol="features").transform(add_fold(filled, folds, key))
    return materialize(assembled.select(key, "split", F.col(label).cast("double").alias(label), "fold", "features"))


@dataclass
class CrossValidated:
    """Out-of-fold scores, averaged test scores, and the fold models."""

    scores: DataFrame
    models: list[Model]
    inputs: list[str]

    def nodes(self) -> DataFrame:
        """One row per node of every fold's trees."""
        return node_table(self.scores.sparkSession, self.models, self.inputs)

    def importances(self, kind: str = "gain") -> DataFrame:
        """Importance of every feature in every fold (folds x features rows).

        ``gain``: the share of the impurity that splits on the feature take away. ``split``: how
        many nodes split on it.
        """
        if kind == "split":
            return split_counts(self.nodes(), self.inputs)
        if kind != "gain":
            raise ValueError(f"unknown kind of importance {kind!r}")
        spark = self.scores.sparkSession
        rows = [
            (name, float(value), fold)
            for fold, model in enumerate(self.models, start=1)
            for name, value in zip(self.inputs, model.featureImportances.toArray())
        ]
        return spark.createDataFrame(rows, "feature string, importance double, fold int")


def _fit(learner: Estimator, train: DataFrame, fold: int) -> Model:
    """Fit on all other folds; a learner with early stopping watches this one, and one with a folder keeps a part of it for each."""
    if isinstance(learner, PatientBoosting) and learner.path:
        learner.path = f"{learner.path}/fold-{fold}"
    if learner.hasParam("validationIndicatorCol") and learner.isSet("validationIndicatorCol"):
        return learner.fit(train.withColumn(learner.getValidationIndicatorCol(), F.col("fold") == fold))
    return learner.fit(train.filter(F.col("fold") != fold))


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    label: str,
    learner: Callable[[], Estimator],
    folds: int = 10,
    name: str = "prediction",
    key: str = "card_id",
    train_filter: Column | None = None,
    parallelism: int = 4,
    vectors: Sequence[str] = (),
) -> CrossValidated:
    """Fit ``learner`` per fold over rows of split 'train'.

    ``train_filter`` leaves rows out of the fits (and out of the result)
    without touching test rows. ``vectors`` names sparse one-hot columns.
    """
    if train_filter is not None:
        df = df.filter((F.col("split") != "train") | train_filter)
    table = prepare(df, features, label, folds, key, vectors)
    train, test = table.filter(F.col("split") == "train"), table.filter(F.col("split") == "test")
    # the fits are separate Spark jobs; side by side they fill each other's gaps
    with ThreadPool(min(folds, parallelism)) as pool:
        fit = inheritable_thread_target(df.sparkSession)(lambda fold, scope: scope.run(_fit, learner(), train, fold))
        models = pool.starmap(fit, [(fold, copy_context()) for fold in range(folds)])
    held_out = [
        model.transform(train.filter(F.col("fold") == fold)).select(key, "split", "fold", predicted(model).alias(name))
        for fold, model in enumerate(models)
    ]
    out_of_fold = reduce(DataFrame.unionByName, held_out)
    # test rows pass through the models one after the other; no join, no shuffle
    averaged = test.withColumn("_sum", F.lit(0.0))
    for model in models:
        scored = model.transform(averaged)
        averaged = scored.withColumn("_sum", F.col("_sum") + predicted(model)).select(*table.columns, "_sum")
    average = (F.col("_sum") / folds).alias(name)
    scores = out_of_fold.unionByName(averaged.select(key, "split", "fold", average))
    return CrossValidated(scores, models, input_names(df, features, vectors))


def mean_importance(importances: DataFrame, top: int = 1000) -> DataFrame:
    """Features by their importance averaged over folds, strongest first."""
    return (
        importances.groupBy("feature")
        .agg(F.avg("importance").alias("importance"))
        .orderBy(F.desc("importance"), "feature")
        .limit(top)
    )
