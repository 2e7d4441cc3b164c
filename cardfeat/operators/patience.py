"""Boosting that goes on until the held-out rows stop getting better.

Every round fits one tree of ``pyspark.ml`` on what the rounds before have left
over. Rounds are taken in chunks: after a chunk the rows are written with their
scores, so no plan grows longer than a chunk, the held-out error after each of its
rounds is taken in one pass, and the run ends once the best round lies ``patience``
rounds back. The model keeps the trees up to that round.

With ``path`` a chunk's trees and rows are written there and a run that was killed
goes on after its last whole chunk, given the same rows and settings. Without it
they go to the shared folder.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasValidationIndicatorCol
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardfeat.session import ensure_checkpoint_dir, scratch_path

#: Rounds at most, rounds without a better one after which a run ends, weight of a tree.
ROUNDS, PATIENCE, STEP = 10_000, 150, 0.005
CHUNK = 25
#: Rows a task goes over at least: each round is some ten jobs, and below this their tasks cost more than their rows.
TASK_ROWS = 100_000
#: Held-out probabilities are kept this far from 0 and 1 in the log loss.
_EDGE = 1e-12


def ensemble(trees: Sequence, step: float, spark: SparkSession) -> GBTRegressionModel:
    """The trees as one boosted model, all with the weight ``step``."""
    gateway = spark.sparkContext._gateway
    regression = gateway.jvm.org.apache.spark.ml.regression
    array = gateway.new_array(regression.DecisionTreeRegressionModel, len(trees))
    weights = gateway.new_array(gateway.jvm.double, len(trees))
    for k, tree in enumerate(trees):
        array[k], weights[k] = tree._java_obj, float(step)
    uid = gateway.jvm.org.apache.spark.ml.util.Identifiable.randomUID("patient")
    return GBTRegressionModel(regression.GBTRegressionModel(uid, array, weights))


def probability(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-margin))


def left_over(label: Column, margin: Column, logistic: bool) -> Column:
    """What the next tree is fitted on: the rest, or four times the rest of a probability."""
    return (label - probability(margin)) * 4.0 if logistic else label - margin


def held_out_loss(label: Column, margin: Column, logistic: bool) -> Column:
    if not logistic:
        return (label - margin) * (label - margin)
    p = F.least(F.greatest(probability(margin), F.lit(_EDGE)), F.lit(1 - _EDGE))
    return -(label * F.log(p) + (1.0 - label) * F.log(1.0 - p))


def best_round(errors: Sequence[float]) -> int:
    """The number of rounds after which the error is smallest; ties go to the fewer."""
    return int(np.argmin(errors)) + 1 if len(errors) else 0


def is_over(errors: Sequence[float], rounds: int, patience: int) -> bool:
    return len(errors) >= rounds or len(errors) - best_round(errors) >= patience


class _State:
    """What a run has reached, in a folder: a folder per chunk, whole once its note is there."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        jvm = spark._jvm
        self._Path = jvm.org.apache.hadoop.fs.Path
        self.files = self._Path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def chunk(self, number: int) -> str:
        return f"{self.path}/chunk-{number:05d}"

    def note(self, number: int) -> dict | None:
        """What was noted of a chunk, or None if it is not whole."""
        where = f"{self.chunk(number)}/note"
        if not self.files.exists(self._Path(f"{where}/_SUCCESS")):
            return None
        return json.loads(self.spark.read.text(where).first()[0])

    def write_note(self, number: int, note: dict) -> None:
        """Written last: a chunk counts once Spark has marked its note as done."""
        self.spark.createDataFrame([(json.dumps(note),)], "value string").coalesce(1).write.text(f"{self.chunk(number)}/note")

    def delete(self, path: str) -> None:
        self.files.delete(self._Path(path), True)


class PatientBoosting(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol, HasValidationIndicatorCol):
    """Regression trees, one a round, until ``patience`` rounds bring no better held-out error."""

    logistic = False

    def __init__(
        self,
        label: str = "target",
        rounds: int = ROUNDS,
        patience: int = PATIENCE,
        chunk: int = CHUNK,
        depth: int = 5,
        step: float = STEP,
        min_rows: int = 30,
        feature_share: str = "0.9",
        row_share: float = 0.9,
        seed: int = 11,
        path: str | None = None,
    ):
        super().__init__()
        self._set(featuresCol="features", labelCol=label, predictionCol="prediction", validationIndicatorCol="held_out")
        self.rounds, self.patience, self.chunk, self.step, self.seed, self.path = rounds, patience, chunk, step, seed, path
        self._tree = dict(maxDepth=depth, minInstancesPerNode=min_rows, featureSubsetStrategy=feature_share, subsamplingRate=row_share)

    def settings(self) -> dict:
        """What must be alike for a run to be gone on with."""
        return {"label": self.getLabelCol(), "step": self.step, "seed": self.seed, "chunk": self.chunk, "logistic": self.logistic, **self._tree}

    def _start(self, train: DataFrame) -> float:
        mean = train.agg(F.avg("label")).first()[0]
        if mean is None:
            raise ValueError("no rows to fit on besides the held-out ones")
        if not self.logistic:
            return float(mean)
        mean = min(max(mean, 1e-6), 1 - 1e-6)
        return float(np.log(mean / (1 - mean)))

    def _grow(self, rows: DataFrame, count: int, first: int) -> list:
        """``count`` trees, each fitted on what those before have left of the rows."""
        spark, trees = rows.sparkSession, []
        # every fit goes over its rows three times, so those of a chunk are decoded once
        fit_rows = rows.filter(~F.col("held")).select("features", "label", "margin").persist()
        try:
            for k in range(count):
                margin = F.col("margin")
                current = fit_rows
                if trees:
                    current = ensemble(trees, self.step, spark).setPredictionCol("_grown").transform(current)
                    margin = margin + F.col("_grown")
                current = current.select("features", left_over(F.col("label"), margin, self.logistic).alias("left"))
                forest = RandomForestRegressor(labelCol="left", numTrees=1, bootstrap=False, seed=self.seed + first + k, **self._tree)
                trees.append(forest.fit(current).trees[0])
        finally:
            fit_rows.unpersist()
        return trees

    def _errors(self, rows: DataFrame, trees: list) -> list[float]:
        """The mean held-out loss after each of the trees, in one pass."""
        held, margin, losses = rows.filter("held"), F.col("margin"), []
        for k, tree in enumerate(trees):
            held = tree.setPredictionCol(f"_tree{k}").transform(held)
            margin = margin + F.col(f"_tree{k}") * self.step
            losses.append(F.avg(held_out_loss(F.col("label"), margin, self.logistic)).alias(f"e{k}"))
        found = list(held.agg(*losses).first())
        if found[0] is None:
            raise ValueError("no held-out rows to watch")
        return found

    def _fit(self, dataset: DataFrame) -> PatientModel:
        spark = dataset.sparkSession
        ensure_checkpoint_dir(spark)
        state = _State(spark, self.path or scratch_path(spark, "patient"))
        held = F.coalesce(F.col(self.getValidationIndicatorCol()), F.lit(False)).alias("held")
        given = dataset.select(F.col(self.getFeaturesCol()).alias("features"), F.col(self.getLabelCol()).cast("double").alias("label"), held)
        given = given.filter(F.col("label").isNotNull())
        chunks, errors, number, rows = [], [], 0, None
        while (note := state.note(number)) is not None:
            if note["settings"] != self.settings():
                raise ValueError(f"{state.path} holds a run with other settings: {note['settings']}")
            chunks.append(GBTRegressionModel.load(f"{state.chunk(number)}/trees"))
            errors += note["errors"]
            start, number = note["start"], number + 1
        if number:
            rows = spark.read.parquet(f"{state.chunk(number - 1)}/rows") if not is_over(errors, self.rounds, self.patience) else None
        else:
            start = self._start(given.filter(~F.col("held")))
            rows = given.coalesce(-(-given.count() // TASK_ROWS)).withColumn("margin", F.lit(start))
        while not is_over(errors, self.rounds, self.patience):
            state.delete(state.chunk(number))  # what a killed run may have left of it
            trees = self._grow(rows, min(self.chunk, self.rounds - len(errors)), len(errors))
            grown = ensemble(trees, self.step, spark)
            grown.save(f"{state.chunk(number)}/trees")
            after = grown.setPredictionCol("_grown").transform(rows)
            after = after.select("features", "label", "held", (F.col("margin") + F.col("_grown")).alias("margin"))
            after.write.parquet(f"{state.chunk(number)}/rows")
            found = self._errors(rows, trees)
            state.write_note(number, {"start": start, "errors": found, "settings": self.settings()})
            if number:
                state.delete(f"{state.chunk(number - 1)}/rows")
            rows = spark.read.schema(after.schema).parquet(f"{state.chunk(number)}/rows")
            chunks.append(grown)
            errors += found
            number += 1
        if not self.path:
            state.delete(state.path)
        best = best_round(errors)
        trees = [tree for chunk in chunks for tree in chunk.trees][:best]
        return self._model(ensemble(trees, self.step, spark), start, errors)

    def _model(self, grown: GBTRegressionModel, start: float, errors: list[float]) -> PatientModel:
        return PatientModel(grown, start, errors, self.getPredictionCol(), self.getFeaturesCol())


class PatientModel(Model, HasPredictionCol, HasFeaturesCol):
    """The trees up to the best round, and the held-out error after every round that was run."""

    def __init__(self, trees: GBTRegressionModel, start: float, errors: list[float], prediction: str, features: str):
        super().__init__()
        self._set(predictionCol=prediction, featuresCol=features)
        self.ensemble, self.start, self.errors = trees, start, errors

    @property
    def rounds(self) -> int:
        return self.ensemble.getNumTrees

    @property
    def featureImportances(self):
        return self.ensemble.featureImportances

    def save(self, path: str) -> None:
        """Write the trees in Spark's own layout."""
        self.ensemble.save(path)

    def margin(self, dataset: DataFrame, name: str) -> DataFrame:
        scored = self.ensemble.setPredictionCol(name).setFeaturesCol(self.getFeaturesCol()).transform(dataset)
        return scored.withColumn(name, F.col(name) + self.start)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.margin(dataset, self.getPredictionCol())


class PatientClassifier(PatientBoosting, HasProbabilityCol):
    """The same for 0/1 labels, by log loss."""

    logistic = True

    def __init__(self, label: str = "outliers", **settings):
        super().__init__(label, **settings)
        self._set(probabilityCol="probability")

    def _model(self, grown: GBTRegressionModel, start: float, errors: list[float]) -> PatientClassifierModel:
        return PatientClassifierModel(grown, start, errors, self.getPredictionCol(), self.getFeaturesCol(), self.getProbabilityCol())


class PatientClassifierModel(PatientModel, HasProbabilityCol):
    def __init__(self, trees, start, errors, prediction, features, probability_col):
        super().__init__(trees, start, errors, prediction, features)
        self._set(probabilityCol=probability_col)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scored = self.margin(dataset, "_margin")
        p = probability(F.col("_margin"))
        scored = scored.withColumn(self.getProbabilityCol(), array_to_vector(F.array(1.0 - p, p)))
        return scored.withColumn(self.getPredictionCol(), (p >= 0.5).cast("double")).drop("_margin")
