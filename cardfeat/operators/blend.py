"""Combining predictions: fixed weights, least squares, ridge, routing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Weights of the published two-model blend, the probability from
#: which a card counts as an outlier, and the score such a card gets.
BLEND_WEIGHTS = {"target0": 0.73839798, "target1": 0.26555364}
OUTLIER_PROBABILITY = 0.3
OUTLIER_SCORE = -33.219281


def weighted(columns: Mapping[str, float] = BLEND_WEIGHTS) -> Column:
    """Sum of columns times weights, without intercept."""
    terms = [F.col(c) * F.lit(w) for c, w in columns.items()]
    out = terms[0]
    for term in terms[1:]:
        out = out + term
    return out


def blend_tables(first: DataFrame, second: DataFrame, key: str = "card_id") -> DataFrame:
    """Inner-join two prediction tables and blend them with the fixed weights."""
    left = first.withColumnRenamed("target", "target0")
    right = second.withColumnRenamed("target", "target1")
    return left.join(right, key).select(key, weighted().alias("target"))


def rmse(prediction: Column, truth: Column) -> Column:
    return F.sqrt(F.avg(F.pow(prediction - truth, F.lit(2.0))))


def route_outliers(
    probability: Column,
    prediction: Column,
    threshold: float = OUTLIER_PROBABILITY,
    score: float = OUTLIER_SCORE,
) -> Column:
    """The outlier score from the threshold on, else the regressor's value."""
    return F.when(probability >= threshold, F.lit(score)).otherwise(prediction)


def _moment_columns(features: Sequence[str], target: str) -> list[Column]:
    """Count, means and centred cross products: everything a linear fit needs.

    Spark merges them around the running means, so large means do not swallow
    small spreads.
    """
    names = [F.col(c).cast("double") for c in (*features, target)]
    columns = [F.count(F.lit(1)).alias("n")]
    columns += [F.avg(c).alias(f"m_{i}") for i, c in enumerate(names)]
    pairs = combinations_with_replacement(range(len(names)), 2)
    columns += [F.covar_pop(names[i], names[j]).alias(f"c_{i}_{j}") for i, j in pairs]
    return columns


@dataclass
class _Moments:
    """Rows, means and centred cross products of a set of rows."""

    n: float
    mean: np.ndarray
    cross: np.ndarray

    @classmethod
    def of(cls, row: Mapping[str, float], size: int) -> _Moments:
        cross = np.empty((size, size))
        for i, j in combinations_with_replacement(range(size), 2):
            cross[i, j] = cross[j, i] = row[f"c_{i}_{j}"] * row["n"]
        return cls(row["n"], np.array([row[f"m_{i}"] for i in range(size)]), cross)

    def __add__(self, other: _Moments) -> _Moments:
        n = self.n + other.n
        step = other.mean - self.mean
        cross = self.cross + other.cross + np.outer(step, step) * (self.n * other.n / n)
        return _Moments(n, self.mean + step * (other.n / n), cross)

    def solve(self, alpha: float) -> np.ndarray:
        """Coefficients and intercept of a ridge fit with a free intercept."""
        size = len(self.mean) - 1
        weights = np.linalg.solve(self.cross[:size, :size] + alpha * np.eye(size), self.cross[:size, size])
        return np.append(weights, self.mean[size] - weights @ self.mean[:size])


def linear_fit(train: DataFrame, features: Sequence[str], target: str, alpha: float = 0.0) -> np.ndarray:
    """Least squares (``alpha=0``) or ridge weights, the intercept last.

    Spark adds up the moments; one row reaches the driver, however many train
    rows there are.
    """
    row = train.agg(*_moment_columns(features, target)).first()
    return _Moments.of(row.asDict(), len(features) + 1).solve(alpha)


def fold_fits(
    train: DataFrame, features: Sequence[str], target: str, alpha: float = 1.0, fold: str = "fold"
) -> dict[int, np.ndarray]:
    """One ridge fit per fold, each on the rows of all other folds.

    Moments are added up per fold in one pass (one row per fold on the driver)
    and merged for each fold's complement.
    """
    rows = train.groupBy(fold).agg(*_moment_columns(features, target)).collect()
    parts = {r[fold]: _Moments.of(r.asDict(), len(features) + 1) for r in sorted(rows, key=lambda r: r[fold])}
    others = {k: [m for j, m in parts.items() if j != k] or [parts[k]] for k in parts}
    return {k: reduce(lambda a, b: a + b, some).solve(alpha) for k, some in others.items()}


def linear_prediction(weights: Sequence[float], features: Sequence[str]) -> Column:
    out = F.lit(float(weights[-1]))
    for w, c in zip(weights, features):
        out = out + F.lit(float(w)) * F.col(c)
    return out


def ridge_stack(
    df: DataFrame, features: Sequence[str], target: str, name: str = "stacked", alpha: float = 1.0, fold: str = "fold"
) -> DataFrame:
    """Stack prediction columns with a ridge per fold.

    Train rows get the fit that did not see them, rows without a target the
    average over the folds.
    """
    fits = fold_fits(df.filter(F.col(target).isNotNull()), features, target, alpha, fold)
    average = np.mean(list(fits.values()), axis=0)
    held_out = F.lit(None).cast("double")
    for k, weights in fits.items():
        held_out = F.when(F.col(fold) == k, linear_prediction(weights, features)).otherwise(held_out)
    return df.withColumn(
        name, F.when(F.col(target).isNotNull(), held_out).otherwise(linear_prediction(average, features))
    )


def two_column_blend(first: str, second: str, target: str) -> list[Column]:
    """Least-squares weights of two predictions as plain aggregates.

    Gives ``coef_1``, ``coef_2`` and ``intercept`` in one row without a fit on
    the driver; null when the two predictions are collinear.
    """
    a, b, y = (F.col(c) for c in (first, second, target))
    va, vb, cab = F.var_pop(a), F.var_pop(b), F.covar_pop(a, b)
    cay, cby = F.covar_pop(a, y), F.covar_pop(b, y)
    det = va * vb - cab * cab
    w1 = F.try_divide(vb * cay - cab * cby, det)
    w2 = F.try_divide(va * cby - cab * cay, det)
    return [
        w1.alias("coef_1"),
        w2.alias("coef_2"),
        (F.avg(y) - w1 * F.avg(a) - w2 * F.avg(b)).alias("intercept"),
    ]
