import numpy as np
import pytest
from pyspark.sql import functions as F

from cardfeat.operators import blend, folds

DATA = [(1.0, 2.0, 1.0), (2.0, 1.0, 2.0), (3.0, 5.0, 2.5), (4.0, 4.0, 4.0), (5.0, 9.0, 6.0)]


def test_ridge_closed_form(rows):
    fit = blend.linear_fit(rows(DATA, "a double, b double, y double"), ["a", "b"], "y", alpha=1.0)
    assert fit == pytest.approx([0.764785, 0.211022, -0.080645], abs=1e-6)


def test_least_squares_agrees_with_numpy(rows):
    df = rows(DATA, "a double, b double, y double")
    x = np.array([[a, b, 1.0] for a, b, _ in DATA])
    want = np.linalg.lstsq(x, np.array([y for *_, y in DATA]), rcond=None)[0]
    assert blend.linear_fit(df, ["a", "b"], "y") == pytest.approx(want)
    assert list(df.agg(*blend.two_column_blend("a", "b", "y")).first()) == pytest.approx(want)


def test_fold_fits_leave_their_fold_out(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3))
    y = x @ [1.0, -2.0, 0.5] + rng.normal(size=200) * 0.1
    data = [(*map(float, r), float(t), i % 4) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "a double, b double, c double, y double, fold int")
    for k, got in blend.fold_fits(df, ["a", "b", "c"], "y", 1.0).items():
        keep = np.array([f != k for *_, f in data])
        xc, yc = x[keep] - x[keep].mean(0), y[keep] - y[keep].mean()
        w = np.linalg.solve(xc.T @ xc + np.eye(3), xc.T @ yc)
        assert got == pytest.approx(np.append(w, y[keep].mean() - w @ x[keep].mean(0)))


def test_weighted_blend(rows):
    df = rows([(1.0, 2.0)], "target0 double, target1 double")
    assert df.select(blend.weighted()).first()[0] == pytest.approx(1.26950526)


def test_routing(rows):
    df = rows([(0.3, 1.5), (0.29, 1.5)], "p double, pred double")
    got = df.select(blend.route_outliers(F.col("p"), F.col("pred"))).collect()
    assert [r[0] for r in got] == [-33.219281, 1.5]


def test_folds_partition_the_rows_and_repeat(spark):
    df = spark.range(2000).withColumnRenamed("id", "card_id")
    first = {r["card_id"]: r["fold"] for r in folds.add_fold(df, 10).collect()}
    again = {r["card_id"]: r["fold"] for r in folds.add_fold(df.repartition(7), 10).collect()}
    assert first == again and set(first.values()) == set(range(10))
    assert min(np.bincount(list(first.values()))) > 140
    assert first != {r["card_id"]: r["fold"] for r in folds.add_fold(df, 10, seed=1).collect()}


def test_out_of_fold_means_do_not_see_their_row(rows):
    data = [(1, 0, 10.0), (1, 1, 20.0), (1, 1, 30.0), (2, 0, 5.0), (1, 0, None), (3, 1, None)]
    df = rows(data, "f int, fold int, y double")
    got = folds.out_of_fold_means(df, "f", "y", "p").collect()
    seen = sorted((r["f"], r["fold"], r["y"], r["p"]) for r in got if r["y"] is not None)
    assert seen == [(1, 0, 10.0, 25.0), (1, 1, 20.0, 10.0), (1, 1, 30.0, 10.0), (2, 0, 5.0, None)]
    assert {(r["f"], r["p"]) for r in got if r["y"] is None} == {(1, 20.0), (3, None)}


def test_large_means_do_not_swallow_small_spreads(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 2))
    y = x @ [1.0, -2.0] + rng.normal(size=500) * 0.01
    data = [(float(a) + 1e7, float(b) - 1e7, float(t), i % 5) for i, ((a, b), t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(data, "a double, b double, y double, fold int").repartition(7)

    def centred(keep, alpha):
        c = x[keep] - x[keep].mean(axis=0)
        return np.linalg.solve(c.T @ c + alpha * np.eye(2), c.T @ (y[keep] - y[keep].mean()))

    assert blend.linear_fit(df, ["a", "b"], "y")[:2] == pytest.approx(centred(np.arange(500), 0.0), abs=1e-6)
    for k, got in blend.fold_fits(df, ["a", "b"], "y", 1.0).items():
        assert got[:2] == pytest.approx(centred(np.arange(500) % 5 != k, 1.0), abs=1e-6)
