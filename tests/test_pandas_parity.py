"""Rollups against pandas, whose treatment of missing values they follow."""

import numpy as np
import pandas as pd
import pytest

from cardfeat.operators.rollup import Rollup, roll_up, successive_means, take

STATS = ["sum", "mean", "min", "max", "std", "var", "skew", "median", "nunique", "count"]


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(7)
    n = 600
    x = np.round(rng.gamma(2.0, 3.0, n) - 2, 6)
    x[rng.random(n) < 0.2] = np.nan
    card = rng.integers(0, 60, n).astype(float)
    card[rng.random(n) < 0.05] = np.nan
    card[rng.random(n) < 0.33] = 3.0  # a third of the rows on one card
    return pd.DataFrame(
        {
            "card_id": card,
            "x": x,
            "lag": rng.integers(-13, 1, n),
            "group": rng.choice(["a", "b", None], n, p=[0.5, 0.3, 0.2]),
        }
    )


@pytest.fixture(scope="module")
def table(spark, frame):
    kinds = {"card_id": int, "x": float, "lag": int, "group": str}
    rows = [
        tuple(None if pd.isna(v) else kinds[c](v) for c, v in zip(frame.columns, r)) for r in frame.itertuples(index=False)
    ]
    return spark.createDataFrame(rows, "card_id bigint, x double, lag int, group string")


@pytest.mark.parametrize("hot_rows", [10_000, 50])
def test_every_statistic(frame, table, hot_rows):
    want = frame.groupby("card_id").agg({"x": STATS, "lag": STATS})
    want.columns = ["_".join(c) for c in want.columns]
    want["size"] = frame.groupby("card_id").size()
    got = roll_up(table, Rollup("", take(" ".join(STATS), "x", "lag"), "size"), hot_rows=hot_rows).toPandas()
    got = got.set_index("card_id").sort_index()
    assert list(got.index) == [int(i) for i in want.index]
    for c in want.columns:
        assert got[c].astype(float).to_numpy() == pytest.approx(want[c].to_numpy(float), rel=1e-9, abs=1e-9, nan_ok=True), c


def test_successive_means(frame, table):
    first = frame.groupby(["card_id", "group"])["x"].mean().reset_index()
    want = first.groupby("card_id")["x"].agg(["mean", "min", "max", "std"])
    got = successive_means(table, [("group", "x")]).toPandas().set_index("card_id").sort_index()
    assert list(got.index) == [int(i) for i in want.index]
    for stat in want.columns:
        mine = got[f"group_x_{stat}"].astype(float).to_numpy()
        assert mine == pytest.approx(want[stat].to_numpy(), rel=1e-9, abs=1e-9, nan_ok=True), stat
