import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cardfeat.functions.scoring import GRID, step_score
from cardfeat.operators import quantiles as q
from cardfeat.operators.quantiles import exact_quantiles, table_quantiles


def quantiles(spark, values, probabilities):
    df = spark.createDataFrame([(1, v) for v in values], "k int, v double")
    return exact_quantiles(df, ["k"], "v", probabilities).first()["quantiles"]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e9, 1e9) | st.sampled_from([0.0, 1.0, -1e-12, 1e-12]), min_size=1, max_size=40))
def test_matches_linear_interpolation(spark, values):
    got = quantiles(spark, values, GRID)
    want = np.quantile(np.array(values), GRID)
    assert got == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_grid_of_whole_numbers(spark):
    got = quantiles(spark, [float(v) for v in range(17)], GRID)
    assert got == pytest.approx([0.176, 0.8, 4, 8, 12, 15.2, 15.824])


def test_one_value_holds_most_rows(spark):
    """Many copies of one value: counted before they are shuffled."""
    df = spark.range(30000).select(F.lit(1).alias("k"), F.when(F.col("id") < 29000, 5.0).otherwise(F.col("id") * 1.0).alias("v"))
    got = exact_quantiles(df, ["k"], "v", [0.5, 0.989]).first()["quantiles"]
    assert got == pytest.approx(np.quantile([5.0] * 29000 + list(range(29000, 30000)), [0.5, 0.989]))


def test_nulls_are_left_out_and_columns_are_apart(rows):
    df = rows([(1.0, None), (3.0, None), (None, 7.0)], "a double, b double")
    got = {r["metric"]: r["quantiles"] for r in table_quantiles(df, ["a", "b"], [0.5]).collect()}
    assert got == {"a": [2.0], "b": [7.0]}


def test_scores(rows):
    bounds = [0.176, 0.8, 4.0, 8.0, 12.0, 15.2, 15.824]
    df = rows([(0, 0.0), (1, 1.0), (2, 4.0), (3, 5.0), (4, 16.0), (5, None)], "i int, x double")
    columns = [F.lit(b) for b in bounds]
    got = df.select("i", step_score(F.col("x"), columns), step_score(F.col("x"), columns, False)).orderBy("i").collect()
    assert [r[1] for r in got] == [1, 3, 3, 4, 8, 8]
    assert [r[2] for r in got] == [8, 6, 6, 5, 1, 1]


def test_a_crowded_bucket_is_cut_until_it_is_small(spark, monkeypatch):
    """A million different doubles between 1 and 1.00005; no task orders more than a set number."""
    sizes = []

    def noted(df, name):
        out = q_stage(df, name)
        if name == "ranks":
            sizes.append(out.agg(F.max(F.when(F.col("_low") < F.col("_high"), F.col("_size")))).first()[0])
        return out

    q_stage = q.stage
    monkeypatch.setattr(q, "stage", noted)
    n = 1_000_000
    df = spark.range(n).select(F.lit(1).alias("k"), (1 + F.col("id") * (0.00005 / n)).alias("v"))
    got = exact_quantiles(df, ["k"], "v", GRID).first()["quantiles"]
    assert got == pytest.approx(np.quantile(1 + np.arange(n) * (0.00005 / n), GRID), rel=1e-14)
    assert sizes[0] > q.CELL_ROWS >= sizes[-1]


@pytest.mark.parametrize("cell_rows", [1, 3])
def test_small_cells_give_the_same(spark, monkeypatch, cell_rows):
    monkeypatch.setattr(q, "CELL_ROWS", cell_rows)
    inf = float("inf")
    values = [1.0, 1.0 + 1e-9, 1.0 + 2e-9, 1.0 + 2e-9, 5.0, -inf, inf, inf, float("nan"), -0.0, 0.0, 1e300, 1.7e308, -1.7e308]
    got = quantiles(spark, values, [0.0, 0.25, 0.5, 0.75, 1.0])
    clean = sorted(v for v in values if v == v)
    assert got == [clean[k] for k in (0, 3, 6, 9, 12)]
