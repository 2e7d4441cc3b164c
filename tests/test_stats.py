"""Per-group statistics against values worked out by hand."""

import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from cardfeat.operators.clean import clear_sentinels
from cardfeat.operators.rollup import Rollup, custom, roll_up, take

ALL = "sum mean min max std var skew ptp count nunique median"


def one(df, measures, **kwargs):
    return {r["card_id"]: r.asDict() for r in roll_up(df, Rollup("", measures, "size"), **kwargs).collect()}


def amounts(rows, *values, card="a"):
    return rows([(card, v) for v in values], "card_id string, x double")


def test_spread(rows):
    got = one(amounts(rows, 1.0, 2.0, 5.0, 11.0), take(ALL, "x"))["a"]
    assert [got[f"x_{s}"] for s in ("mean", "median", "var", "std")] == pytest.approx([4.75, 3.5, 20.25, 4.5])
    assert got["x_skew"] == pytest.approx(1.248285, abs=1e-6)
    assert (got["x_ptp"], got["x_count"], got["x_nunique"], got["size"]) == (10.0, 4, 4, 4)


def test_single_row(rows):
    got = one(amounts(rows, 10.0), take(ALL, "x"))["a"]
    assert (got["x_std"], got["x_var"], got["x_skew"]) == (None, None, None)
    assert (got["x_ptp"], got["x_count"], got["x_median"]) == (0.0, 1, 10.0)


def test_two_rows_have_no_skew(rows):
    assert one(amounts(rows, 1.0, 4.0), take("skew", "x"))["a"]["x_skew"] is None


def test_constant(rows):
    got = one(amounts(rows, 1.0, 1.0, 1.0), take("var skew", "x"))["a"]
    assert (got["x_var"], got["x_skew"]) == (0.0, 0.0)


def test_group_without_values(rows):
    df = clear_sentinels(rows([("a", -1), ("a", 999)], "card_id string, installments int"))
    got = one(df, take("sum mean min max std count nunique", "installments"))["a"]
    assert (got["installments_sum"], got["installments_count"], got["installments_nunique"], got["size"]) == (0, 0, 0, 2)
    assert [got[f"installments_{s}"] for s in ("mean", "min", "max", "std")] == [None] * 4


def test_null_key_is_no_group(rows):
    df = rows([(None, 1.0), ("a", 2.0)], "card_id string, x double")
    assert set(one(df, take("sum nunique", "x"))) == {"a"}


def test_custom_aggregate(rows):
    spread = custom("range", "x", lambda c: F.max(c) - F.min(c))
    assert one(amounts(rows, 1.0, 4.0), (spread,))["a"]["x_range"] == 3.0


def test_stable_sums_do_not_depend_on_order(spark):
    df = spark.range(2000).select(F.lit("a").alias("card_id"), (F.col("id") * 0.1 / 7).alias("x"))
    spec = Rollup("", take("sum mean std", "x"), None, 6)
    results = {tuple(roll_up(df.repartition(n), spec).first()) for n in (1, 3, 7, 16)}
    assert len(results) == 1


@pytest.mark.parametrize("hot_rows", [0, 30, 10_000])
def test_hot_keys_give_the_same_result(spark, hot_rows):
    """A third of the rows on one key; every route must agree."""
    df = spark.range(300).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 20).cast("string")).alias("card_id"),
        (F.col("id") % 17).cast("double").alias("x"),
        F.when(F.col("id") % 5 != 0, F.col("id") % 11).alias("y"),
    )
    spec = Rollup("", take("nunique median sum", "x", "y"), "size", 6)
    want = {}
    for r in df.collect():
        want.setdefault(r["card_id"], []).append((r["x"], r["y"]))
    got = {r["card_id"]: r for r in roll_up(df, spec, hot_rows=hot_rows).collect()}
    assert set(got) == set(want)
    for card, values in want.items():
        xs, ys = sorted(v[0] for v in values), sorted(v[1] for v in values if v[1] is not None)
        mid = lambda v: (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2 if v else None
        r = got[card]
        assert (r["size"], r["x_nunique"], r["y_nunique"]) == (len(xs), len(set(xs)), len(set(ys)))
        assert (r["x_median"], r["y_median"], r["x_sum"]) == (mid(xs), mid(ys), sum(xs))


def test_distinct_counts_of_hot_keys_hold_one_column_at_a_time(rows):
    data = [("a", 0.0, "p", None), ("a", -0.0, None, None), ("a", float("nan"), "q", None), ("b", None, "p", 3), ("b", 1.5, "p", 3), (None, 9.0, "z", 9)]
    df = rows(data * 2, "card_id string, x double, y string, z int")
    found = roll_up(df, Rollup("", take("nunique", "x", "y", "z", "card_id")), hot_rows=0)
    assert {tuple(r) for r in found.collect()} == {("a", 1, 2, 0, 1), ("b", 1, 1, 1, 1)}
    assert "Expand" not in found._jdf.queryExecution().toString()  # rows as wide as all columns, once for each


def test_wide_specs_are_split_and_joined(rows):
    names = [f"c{i}" for i in range(30)]
    df = rows([("a", *range(30)), ("a", *range(1, 31)), ("b", *[None] * 30)], "card_id string, " + ", ".join(f"{n} int" for n in names))
    got = one(df, take("sum max min", *names))
    assert (got["a"]["c7_sum"], got["a"]["c29_max"], got["a"]["c0_min"], got["a"]["size"]) == (15, 30, 0, 2)
    assert (got["b"]["c29_sum"], got["b"]["c29_max"], got["b"]["size"]) == (0, None, 1)


@pytest.mark.parametrize("hot_rows", [0, 10_000])
def test_missing_values_on_both_routes(rows, hot_rows):
    nan, inf = float("nan"), float("inf")
    data = [("a", v) for v in (nan, nan, 1.0, 2.0, 3.0, -0.0, 0.0)] + [("b", nan), ("b", None), ("c", 1.0), ("c", inf), ("d", inf), ("d", -inf)]
    spec = Rollup("", take("nunique median sum std count", "x"), None, 6)
    got = {r["card_id"]: tuple(r)[1:] for r in roll_up(rows(data, "card_id string, x double"), spec, hot_rows=hot_rows).collect()}
    assert got["a"] == (4, 1.0, 6.0, 1.30384, 5)
    assert got["b"] == (0, None, 0.0, None, 0)
    assert got["c"] == (2, inf, inf, None, 2)
    assert got["d"][0] == 2 and got["d"][3:] == (None, 2)


def test_large_sums_can_be_repeated(spark):
    df = spark.range(400_000).select(F.lit("a").alias("card_id"), (4000 + F.col("id") * 0.1 / 7).alias("x"))
    spec = Rollup("", take("sum mean", "x"), None, 6)
    results = {tuple(roll_up(df.repartition(n), spec).first()) for n in (1, 3, 8, 17, 64)}
    assert len(results) == 1 and next(iter(results))[1] > 1e9


@pytest.mark.parametrize("hot_rows", [10_000, 0])
def test_repeatable_spreads_have_equal_bits(spark, hot_rows):
    i = F.col("id")
    df = spark.range(3_000).select(
        F.when(i % 3 == 0, "hot").otherwise((i % 20).cast("string")).alias("card_id"), (1e6 + F.sin(i) / 7).alias("x"),
        F.when(i % 5 != 0, (i % 11) * 0.1).alias("y"), F.lit(0.1).alias("same"),
    )
    spec = Rollup("", take("std var skew", "x", "y", "same"), "size", repeatable=True)
    runs = [sorted(map(tuple, roll_up(df.repartition(n), spec, hot_rows=hot_rows).collect())) for n in (1, 3, 7, 16, 40)]
    assert all(run == runs[0] for run in runs)
    want = {}
    for r in df.collect():
        want.setdefault(r["card_id"], []).append(r)
    for card, size, *got in runs[0]:
        values = want[card]
        assert size == len(values)
        for k, name in enumerate(("x", "y", "same")):
            own = sorted(v[name] for v in values if v[name] is not None)
            if not own:
                assert got[3 * k : 3 * k + 3] == [None] * 3
                continue
            n, mean = len(own), sum(map(Fraction, own)) / len(own)
            m2, m3 = (float(sum((Fraction(v) - mean) ** p for v in own)) for p in (2, 3))
            var = m2 / (n - 1) if name != "same" else 0.0
            skew = math.sqrt(n * (n - 1)) * math.sqrt(n) * m3 / ((n - 2) * m2**1.5) if name != "same" else 0.0
            assert got[3 * k : 3 * k + 3] == pytest.approx([math.sqrt(var), var, skew], rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("hot_rows", [10_000, 0])
def test_repeatable_spreads_of_few_and_odd_values(rows, hot_rows):
    nan, inf = float("nan"), float("inf")
    data = [("a", 10.0), ("b", 1.0), ("b", 4.0), ("c", 1.0), ("c", 1.0), ("c", 1.0), ("d", None), ("d", nan), ("e", 1.0), ("e", inf), (None, 3.0)]
    data += [("f", v) for v in (1.0, 2.0, 5.0, 11.0, nan)]
    spec = Rollup("", take("std var skew median count", "x"), None, 6, repeatable=True)
    got = {r["card_id"]: tuple(r)[1:] for r in roll_up(rows(data, "card_id string, x double"), spec, hot_rows=hot_rows).collect()}
    assert got["a"][:3] == (None, None, None) and got["b"][1:3] == (4.5, None) and got["c"][:3] == (0.0, 0.0, 0.0)
    assert got["d"] == (None, None, None, None, 0) and got["e"][:3] == (None, None, None) and set(got) == set("abcdef")
    assert got["f"][:3] == pytest.approx((4.5, 20.25, 1.248285), abs=1e-6) and got["f"][3:] == (3.5, 4)


def test_spreads_of_few_deals(spark):
    from cardfeat.operators.spreads import of_large_groups

    df = spark.range(500).select(F.lit(1).alias("k"), F.lit("z").alias("z"), F.sqrt("id").alias("x"))
    whole, dealt = (of_large_groups(df, ["k", "z"], "x", {"var": "var", "skew": "skew"}, deals).first() for deals in (1, 7))
    assert tuple(whole)[:2] == (1, "z") and tuple(whole)[2:] == pytest.approx(tuple(dealt)[2:], rel=1e-12)
