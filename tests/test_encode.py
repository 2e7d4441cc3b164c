import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardfeat.functions.scalars import below, cap, yes_no
from cardfeat.operators import clean, encode, joins, narrow, rfm
from cardfeat.operators.skew import is_small


def test_one_hot(rows):
    df = rows([(1, 1.0), (2, None), (3, 5.0)], "i int, category_2 double")
    got = encode.one_hot(df, {"category_2": [1.0, 5.0]}).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [(1, 0), (0, 0), (0, 1)]
    assert got[0].asDict().keys() == {"i", "category_2_1_0", "category_2_5_0"}
    assert encode.one_hot(df, ["category_2"]).columns == ["i", "category_2_1_0", "category_2_5_0"]


@pytest.mark.parametrize("small", [100, 0])
def test_label_encode_orders_text(rows, small):
    df = rows([(10,), (2,), (1,), (None,)], "x int").withColumn("raw", F.col("x"))
    got = {r["raw"]: r["x"] for r in encode.label_encode(df, ["x"], small).collect()}
    assert got == {10: 1, 2: 2, 1: 0, None: None}


def test_spread_index_equals_single_sort(spark):
    df = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("x"))
    got = {r["x"]: r["i"] for r in encode.dense_index(df, "x", "i", small=0)[0].collect()}
    assert got == {v: i for i, v in enumerate(sorted(got))} and len(got) == 5000


def test_combination_index(rows):
    df = rows([(8, 1, 3), (1, 1, 1), (8, 1, 3), (2, 2, 2)], "a int, b int, c int")
    got = {(r["a"], r["b"], r["c"]): r["i"] for r in encode.combination_index(df, ["a", "b", "c"], "i").collect()}
    assert got == {(8, 1, 3): 2, (1, 1, 1): 0, (2, 2, 2): 1}


def test_target_encode_unseen_is_null(rows):
    train = rows([(1, 1), (1, 0), (2, 0)], "f int, y int")
    got = encode.target_encode(rows([(1,), (2,), (3,)], "f int"), train, ["f"], F.col("y"))
    assert {r["f"]: r["f_bp"] for r in got.collect()} == {1: 0.5, 2: 0.0, 3: None}


@pytest.mark.parametrize("limits", [{}, {"small": 0}, {"small": 0, "hot_rows": 0}, {"small": 0, "hot_rows": 1}])
def test_merchant_join(rows, limits):
    tx = rows([("t1", "m1", 1), ("t2", None, 1), ("t3", "gone", 1), ("t4", "twice", 1)], "tx string, merchant_id string, city int")
    merchants = rows([("m1", 9), ("idle", 9), ("twice", 7), ("twice", 8)], "merchant_id string, city int")
    got = sorted((r["tx"], r["city"], r["city_X"]) for r in joins.enrich(tx, merchants, "merchant_id", **limits).collect())
    assert got == [("t1", 1, 9), ("t4", 1, 7), ("t4", 1, 8)]


@pytest.mark.parametrize("limits", [{}, {"small": 0}, {"small": 0, "hot_rows": 0}, {"small": 0, "hot_rows": 2}])
def test_lookup_keeps_every_row(rows, limits):
    df = rows([(1, "a")] * 3 + [(2, "b"), (3, "b"), (None, "c"), (None, "d")], "k int, tag string")
    got = joins.lookup(df, rows([(1, 10), (2, 20)], "k int, v int"), ["k"], **limits).collect()
    assert sorted((r["tag"], r["k"] or 0, r["v"] or 0) for r in got) == (
        [("a", 1, 10)] * 3 + [("b", 2, 20), ("b", 3, 0), ("c", 0, 0), ("d", 0, 0)]
    )


def test_narrowing_bounds(rows):
    df = rows(
        [(-127, -128, 0, 0, None, 0.5), (126, 5, 127, 32767, None, 1.5)],
        "a bigint, b bigint, c bigint, d bigint, e bigint, f double",
    )
    types = dict(narrow.narrow(df).dtypes)
    assert types == {"a": "tinyint", "b": "smallint", "c": "smallint", "d": "int", "e": "bigint", "f": "double"}
    assert narrow.narrowed_types(df, keep_double=False)["f"] == T.FloatType()


def test_cleaning(rows):
    df = rows([("Y", 5.0, float("nan"), 999), ("?", None, 1.0, 3)], "flag string, amount double, x double, installments int")
    got = clean.clear_sentinels(clean.nan_to_null(df)).select(
        yes_no(F.col("flag")), cap(F.col("amount"), 0.8), "x", "installments", below(F.col("amount"), 6.0)
    )
    assert [tuple(r) for r in got.collect()] == [(1, 0.8, None, None, 1), (None, None, 1.0, 3, 0)]
    filled = clean.fill_missing(rows([(None, None)], "category_2 double, category_3 string")).first()
    assert tuple(filled) == (1.0, "A")


def test_rfm_scores_stay_in_range(spark):
    df = spark.range(400).select(
        F.col("id").alias("card_id"),
        F.when(F.col("id") % 2 == 0, "train").otherwise("test").alias("split"),
        F.when(F.col("id") % 7 != 0, F.col("id") % 50).alias("r"),
        (F.col("id") % 13).alias("f"),
        (F.col("id") * 0.25).alias("v"),
    )
    got = rfm.rfm_scores(df, "r", "f", "v").collect()
    assert len(got) == 400
    for r in got:
        scores = [r["r_quantile"], r["f_quantile"], r["v_quantile"]]
        assert all(1 <= s <= 8 for s in scores) and r["rfm_score"] == sum(scores)
        assert r["rfm_code"] == scores[0] * 100 + scores[1] * 10 + scores[2]
    for split in ("train", "test"):
        codes = sorted({r["rfm_code"] for r in got if r["split"] == split})
        assert {(r["rfm_code"], r["rfm_index"]) for r in got if r["split"] == split} == {(c, i) for i, c in enumerate(codes)}
    assert all(r["r_quantile"] == 8 for r in got if r["card_id"] % 7 == 0)  # null recency


def test_rfm_pooled_grid(spark):
    i = F.col("id")
    df = spark.range(17).select(i.alias("card_id"), i.alias("r"), i.alias("f"), i.alias("v"))
    got = {r["card_id"]: r for r in rfm.rfm_scores(df, "r", "f", "v", tag="new", by=None).collect()}
    assert got[16]["rnew_quantile"] == 8 and got[16]["fnew_quantile"] == 1 and got[16]["rfmnew_code"] == 811
    assert got[0]["rfmnew_code"] == 188 and got[0]["rfmnew_score"] == 17
    assert "split" not in df.columns and set(df.columns) < set(got[0].asDict())


def test_missing_text_gets_its_own_code(rows):
    df = rows([("b",), (None,), ("a",), (None,)], "x string").withColumn("raw", F.col("x"))
    got = {r["raw"]: r["x"] for r in encode.label_encode(df, ["x"], missing="nan").collect()}
    assert got == {"a": 0, "b": 1, None: 2}
    assert {r["raw"]: r["x"] for r in encode.label_encode(df, ["x"]).collect()}[None] is None


def test_one_hot_refuses_too_many_values(rows):
    df = rows([(1,), (2,), (3,)], "x int")
    with pytest.raises(ValueError, match="over 2"):
        encode.one_hot(df, ["x"], most=2)
    assert encode.one_hot(df, ["x"], most=3).columns == ["x_1", "x_2", "x_3"]


def test_wide_tables_are_not_small(spark):
    narrow = spark.range(1000)
    wide = narrow.select("id", *(F.lit("x").alias(f"c{k}") for k in range(2000)))
    assert is_small(narrow, 1000) and not is_small(wide, 1000)
