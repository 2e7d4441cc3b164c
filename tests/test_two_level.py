import pytest

from cardfeat.operators.rollup import Rollup, mean_of_group_means, roll_up, successive_means, take, two_level


def test_mean_of_group_means(rows):
    data = [("a", 1, 2.0), ("a", 1, 4.0), ("a", 2, 9.0), ("a", None, 100.0)]
    ddl = "card_id string, subsector_id int, amount double"
    got = mean_of_group_means(rows(data, ddl), "card_id", "subsector_id", "amount", "new_").first()
    assert (got["new_sum_cal"], got["new_mean_cal"]) == (6.0, 3.0)
    data += [("a", 3, 1.0), ("a", 3, -1.0)]
    got = mean_of_group_means(rows(data, ddl), "card_id", "subsector_id", "amount", "new_").first()
    assert (got["new_sum_cal"], got["new_mean_cal"]) == (4.0, 2.0)
    only_zero = rows([("a", 1, 1.0), ("a", 1, -1.0)], ddl)
    assert mean_of_group_means(only_zero, "card_id", "subsector_id", "amount", "new_").first()["new_mean_cal"] is None


def test_successive_means(rows):
    data = [("a", "Y", 1.0, 5), ("a", "Y", 3.0, 5), ("a", "N", 10.0, None), ("a", None, 50.0, 7), ("b", None, 1.0, 1)]
    df = rows(data, "card_id string, category_1 string, amount double, city_id int")
    got = successive_means(df, [("category_1", "amount"), ("city_id", "amount")]).collect()
    assert [r["card_id"] for r in got] == ["a"]  # b has no value in the first grouping
    r = got[0]
    assert (r["category_1_amount_mean"], r["category_1_amount_min"], r["category_1_amount_max"]) == (6.0, 2.0, 10.0)
    assert r["category_1_amount_std"] == pytest.approx(5.656854, abs=1e-6)
    assert (r["city_id_amount_mean"], r["city_id_amount_max"]) == (26.0, 50.0)


def test_two_level_takes_the_group_itself(rows):
    df = rows([("a", -1, 2.0), ("a", -1, 4.0), ("a", -3, 9.0)], "card_id string, month_lag int, amount double")
    r = two_level(df, "card_id", "month_lag", take("sum mean", "amount"), "mean max", with_group=True).first()
    assert (r["month_lag_mean"], r["amount_sum_mean"], r["amount_mean_mean"], r["amount_mean_max"]) == (-2.0, 7.5, 6.0, 9.0)


def test_shares_are_of_all_rows(rows):
    log = rows([("a",)] * 2 + [("b",)] * 5 + [(None,)], "card_id string")
    got = {r["card_id"]: r for r in roll_up(log, Rollup("", (), "n"), share="share").collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"]["share_mean"], got["a"]["share_sum"]) == (0.25, 0.5)
