"""Rows of a key side by side before wide aggregates."""

import pytest
from pyspark.sql import functions as F

from cardfeat.operators.skew import gathered
from cardfeat.plans import features


def test_rows_of_a_key_meet_in_one_part_and_none_is_lost(spark):
    i = F.col("id")
    table = spark.range(4000, numPartitions=8).select(F.when(i % 50 != 0, i % 49).alias("card_id"), (i % 3).alias("x"))
    got = gathered(table, ["card_id"])
    assert got.columns == table.columns
    assert got.exceptAll(table).isEmpty() and table.exceptAll(got).isEmpty()
    parts = lambda df: df.withColumn("part", F.spark_partition_id()).groupBy("card_id").agg(F.count_distinct("part").alias("n")).agg(F.max("n")).first()[0]
    assert parts(table) == 8 and parts(got) == 1


@pytest.mark.parametrize("rollup", [features.full_new_rollup, features.full_hist_rollup, features.share_rollup])
def test_wide_rollups_gather_rows_and_still_combine_per_task(spark, rollup, monkeypatch):
    """A buffer per card travels, not one per row; a hot card may still be cut."""
    log = spark.createDataFrame(
        [(c, "Y", "N", 1.0, "A", 1, c, 0, 1.5, 3, 2, 7, 5) for c in (1, 1, 2, None)],
        "card_id bigint, authorized_flag string, category_1 string, category_2 double, category_3 string, installments int, "
        "merchant_id bigint, month_lag int, purchase_amount double, city_id int, state_id int, merchant_category_id int, subsector_id int",
    ).withColumn("purchase_date", F.to_timestamp_ntz(F.lit("2018-01-05 10:00:00")))
    plans, stage = [], __import__("cardfeat.operators.rollup", fromlist=["stage"]).stage

    def noted(df, name="stage"):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, name)

    monkeypatch.setattr("cardfeat.operators.rollup.stage", noted)
    got = {r["card_id"]: r for r in rollup(log).collect()}
    assert set(got) == {1, 2}
    size = next(c for c in got[1].asDict() if c.endswith("transactions_count"))
    assert got[1][size] == 2 and got[2][size] == 1
    plan = plans[0]
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "partial_" in plan
    assert plan.index("hashpartitioning(card_id") < plan.index("partial_") < plan.index("REBALANCE_PARTITIONS_BY_COL")
