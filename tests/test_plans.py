"""What the physical plans must and must not hold."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cardfeat.operators import models, quantiles, rollup, skew
from cardfeat.operators.joins import enrich
from cardfeat.session import stage
from tests.conftest import SMALL

QUERIES = entry.queries()
NO_FITS = [n for n in QUERIES if n not in entry.oracle_sql()]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(NO_FITS)))
def test_no_cross_product_and_no_python_rows(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "BatchEvalPython", "MapInPandas"):
        assert bad not in text


def test_scan_reads_only_needed_columns(spark):
    text = plan(QUERIES["first_last_purchase"](spark, SMALL))
    assert "l_extendedprice" not in text and "part.parquet" not in text and "supplier.parquet" not in text
    assert "LessThan(o_orderdate" in text and "PushedFilters" in text


@pytest.mark.parametrize("name", ["rollup_full_hist", "rollup_merchant_new", "rollup_share_hist", "rollup_basic_hist"])
def test_a_rollup_reads_the_log_twice_at_most(spark, monkeypatch, name):
    """Scans of the log in the result's plan and in all that was written while it was built."""
    scans = []

    def counted(df, *args):
        scans.append(plan(df).count("lineitem.parquet"))
        return stage(df, *args)

    for module in (rollup, skew, quantiles):
        monkeypatch.setattr(module, "stage", counted)
    scans.append(plan(QUERIES[name](spark, SMALL)).count("lineitem.parquet"))
    assert 1 <= sum(scans) <= 2


def test_learners_start_from_written_vectors(spark):
    """The fold loop reads a finished table, not the logs."""
    table = spark.range(90).selectExpr("id AS card_id", "IF(id % 3 = 0, 'test', 'train') AS split", "id * 1.0 AS x", "id * 2.0 AS target")
    text = plan(models.prepare(table, ["x"], "target", 3))
    assert "Scan ExistingRDD" in text and "Range" not in text


def test_basic_rollup_skips_dimensions(spark):
    text = plan(QUERIES["rollup_basic_new"](spark, SMALL))
    assert "part.parquet" not in text and "supplier.parquet" not in text


def test_rollup_combines_before_the_shuffle(spark):
    text = plan(QUERIES["skew_corrected"](spark, SMALL))
    assert "partial_skewness" in text


def test_no_broadcast_of_growing_tables(spark):
    """With size-based broadcasts off, rollups and cards meet without one."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("rollup_left_join", "rollup_full_hist", "cross_period_combos", "reference_lags"):
            assert "BroadcastHashJoin" not in plan(QUERIES[name](spark, SMALL)), name
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_lookup_keys_are_not_shuffled(spark):
    """A third of the rows on one merchant of a large dimension."""
    i = F.col("id")
    tx = spark.range(3000).select(i.alias("tx"), F.when(i % 3 == 0, 1).otherwise(i % 50).alias("merchant_id"))
    merchants = spark.range(50).select(i.alias("merchant_id"), (i * 2).alias("city"))
    joined = enrich(tx, merchants, "merchant_id", small=10, hot_rows=500)
    text = plan(joined)
    assert "Union" in text and "LeftAnti" in text and "LeftSemi" in text
    assert joined.count() == 3000 and joined.filter(F.col("city") != F.col("merchant_id") * 2).count() == 0
