"""Tasks and memory of boosting with patience."""

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cardfeat.operators import models, patience


def _fit(spark, monkeypatch):
    i = F.col("id")
    rows = spark.range(400, numPartitions=16).select(
        (i % 7).cast("double").alias("a"), (i % 7 + F.pmod(F.xxhash64(i), F.lit(9)) / 3.0).alias("target"), (i % 3 == 0).alias("held_out")
    )
    table, seen = VectorAssembler(inputCols=["a"], outputCol="features").transform(rows), []
    grow, persistent = patience.PatientBoosting._grow, spark.sparkContext._jsc.getPersistentRDDs

    def noted(self, rows, count, first):
        before = persistent().size()
        trees = grow(self, rows, count, first)
        seen.append((rows.rdd.getNumPartitions(), persistent().size() - before))
        return trees

    with monkeypatch.context() as m:
        m.setattr(patience.PatientBoosting, "_grow", noted)
        model = models.patient(patience=2, chunk=2, step=0.5, depth=2, min_rows=1).fit(table)
    return model, seen


def test_tasks_follow_the_rows_not_the_parts(spark, monkeypatch):
    model, seen = _fit(spark, monkeypatch)
    assert {n for n, _ in seen} == {1} and all(kept <= 0 for _, kept in seen)
    assert model.errors[0] > min(model.errors)
    monkeypatch.setattr(patience, "TASK_ROWS", 150)
    _, seen = _fit(spark, monkeypatch)
    assert seen[0][0] == 3
