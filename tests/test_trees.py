"""Nodes of fitted trees as rows, importances by splits, boosting with patience."""

import os

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from cardfeat.operators import models, patience, trees
from cardfeat.session import stage_scope


@pytest.fixture(scope="module")
def table(spark):
    """A target that follows ``a``, a little of ``b`` and much noise; ``held`` marks a third of the rows."""
    i = F.col("id")
    noise = F.pmod(F.xxhash64(i), F.lit(1000)) / 1000.0 - 0.5
    rows = spark.range(1500).select(
        i.alias("card_id"), F.when(i % 5 == 4, "test").otherwise("train").alias("split"), (i % 7).cast("double").alias("a"),
        (F.pmod(F.xxhash64(i, F.lit(3)), F.lit(50)) / 10.0).alias("b"), F.lit(1.0).alias("c"), noise.alias("noise"),
        (i % 3 == 0).alias("held_out"),
    )
    rows = rows.withColumns({"target": F.col("a") + F.col("b") * 0.2 + F.col("noise") * 4, "outliers": (F.col("a") + F.col("noise") > 5).cast("double")})
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows).cache()


NAMES = ["a", "b", "c"]


@pytest.mark.parametrize(
    "learner, per_tree",
    [
        (lambda: GBTRegressor(labelCol="target", maxIter=4, maxDepth=3), False),
        (lambda: RandomForestRegressor(labelCol="target", numTrees=3, maxDepth=4, seed=1), True),
        (lambda: GBTClassifier(labelCol="outliers", maxIter=2, maxDepth=2), False),
        (lambda: DecisionTreeRegressor(labelCol="target", maxDepth=3), True),
    ],
    ids=["boosted", "forest", "classifier", "tree"],
)
def test_node_table(spark, table, learner, per_tree):
    model = learner().fit(table)
    nodes = trees.node_table(spark, [model, model], NAMES)
    assert nodes.columns == trees.NODE_COLUMNS
    got = nodes.filter("fold = 2").collect()
    assert nodes.count() == 2 * len(got)
    whole = model.totalNumNodes if hasattr(model, "totalNumNodes") else model.numNodes
    assert len(got) == whole
    by_place = {(r["tree"], r["node"]): r for r in got}
    for r in got:
        if r["feature"] is None:
            assert r["left"] is None and r["right"] is None and r["gain"] is None and r["threshold"] is None
        else:
            left, right = (by_place[r["tree"], r[side]] for side in ("left", "right"))
            assert r["feature"] in ("a", "b") and r["threshold"] is not None and r["gain"] > 0
            assert left["rows"] + right["rows"] == r["rows"]
    # the gains, per tree and then over trees, make up Spark's own importances
    per = {(r["tree"], r["feature"]): r["gain"] for r in trees.gain_totals(nodes.filter("fold = 1")).collect()}
    sizes = getattr(model, "treeWeights", [1.0])
    total = dict.fromkeys(NAMES, 0.0)
    for k in range(len(sizes)):
        whole = sum(v for (tree, _), v in per.items() if tree == k) if per_tree else 1.0  # 0: a tree without splits
        for name in NAMES:
            total[name] += per.get((k, name), 0.0) / (whole or 1.0)
    scale = sum(total.values())
    assert [total[n] / scale for n in NAMES] == pytest.approx(list(model.featureImportances.toArray()), abs=1e-9)


def test_importance_by_splits(spark, table):
    with stage_scope(spark):
        run = models.cross_validate(table.drop("features"), ["a", "b", "c"], "target", lambda: models.forest(trees=5, depth=4), 3)
        counts = {(r["fold"], r["feature"]): r["importance"] for r in run.importances("split").collect()}
        inner = {r["fold"]: r["n"] for r in run.nodes().filter("feature IS NOT NULL").groupBy("fold").agg(F.count("*").alias("n")).collect()}
        assert len(counts) == 3 * 6 and {k: sum(v for (f, _), v in counts.items() if f == k) for k in (1, 2, 3)} == inner
        assert all(inner[k] == sum((m.numNodes - 1) // 2 for m in model.trees) for k, model in enumerate(run.models, start=1))
        assert counts[1, "c"] == 0 and counts[1, "a"] > 0
        strongest = models.mean_importance(run.importances("split"), 2).collect()
        assert {r["feature"] for r in strongest} == {"a", "b"}
        with pytest.raises(ValueError, match="unknown kind"):
            run.importances("other")


def test_best_round_and_end():
    errors = [5.0, 3.0, 2.0, 2.0, 2.5]
    assert patience.best_round(errors) == 3 and patience.best_round([]) == 0
    assert not patience.is_over(errors, 100, 3) and patience.is_over(errors, 100, 2) and patience.is_over(errors, 5, 10)
    assert not patience.is_over([], 10, 1)


def _rmse(model, table):
    scored = model.transform(table.filter("held_out"))
    return scored.agg(F.avg(F.pow(F.col("prediction") - F.col("target"), F.lit(2)))).first()[0]


def test_a_run_stops_within_a_chunk_of_its_best_round(table):
    model = models.patient(patience=4, chunk=3, step=0.5, depth=3, min_rows=1).fit(table)
    best = model.errors.index(min(model.errors)) + 1
    assert model.rounds == best and 1 < best < 40
    assert best + 4 <= len(model.errors) < best + 4 + 3
    assert _rmse(model, table) == pytest.approx(min(model.errors))
    spread = table.agg(F.var_pop("target")).first()[0]
    assert min(model.errors) < 0.5 * spread


def test_rounds_are_bounded(table):
    model = models.patient(rounds=4, patience=50, chunk=3, step=0.05, depth=2).fit(table)
    assert len(model.errors) == 4 == model.rounds


def test_a_killed_run_goes_on(spark, table, tmp_path, monkeypatch):
    settings = dict(patience=4, chunk=3, step=0.5, depth=3, min_rows=1)
    whole = models.patient(**settings).fit(table)
    path, grown = str(tmp_path / "run"), []
    grow = patience.PatientBoosting._grow

    def killed(self, rows, count, first):
        if first >= 3:
            os.makedirs(f"{path}/chunk-00001/trees", exist_ok=True)  # what it leaves behind
            raise KeyboardInterrupt
        return grow(self, rows, count, first)

    monkeypatch.setattr(patience.PatientBoosting, "_grow", killed)
    with pytest.raises(KeyboardInterrupt):
        models.patient(path=path, **settings).fit(table)

    def counted(self, rows, count, first):
        grown.append(first)
        return grow(self, rows, count, first)

    monkeypatch.setattr(patience.PatientBoosting, "_grow", counted)
    model = models.patient(path=path, **settings).fit(table)
    assert grown[0] == 3 and len(model.errors) == len(whole.errors)
    assert model.errors == pytest.approx(whole.errors) and model.rounds == whole.rounds
    grown.clear()
    again = models.patient(path=path, **settings).fit(table)
    assert grown == [] and again.errors == model.errors and again.rounds == model.rounds
    with pytest.raises(ValueError, match="other settings"):
        models.patient(path=path, **{**settings, "step": 0.1}).fit(table)
    assert [d for d in sorted(os.listdir(path)) if os.path.isdir(f"{path}/{d}/rows")] == [sorted(os.listdir(path))[-1]]


def test_classifier(spark, table):
    model = models.patient_classifier(patience=3, chunk=4, step=0.5, depth=3).fit(table)
    scored = model.transform(table.filter("held_out")).withColumn("p", models.predicted(model))
    got = {r["outliers"]: r["p"] for r in scored.groupBy("outliers").agg(F.avg("p").alias("p")).collect()}
    assert got[1.0] > 0.8 and got[0.0] < 0.1 and min(model.errors) < 0.2
    p = F.least(F.greatest(F.col("p"), F.lit(1e-12)), F.lit(1 - 1e-12))
    loss = scored.agg(F.avg(-(F.col("outliers") * F.log(p) + (1 - F.col("outliers")) * F.log(1 - p)))).first()[0]
    assert loss == pytest.approx(min(model.errors))


def test_out_of_fold_with_patience(spark, table, tmp_path):
    path = str(tmp_path / "folds")
    learner = lambda: models.patient(patience=3, chunk=3, step=0.5, depth=3, path=path)
    run = models.cross_validate(table.drop("features"), ["a", "b"], "target", learner, 3)
    assert run.scores.count() == 1500 and run.scores.filter("prediction IS NULL").count() == 0
    assert sorted(os.listdir(path)) == ["fold-0", "fold-1", "fold-2"]
    inner = run.nodes().filter("feature IS NOT NULL").count()
    assert run.importances("split").agg(F.sum("importance")).first()[0] == inner > 0


def test_needs_rows_to_fit_and_to_watch(table):
    with pytest.raises(ValueError, match="no rows to fit"):
        models.patient().fit(table.withColumn("held_out", F.lit(True)))
    with pytest.raises(ValueError, match="no held-out rows"):
        models.patient(chunk=1).fit(table.withColumn("held_out", F.lit(None).cast("boolean")))


def test_scopes_delete_what_was_staged_inside(spark):
    from cardfeat import session

    def there(paths):
        return [os.path.isdir(p.removeprefix("file:")) for p in paths]

    before = list(session._STAGED)
    with stage_scope(spark):
        outer = session.stage(spark.range(3).toDF("x"), "outer")
        with stage_scope(spark):
            session.stage(spark.range(3).toDF("x"), "inner")
            inner = list(session._SCOPE.get())
            assert there(inner) == [True]
        listed = list(session._SCOPE.get())
        assert there(inner) == [False] and there(listed) == [True] and outer.count() == 3
        with pytest.raises(ZeroDivisionError), stage_scope(spark):
            session.stage(spark.range(3).toDF("x"), "failed")
            failed = list(session._SCOPE.get())
            1 / 0
        assert there(failed) == [False]
    assert there(listed) == [False] and session._STAGED == before
