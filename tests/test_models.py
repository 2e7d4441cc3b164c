import pytest
from pyspark.sql import functions as F

from cardfeat.operators import models
from cardfeat.plans import assemble


@pytest.fixture(scope="module")
def planted(spark):
    """Cards whose target follows two features, with a few outliers."""
    i = F.col("id")
    noise = (F.pmod(F.xxhash64(i), F.lit(1000)) / 1000.0) - 0.5
    return spark.range(900).select(
        i.alias("card_id"),
        F.when(i % 3 == 2, "test").otherwise("train").alias("split"),
        (i % 7).cast("double").alias("a"),
        F.when(i % 11 != 0, (i % 5).cast("double")).alias("b"),
        (i % 40 == 0).cast("int").alias("mark"),
        F.when(i % 3 != 2, F.when(i % 40 == 0, -33.0).otherwise((i % 7) * 1.0 - (i % 5) * 0.5 + noise)).alias("target"),
    ).withColumn("outliers", F.coalesce((F.col("target") < -30).cast("int"), F.lit(0)))


def rmse_of(scores, table, name="prediction"):
    train = table.filter((F.col("split") == "train") & (F.col("outliers") == 0))
    joined = train.join(scores.select("card_id", name), "card_id")
    mean = train.agg(F.avg("target")).first()[0]
    return joined.agg(
        F.sqrt(F.avg(F.pow(F.col(name) - F.col("target"), F.lit(2)))), F.sqrt(F.avg(F.pow(F.col("target") - mean, F.lit(2))))
    ).first()


@pytest.mark.parametrize("learner", [models.boosted, models.forest])
def test_out_of_fold_learns_a_planted_signal(planted, learner):
    run = models.cross_validate(
        planted, ["a", "b"], "target", learner, 3, train_filter=F.col("outliers") == 0
    )
    cards = [r["card_id"] for r in run.scores.select("card_id").collect()]
    kept = planted.filter((F.col("split") == "test") | (F.col("outliers") == 0)).count()
    assert len(cards) == len(set(cards)) == kept  # each card once
    model, mean = rmse_of(run.scores, planted)
    assert model < 0.7 * mean
    table = run.importances()
    assert table.count() == 3 * 4
    assert models.mean_importance(table, 1).first()["feature"] == "a"


def test_forest_keeps_the_nodes_of_its_rows_and_its_scores(planted):
    """Kept node numbers save time and change no score."""
    assert models.forest().getCacheNodeIds()
    kept, walked = (
        models.cross_validate(planted, ["a", "b"], "target", lambda k=k: models.forest(trees=10, cacheNodeIds=k), 2).scores for k in (True, False)
    )
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, walked.collect()))


def test_classifier_finds_marked_cards(planted):
    run = models.cross_validate(planted, ["a", "mark"], "outliers", models.outlier_classifier, 3, "risk")
    joined = run.scores.join(planted.select("card_id", "mark", "split"), ["card_id", "split"]).filter("split = 'train'")
    got = {r["mark"]: r["risk"] for r in joined.groupBy("mark").agg(F.avg("risk").alias("risk")).collect()}
    assert got[1] > 0.5 > 0.2 > got[0]


def test_routed_scores_use_the_constant_for_outliers(planted):
    got = {r["card_id"]: r["target"] for r in assemble.routed_scores(planted, ["a", "b", "mark"], 3).collect()}
    assert len(got) == 300 and all(v is not None for v in got.values())
    assert all(got[c] == -33.219281 for c in got if c % 40 == 0)


def test_stack_is_no_worse_than_its_parts(planted):
    table = planted.filter("outliers = 0")
    scores = assemble.stacked_scores(table, ["a", "b"], assemble.STACK_LEARNERS[:2], 3)
    stacked, _ = rmse_of(scores, planted, "stacked")
    parts = [rmse_of(scores, planted, f"oof{i}")[0] for i in (1, 2)]
    assert stacked <= min(parts) * 1.02
    assert scores.filter("split = 'test' AND stacked IS NULL").count() == 0


def test_impute_flags(rows):
    got = models.impute_with_flags(rows([(1,), (None,)], "x int"), ["x"]).collect()
    assert [tuple(r) for r in got] == [(1.0, 0), (-9999.0, 1)]
