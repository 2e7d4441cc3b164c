"""Row numbers, heads of files, zipped files, equal folds, lasting codes, sparse vectors, measured broadcasts, long sums."""

import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cardfeat.functions import stats
from cardfeat.operators import encode, folds, joins, models, positions, skew
from cardfeat.operators.dictionary import Dictionary
from cardfeat.operators.rollup import Rollup, roll_up, take
from cardfeat.session import scratch_path
from cardfeat.sources import readers
from tests.test_plans import plan


@pytest.fixture
def many_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_are_zipped_by_row_like_frames(spark, tmp_path, many_splits):
    left = pd.DataFrame({"card_id": [f"C_{k * 7919 % 1000}" for k in range(3_000)]})
    right = pd.DataFrame({"target": [k / 8 for k in range(2_900)], "note": ["x" * (k % 9) + "y" for k in range(2_900)]})
    left.to_csv(tmp_path / "left.csv", index=False)
    right.to_csv(tmp_path / "right.csv", index=False)
    a = readers.read_csv(spark, str(tmp_path / "left.csv"), "card_id string")
    b = readers.read_csv(spark, str(tmp_path / "right.csv"), "target double, note string")
    assert a.rdd.getNumPartitions() > 5 and b.rdd.getNumPartitions() > 10
    numbered = positions.number_by_file(a, "n").orderBy("n").toPandas()
    assert numbered["n"].tolist() == list(range(3_000)) and numbered["card_id"].tolist() == left["card_id"].tolist()
    got = positions.zip_files(a, b).toPandas().sort_values(["target", "card_id"], ignore_index=True)
    want = pd.concat([left, right], axis=1).sort_values(["target", "card_id"], ignore_index=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)
    parts = positions.split_at(a, 2_000).groupBy("split").agg(F.count("*").alias("n"), F.collect_set("card_id").alias("ids")).collect()
    assert {r["split"]: (r["n"], set(r["ids"])) for r in parts} == {
        "train": (2_000, set(left["card_id"][:2_000])), "test": (1_000, set(left["card_id"][2_000:]))
    }
    with pytest.raises(ValueError, match="both tables"):
        positions.zip_files(a, a)


def test_numbers_follow_the_order_of_paths(spark, tmp_path):
    for name, ids in (("b", range(10, 30)), ("a", range(10)), ("c", [])):
        pd.DataFrame({"id": list(ids)}).astype("int64").to_parquet(tmp_path / f"{name}.parquet")
    got = positions.number_by_file(spark.read.parquet(str(tmp_path)), "n").collect()
    assert all(r["id"] == r["n"] for r in got) and len(got) == 30


def test_head_opens_no_more_splits_than_it_needs(spark, tmp_path, many_splits):
    path = scratch_path(spark, "head")
    spark.range(0, 200_000, 1, 8).selectExpr("id", "repeat('x', 20) AS pad").write.parquet(path)
    df = spark.read.parquet(path)
    files = sorted(df.inputFiles())
    first = [r["id"] for r in spark.read.parquet(files[0]).collect()]
    head = readers.read_head(spark.read.parquet, path, 50)
    assert [r["id"] for r in head.collect()] == first[:50] and head.schema == df.schema
    assert "FileScan" not in plan(head) and "FileScan" in plan(df)
    more = [r["id"] for r in readers.read_head(lambda p: spark.read.parquet(p).select("id"), path, 30_000).collect()]
    assert more[: len(first)] == first and len(more) == 30_000 == len(set(more))
    assert readers.read_head(spark.read.parquet, path, 0).count() == 0
    with pytest.raises(ValueError, match="at most"):
        readers.read_head(spark.read.parquet, path, readers.MAX_HEAD + 1)
    jobs = spark.sparkContext.statusTracker()
    given = spark.read.schema(df.schema)  # a schema that is not given takes a job to look it up
    spark.sparkContext.setJobGroup("head", "head")
    readers.read_head(given.parquet, path, 10)
    tasks = [jobs.getStageInfo(s).numTasks for j in jobs.getJobIdsForGroup("head") for s in jobs.getJobInfo(j).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # splits of the first file only; several, as its one row group is longer than these short splits
    assert 0 < sum(tasks) <= spark.read.parquet(files[0]).rdd.getNumPartitions() < df.rdd.getNumPartitions() / 7


def test_head_of_csv(spark, tmp_path):
    folder = tmp_path / "two words"
    folder.mkdir()
    (folder / "b.csv").write_text("card_id,target\nC_3,3.0\n")
    (folder / "a.csv").write_text("card_id,target\nC_1,1.0\nC_2,NaN\n")
    read = lambda p: readers.read_csv(spark, p, "predictions")
    assert [tuple(r) for r in readers.read_head(read, str(folder), 9).collect()] == [("C_1", 1.0), ("C_2", None), ("C_3", 3.0)]
    assert [r["card_id"] for r in readers.read_head(read, str(folder), 1).collect()] == ["C_1"]


@pytest.mark.parametrize("rows, k", [(1_000, 7), (5, 10), (0, 3)])
def test_equal_folds(spark, rows, k):
    df = spark.range(rows).select(F.col("id").alias("card_id"), (F.col("id") * 2).alias("x"))
    got = folds.add_equal_folds(df, k)
    sizes = {r["fold"]: r["count"] for r in got.groupBy("fold").count().collect()}
    assert sum(sizes.values()) == rows and max(sizes.values(), default=0) - min([sizes.get(f, 0) for f in range(k)]) <= 1
    assert got.columns == ["card_id", "x", "fold"]
    again = folds.add_equal_folds(df.repartition(3), k)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, again.collect()))


@pytest.mark.parametrize("small", [100, 0])
def test_codes_last(spark, rows, small):
    kept = Dictionary(spark, scratch_path(spark, "codes"))
    assert kept.encode(rows([("a",)], "x string"), "x", "code").collect()[0]["code"] is None
    assert kept.append(rows([("m",), ("b",), ("m",), (None,)], "x string"), "x", small) == 2
    assert kept.append(rows([("a",), ("z",), ("b",), ("c",)], "y string"), "y", small) == 3
    assert kept.append(rows([("a",), (None,)], "x string"), "x", small) == 0
    assert kept.append(rows([("0",)], "x string"), "x", small) == 1
    assert {r["value"]: r["code"] for r in kept.table().collect()} == {"b": 0, "m": 1, "a": 2, "c": 3, "z": 4, "0": 5}
    df = rows([("b", 1), ("unseen", 2), (None, 3), ("z", 4), ("0", 5), ("b", 6)], "x string, n int")
    got = kept.encode(df, "x", "code", small, 1 if small == 0 else skew.HOT_ROWS)
    assert got.columns == ["x", "n", "code"] and dict(got.dtypes)["code"] == "bigint"
    assert {r["n"]: r["code"] for r in got.collect()} == {1: 0, 2: None, 3: None, 4: 4, 5: 5, 6: 0}
    back = kept.decode(got.select("n", "code"), "code", "x", small)
    assert {r["n"]: r["x"] for r in back.collect()} == {1: "b", 2: None, 3: None, 4: "z", 5: "0", 6: "b"}


def test_a_killed_append_leaves_the_dictionary_as_it_was(spark, rows):
    import os

    kept = Dictionary(spark, scratch_path(spark, "codes"))
    kept.append(rows([("a",)], "x string"), "x")
    os.makedirs(kept._part(1).removeprefix("file:") + "/_temporary")
    assert kept.table().count() == 1
    assert kept.append(rows([("b",)], "x string"), "x") == 1 and len(kept.parts()) == 2


def test_sparse_one_hot(spark, rows):
    df = rows([(1, "b"), (2, None), (3, "a"), (4, "b")], "i int, c string")
    for small in (100, 0):
        made, values = encode.sparse_one_hot(df, "c", small=small)
        assert made.columns == ["i", "c_one_hot"] and models.vector_size(made, "c_one_hot") == 2
        got = {r["i"]: r["v"] for r in made.select("i", vector_to_array("c_one_hot").alias("v")).collect()}
        assert got == {1: [0.0, 1.0], 2: [0.0, 0.0], 3: [1.0, 0.0], 4: [0.0, 1.0]}
        assert sorted((r["c"], r["position"]) for r in values.collect()) == [("a", 0), ("b", 1)]


def test_learner_takes_more_values_than_a_table_may_have_columns(spark):
    i = F.col("id")
    df = spark.range(9_000).select(
        i.alias("card_id"), F.when(i % 4 == 3, "test").otherwise("train").alias("split"), (i % 3).cast("double").alias("a"),
        F.when(i % 2 == 0, "common").otherwise(F.concat(F.lit("m"), (i % 6_000).cast("string"))).alias("merchant_id"),
        F.when(i % 4 != 3, F.when(i % 2 == 0, 5.0).otherwise(0.0) + (i % 3)).alias("target"),
    )
    with pytest.raises(ValueError, match="over"):
        encode.one_hot(df, ["merchant_id"], most=2_000)
    made, values = encode.sparse_one_hot(df, "merchant_id")
    assert models.vector_size(made, "merchant_id_one_hot") == values.count() == 3_001
    run = models.cross_validate(
        made, ["a"], "target", lambda: models.forest(trees=2, depth=2, featureSubsetStrategy="all"), 2, vectors=["merchant_id_one_hot"]
    )
    best = models.mean_importance(run.importances(), 1).first()["feature"]
    assert len(run.inputs) == 3_003 and best == "merchant_id_one_hot_0"  # 'common' comes first in sorted order
    assert run.scores.count() == 9_000


def test_wide_values_are_not_sent(spark):
    table = spark.range(1_000).select("id", F.sequence(F.lit(1), F.lit(20_000)).cast("array<bigint>").alias("many"))
    assert skew.measured(table)[0] == 1_000 and 150e6 < skew.measured(table)[1] < 170e6
    rows = spark.range(5_000).select((F.col("id") % 1_000).alias("id"))
    joined = joins.lookup(rows, table, ["id"])
    assert "Broadcast" not in plan(joined)
    sent = joins.lookup(rows, table.select("id"), ["id"])
    assert "BroadcastHashJoin" in plan(sent)
    assert joined.agg(F.sum(F.size("many"))).first()[0] == 5_000 * 20_000


def test_bytes_of_nested_values(rows):
    ddl = "s string, b binary, a array<string>, n array<int>, m map<string,int>, t struct<x:string,y:array<string>>, d decimal(20,2)"
    big = "é" * 1_000
    df = rows([(big, bytearray(500), [big, None], [1] * 300, {big: 1}, (big, [big]), None)], ddl)
    n, size = skew.measured(df)
    assert n == 1 and 12_000 + 500 + 2_400 - 2_000 < size < 12_000 + 500 + 2_400 + 1_000
    assert skew.measured(rows([], ddl)) == (0, 0)
    none = skew.measured(rows([(None,) * 7], ddl))
    assert none[0] == 1 and none[1] <= 120


def test_sums_past_a_bigint(spark, monkeypatch):
    """With units of 1e-15 forty thousand fractions pass 2**63."""
    monkeypatch.setattr(stats, "SUM_DIGITS", 15)
    df = spark.range(40_000).select(F.lit("a").alias("card_id"), F.lit(0.4375).alias("x"), F.when(F.col("id") % 2 == 0, -0.4375).otherwise(0.25).alias("y"))
    spec = Rollup("", take("sum mean", "x", "y"), None, 6)
    results = {tuple(roll_up(df.repartition(n), spec).first()) for n in (1, 5, 13)}
    assert results == {("a", 17_500.0, 0.4375, -3_750.0, -0.09375)}


def test_fold_means_do_not_depend_on_order(spark):
    df = spark.range(3_000).select(
        (F.col("id") % 7).alias("f"), F.when(F.col("id") % 5 != 0, F.col("id") * 0.1 / 7).alias("y"), (F.col("id") % 4).alias("fold"), "id"
    )
    got = {tuple(sorted((r["id"], r["p"]) for r in folds.out_of_fold_means(df.repartition(n), "f", "y", "p", 9).collect())) for n in (1, 4, 9)}
    assert len(got) == 1
    means = {tuple(sorted(map(tuple, encode.target_means(df.repartition(n), "f", F.col("y"), 9).collect()))) for n in (1, 4, 9)}
    assert len(means) == 1
