import pytest

from cardfeat.operators import joins
from cardfeat.sources import readers, sinks
from cardfeat.sources.schemas import SCHEMAS, schema


def test_schemas_parse(spark):
    assert all(len(schema(n).fields) > 1 for n in SCHEMAS)


def test_typed_csv(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text("card_id,first_active_month,feature_1,feature_2,feature_3,target\nC_1,2017-06,5,2,1,-0.8\nC_2,,4,1,0,NaN\n")
    df = readers.read_csv(spark, str(path), "train")
    assert [tuple(r) for r in df.orderBy("card_id").collect()] == [("C_1", "2017-06", 5, 2, 1, -0.8), ("C_2", None, 4, 1, 0, None)]
    profile = readers.card_profile(df).orderBy("card_id").collect()
    assert (profile[0]["year"], profile[0]["month"], profile[0]["elapsed_time"]) == (2017, 6, 245)
    assert profile[1]["elapsed_time"] is None


def test_wrong_header_is_refused(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text("id,score\nC_1,1.0\n")
    with pytest.raises(Exception, match="header|CSV"):
        readers.read_csv(spark, str(path), "predictions").collect()
    renamed = readers.read_csv_renamed(spark, str(path), ["card_id", "target0"])
    assert [tuple(r) for r in renamed.collect()] == [("C_1", 1.0)]


def test_round_trip_and_template(spark, rows):
    df = rows([("C_1", 0.1), ("C_2", -33.219281)], "card_id string, target double")
    path = sinks.scratch_path(spark, "out")
    sinks.write_csv(df, path)
    back = readers.read_csv(spark, path, "predictions")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    sinks.write_parquet(df, path + "-p")
    assert readers.read_parquet(spark, path + "-p", ["card_id"]).count() == 2
    template = rows([("C_2", 0.0), ("C_3", 0.0)], "card_id string, target double")
    assert sorted(map(tuple, sinks.fill_template(template, back).collect())) == [("C_2", -33.219281), ("C_3", None)]


def test_stack_rows_fills_missing_columns(rows):
    got = joins.stack_rows(rows([(1, 2.0)], "a int, target double"), rows([(3,)], "a int"))
    assert sorted(map(tuple, got.collect())) == [(1, 2.0), (3, None)]


def test_broken_lines_are_refused(spark, tmp_path):
    for number, line in enumerate(("C_2,oops", "C_2,1.0,extra", "C_2")):
        path = tmp_path / f"broken{number}.csv"
        path.write_text(f"card_id,target\nC_1,1.0\n{line}\n")
        with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
            readers.read_csv(spark, str(path), "card_id string, target double").collect()
        kept = readers.read_csv(spark, str(path), "card_id string, target double", mode="PERMISSIVE")
        assert kept.count() == 2


def test_staged_tables_can_be_deleted(spark):
    import os

    from cardfeat import session

    staged = session.stage(spark.range(5).toDF("x"), "test")
    path = session._STAGED[-1].removeprefix("file:")
    assert staged.count() == 5 and os.path.isdir(path)
    others = session._STAGED[:-1]
    session._STAGED[:] = session._STAGED[-1:]
    session.drop_stages(spark)
    session._STAGED[:] = others
    assert not os.path.exists(path)
