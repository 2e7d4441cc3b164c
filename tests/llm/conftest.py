import pytest

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, _value int, id int, fp int, mark string, score string"
LONG = "word" + " another word of many, and more." * 40_000


@pytest.fixture(scope="session")
def edge_rows():
    """Null ids, null and empty texts, a very long one, ties and repeated rows."""
    line = "A line of ten words that is long enough for all.\n" * 8
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, LONG),
        (5, line),
        (5, line),
        (6, line),
        (None, "Some text without an id, password=abcdefghij0123456789 end."),
        (None, None),
        (7, "one"),
        (8, "été \U0001f600 \x85 x y  z\r\n\n\x00end"),
        (9, "12345 !!!"),
    ]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    """The edge rows with extra columns that are named like helper columns."""
    rows = [(i, t, None if i == 7 else "en", None, None, "x", 1, 2, 3, "m", "s") for i, t in edge_rows]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def edge_labels(spark):
    rows = [(5, 1, 0), (5, 0, 0), (6, 1, None), (4, 0, 0), (7, 1, 1), (None, 1, 0), (99, 1, 0), (9, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
