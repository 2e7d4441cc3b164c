"""The tables the queries read, and joins with labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardfeat.operators.skew import is_small

#: Up to so many narrow rows (a key and a number) are sent to every executor, some 10 MB.
SMALL_KEYS = 500_000

SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "labels": "doc_id bigint, quality int, toxic int",
    "benchmark": "item_id bigint, text string",
    "pages": "page_id bigint, url string, html string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


#: Rows of an Arrow batch; a few hundred texts rather than ten thousand, so that a batch of long ones fits.
BATCH_ROWS = 500


def small_batches(df: DataFrame) -> DataFrame:
    """The frame, whose session now hands texts to Python in small batches."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df


def one_label(labels: DataFrame, value, key: str = "doc_id") -> DataFrame:
    """One row (key, value) per labelled key; of several the smallest value, none of null keys or values."""
    rows = labels.select(F.col(key).alias("_key"), value.alias("_value")).filter("_key IS NOT NULL AND _value IS NOT NULL")
    return rows.groupBy("_key").agg(F.min("_value").alias("_value"))


def with_label(docs: DataFrame, labelled: DataFrame, key: str = "doc_id", columns: tuple[str, ...] = ("text",)) -> DataFrame:
    """The rows of labelled documents: ``columns`` and ``_value``; rows that repeat a key all stay.

    Few labels are sent to the documents; beyond that both sides are shuffled by the key.
    """
    if is_small(labelled, SMALL_KEYS):
        labelled = F.broadcast(labelled)
    return docs.join(labelled, docs[key] == labelled["_key"]).select(*(docs[c] for c in columns), labelled["_value"])


def cut_rows(rows: DataFrame, group: str, limits: dict, row: Column) -> DataFrame:
    """The rows, or about ``limits[group]`` of each group where one has more than a quarter too many.

    ``row`` is a hash of all that tells rows apart: rows alike count as one, and others are chosen by a hash of it.
    Groups without a limit keep nothing.
    """
    counts = {r[group]: r["n"] for r in rows.groupBy(group).agg(F.count("*").alias("n")).collect()}
    if all(n <= 1.25 * limits.get(g, 0) for g, n in counts.items()):
        return rows
    hashed = rows.withColumn("_row", row)
    alike = hashed.select(group, "_row").distinct().groupBy(group).agg(F.count("*").alias("n"))
    scale = 1 << 30
    shares = {r[group]: min(scale, int(scale * limits.get(r[group], 0) / r["n"])) for r in alike.collect()}
    share = F.create_map(*(x for g, n in shares.items() for x in (F.lit(g), F.lit(n))))[F.col(group)]
    return hashed.filter(F.pmod(F.xxhash64("_row", F.lit(7)), F.lit(scale)) < share).dropDuplicates([group, "_row"]).drop("_row")
