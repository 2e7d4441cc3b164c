"""The nodes of fitted trees as rows.

Spark writes a fitted tree model as a table with one row per node. Read back, it
tells which feature each inner node splits on, where, with which gain and over how
many rows; counting its rows gives the importance by number of splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardfeat.session import scratch_path

NODE_COLUMNS = "fold tree node feature threshold categories gain rows left right prediction impurity".split()


def _named(position: Column, inputs: Sequence[str]) -> Column:
    names = F.array(*(F.lit(name) for name in inputs))
    return F.when(position >= 0, F.get(names, position))


def _nodes_of(spark: SparkSession, model: Model, inputs: Sequence[str], fold: int) -> DataFrame:
    path = scratch_path(spark, "tree-model")
    model.save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        data = data.withColumn("tree", F.lit(0))
    continuous = F.col("split.numCategories") < 0
    values = F.col("split.leftCategoriesOrThreshold")
    inner = F.col("leftChild") >= 0
    columns = {
        "fold": F.lit(fold),
        "node": F.col("id"),
        "feature": _named(F.col("split.featureIndex"), inputs),
        "threshold": F.when(inner & continuous, F.get(values, F.lit(0))),
        "categories": F.when(inner & ~continuous, values),
        "gain": F.when(inner, F.col("gain")),
        "rows": F.col("rawCount").cast("bigint"),
        "left": F.when(inner, F.col("leftChild")),
        "right": F.when(inner, F.col("rightChild")),
    }
    return data.withColumns(columns).select(*NODE_COLUMNS)


def node_table(spark: SparkSession, models: Sequence[Model], inputs: Sequence[str]) -> DataFrame:
    """One row per node of every tree of every model; models are numbered from 1 as ``fold``.

    ``feature`` is the input an inner node splits on, null for a leaf. Rows go left up to the
    ``threshold`` (or in one of the ``categories``). The models are written to the shared folder
    and read from there; nothing is collected.
    """
    parts = [_nodes_of(spark, model, inputs, fold) for fold, model in enumerate(models, start=1)]
    return reduce(DataFrame.unionByName, parts)


def split_counts(nodes: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """How many inner nodes split on each input, per fold; 0 for an input that none splits on."""
    found = nodes.filter(F.col("feature").isNotNull()).groupBy("fold", "feature").agg(F.count("*").alias("n"))
    names = F.explode(F.array(*(F.lit(name) for name in inputs)))
    every = nodes.select("fold").distinct().select("fold", names.alias("feature"))
    counted = every.join(found, ["fold", "feature"], "left")
    return counted.select("feature", F.coalesce("n", F.lit(0)).cast("double").alias("importance"), "fold")


def gain_totals(nodes: DataFrame) -> DataFrame:
    """Gain times rows per fold, tree and feature: what Spark's own importances are made of.

    Boosted models add them up over trees as they are, forests after each tree's were made to sum to 1.
    """
    inner = nodes.filter(F.col("feature").isNotNull())
    return inner.groupBy("fold", "tree", "feature").agg(F.sum(F.col("gain") * F.col("rows")).alias("gain"))
