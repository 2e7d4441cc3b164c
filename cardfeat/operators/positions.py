"""Row numbers over whole tables, without a window over all rows.

Rows are numbered inside their partition and shifted by the rows of the partitions
before. What orders the partitions is either a range split of a key or the place of
the rows in their files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardfeat.session import materialize, stage

_IN_PART = (1 << 33) - 1


def in_partition() -> Column:
    """The number of a row inside its partition, from 0."""
    return F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PART))


def _starts(sizes: DataFrame, order: Sequence[str]) -> DataFrame:
    """``_start``: the rows of all parts before; one row per partition or file split, so one task will do."""
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))


def number_by(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """The rows with their position (from 0) in the order of ``columns``.

    The rows are range-partitioned and written in that order, since a second run of the
    range split could cut elsewhere. Equal rows get numbers in any order, which only
    matters if other columns tell them apart.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = df.repartitionByRange(parts, *columns).sortWithinPartitions(*columns)
    ordered = materialize(ordered.select("*", F.spark_partition_id().alias("_part"), in_partition().alias("_pos")))
    starts = _starts(ordered.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows")), ["_part"])
    shifted = ordered.join(F.broadcast(starts.drop("_rows")), "_part")
    return shifted.select(*df.columns, (F.col("_start") + F.col("_pos")).alias(name))


def number_by_file(df: DataFrame, name: str) -> DataFrame:
    """The rows of a file scan with their position (from 0) in the files, taken in the order of their paths.

    ``df`` must be the scan itself, or columns of it: Spark reads each split of a file from
    front to back, so a split's rows have consecutive numbers, and path and offset order the splits.
    """
    placed = df.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
    )
    placed = stage(placed, "numbered")
    sizes = placed.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_rows"), F.min("_seq").alias("_first"))
    starts = F.broadcast(_starts(sizes, ["_file", "_block"]).drop("_rows"))  # a row per file split
    numbered = placed.join(starts, ["_file", "_block"])
    return numbered.select(*df.columns, (F.col("_start") + F.col("_seq") - F.col("_first")).alias(name))


def zip_files(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns of two file scans side by side, row by row in file order.

    Rows past the end of the shorter one get nulls. Names must differ.
    """
    both = set(left.columns) & set(right.columns)
    if both:
        raise ValueError(f"columns in both tables: {sorted(both)}")
    joined = number_by_file(left, "_row").join(number_by_file(right, "_row"), "_row", "full")
    return joined.select(*left.columns, *right.columns)


def split_at(df: DataFrame, rows: int, name: str = "split") -> DataFrame:
    """A file scan with 'train' for its first ``rows`` rows and 'test' for the others."""
    numbered = number_by_file(df, "_row")
    return numbered.withColumn(name, F.when(F.col("_row") < rows, "train").otherwise("test")).drop("_row")
