"""A lasting table of codes for values: new values get new codes, old ones keep theirs.

The dictionary is a folder with one Parquet part per :meth:`Dictionary.append`. A
part counts once Spark has marked it as whole, so a killed append leaves nothing and
can be repeated. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardfeat.operators.encode import dense_index
from cardfeat.operators.joins import lookup
from cardfeat.operators.skew import HOT_ROWS, SMALL_LOOKUP


class Dictionary:
    """Codes of the values of a column, kept at ``path``; null has none."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._Path = spark._jvm.org.apache.hadoop.fs.Path

    def _files(self):
        return self._Path(self.path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def parts(self) -> list[str]:
        """The whole parts, oldest first."""
        files, found = self._files(), []
        while files.exists(self._Path(f"{self._part(len(found))}/_SUCCESS")):
            found.append(self._part(len(found)))
        return found

    def _part(self, number: int) -> str:
        return f"{self.path}/part-{number:06d}"

    def table(self) -> DataFrame | None:
        """``value`` and ``code`` of everything known so far, or None before the first append."""
        parts = self.parts()
        return self.spark.read.parquet(*parts) if parts else None

    def append(self, df: DataFrame, column: str, small: int = SMALL_LOOKUP) -> int:
        """Give codes to the values that have none yet, in sorted order after all others; how many there were."""
        parts = self.parts()
        values = df.select(F.col(column).alias("value")).dropna().distinct()
        start = 0
        if parts:
            known = self.table()
            top = known.agg(F.max("code")).first()[0]
            start = 0 if top is None else top + 1
            # the larger side decides how they meet; both have one row per value
            values = values.join(known.select("value"), "value", "left_anti")
        fresh, _ = dense_index(values, "value", "code", small)
        coded = fresh.select("value", (F.col("code").cast("bigint") + F.lit(start).cast("bigint")).alias("code"))
        part = self._part(len(parts))
        self._files().delete(self._Path(part), True)  # what a killed append may have left
        coded.write.parquet(part)
        return self.spark.read.parquet(part).count()

    def encode(self, df: DataFrame, column: str, name: str, small: int = SMALL_LOOKUP, hot_rows: int = HOT_ROWS) -> DataFrame:
        """The rows with the code of their value as ``name``; null for null and for values without a code."""
        table = self.table()
        if table is None:
            return df.withColumn(name, F.lit(None).cast("bigint"))
        codes = table.select(F.col("value").alias(column), F.col("code").alias(name))
        return lookup(df, codes, [column], "left", small, hot_rows).select(*df.columns, name)

    def decode(self, df: DataFrame, code: str, name: str, small: int = SMALL_LOOKUP, hot_rows: int = HOT_ROWS) -> DataFrame:
        """The rows with the value of their code as ``name``; null for codes that were never given."""
        table = self.table()
        if table is None:
            raise ValueError(f"{self.path} holds no dictionary")
        values = table.select(F.col("code").alias(code), F.col("value").alias(name))
        return lookup(df, values, [code], "left", small, hot_rows).select(*df.columns, name)
