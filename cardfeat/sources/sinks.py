"""Writing results and filling the submission template."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cardfeat.session import scratch_path

__all__ = ["fill_template", "scratch_path", "write_csv", "write_parquet"]


def write_csv(df: DataFrame, path: str) -> None:
    """A folder of CSV parts, each with a header and no index column."""
    df.write.mode("overwrite").csv(path, header=True)


def write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def fill_template(template: DataFrame, predictions: DataFrame, key: str = "card_id") -> DataFrame:
    """The template's keys with the predicted target; a missing one is null."""
    return template.select(key).join(predictions.select(key, "target"), key, "left")

