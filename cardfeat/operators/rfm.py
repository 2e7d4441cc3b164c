"""Recency, frequency and value scores."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardfeat.functions.scalars import joined_digits
from cardfeat.functions.scoring import GRID, step_score
from cardfeat.functions.stats import SUM_DIGITS
from cardfeat.operators.quantiles import table_quantiles
from cardfeat.session import materialize


def rfm_scores(
    df: DataFrame, recency: str, frequency: str, value: str, tag: str = "", by: str | None = "split"
) -> DataFrame:
    """Add scores 1..8 for each measure, their sum and a dense code index.

    Columns: ``r{tag}_quantile f{tag}_quantile v{tag}_quantile rfm{tag}_score
    rfm{tag}_code rfm{tag}_index``. Grid and index are fitted per value of
    ``by`` (the split), or over all rows when it is None.
    """
    columns = df.columns
    group = by or "_all"
    df = df if by else df.withColumn(group, F.lit(1))
    measures = [recency, frequency, value]
    # One grid row per split: the broadcast does not grow with the cards. The
    # scores are needed for the codes and for the result, the grid only once.
    grid = materialize(
        table_quantiles(df, measures, GRID, [group], SUM_DIGITS)
        .groupBy(group)
        .agg(*(F.max(F.when(F.col("metric") == m, F.col("quantiles"))).alias(f"_grid_{m}") for m in measures))
    )
    scored = df.join(F.broadcast(grid), group, "left")
    names = [f"{letter}{tag}_quantile" for letter in "rfv"]
    for name, measure in zip(names, measures):
        bounds = [F.col(f"_grid_{measure}")[i] for i in range(len(GRID))]
        scored = scored.withColumn(name, step_score(F.col(measure), bounds, ascending=measure == recency))
    scores = [F.col(n) for n in names]
    code = f"rfm{tag}_code"
    scored = scored.withColumn(f"rfm{tag}_score", scores[0] + scores[1] + scores[2]).withColumn(
        code, joined_digits(scores)
    )
    # Three scores of 1..8: never more than 512 codes per split.
    index = (
        scored.select(group, code)
        .distinct()
        .withColumn(f"rfm{tag}_index", F.row_number().over(Window.partitionBy(group).orderBy(code)) - 1)
    )
    out = scored.join(F.broadcast(index), [group, code], "left")
    return out.select(*columns, *names, f"rfm{tag}_score", code, f"rfm{tag}_index")
