"""Eight-step scores against a grid of quantiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The probabilities of the scoring grid.
GRID = (0.011, 0.05, 0.25, 0.5, 0.75, 0.95, 0.989)


def step_score(value: Column, bounds: Sequence[Column], ascending: bool = True) -> Column:
    """Index (from 1) of the first bound at or above the value.

    Above the last bound, or for null, the score is one more than the number of
    bounds. ``ascending=False`` turns the scale round: small values score high.
    """
    top = len(bounds) + 1
    chain = None
    for step, bound in enumerate(bounds, start=1):
        score = step if ascending else top + 1 - step
        chain = F.when(value <= bound, score) if chain is None else chain.when(value <= bound, score)
    return chain.otherwise(top if ascending else 1)
