"""Joins of cards, rollups and dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardfeat.operators.skew import HOT_ROWS, SMALL_KEYS, SMALL_LOOKUP, broadcast_if_small, hot_keys, sent_or_shuffled, split_hot


def lookup(
    df: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "left",
    small: int = SMALL_LOOKUP,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Join a table of values whose keys may be very unevenly used.

    The table's rows and bytes are measured (up to the limit) and it is broadcast
    when small, so the rows do not move; a larger one goes through :func:`spread_lookup`.
    """
    table, sent = sent_or_shuffled(table, small)
    if sent:
        return df.join(table, list(on), how)
    return spread_lookup(df, table, on, how, hot_rows)


def spread_lookup(
    df: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Join by shuffle, but keep rows of hot keys where they are.

    Rows of keys with more than ``hot_rows`` rows meet a broadcast of just
    those keys' entries. Rows with a null key match nothing and skip the join.
    """
    on = list(on)
    has_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in on])
    rows = df.filter(has_key)
    hot = hot_keys(rows, on, hot_rows)
    if hot is None:
        out = rows.join(table, on, how)
    else:
        ordinary, large = split_hot(rows, on, hot)
        entries = broadcast_if_small(split_hot(table, on, hot)[1], SMALL_KEYS)
        out = ordinary.join(table, on, how).unionByName(large.join(entries, on, how))
    if how == "inner":
        return out
    return out.unionByName(df.filter(~has_key), allowMissingColumns=True)


def attach(cards: DataFrame, rollups: Sequence[DataFrame], key: str = "card_id") -> DataFrame:
    """Left-join tables with one row per key; every card stays."""
    return reduce(lambda left, right: left.join(right, key, "left"), rollups, cards)


def enrich(
    rows: DataFrame, dimension: DataFrame, key: str, suffix: str = "_X", small: int = SMALL_LOOKUP, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Rows with a match in the dimension, with the dimension's columns added.

    Dimension columns that also exist in the rows get the suffix.
    """
    clash = (set(rows.columns) & set(dimension.columns)) - {key}
    renamed = dimension.withColumnsRenamed({c: f"{c}{suffix}" for c in clash})
    return lookup(rows, renamed, [key], "inner", small, hot_rows)


def keep_listed(df: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is on the list."""
    return df.join(listed.select(key), key, "left_semi")


def stack_rows(*tables: DataFrame) -> DataFrame:
    """Rows of all tables; columns a table lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
