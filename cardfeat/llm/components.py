"""Connected components of a table of links, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardfeat.llm.tables import SMALL_KEYS
from cardfeat.operators.skew import HOT_ROWS, broadcast_if_small
from cardfeat.session import stage

#: The diameter halves in a round or better; this many suffice for any table that fits on disk.
MAX_ROUNDS = 60


def _with_smallest(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The edges (u, v) with ``m``, the smallest of u and its neighbours v, and the table (k, m) of all u.

    Minima are combined before the shuffle. Edges of a node with very many stay where they are and meet a broadcast
    of those nodes, of which there are at most edges / HOT_ROWS.
    """
    nodes = edges.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"), F.count("*").alias("n"))
    nodes = stage(nodes.select("k", F.least("k", "m").alias("m"), "n"), "nodes")
    hubs = nodes.filter(F.col("n") > HOT_ROWS).select("k", "m")
    same = F.col("u") == F.col("k")
    if hubs.isEmpty():
        return edges.join(nodes.select("k", "m"), same).select("u", "v", "m"), nodes
    hubs = broadcast_if_small(hubs, SMALL_KEYS)
    others = edges.join(hubs, same, "left_anti").join(nodes.select("k", "m"), same).select("u", "v", "m")
    return others.union(edges.join(hubs, same).select("u", "v", "m")), nodes


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_smallest(both)[0].filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = stage(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "down")
    found, nodes = _with_smallest(down)
    moved = found.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(nodes.select(F.col("k").alias("u"), F.col("m").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """Nodes (``u``) that are linked to a smaller one, with the smallest of their component (``v``).

    ``links`` has columns ``u`` and ``v``; loops and repeats do no harm. Every
    round is written to the shared folder, so a lost executor repeats one round.
    """
    edges = stage(links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    seen = None
    for _ in range(MAX_ROUNDS):
        count, digest = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if count == 0 or (count, digest) == seen:
            return edges
        seen = count, digest
        edges = stage(_small_star(_large_star(edges)).distinct(), "links")
    raise RuntimeError(f"no end after {MAX_ROUNDS} rounds")
