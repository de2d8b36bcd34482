"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.session import materialize


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))


def _both(links: DataFrame) -> DataFrame:
    return links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(links: DataFrame) -> DataFrame:
    """Larger neighbours of a node are tied to its least neighbour."""
    both = _both(links)
    return both.join(_least(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are tied to the least of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return tied.union(least.select("a", F.col("m").alias("b"))).where("a <> b")


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b of one integer type); root is the least node that can be reached.

    Minima are aggregates joined back, never windows over a node's neighbours, so that a node with
    very many neighbours is combined before the shuffle and split by the join. Each round is a
    reliable checkpoint; rounds grow with the logarithm of the longest path.
    Links from a node to itself and nulls are left out; an empty table gives an empty table.
    """
    links = materialize(links.select("a", "b").where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(links)
    while state[0]:
        links = materialize(_small_star(_large_star(links).distinct()).distinct())
        now = _state(links)
        if now == state:
            break
        state = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
