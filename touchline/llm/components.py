"""Connected components of a table of links, by alternating large and small stars.

Each round points every node at the smallest node known to it. A round is two joins of the links
with the smallest neighbour per node; its result is written, so neither the plan nor the loss of
an executor makes it repeat earlier rounds. The number of rounds grows with the logarithm of a
component's size; there is no cap on it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.sources.workspace import pinned


def _pointed(directed: DataFrame) -> DataFrame:
    """``directed(u, v)`` with the smallest of u and its neighbours."""
    smallest = directed.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return directed.join(smallest, "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select(F.inline(F.array(
        F.struct(F.col("u"), F.col("v")), F.struct(F.col("v").alias("u"), F.col("u").alias("v"))
    )))
    pointed = _pointed(both).filter(F.col("v") > F.col("u"))
    return pointed.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """``links(u, v)`` hold v < u."""
    pointed = _pointed(links)
    to_smallest = pointed.select(F.inline(F.array(
        F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))
    )))
    return to_smallest.filter(F.col("u") != F.col("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``: the smallest node it can reach."""
    ordered = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = pinned(ordered.filter(F.col("u") != F.col("v")).distinct(), "links")
    state = None
    while True:
        now = pinned(_small_star(_large_star(now)), "links")
        sums = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.max(F.xxhash64("u", "v"))).first()
        if sums == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
        state = sums
