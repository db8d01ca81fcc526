"""Connected components of a table of links, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import discard, stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a", "a"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has a link; ``component`` is the smallest node reachable.

    Alternates two steps until nothing changes: every node hangs its larger
    neighbours on its smallest neighbour, then its smaller ones.  A step is a
    grouped minimum (combined before the shuffle) and a join with it, so a hub
    with very many links is no single group; the rounds grow with the logarithm
    of the number of nodes.  Each round is a table in the shared folder.
    Links to itself and with a null end do not count; repeated ones count once.
    """
    edges = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter(F.col(a) != F.col(b)).distinct()
    edges = stored(edges, "links")
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (both.filter("b > a").join(low, "a")
                 .select(F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct())
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (large.join(low, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(low.select("a", F.col("m").alias("b"))))
        old = edges
        edges = stored(small.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
        before, state = state, _state(edges)
        discard(old)
        if state == before:
            break
    tops = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(tops)
