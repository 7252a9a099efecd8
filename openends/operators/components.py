"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from openends.sources.shared import stored


def _state(edges: DataFrame) -> tuple:
    found = edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(found)


def components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """(node, component) for every node with a link to another: the smallest node reached.

    Star contraction: a node's neighbours are linked to the smallest of them instead,
    first the larger ones, then the smaller ones, until every group is one star. The
    number of rounds grows with the logarithm of a group's width. A round is two
    aggregations with map-side combining and joins on narrow keys, stored in the shared folder.
    """
    a, b = F.col(left), F.col(right)
    links = edges.filter(a.isNotNull() & b.isNotNull() & (a != b))
    links = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    links = stored(links.distinct(), "links")
    state = _state(links)
    while True:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        larger = both.join(lowest, "a").filter("b > a")
        links = larger.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        lowest = links.groupBy("a").agg(F.min("b").alias("m"))
        smaller = links.join(lowest, "a").filter("b != m").select(F.col("b").alias("a"), "m")
        links = smaller.unionByName(lowest).select("a", F.col("m").alias("b")).distinct()
        links = stored(links, "links")
        last, state = state, _state(links)
        if state == last:
            break
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionByName(
        links.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
