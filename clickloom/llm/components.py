"""Connected components of a link table, as rounds of joins with every round's table on shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.storage import stored


def components(links: DataFrame) -> DataFrame:
    """Columns ``node``, ``label``: the smallest node that can be reached from each node of a link.

    ``links`` has the long columns ``a`` and ``b`` in any direction, repeated or not; loops and nulls don't
    count. Each round hangs a node's larger neighbours on its smallest neighbour, then its smaller
    ones, so that stars with the smallest node as centre remain; hubs cost no more than their links.
    """
    pair = F.array_sort(F.array("a", "b"))
    edges = links.filter("a is not null and b is not null and a <> b").select(F.get(pair, 0).alias("low"), F.get(pair, 1).alias("high"))
    edges = stored(edges.distinct(), "links")
    while True:
        # Larger neighbours of each node go to its smallest neighbour, or itself if that is smaller.
        both = edges.select(F.col("low").alias("u"), F.col("high").alias("v")).unionByName(edges.select(F.col("high").alias("u"), F.col("low").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("m").alias("low"), F.col("v").alias("high"))
        large = large.filter("low <> high").distinct()
        # Smaller neighbours of each node, and the node, go to the smallest of them.
        first = large.groupBy("high").agg(F.min("low").alias("m"))
        joined = large.join(first, "high")
        small = joined.select(F.col("m").alias("low"), F.col("low").alias("high")).filter("low <> high")
        small = small.unionByName(first.select(F.col("m").alias("low"), "high")).distinct()
        small = stored(small, "links")
        same = _digest(small) == _digest(edges)
        edges = small
        if same:
            break
    return edges.select(F.col("high").alias("node"), F.col("low").alias("label")).unionByName(edges.select(F.col("low").alias("node"), F.col("low").alias("label")).distinct())


def _digest(edges: DataFrame) -> tuple:
    h = F.xxhash64("low", "high")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(h, 20)), F.bit_xor(h)).first())
