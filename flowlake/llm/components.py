"""Connected components of an edge table, by alternating large and small stars.

Every step is an aggregate and a join whose sides are both stored or freshly
shuffled, so run-time skew splitting can divide a node with very many edges.
Steps are written to the shared folder; nothing is collected but two sums that
tell whether anything changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlake.llm.tables import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """edges: a, b (bigint). Returns node, component (the smallest node
    reachable) for every node with an edge to another. Null ends and edges from
    a node to itself are ignored; repeated edges don't matter."""
    pairs = edges.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    pairs = stored(pairs.filter("hi > lo").distinct(), "edges")
    state = _state(pairs)
    while True:
        both = pairs.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(pairs.select("lo", "hi"))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.join(least, "u").filter("v > u AND v > m").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = stored(large, "large-star")
        lowest = stored(large.groupBy("hi").agg(F.min("lo").alias("m")), "lowest")
        small = large.join(lowest, "hi").filter("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        pairs = stored(small.unionAll(lowest.select("hi", F.col("m").alias("lo"))).distinct(), "small-star")
        before, state = state, _state(pairs)
        if state == before:
            break
    return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(
        pairs.select("lo", "lo").distinct())
