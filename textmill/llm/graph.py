"""Connected components by alternating large and small stars; edges and labels stay distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textmill.llm.common import discard, stored


def connected_components(edges: DataFrame, *, rounds: int = 100) -> DataFrame:
    """(node, component) for the nodes of edges (a, b): component is the smallest node reachable.

    Each round rewires every node to the smallest neighbour that it knows, so the number of rounds grows with the logarithm of the nodes; more than `rounds` raise an error. Edges with a null end and loops are left out of the graph. Minima are combined before they are shuffled, and both sides of every join are read from written tables: where a node has very many edges, adaptive execution cuts its part of the shuffle into several tasks, as the other side has one row a node.
    """
    ends = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("a is not null and b is not null and a <> b")
    e = stored(ends.distinct(), "cc")
    last = None
    for _ in range(rounds):
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m")), "cc-low")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = stored(large.distinct(), "cc-large")
        down = stored(large.groupBy("u").agg(F.min("v").alias("m")), "cc-down")
        small = large.join(down, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new = stored(small.union(down.select("u", F.col("m").alias("v"))).distinct(), "cc")
        state = new.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        discard(e, low, large, down)
        e = new
        if (state.n, state.h) == last:
            break
        last = (state.n, state.h)
    else:
        raise RuntimeError(f"components have not settled after {rounds} rounds")
    top = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(top)
