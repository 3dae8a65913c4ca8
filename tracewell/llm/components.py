"""Connected components of a graph given as edges, by large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and root (the smallest node of its component) of every node in edges (a, b: longs, in any direction, a <> b).

    Each round links, for every node, its larger neighbours to its smallest neighbour (large star) and then
    its smaller ones and itself to the smallest of these (small star). Both keep components whole; the graph
    becomes one star per component in a number of rounds that grows with the logarithm of its size. A round
    needs of each node's neighbours only their minimum, so no group is ever collected. Minima and rounds are
    written to the shared folder, which also lets adaptive execution split a hub in the joins.
    """
    state = stored(edges.selectExpr("greatest(a, b) a", "least(a, b) b").filter("a <> b").distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        both = state.unionAll(state.selectExpr("b a", "a b"))
        least = stored(both.groupBy("a").agg(F.min("b").alias("m")).selectExpr("a", "least(a, m) m"), "least")
        large = stored(both.join(least, "a").filter("b > a").selectExpr("b a", "m b").distinct(), "large")  # a is the larger end
        least = stored(large.groupBy("a").agg(F.min("b").alias("m")), "least")
        small = large.join(least, "a").selectExpr("b a", "m b").filter("a <> b").unionAll(least.selectExpr("a", "m b")).distinct()
        state = stored(small, "edges")
        now = tuple(state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            return state.selectExpr("a node", "b root").unionAll(state.selectExpr("b node", "b root").distinct())
        before = now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
