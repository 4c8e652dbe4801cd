"""Connected components of a graph given as edges, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from municipia.llm.common import cut


def _hang(pairs: DataFrame, keep: str) -> DataFrame:
    """Every pair (u, v) becomes (v, least neighbour of u); with ``keep`` "larger" only for v > u."""
    least = pairs.groupBy("u").agg(F.min("v").alias("least"))
    if keep == "larger":
        least = least.select("u", F.least("u", "least").alias("least"))
        return pairs.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    inner = pairs.join(least, "u").filter(F.col("v") != F.col("least")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    return inner.unionByName(least.select("u", F.col("least").alias("v")))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, component) for every id that has an edge: the least id reachable. ``edges`` has columns a and b, in any order and number.

    Each round hangs the larger neighbours of a node, then the smaller ones, on its least neighbour, until nothing
    changes. Only minima are gathered per node, so that a node with any number of edges never meets in one task. Edges with a null
    end or two equal ends are passed over; no edges give no rows. Rounds grow with the logarithm of the longest path.
    """
    ends = edges.filter(F.col("a") != F.col("b"))
    pairs = cut(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
    before = state(pairs)
    for _ in range(most_rounds):
        if before[0] == 0:
            break
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        pairs = cut(_hang(_hang(both, "larger").distinct(), "smaller").distinct())
        after = state(pairs)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return pairs.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(pairs.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
