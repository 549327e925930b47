"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from notewright.llm.common import table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (``large``), or its smaller-or-equal, neighbours on its least neighbour or itself."""
    if large:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = near.join(least, "u")
    if large:
        out = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionAll(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node connected with it.

    Nodes are of any one orderable type.  Loops and repeated edges are ignored, nulls dropped; an empty
    table gives an empty one.  Each round is written to the shared folder; the rounds needed grow with the
    logarithm of the longest chain.
    """
    clean = edges.select("a", "b").where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).distinct()
    state, seen = table(clean, "edges"), None
    for _ in range(rounds):
        state = table(_star(_star(state, large=True), large=False), "edges")
        mark = state.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
