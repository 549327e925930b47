"""Exact top-k inner products with a KD-tree per shard of the vectors.

A shard's tree is built by median splits, and each node has a tight bounding
box.  A search goes best first by the bound of a query on a box, and stops at
the k-th best score found.  Each query first searches the shard it would itself
lie in; the k-th score found there goes with it to all other shards.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from notewright.llm.common import table

_FOUND = "query long, query_id long, vec_id long, score long"
_LONG = 2**63 - 1


class KdTree:
    """Integer vectors in a tree of median splits; arrays by node."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = 128):
        order = np.arange(len(ids))
        self.low, self.high, self.kids, self.span = [], [], [], []
        stack = [(0, len(ids), -1, 0)]
        while stack:
            a, b, parent, side = stack.pop()
            part = vectors[order[a:b]]
            low, high = part.min(axis=0), part.max(axis=0)
            node = len(self.span)
            self.low.append(low)
            self.high.append(high)
            self.kids.append([-1, -1])
            self.span.append((a, b))
            if parent >= 0:
                self.kids[parent][side] = node
            if b - a > leaf and len(low):
                axis = int(np.argmax(high - low))
                middle = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(part[:, axis], middle, kind="introselect")]
                stack += [(a, a + middle, node, 0), (a + middle, b, node, 1)]
        self.ids, self.vectors = ids[order], vectors[order]
        self.low, self.high = np.array(self.low), np.array(self.high)
        self.least = [int(self.ids[a:b].min()) for a, b in self.span]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The most that any vector in each node's box can score, by query."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T

    def search(self, own: int, query: np.ndarray, bounds: np.ndarray, k: int, floor: tuple[int, int] | None) -> list[tuple[int, int]]:
        """The k best (score, -vec_id) but ``own``, best last to first in no order; only those above ``floor``."""
        top: list[tuple[int, int]] = []
        heap = [(-bounds[0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            worst = top[0] if len(top) == k else floor
            if worst is not None and -bound < worst[0]:
                break
            if worst is not None and -bound == worst[0] and -self.least[node] <= worst[1]:
                continue
            left, right = self.kids[node]
            if left >= 0:
                heapq.heappush(heap, (-bounds[left], left))
                heapq.heappush(heap, (-bounds[right], right))
                continue
            a, b = self.span[node]
            scores = self.vectors[a:b] @ query
            near = range(b - a) if worst is None else np.flatnonzero(scores >= worst[0])  # a bound or score past a long is past each kth, too
            for i in near:
                found = (max(-_LONG - 1, min(_LONG, int(scores[i]))), -int(self.ids[a + i]))
                if found[1] == -own or floor is not None and found <= floor:
                    continue
                if len(top) < k:
                    heapq.heappush(top, found)
                elif found > top[0]:
                    heapq.heapreplace(top, found)
        return top


def _exact_kind(*columns: pd.Series) -> type:
    """What holds all inner products exactly: float64 (fastest), int64 or Python's whole numbers."""
    most = max((max(int(v.max(initial=0)), -int(v.min(initial=0))) for c in columns for v in c), default=0)
    top = most * most * max(1, max(len(c.iloc[0]) for c in columns))
    return np.float64 if top < 2**53 else np.int64 if top < 2**63 else object


def _matrix(column: pd.Series, kind: type) -> np.ndarray:
    rows = column.to_numpy()
    return np.array([[int(x) for x in v] for v in rows], object).reshape(len(rows), -1) if kind is object else np.stack(rows).astype(kind)


def quantize(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, v: floor(256 * x) of each component, x as double; whole numbers, as doubles, which hold them exactly.

    Rows take no part whose id or vector is null, or that hold a component that is null or not finite.  So does a row with a
    double of 2**1016 or more, 256 times which is beyond a double; no float is that large.
    """
    scaled = F.transform(F.col(vec_col).cast("array<double>"), lambda x: F.when(F.isnan(x), None).otherwise(x * 256.0))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), scaled.alias("e"))
    usable = F.forall("e", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    # The floor of a double beyond 2**53 is itself; Spark's own goes by way of a long.
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("e").isNotNull() & usable)
    return rows.select("vec_id", F.transform("e", lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)).alias("v"))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, shard_rows: int = 2048, block_queries: int = 2048) -> DataFrame:
    """The k best rows of ``vectors`` (vec_id, v array<double> of whole numbers) for each row of ``queries`` (the same columns).

    query_id, rank (from 1), vec_id, score: by inner product, ties to the smaller vec_id.  Rows with the
    query's own id are no candidates; vectors meet those of their own dimension only.  A repeated vec_id is
    as many candidates; a repeated query row is answered once, an id with several vectors once for each of
    them.  Fewer candidates than k: all of them.  Products are exact at any size; a score beyond a long is
    given as the nearest long, and such scores tie.

    A task holds one shard (about ``shard_rows``) and one block of queries (about ``block_queries``), so its
    size doesn't grow with the input.
    """
    vectors = table(vectors, "vectors")
    queries = table(queries.select("vec_id", "v").distinct().withColumn("query", F.monotonically_increasing_id()), "queries")
    shards = max(1, -(-vectors.count() // shard_rows))
    blocks = max(1, -(-queries.count() // block_queries))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    sharded = vectors.select(F.size("v").alias("dim"), shard.alias("shard"), "vec_id", "v")
    asked = queries.select(F.size("v").alias("dim"), shard.alias("home"), "query", "vec_id", "v", F.pmod(F.xxhash64("v"), F.lit(blocks)).cast("int").alias("block"))

    home = sharded.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).groupBy("dim", "shard", "block")
    own = asked.withColumnRenamed("home", "shard").withColumn("floor", F.lit(None).cast("array<long>"))
    seeds = table(home.cogroup(own.groupBy("dim", "shard", "block")).applyInPandas(_searcher(k), _FOUND), "seeds")

    kth = seeds.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("score", (-F.col("vec_id")).alias("n")))).alias("t"))
    kth = kth.where(F.size("t") >= k).select("query", F.array(F.element_at("t", -k)["score"], F.element_at("t", -k)["n"]).alias("floor"))
    away = asked.join(kth, "query", "left").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where(F.col("shard") != F.col("home")).drop("home")
    rest = home.cogroup(away.groupBy("dim", "shard", "block")).applyInPandas(_searcher(k), _FOUND)

    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = seeds.unionAll(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")


def _searcher(k: int):
    def search(shard: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(_search(shard, asked, k), columns=["query", "query_id", "vec_id", "score"])

    return search


def _search(shard: pd.DataFrame, asked: pd.DataFrame, k: int) -> list[tuple[int, int, int, int]]:
    if shard.empty or asked.empty:
        return []
    kind = _exact_kind(shard["v"], asked["v"])
    tree = KdTree(shard["vec_id"].to_numpy(), _matrix(shard["v"], kind))
    queries = _matrix(asked["v"], kind)
    bounds, out = tree.bounds(queries), []
    for number, own, q, bound, floor in zip(asked["query"], asked["vec_id"], queries, bounds, asked["floor"]):
        above = None if floor is None else (int(floor[0]), int(floor[1]))
        out += [(number, own, -n, s) for s, n in tree.search(int(own), q, bound, k, above)]
    return out


#: The same result in SQL.
ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT *, row_number() OVER () AS query FROM (SELECT DISTINCT vec_id, v FROM v WHERE vec_id % 50 = 0)),
p AS (
  SELECT q.query, q.vec_id AS query_id, c.vec_id, CAST(greatest(least(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: CAST(z[1] AS HUGEINT) * z[2])), 0), 9223372036854775807), -9223372036854775808) AS BIGINT) AS score
  FROM q JOIN v c ON c.vec_id <> q.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
