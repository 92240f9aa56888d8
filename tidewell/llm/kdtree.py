"""Exact top-k search by inner product with a KD-tree per shard."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewell.functions.session import settle
from tidewell.llm.ann import matrix, top_of_queries, usable
from tidewell.llm.common import shuffle_partitions

# Rows of a shard and of a leaf, and queries that visit a shard together.
SHARD_ROWS, LEAF_ROWS, BLOCK_QUERIES = 16384, 256, 1024

# Scores beyond a long count as the largest or smallest one.
MOST = (1 << 63) - 1

_FOUND = "query_id long, vec_id long, score long"


class Tree:
    """Median splits of the widest dimension; every node knows the tight box around its rows."""

    def __init__(self, rows: np.ndarray, leaf: int = LEAF_ROWS) -> None:
        self.low, self.high, self.children, self.members = [], [], [], []
        self._rows, self._leaf = rows, leaf
        self._grow(np.arange(len(rows)))
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _grow(self, own: np.ndarray) -> int:
        node = len(self.low)
        box = self._rows[own]
        self.low.append(box.min(axis=0))
        self.high.append(box.max(axis=0))
        self.children.append(())
        self.members.append(own)
        spread = self.high[node] - self.low[node]
        widest = int(np.argmax(spread))
        if len(own) > self._leaf and spread[widest] > 0:
            half = len(own) // 2
            order = np.argpartition(box[:, widest], half)
            self.members[node] = None
            self.children[node] = (self._grow(own[order[:half]]), self._grow(own[order[half:]]))
        return node

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest inner product that any point of each box can have with each query."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T


def search_shard(tree: Tree, rows: np.ndarray, ids: np.ndarray, query: np.ndarray, query_id: int, bounds: np.ndarray, k: int, kth: int) -> list[tuple[int, int]]:
    """The k best ``(score, -id)`` of a shard for a query that reach ``kth``: boxes by bound, until none can."""
    best: list[tuple[int, int]] = []
    open_ = [(-bounds[0], 0)]
    while open_ and -open_[0][0] >= kth:
        node = heapq.heappop(open_)[1]
        for child in tree.children[node]:
            if bounds[child] >= kth:
                heapq.heappush(open_, (-bounds[child], child))
        own = tree.members[node]
        if own is None:
            continue
        scores = rows[own] @ query
        enough = (scores >= kth).astype(bool)
        reach, scores = own[enough], scores[enough]
        keep = ids[reach] != query_id
        reach, scores = reach[keep], scores[keep]
        if len(scores) > k:
            top = np.lexsort([ids[reach], -scores])[:k]
            reach, scores = reach[top], scores[top]
        best = heapq.nlargest(k, best + [(int(s), -int(i)) for s, i in zip(scores, ids[reach])])
        if len(best) == k:
            kth = max(kth, best[-1][0])
    return best


def _search(rows: DataFrame, queries: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Search the shard named by the first two ``keys`` with all queries of the same keys; ``_kth`` is each query's limit."""

    def run(shard: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if shard.num_rows and asked.num_rows:
            x, q = matrix(shard["_v"].combine_chunks()), matrix(asked["_q"].combine_chunks())
            largest = float(np.abs(x.astype(float)).max(initial=0)) * float(np.abs(q.astype(float)).max(initial=0)) * x.shape[1]
            ids, tree = shard["_id"].to_numpy(), Tree(x.astype(float))
            # rounding must not lower a bound below a score it bounds
            bounds = tree.bounds(q.astype(float)) + largest * 1e-12
            # doubles are exact while all sums stay below 2**53; beyond a long, Python's numbers are
            kind = float if largest < 2.0**53 else np.int64 if largest < 2.0**62 else object
            x, q = x.astype(kind), q.astype(kind)
            for i, (asking, kth) in enumerate(zip(asked["_asking"].to_pylist(), asked["_kth"].to_pylist())):
                found += [(asking, -i_, min(max(s, -MOST), MOST)) for s, i_ in search_shard(tree, x, ids, q[i], asking, bounds[i], k, kth)]
        return pa.table({n: pa.array([f[c] for f in found], pa.int64()) for c, n in enumerate(["query_id", "vec_id", "score"])})

    left = rows.select("_id", "_v", *keys).repartition(shuffle_partitions(rows), *keys)
    # both sides stem from the same rows: the queries' columns need names of their own
    right = queries.select(F.col("_id").alias("_asking"), F.col("_v").alias("_q"), "_kth", *[F.col(c).alias(f"_at{c}") for c in keys])
    return left.groupBy(*keys).cogroup(right.groupBy(*[f"_at{c}" for c in keys])).applyInArrow(run, _FOUND)


def exact_top_k(vectors: DataFrame, is_query, k: int, scale: int = 256, key: str = "vec_id", value: str = "embedding") -> DataFrame:
    """Each query's k rows with the largest integer inner product: ``query_id, rank, vec_id, score``.

    Components become floor(``scale`` * x). Queries are the rows where
    ``is_query`` (a function of the id column) holds, candidates all rows but
    those with the query's own id; ties go to the smaller id.

    Rows are dealt into shards of at most SHARD_ROWS by their place in the
    table, whatever their values. First every query searches the shard it lies
    in; its kth score there is carried to all other shards, where whole boxes
    below it are passed over. Query blocks meet all shards, so the work is
    exhaustive where boxes cannot exclude anything (as with many independent
    dimensions), and the result exact in any case.

    Components and scores beyond a long count as the largest or smallest long.
    Vectors that are null or hold null or non-finite components, and null ids,
    take no part; all others must have one length. Repeated ids are repeated
    candidates. Other columns are ignored; an empty table gives an empty result.
    """
    whole: Column = F.transform("_v", lambda x: F.floor(x * scale).cast("long"))
    good = usable(vectors, key, value).select("_id", whole.alias("_v"), F.monotonically_increasing_id().alias("_at"))
    rows = settle(good.select("_id", "_v", F.shiftright("_at", 33).cast("int").alias("_part"),
                              F.floor(F.col("_at").bitwiseAND((1 << 33) - 1) / SHARD_ROWS).cast("int").alias("_chunk")))
    lowest = F.lit(-MOST).cast("long")
    asked = rows.where(is_query(F.col("_id")))
    home = settle(_search(rows.withColumn("_block", F.lit(0)), asked.withColumn("_kth", lowest).withColumn("_block", F.lit(0)), ["_part", "_chunk", "_block"], k))

    # kth scores of the home shards; a query that found fewer than k has none
    kth = home.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("_kth"))
    shards = rows.select("_part", "_chunk").distinct().collect()  # one row per SHARD_ROWS rows or input partition
    n_blocks = max(1, -(-asked.count() // BLOCK_QUERIES))
    block = F.pmod(F.xxhash64("_id"), F.lit(n_blocks)).cast("int")
    limited = asked.join(kth, F.col("_id") == F.col("query_id"), "left").select(
        "_id", "_v", F.coalesce("_kth", lowest).alias("_kth"), F.col("_part").alias("_p"), F.col("_chunk").alias("_c"), block.alias("_block"))
    every = F.explode(F.array(*[F.struct(F.lit(r["_part"]).alias("_part"), F.lit(r["_chunk"]).alias("_chunk")) for r in shards] or [F.struct(F.lit(0).alias("_part"), F.lit(0).alias("_chunk"))]))
    visits = limited.withColumn("_s", every).select("_id", "_v", "_kth", "_block", "_p", "_c", "_s.*").where((F.col("_p") != F.col("_part")) | (F.col("_c") != F.col("_chunk")))
    repeated = rows.withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    away = _search(repeated, visits, ["_part", "_chunk", "_block"], k)
    return top_of_queries(home.union(away), k)
