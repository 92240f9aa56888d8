"""Approximate nearest neighbours: probed lists scanned by blocks of rotated dimensions."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidewell.functions.session import settle
from tidewell.llm.common import shuffle_partitions

# Rows the index is fitted on, and queries it is tuned on.
FIT_ROWS, TUNE_QUERIES = 8192, 128
# Rows of a list that one task compares at a time, and queries that meet them.
BLOCK_ROWS, BLOCK_QUERIES = 2048, 512
# Dimensions per step; how many standard deviations a partial distance must be
# above its share of the limit before the candidate is abandoned.
BLOCK_DIMS, DOUBT = 16, 3.0


def usable(vectors: DataFrame, key: str, value: str) -> DataFrame:
    """``_id, _v`` (doubles) of the vectors without null or non-finite components."""
    good = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where(F.col(key).isNotNull() & F.col(value).isNotNull() & good).select(
        F.col(key).cast("long").alias("_id"), F.col(value).cast("array<double>").alias("_v"))


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


@dataclass
class Index:
    """Unit centroids of the lists, a random rotation, and how many lists a query probes."""

    centroids: np.ndarray
    rotation: np.ndarray
    probes: int

    def ranked(self, vectors: np.ndarray) -> np.ndarray:
        """For each vector the lists, nearest direction first."""
        return np.argsort(-(vectors @ self.centroids.T), axis=1, kind="stable")

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        return np.argmax(vectors @ self.centroids.T, axis=1)

    def probed(self, vectors: np.ndarray, sizes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Vectors by place, and the lists that the vectors probe: ``probes`` of the lists that are not empty, and more until they hold ``least`` rows."""
        ranked = self.ranked(vectors)
        held = sizes[ranked]
        filled = np.cumsum(held > 0, axis=1)
        before = np.cumsum(held, axis=1) - held
        place, rank = np.nonzero((held > 0) & ((filled <= self.probes) | (before < least)))
        return place, ranked[place, rank]


def _kmeans(points: np.ndarray, lists: int, rounds: int = 10) -> np.ndarray:
    """Centroids of the points' directions."""
    points = points / np.linalg.norm(points, axis=1, keepdims=True)
    random = np.random.default_rng(11)
    centroids = points[random.choice(len(points), lists, replace=False)]
    for _ in range(rounds):
        own = np.argmax(points @ centroids.T, axis=1)
        for k in range(lists):
            if (own == k).any():
                centroids[k] = points[own == k].sum(axis=0)
        centroids = centroids / np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)
    return centroids


def fit(rows: DataFrame, queries: DataFrame, k: int, recall: float) -> Index:
    """Fit centroids on FIT_ROWS rows and choose the probes on TUNE_QUERIES queries.

    Both samples are those with the smallest hashes of their ids. The sampled
    queries' exact neighbours among all rows are found by brute force; the
    probes are the fewest lists that hold a share of ``recall`` of them.
    """
    sample = rows.orderBy(F.xxhash64("_id"), "_id").limit(FIT_ROWS)
    points = matrix(sample.select("_v").toArrow().column("_v").combine_chunks())
    lists = int(max(1, min(np.sqrt(rows.count()) / 4, 1024, len(points) // 8)))
    random = np.random.default_rng(7)
    rotation = np.linalg.qr(random.normal(size=(points.shape[1], points.shape[1])))[0]
    index = Index(_kmeans(points, lists), rotation, lists)

    tuned = queries.orderBy(F.xxhash64("_id"), "_id").limit(TUNE_QUERIES).toArrow()
    ids, vectors = tuned.column("_id").to_numpy(), matrix(tuned.column("_v").combine_chunks())

    def brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [np.zeros(0)] * len(ids)
        place = [np.zeros(0, int)] * len(ids)
        for batch in batches:
            own, x = batch.column("_id").to_numpy(), matrix(batch.column("_v"))
            scores, lists_of = vectors @ x.T, index.nearest(x)
            scores[ids[:, None] == own[None, :]] = -np.inf
            for q in range(len(ids)):
                both, where = np.concatenate([best[q], scores[q]]), np.concatenate([place[q], lists_of])
                top = np.argsort(-both, kind="stable")[:k]
                best[q], place[q] = both[top], where[top]
        for q in range(len(ids)):
            yield pa.RecordBatch.from_pydict({"_query": [q] * len(best[q]), "_list": place[q].astype(np.int32), "_score": best[q]})

    found = rows.mapInArrow(brute, "_query long, _list int, _score double").where("_score > double('-inf')")
    nearest = found.withColumn("_n", F.row_number().over(Window.partitionBy("_query").orderBy(F.desc("_score")))).where(F.col("_n") <= k)
    order = np.argsort(index.ranked(vectors), axis=1)
    depth = np.sort([order[r["_query"], r["_list"]] for r in nearest.collect()])
    index.probes = int(depth[min(len(depth) - 1, int(recall * len(depth)))]) + 1 if len(depth) else lists
    return index


def _scan(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, norms: np.ndarray, k: int) -> list[tuple[int, int]]:
    """Indices (query, row) of the k nearest rows of a block for every query, by inner product.

    ``rows`` and ``queries`` are rotated. A first slice of rows gives every
    query a limit. For the rest the squared distance grows by BLOCK_DIMS
    dimensions at a time; as the rotation is random, the part seen is a sample
    of the whole, and a candidate whose part is too large for the limit beyond
    doubt is abandoned. Whoever sees all dimensions is compared exactly.
    """
    dims = rows.shape[1]
    square_q, square_x = (queries**2).sum(axis=1), norms
    found = []
    first = min(len(rows), max(4 * k, 64))
    head = queries @ rows[:first].T
    head[query_ids[:, None] == row_ids[None, :first]] = -np.inf
    limit = np.full(len(queries), -np.inf)
    if first > k:
        limit = np.partition(head, first - k, axis=1)[:, first - k]
    for q, r in zip(*np.nonzero((head >= limit[:, None]) & (head > -np.inf))):
        found.append((int(q), int(r)))
    if first == len(rows):
        return found
    rest = rows[first:]
    # squared distance at which the inner product equals the limit
    far = square_q[:, None] + square_x[None, first:] - 2 * limit[:, None]
    # so much can rounding change a distance; ties with the limit must pass
    slack = 1e-9 * (square_q.max() + square_x.max())
    q, r = np.nonzero(query_ids[:, None] != row_ids[None, first:])
    partial = np.zeros(len(q))
    for at in range(0, dims, BLOCK_DIMS):
        upto = min(at + BLOCK_DIMS, dims)
        # whole columns while most pairs are alive, single pairs later
        if len(q) * 4 > len(queries) * len(rest):
            a, b = queries[:, at:upto], rest[:, at:upto]
            part = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1)[None, :] - 2 * (a @ b.T)
            partial += part[q, r]
        else:
            partial += ((queries[q, at:upto] - rest[r, at:upto])**2).sum(axis=1)
        share = upto / dims
        allowed = far[q, r] * share * (1 + DOUBT * np.sqrt(2 * (1 - share) / upto))
        alive = partial <= allowed + slack
        q, r, partial = q[alive], r[alive], partial[alive]
    return found + list(zip(q.tolist(), (r + first).tolist()))


def _best(query_ids: np.ndarray, queries: np.ndarray, row_ids: np.ndarray, rows: np.ndarray, pairs: list[tuple[int, int]], k: int) -> list[tuple[int, int, float]]:
    """The k best of each query among the pairs by inner product of the original vectors, ties to the smaller id."""
    if not pairs:
        return []
    q, r = np.array(pairs).T
    score = np.einsum("ij,ij->i", queries[q], rows[r])
    order = np.lexsort([row_ids[r], -score, q])
    q, r, score = q[order], r[order], score[order]
    start = np.searchsorted(q, q)
    top = np.arange(len(q)) - start < k
    return list(zip(query_ids[q[top]].tolist(), row_ids[r[top]].tolist(), score[top].tolist()))


def top_of_queries(found: DataFrame, k: int) -> DataFrame:
    """Rank each query's found rows: score first, then the smaller id; a query keeps at most k rows of each block before."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(vectors: DataFrame, is_query, k: int, key: str = "vec_id", value: str = "embedding", recall: float = 0.97) -> DataFrame:
    """Each query's k nearest rows by inner product: ``query_id, rank, vec_id, score``.

    Queries are the rows where ``is_query`` (a function of the id column)
    holds; candidates all rows but those with the query's own id. Every row is
    in one list, by its direction; a query probes the lists nearest to it, as
    many as held a share of ``recall`` of the true neighbours of a sample, and
    more where these hold fewer than ``k`` candidates. A
    list of any size is dealt out in blocks of BLOCK_ROWS rows and its queries
    in blocks of BLOCK_QUERIES, so a third of all vectors in one list, or all
    alike, makes more tasks and no longer ones. Scores are inner products of
    the original vectors in double precision, ties go to the smaller id.

    Vectors that are null, zero or hold null or non-finite components, and null
    ids, take no part; all others must have one length. Repeated ids are
    repeated candidates. Other columns are ignored; an empty table gives an
    empty result.
    """
    good = usable(vectors, key, value)
    norm = F.aggregate("_v", F.lit(0.0), lambda a, x: a + x * x)
    rows = settle(good.where(norm > 0))
    queries = rows.where(is_query(F.col("_id")))
    empty = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if rows.isEmpty() or queries.isEmpty():
        return empty
    index = fit(rows, queries, k, recall)
    parts = shuffle_partitions(vectors)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = index.nearest(matrix(batch.column("_v"))).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists)], names=[*batch.schema.names, "_list"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                place, lists = index.probed(matrix(part.column("_v")), sizes, least)
                yield pa.RecordBatch.from_arrays([part.column("_id").take(pa.array(place)), pa.array(lists.astype(np.int32))], names=["_id", "_list"])

    placed = settle(rows.mapInArrow(assign, "_id long, _v array<double>, _list int"))
    # One number per list comes to the driver: its rows.
    n_rows = dict(placed.groupBy("_list").count().collect())
    sizes = np.array([n_rows.get(i, 0) for i in range(len(index.centroids))], np.int64)
    # a query's own rows, should its id repeat, are no candidates
    least = k + placed.groupBy("_id").count().agg(F.max("count")).first()[0]
    probing = settle(queries.select("_id", "_v").mapInArrow(probe, "_id long, _list int"))
    # and its queries
    n_queries = dict(probing.groupBy("_list").count().collect())
    row_blocks = {k_: -(-n // BLOCK_ROWS) for k_, n in n_rows.items()}
    query_blocks = {k_: -(-n // BLOCK_QUERIES) for k_, n in n_queries.items()}

    def blocks(of: dict[int, int]):
        return F.element_at(F.array(*[F.lit(of.get(i, 1)) for i in range(len(index.centroids))]), F.col("_list") + 1)

    spread = F.pmod(F.xxhash64("_id"), blocks(row_blocks)).cast("int")
    left = placed.withColumn("_rb", spread).withColumn("_qb", F.explode(F.sequence(F.lit(0), blocks(query_blocks) - 1)))
    spread = F.pmod(F.xxhash64("_id"), blocks(query_blocks)).cast("int")
    right = probing.join(queries, "_id").withColumn("_qb", spread).withColumn("_rb", F.explode(F.sequence(F.lit(0), blocks(row_blocks) - 1)))

    def compare(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        x, q = matrix(rows["_v"].combine_chunks()), matrix(asked["_v"].combine_chunks())
        ids, asking = rows["_id"].to_numpy(), asked["_id"].to_numpy()
        pairs = _scan(q @ index.rotation, asking, x @ index.rotation, ids, (x**2).sum(axis=1), k)
        best = _best(asking, q, ids, x, pairs, k)
        return pa.table({"query_id": pa.array([b[0] for b in best], pa.int64()), "vec_id": pa.array([b[1] for b in best], pa.int64()), "score": pa.array([b[2] for b in best], pa.float64())})

    keys = ["_list", "_rb", "_qb"]
    found = left.repartition(parts, *keys).groupBy(*keys).cogroup(right.select("_id", "_v", *keys).groupBy(*keys)).applyInArrow(compare, "query_id long, vec_id long, score double")
    return top_of_queries(found, k)
