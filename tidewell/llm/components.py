"""Connected components of a graph of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewell.functions.session import settle

# Edges that a task ties to stars at once.
CHUNK = 1 << 18


def components(links: DataFrame) -> DataFrame:
    """The smallest node that each linked node reaches: ``node, component``.

    ``links`` has the long columns ``a, b``; direction, repeats and loops do
    not matter. It is read twice, so settle what is costly to make.

    First the tasks tie the edges they hold, CHUNK at a time, to the smallest
    nodes that these edges reach. Edges that fit one chunk are done with that:
    rounds of shuffles would cost them many more tasks and files than they have
    rows. Else large-star and small-star steps alternate (Kiveris et al.,
    2014): each ties neighbours to the smallest node around them and never
    joins or parts components. Edges stay linear in number, and the rounds grow
    with the logarithm of the nodes. A node with many links is met by
    pre-aggregated minima and joins that can be split, never in one task.
    """
    links = links.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high")).where("low < high")
    chunks = -(-links.count() // CHUNK)
    tied = links.coalesce(max(1, chunks)).mapInArrow(_tied(CHUNK), "low long, high long")
    if chunks <= 1:
        return tied.select(F.col("high").alias("node"), F.col("low").alias("component"))
    edges = settle(tied.where("low < high"))
    before = None
    while True:
        edges = settle(_small_star(_large_star(edges)))
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("low").alias("node")).distinct()
    return edges.select(F.col("high").alias("node"), F.col("low").alias("component")).union(roots.select("node", "node"))


def _tied(chunk: int):  # noqa: ANN202
    """Edges from each node to the smallest one that a task's edges, ``chunk`` at a time, connect it with; from that one to itself."""

    def stars(low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for a, b in zip(low.tolist(), high.tolist()):
            x, y = top(a), top(b)
            parent[max(x, y)] = min(x, y)
        tops = [top(x) for x in parent]
        return pa.RecordBatch.from_arrays([pa.array(tops, pa.int64()), pa.array(parent, pa.int64())], names=["low", "high"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                held.append(batch.slice(0, chunk - n))
                n += held[-1].num_rows
                batch = batch.slice(held[-1].num_rows)
                if n == chunk:
                    yield stars(*_columns(held))
                    held, n = [], 0
        if held:
            yield stars(*_columns(held))

    return run


def _columns(batches: list[pa.RecordBatch]) -> list[np.ndarray]:
    return [np.concatenate([b.column(c).to_numpy() for b in batches]) for c in ("low", "high")]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("high", "low"))
    least = both.groupBy("low").agg(F.least("low", F.min("high")).alias("_least"))
    tied = both.join(least, "low").where("high > low").select(F.col("_least").alias("low"), "high")
    return tied.where("low < high").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("high").agg(F.min("low").alias("_least"))
    others = edges.join(least, "high").where("low > _least").select(F.col("_least").alias("low"), F.col("low").alias("high"))
    return others.union(least.select(F.col("_least").alias("low"), "high")).distinct()
