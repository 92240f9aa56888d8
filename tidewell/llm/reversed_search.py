"""Ranked lexical search, reversed: documents stream through an inverted index over the items' terms."""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tidewell.functions.session import settle
from tidewell.llm.common import by_bytes, in_order, running, stored

# An index holds the items that begin within so many pairs of item and distinct
# term; more items are searched block by block.
POSTINGS = 1 << 18
# Scores of documents and items held at a time, and bytes of a text split at a time.
CELLS, SLICE = 1 << 21, 1 << 20
# Heaps of an item are merged in so many groups of tasks, then once more.
GROUPS = 64
# Stands for a null id among negated ids: after all others.
_NO_ID = -(1 << 63)

# ASCII letters and digits are lower-cased and kept, as are the bytes of all
# characters beyond ASCII; the rest of ASCII becomes a blank.
_TABLE = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


def term_slices(text: str | None) -> Iterator[list[bytes]]:
    """The terms of a text, in lists of those that begin in about SLICE bytes."""
    said = (text or "").encode().translate(_TABLE)
    start = 0
    while start < len(said):
        cut = said.find(b" ", start + SLICE)
        end = len(said) if cut < 0 else cut
        yield said[start:end].split()
        start = end


def item_terms(items: DataFrame) -> DataFrame:
    """``_item, item_id, _term, _times``: a row per row of ``items`` and distinct term; ``_item`` numbers the rows. Stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            at, terms, times = [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                held = Counter()
                for said in term_slices(text):
                    held.update(said)
                at += [k] * len(held)
                terms += held.keys()
                times += held.values()
            rows = batch.select(["_item", "item_id"]).take(pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(terms, pa.binary()), pa.array(times, pa.int64())], names=["_item", "item_id", "_term", "_times"])

    numbered = items.select(F.monotonically_increasing_id().alias("_item"), "item_id", "text")
    kind = items.schema["item_id"].dataType.simpleString()
    return stored(numbered.mapInArrow(run, f"_item long, item_id {kind}, _term binary, _times long"))


def inverted(rows: pa.Table) -> dict:
    """The inverted index of a block of items.

    ``terms`` numbers the terms; the places ``start[t]`` to ``start[t + 1]`` of
    ``item`` and ``times`` hold a term's items and repeats. ``items`` has the
    ``_item`` of each item number. A plain dict, so that executors need no code
    to read it.
    """
    items = np.unique(rows["_item"].to_numpy())
    words = rows["_term"].to_pylist()
    terms = {term: k for k, term in enumerate(dict.fromkeys(words))}
    number = np.fromiter(map(terms.__getitem__, words), np.int64, len(words))
    order = np.argsort(number, kind="stable")
    return {
        "terms": terms, "items": items, "item": np.searchsorted(items, rows["_item"].to_numpy())[order], "times": rows["_times"].to_numpy()[order],
        "start": np.searchsorted(number[order], np.arange(len(terms) + 1)),
    }


def counted(docs: DataFrame, index) -> DataFrame:
    """``doc_id, _n, _terms, _tf`` of every document with a term: how many, and the counts of those in the index. Stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = index.value["terms"]
        for batch in by_bytes(batches):
            total, ends, terms, tf = [], [0], [], []
            for text in batch.column("text").to_pylist():
                n, held = 0, Counter()
                for said in term_slices(text):
                    n += len(said)
                    held.update(map(number.get, said))
                held.pop(None, None)
                total.append(n)
                terms += held.keys()
                tf += held.values()
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            rows = pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tf, pa.int64()))],
                names=["doc_id", "_n", "_terms", "_tf"])
            yield rows.filter(pa.array(np.array(total) > 0))

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return stored(read.mapInArrow(run, "doc_id long, _n long, _terms array<int>, _tf array<long>"))


def _expand(start: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the runs ``of``, one after the other, and which run each place is of."""
    length = start[of + 1] - start[of]
    run = np.repeat(np.arange(len(of)), length)
    return np.arange(len(run)) - np.repeat(np.cumsum(length) - length, length) + np.repeat(start[of], length), run


def best(rows: DataFrame, index, weight: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``_item, _score, doc_id``: each task's ``k`` best documents per item, kept in a heap per item."""

    def scores(part: pa.RecordBatch, own: dict) -> np.ndarray:
        terms, tf = (pa.ListArray.flatten(part.column(c)).to_numpy() for c in ("_terms", "_tf"))
        held = np.diff(part.column("_terms").offsets.to_numpy())
        doc = np.repeat(np.arange(part.num_rows), held)
        # Python's integers, as the product may be large
        m = np.array([75 + 25 * n * n_docs // n_terms for n in part.column("_n").to_pylist()], np.int64)
        value = weight[terms] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[doc]))
        at, pair = _expand(own["start"], terms)
        sums = np.zeros(part.num_rows * len(own["items"]), np.int64)
        np.add.at(sums, doc[pair] * len(own["items"]) + own["item"][at], value[pair] * own["times"][at])
        return sums.reshape(part.num_rows, len(own["items"]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        heaps: list[list[tuple[int, int]]] = [[] for _ in own["items"]]
        least = np.ones(len(own["items"]), np.int64)
        step = max(1, CELLS // max(1, len(own["items"])))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                got = scores(part, own)
                ids = part.column("doc_id").to_pylist()
                for d, i in zip(*(x.tolist() for x in np.nonzero(got >= least))):
                    entry = (int(got[d, i]), _NO_ID if ids[d] is None else -ids[d])
                    heap = heaps[i]
                    if len(heap) < k:
                        heapq.heappush(heap, entry)
                    else:
                        heapq.heappushpop(heap, entry)
                    if len(heap) == k:
                        least[i] = heap[0][0]
        found = [(int(own["items"][i]), score, None if neg == _NO_ID else -neg) for i, heap in enumerate(heaps) for score, neg in heap]
        columns = list(zip(*found)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["_item", "_score", "doc_id"])

    return rows.select("doc_id", "_n", "_terms", "_tf").mapInArrow(run, "_item long, _score long, doc_id long")


def top_documents(docs: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` best documents of each item by a whole-number BM25: ``item_id, rank, doc_id, score``.

    ``docs``: ``doc_id, text``; ``items``: ``item_id, text``. Terms are runs of
    ASCII letters and digits and of all characters beyond ASCII, with A-Z
    lower-cased. N counts the documents with a term, L all their terms, n those
    of one document, df the documents that hold a term, tf its occurrences. Its
    weight w is floor(1000 ln((2N + 2) / (2 df + 1))), a document's m is
    75 + 25 n N div L, and its score the sum of
    w (10**9 tf div (1000 tf + 12 m)) over the item's terms with repeats.

    The index over the items' terms, of at most POSTINGS pairs and one item
    more, is broadcast; the documents' counts stream through it into a heap of
    ``k`` per item and task, and the heaps are merged. More items take a pass
    over the documents for each such block.

    Null and empty texts have no terms: such items have no rows, such documents
    count nowhere. Each row of either table counts for itself, so an id that
    repeats has its results once per row; ids of documents may be null and then
    stand last among equal scores. Other columns are ignored; empty tables give
    an empty result.
    """
    spark = docs.sparkSession
    spoken = item_terms(items)
    sizes = spoken.groupBy("_item").agg(F.count("*").alias("_terms"))
    placed = running(in_order(sizes, F.col("_item")), _before="_terms")
    blocks = settle(placed.select("_item", F.floor(F.col("_before") / POSTINGS).alias("_block")))
    found = []
    for block in [r[0] for r in blocks.select("_block").distinct().orderBy("_block").collect()]:
        own = blocks.where(F.col("_block") == block)
        index = spark.sparkContext.broadcast(inverted(spoken.join(own, "_item").select("_item", "_term", "_times").toArrow()))
        rows = counted(docs, index)
        totals = rows.agg(F.count("*").alias("n"), F.sum("_n").alias("all")).first()
        if not totals["n"]:
            break
        # one number per term of the block
        held = rows.select(F.explode("_terms").alias("_t")).groupBy("_t").agg(F.count("*").alias("_df")).collect()
        weight = np.zeros(len(index.value["terms"]), np.int64)
        for r in held:
            weight[r["_t"]] = math.floor(1000 * math.log((2 * totals["n"] + 2) / (2 * r["_df"] + 1)))
        found.append(best(rows, index, weight, totals["n"], totals["all"], k).withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(GROUPS))))
    if not found:
        found.append(spoken.sparkSession.createDataFrame([], "_item long, _score long, doc_id long, _group int"))

    order = [F.desc("_score"), F.asc_nulls_last("doc_id")]
    first = Window.partitionBy("_item", "_group").orderBy(*order)
    last = Window.partitionBy("_item").orderBy(*order)
    kept = reduce(DataFrame.union, found).withColumn("_r", F.row_number().over(first)).where(F.col("_r") <= k)
    ranked = kept.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k)
    names = spoken.select("_item", "item_id").distinct()
    return ranked.join(names, "_item").select("item_id", "rank", "doc_id", F.col("_score").alias("score"))
