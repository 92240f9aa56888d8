"""Byte-level BPE: encode whole texts to token ids, decode ids to bytes."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType

from tidewell.functions.session import settle
from tidewell.llm.common import by_bytes, fields, shuffle_partitions

# Characters of a chunk, and of the text after it that it is pre-tokenised with.
CHUNK, OVERLAP = 1 << 16, 1 << 10
# The last pre-tokens of a chunk can change with the text that follows.
_UNSURE = 3


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: lines of base64 bytes and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _encode_rows(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """Replace ``text`` by ``ids``; the other columns pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        merges = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
        for batch in by_bytes(batches):
            ids = pa.array([merges.encode_ordinary(text or "") for text in batch.column("text").to_pylist()], pa.list_(pa.int32()))
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], ids], names=[*kept, "ids"])

    return rows.mapInArrow(run, fields(rows.drop("text").schema, ids=ArrayType(IntegerType())))


def encode(docs: DataFrame, path: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """Token ids of every whole text: ``doc_id, ids``, a row per row of ``docs`` (``doc_id, text``).

    Each match of ``pattern`` is encoded separately by the ranks in the file at
    ``path``, without special tokens. Texts of more than ``chunk`` characters
    are spread over tasks:

    1. Chunks, each with ``overlap`` characters of what follows, are
       pre-tokenised in parallel, wherever their first character happens to be.
    2. Where chunk k and k + 1 both start a pre-token in their common
       characters, they agree from there on, since a match depends only on the
       text after its start: the first such place is the cut. Without one
       (say, one word of many thousand letters) the chunks stay together.
    3. The pieces between cuts are encoded in parallel and their ids joined.

    Null and empty texts have no ids. Null and repeated ids are kept: rows are
    told apart by their place in the table. Other columns are ignored.
    """
    rows = docs.select("doc_id", "text")
    is_long = F.length("text") > chunk
    short = _encode_rows(rows.where(F.coalesce(~is_long, F.lit(True))), path, pattern)
    long = settle(rows.where(is_long).withColumn("_row", F.monotonically_increasing_id()))
    return short.unionByName(_encode_long(long, path, pattern, chunk, overlap))


def _encode_long(long: DataFrame, path: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    texts = long.select("_row", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column("_row").to_pylist(), batch.column("text").to_pylist()):
                for k, at in enumerate(range(0, len(text), chunk)):
                    yield pa.RecordBatch.from_pylist([{"_row": row, "_k": k, "_body": text[at:at + chunk + overlap]}])

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        compiled = regex.compile(pattern)
        for batch in batches:
            head, tail = [], []
            for k, body in zip(batch.column("_k").to_pylist(), batch.column("_body").to_pylist()):
                starts = [m.start() for m in compiled.finditer(body)]
                sure = starts if len(body) <= chunk else starts[:-_UNSURE]
                head.append([k * chunk + s for s in sure if s < overlap])
                tail.append([k * chunk + s for s in sure if s >= chunk])
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("_k"), pa.array(head, kind), pa.array(tail, kind)], names=["_row", "_k", "_head", "_tail"])

    n = shuffle_partitions(long)
    chunks = texts.mapInArrow(cut, "_row long, _k long, _body string").repartition(n, "_row", "_k")
    found = settle(chunks.mapInArrow(bounds, "_row long, _k long, _head array<long>, _tail array<long>"))
    after = found.select("_row", (F.col("_k") - 1).alias("_k"), F.col("_head").alias("_next"))
    met = F.array_min(F.array_intersect("_tail", "_next"))
    cuts = found.join(after, ["_row", "_k"]).groupBy("_row").agg(F.sort_array(F.collect_list(met)).alias("_cuts"))

    def slice_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ends = [0, *(r["_cuts"] or []), len(r["text"])]
                for k, (a, b) in enumerate(zip(ends, ends[1:])):
                    yield pa.RecordBatch.from_pylist([{"_row": r["_row"], "_k": k, "text": r["text"][a:b]}])

    pieces = texts.join(cuts, "_row", "left").mapInArrow(slice_, "_row long, _k long, text string").repartition(n, "_row", "_k")
    # A document's ids come together as its text did.
    joined = _encode_rows(pieces, path, pattern).groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_k", "ids"))).alias("_ids"))
    return long.select("_row", "doc_id").join(joined, "_row").select("doc_id", F.flatten("_ids.ids").alias("ids"))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """Add ``decoded``, the raw bytes of all ``ids`` one after the other; null ids decode to none.

    An id without a rank raises.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = {rank: raw for raw, rank in read_ranks(path).items()}
        for batch in by_bytes(batches, "ids", 1 << 18):
            ids = batch.column("ids")
            values, ends = ids.flatten().to_numpy(), np.cumsum([0, *[n or 0 for n in ids.value_lengths().to_pylist()]])
            raw = [b"".join(map(token.__getitem__, values[a:b].tolist())) for a, b in zip(ends, ends[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(raw, pa.binary())], names=[*batch.schema.names, "decoded"])

    return encoded.mapInArrow(run, fields(encoded.schema, decoded=BinaryType()))
