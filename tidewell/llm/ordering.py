"""Materialise token sequences in training order as shards of fixed stride."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import BinaryType, LongType

from tidewell.functions.session import settle
from tidewell.llm.common import by_bytes, fields, running, shuffle_partitions

# Token ids are 16 bits wide, little endian; this one fills the last record.
PAD = 0xFFFF
ROUNDS = 6


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed shuffle of 64 bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def permuted(numbers: np.ndarray, n: int, key: int) -> np.ndarray:
    """The place of each number below ``n`` in a keyed permutation of 0 .. n - 1.

    A Feistel network permutes the numbers of an even count of bits, at most
    four times ``n``; results of ``n`` or more are sent through it again until
    they fall below, which keeps it a permutation.
    """
    half = np.uint64(max(1, (max(1, n - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = _mix(np.uint64(key) + np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def encrypt(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (_mix(right ^ k) & mask)
        return (left << half) | right

    out = encrypt(numbers.astype(np.uint64))
    while (outside := out >= n).any():
        out[outside] = encrypt(out[outside])
    return out.astype(np.int64)


def pack(encoded: DataFrame, end_id: int) -> DataFrame:
    """Replace ``ids`` by ``_tokens``, 16 bits each and closed by ``end_id``, and their number ``_n``; null ids are none.

    A document's tokens are compressed, as they are kept until all are counted.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        tight = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            ids = batch.column("ids")
            values = ids.flatten().to_numpy()
            if len(values) and not 0 <= values.min() <= values.max() < PAD:
                raise ValueError(f"token ids must lie from 0 to {PAD - 1}, here are {values.min()} to {values.max()}")
            values = values.astype("<u2")
            n = np.array([k or 0 for k in ids.value_lengths().to_pylist()], np.int64)
            stops = np.cumsum(n)
            flow = np.insert(values, stops, end_id).astype("<u2").tobytes()
            ends = 2 * np.concatenate([[0], stops + np.arange(1, len(n) + 1)])
            raw = pa.array([tight.compress(flow[a:b]) for a, b in zip(ends, ends[1:])], pa.binary())
            kept = [c for c in batch.schema.names if c != "ids"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], raw, pa.array(n + 1)], names=[*kept, "_tokens", "_n"])

    return encoded.mapInArrow(run, fields(encoded.drop("ids").schema, _tokens=BinaryType(), _n=LongType()))


def materialise(encoded: DataFrame, path: str, length: int, key: int, end_id: int, shards: int | None = None) -> dict[str, int]:
    """Write all tokens as records of ``length`` ids in shuffled order; returns ``sequences, shards, stride``.

    ``encoded`` has ``ids``, a row per document. Documents follow each other in
    the order of the table's partitions, each closed by ``end_id``, and the
    stream is cut every ``length`` tokens: totals per partition give every
    document its place, and each partition cuts its own part. Sequence i goes
    to slot ``permuted(i)``; ``stride`` consecutive slots make a shard, one
    range of slots and one file of rows sorted by slot. So a reader finds slot s
    in shard s // stride at row s % stride, byte 2 * length * (s % stride) of
    the records, and can stop and go on anywhere.

    ``path/shard=k`` holds ``slot, sequence, n_tokens, record``; each record has
    2 * length bytes, the last sequence is filled with PAD. Ids of PAD or
    more, or below 0, end the write with an error. Null ids are an empty document. An empty table writes no records.
    """
    packed = settle(pack(encoded.select("ids"), end_id).withColumn("_part", F.spark_partition_id()))
    total = packed.agg(F.sum("_n")).first()[0] or 0
    sequences = -(-total // length)
    shards = max(1, min(shards or shuffle_partitions(encoded), sequences))
    stride = max(1, -(-sequences // shards))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        loose = zstandard.ZstdDecompressor()
        held, at = b"", None
        for batch in by_bytes(batches, "_tokens", 1 << 21):
            if not batch.num_rows:
                continue
            at = batch.column("_before")[0].as_py() if at is None else at
            flow = held + b"".join(map(loose.decompress, batch.column("_tokens").to_pylist()))
            # all whole sequences; the first may be the end of one begun elsewhere
            whole = (at + len(flow) // 2) // length * length - at
            if whole > 0:
                yield from pieces(flow[:2 * whole], at)
                flow, at = flow[2 * whole:], at + whole
            held = flow
        if held:
            yield from pieces(held, at)

    def pieces(flow: bytes, at: int) -> Iterator[pa.RecordBatch]:
        n = len(flow) // 2
        starts = np.unique(np.concatenate([[at], np.arange(-(-at // length) * length, at + n, length)]))
        ends = np.append(starts[1:], at + n)
        slots = permuted(starts // length, sequences, key)
        raw = [flow[2 * (a - at):2 * (b - at)] for a, b in zip(starts, ends)]
        yield pa.RecordBatch.from_arrays(
            [pa.array((slots // stride).astype(np.int32)), pa.array(slots), pa.array(starts // length), pa.array(starts % length), pa.array(raw, pa.binary())],
            names=["shard", "slot", "sequence", "_at", "record"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Put together the parts of a sequence that two or more partitions hold, and fill the last one."""
        last = None
        for batch in batches:
            out: list[dict] = []
            for r in batch.to_pylist():
                if last is not None and last["slot"] == r["slot"]:
                    last["record"] += r["record"]
                    continue
                if last is not None:
                    out.append(last)
                last = r
            yield from closed(out)
        if last is not None:
            yield from closed([last])

    def closed(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        if rows:
            n = [len(r["record"]) // 2 for r in rows]
            filled = [r["record"] + PAD.to_bytes(2, "little") * (length - k) for r, k in zip(rows, n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["shard"] for r in rows], pa.int32()), pa.array([r["slot"] for r in rows], pa.int64()),
                 pa.array([r["sequence"] for r in rows], pa.int64()), pa.array(n, pa.int32()), pa.array(filled, pa.binary())],
                names=["shard", "slot", "sequence", "n_tokens", "record"])

    parts = running(packed, _before="_n").select("_before", "_tokens").mapInArrow(cut, "shard int, slot long, sequence long, _at long, record binary")
    records = parts.repartition(shards, "shard").sortWithinPartitions("shard", "slot", "_at").mapInArrow(join, "shard int, slot long, sequence long, n_tokens int, record binary")
    records.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return {"sequences": sequences, "shards": shards, "stride": stride}


def read_from(spark: SparkSession, path: str, slot: int, stride: int) -> DataFrame:
    """The records from a slot on, in order: shards before it are not opened, rows before it are skipped by statistics."""
    return spark.read.parquet(path).where((F.col("shard") >= slot // stride) & (F.col("slot") >= slot)).orderBy("shard", "slot")
