"""Token counts without token ids."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType

from tidewell.functions.session import settle
from tidewell.llm.common import blank_parts, by_bytes, fields, safe_slices, shuffle_partitions

# Bytes of text per call of the library, characters of a slice of a long text,
# and results remembered per worker.
BATCH_BYTES, SLICE, REMEMBERED, LONGEST = 4 << 20, 1 << 18, 400_000, 64


def _counter(path: str):
    """A function from texts to their token counts by the library's tokenizer file."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    known: dict[str, int] = {}

    def lengths(parts: list[str]) -> list[int]:
        return [len(e) for e in tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def count(texts: list[str]) -> list[int]:
        split = [blank_parts(text) for text in texts]
        wanted = {part for parts in split for part in parts[1:]}
        if len(known) > REMEMBERED:
            known.clear()
        fresh = [part for part in wanted if part not in known]
        new = dict(zip(fresh, lengths([" " + part for part in fresh])))
        known.update((part, n) for part, n in new.items() if len(part) <= LONGEST)
        new.update((part, known[part]) for part in wanted if part not in new)
        first = lengths([parts[0] for parts in split])
        return [n + sum(map(new.__getitem__, parts[1:])) for n, parts in zip(first, split)]

    return count


def _count_rows(rows: DataFrame, path: str) -> DataFrame:
    """Replace ``text`` by ``n_tokens``; the other columns pass through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(path)
        for batch in by_bytes(batches, "text", BATCH_BYTES):
            found = count([text or "" for text in batch.column("text").to_pylist()])
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(found, pa.int64())], names=[*kept, "n_tokens"])

    return rows.mapInArrow(run, fields(rows.drop("text").schema, n_tokens=LongType()))


def token_counts(docs: DataFrame, path: str, slice_chars: int = SLICE) -> DataFrame:
    """Tokens of every whole text: ``doc_id, n_bytes, n_tokens``, a row per row of ``docs`` (``doc_id, text``).

    The library encodes batches of about equal bytes and only the lengths are
    kept. Blanks after other than white space are safe boundaries: no token
    spans them, and both sides are split as in the whole text. Texts are cut
    there, so that a batch holds each distinct part once, and texts over
    ``slice_chars`` are cut into slices counted by different tasks. A text
    without a safe blank is counted whole.

    Only for tokenizer files that neither add a blank in front nor normalise
    across blanks; a special token that holds a blank would be torn. Null and
    empty texts count 0. Null and repeated ids are kept, rows being told apart
    by their place in the table. Other columns are ignored.
    """
    rows = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text")
    is_long = F.length("text") > slice_chars
    short = _count_rows(rows.where(F.coalesce(~is_long, F.lit(True))), path)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text in zip(batch.column("_row").to_pylist(), batch.column("text").to_pylist()):
                for k, part in enumerate(safe_slices(text, slice_chars)):
                    yield pa.RecordBatch.from_pylist([{"_row": row, "_k": k, "text": part}])

    long = settle(rows.where(is_long).withColumn("_row", F.monotonically_increasing_id()))
    slices = long.select("_row", "text").mapInArrow(cut, "_row long, _k long, text string").repartition(shuffle_partitions(docs), "_row", "_k")
    sums = _count_rows(slices, path).groupBy("_row").agg(F.sum("n_tokens").alias("n_tokens"))
    return short.unionByName(long.drop("text").join(sums, "_row").drop("_row"))
