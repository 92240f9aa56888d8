"""Helpers shared by the operators: global running sums, word counts, safe places to cut a text."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, LongType, StructField, StructType

from tidewell.functions.session import settle, shared_folder

# ASCII white space, the only separators of words in this package.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"


def remainder(doc_id: Column, by: int) -> Column:
    """crc32 of the id's decimal text modulo ``by``; that of the empty text for a null id."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(by))


def by_bytes(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of rows with at most ``most`` bytes in a string or binary column, or items in a list column, a longer value alone."""
    for batch in batches:
        values = batch.column(column)
        lengths = pc.list_value_length(values) if pa.types.is_list(values.type) else pc.binary_length(values)
        upto = np.cumsum(np.nan_to_num(lengths.cast("float64").to_numpy(zero_copy_only=False)))
        start = 0
        while start < batch.num_rows:
            end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + most, "right")))
            yield batch.slice(start, end - start)
            start = end


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def word_count(text: Column) -> Column:
    """Number of words in a text, null counting as empty; the words are never collected in an array."""
    bare = F.trim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return F.length(F.regexp_replace(bare, f"[{SPACE}]*{WORD}", ".")).cast("long")


def fields(schema: StructType, **added: DataType) -> StructType:
    """A schema with further fields."""
    return StructType([*schema, *[StructField(name, kind) for name, kind in added.items()]])


def stored(df: DataFrame) -> DataFrame:
    """Like ``settle``, as a Parquet table in the shared folder: for long tables, whose columns compress well.

    The table stays until the owner of the folder deletes it.
    """
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_order(df: DataFrame, *keys: Column) -> DataFrame:
    """All rows sorted over the partitions, each row with its partition's number as ``_part``; settled."""
    ranged = df.repartitionByRange(shuffle_partitions(df), *keys).sortWithinPartitions(*keys)
    return settle(ranged.withColumn("_part", F.spark_partition_id()))


def running(ordered: DataFrame, **sums: str) -> DataFrame:
    """Add to each row of ``in_order`` the sum of a column over all rows before it.

    ``sums`` maps a new column to the long column it sums. One row of totals
    per partition comes to the driver; the rest happens inside the partitions.
    """
    totals = {r["_part"]: r for r in ordered.groupBy("_part").agg(*[F.sum(c).alias(a) for a, c in sums.items()]).collect()}
    start, at = {}, dict.fromkeys(sums, 0)
    for part in sorted(totals):
        start[part] = dict(at)
        at = {a: at[a] + int(totals[part][a] or 0) for a in sums}

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None
        for batch in batches:
            if not batch.num_rows:
                continue
            now = now or dict(start[batch.column("_part")[0].as_py()])
            columns = list(batch.columns)
            for name, column in sums.items():
                values = batch.column(column).to_numpy(zero_copy_only=False).astype(np.int64)
                upto = np.cumsum(values)
                columns.append(pa.array(now[name] + upto - values))
                now[name] += int(upto[-1])
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *sums])

    return ordered.mapInArrow(add, fields(ordered.schema, **dict.fromkeys(sums, LongType())))


# A place between two texts that every pattern of a byte-level tokenizer splits:
# a blank after something that is not white space. What follows is split alike
# whatever stands before, and no run of white space is torn.
_SAFE = re.compile(r"(?<=\S)(?= )")
_BLANK_AFTER_SPACE = re.compile(r"\s ")


def blank_parts(text: str) -> list[str]:
    """Split a text at its safe blanks; all parts but the first have lost the one blank they begin with."""
    if _BLANK_AFTER_SPACE.search(text) is None:
        return text.split(" ")
    first, *rest = _SAFE.split(text)
    return [first, *(part[1:] for part in rest)]


def safe_slices(text: str, size: int) -> Iterator[str]:
    """Cut a text at the first safe blank after every ``size`` characters; one without such blanks stays whole."""
    start = 0
    while len(text) - start > size and (cut := _SAFE.search(text, start + size)):
        yield text[start:cut.start()]
        start = cut.start()
    yield text[start:]
