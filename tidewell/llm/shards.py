"""Contiguous shards of nearly equal bytes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidewell.llm.common import in_order, running


def by_bytes(items: DataFrame, size: str, order: list[str], shards: int, group: list[str] = (), keep_together: float = 0.02) -> DataFrame:
    """Add ``shard`` and ``slot`` to all rows, cutting their order into shards of equal bytes.

    Rows are range-partitioned and sorted by ``order``. Partition totals give
    each row the bytes before it; the row goes to the shard in whose share of
    all bytes its first byte falls, so shards are contiguous and differ by at
    most the rows on their edges. ``slot`` counts the rows of a shard from 0.

    ``group`` is a prefix of ``order``. A group that a cut would tear stays
    whole, on the side that holds more of it, if it has at most
    ``keep_together`` of a shard's bytes; larger ones are cut, as balance comes
    first. At most ``shards - 1`` groups are looked at.

    Nulls sort first; equal rows are neighbours in any order. ``size`` must be
    a long and not null; ``group`` names the first columns of ``order``. Columns
    ``shard`` and ``slot`` that the rows had are replaced, all others kept. An
    empty table gives an empty result.
    """
    # the row travels as one value, so no column of it can clash
    keys, group = [f"_key{i}" for i in range(len(order))], [f"_key{i}" for i in range(len(group))]
    rows = items.select(F.struct("*").alias("_item"), F.col(size).alias("_size"), *[F.col(c).alias(k) for c, k in zip(order, keys)], F.lit(1).cast("long").alias("_one"))
    ordered = in_order(rows, *[F.col(k) for k in keys])
    placed = running(ordered, _before="_size", _at="_one")
    total = ordered.agg(F.sum("_size")).first()[0] or 0
    shard: Column = F.least(F.lit(shards - 1), F.floor(F.col("_before") * F.lit(shards) / F.lit(max(total, 1)))).cast("int")
    placed = placed.withColumn("shard", shard)
    if group:
        for key, to in _torn(placed, "_size", group, keep_together * total / shards):
            same = F.lit(True)
            for column, value in zip(group, key):
                same = same & F.col(column).eqNullSafe(F.lit(value))
            shard = F.when(same, F.lit(to)).otherwise(shard)
        placed = placed.withColumn("shard", shard.cast("int"))
    first = {r["shard"]: r["first"] for r in placed.groupBy("shard").agg(F.min("_at").alias("first")).collect()}
    base = F.element_at(F.array(*[F.lit(first.get(k, 0)).cast("long") for k in range(shards)]), F.col("shard") + 1)
    kept = [F.col(f"_item.`{c}`") for c in items.columns if c not in ("shard", "slot")]
    return placed.select(*kept, "shard", (F.col("_at") - base).alias("slot"))


def _torn(placed: DataFrame, size: str, group: list[str], most: float) -> list[tuple[tuple, int]]:
    """The groups on both sides of a cut, at most one per cut, with the shard that takes them whole."""
    key = F.struct(*group)
    ends = placed.groupBy("shard").agg(F.min_by(key, "_at").alias("first"), F.max_by(key, "_at").alias("last")).orderBy("shard").collect()
    keys = {tuple(a["last"]) for a, b in zip(ends, ends[1:]) if a["last"] == b["first"]}
    if not keys:
        return []
    wanted = F.lit(False)
    for values in keys:
        same = F.lit(True)
        for column, value in zip(group, values):
            same = same & F.col(column).eqNullSafe(F.lit(value))
        wanted = wanted | same
    parts = placed.where(wanted).groupBy(*group, "shard").agg(F.sum(size).alias("bytes")).collect()
    found = []
    for values in sorted(keys, key=str):
        own = [r for r in parts if tuple(r[c] for c in group) == values]
        if sum(r["bytes"] for r in own) <= most:
            found.append((values, max(own, key=lambda r: (r["bytes"], -r["shard"]))["shard"]))
    return found
