"""Whole-table positions and exact quantiles without a one-task sort.

``row_number() OVER (ORDER BY k)`` sends every row to one task. Here the key is
cut into three digits (21 + 21 + 22 bits). Rows are counted per digit prefix,
the counts are cumulated level by level, and only rows sharing the two upper
digits, at most 2**22 distinct keys, are ordered together. No window partition
can grow with the data, whichever key or group is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


_HIGH, _LOW = 43, 22


def _prefix_sum(weight: str, group: list[str], order: str) -> Column:
    frame = W.partitionBy(*group).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum(weight).over(frame), F.lit(0))


def _digits(df: DataFrame, key: str) -> DataFrame:
    return df.withColumns({"_d0": F.shiftright(key, _HIGH), "_d1": F.shiftright(key, _LOW)})


def _bucket_offsets(df: DataFrame, group: list[str], weight: str) -> DataFrame:
    """(group, _d0, _d1) -> _before: total weight of all smaller buckets."""
    fine = df.groupBy(*group, "_d0", "_d1").agg(F.sum(weight).alias("_w"))
    coarse = (
        fine.groupBy(*group, "_d0").agg(F.sum("_w").alias("_w0"))
        .withColumn("_b0", _prefix_sum("_w0", group, "_d0"))
        .drop("_w0")
    )
    return (
        fine.withColumn("_b1", _prefix_sum("_w", [*group, "_d0"], "_d1"))
        .join(coarse, [*group, "_d0"])
        .withColumn("_before", F.col("_b0") + F.col("_b1"))
        .drop("_b0", "_b1")
    )


def cumulate(df: DataFrame, group: list[str], key: str, weight: str, name: str) -> DataFrame:
    """Add ``name``: the weight of all smaller keys in the group.

    ``df`` holds one row per (group, key); ``key`` is a non-NULL long.
    """
    cut = _digits(df, key)
    offsets = _bucket_offsets(cut, group, weight).drop("_w")
    inner = _prefix_sum(weight, [*group, "_d0", "_d1"], key)
    return (
        cut.join(offsets, [*group, "_d0", "_d1"])
        .withColumn(name, F.col("_before") + inner)
        .drop("_d0", "_d1", "_before")
    )


def positions(df: DataFrame, group: list[str], keys: list[str], name: str) -> DataFrame:
    """Add the 1-based position of each row in its group, ordered by ``keys``.

    One or two long keys that together are unique within the group. The first
    of two may repeat without bound: rows meet only by all digits of both.
    """
    *parent, last = keys
    outer = [*group, *parent]
    cut = _digits(df, last)
    offsets = _bucket_offsets(cut.withColumn("_one", F.lit(1)), outer, "_one")
    if parent:
        totals = offsets.groupBy(*outer).agg(F.sum("_w").alias("_n"))
        totals = cumulate(totals, group, parent[0], "_n", "_start").drop("_n")
        offsets = offsets.join(totals, outer).withColumn("_before", F.col("_before") + F.col("_start"))
        offsets = offsets.drop("_start")
    inner = F.row_number().over(W.partitionBy(*outer, "_d0", "_d1").orderBy(last))
    return (
        cut.join(offsets.drop("_w"), [*outer, "_d0", "_d1"])
        .withColumn(name, F.col("_before") + inner)
        .drop("_d0", "_d1", "_before")
    )


def numbered(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Add the 1-based position of each row among all rows, ordered by ``keys``, which together are unique.

    Rows are dealt out in ranges and sorted there; a row per range says how many
    rows lie in it, and the sums of these where its numbers begin. Ranges are
    counted and numbered from one exchange, in one plan: the counts look at all
    columns, so that the optimizer finds both readings the same. Should a range
    hold other keys than were counted, the query fails rather than misnumber.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged, key = df.repartitionByRange(parts, *keys), F.struct(*keys)
    ranges = ranged.select(F.spark_partition_id().alias("_part"), key.alias("_key"), F.xxhash64(*df.columns).alias("_whole"))
    ranges = ranges.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_key").alias("_first"), F.max("_key").alias("_last"), F.max("_whole").alias("_whole"))
    # a row per partition
    ranges = F.broadcast(ranges.withColumn("_before", _prefix_sum("_n", [], "_part")))
    rows = ranged.sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    rows = rows.withColumn("_part", F.shiftright("_at", 33).cast("int")).join(ranges, "_part")
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    same = F.col("_whole").isNotNull() & (place <= F.col("_n")) & key.between(F.col("_first"), F.col("_last"))
    position = F.when(same, F.col("_before") + place).otherwise(F.raise_error(F.lit("rows were dealt out differently when counted")).cast("bigint"))
    return rows.select(*df.columns, position.alias(name))


def _spots(probabilities: dict[str, float]) -> Column:
    """Per probability the two ranks around it, 0-based, and how far it lies from the lower one."""
    found = []
    for name, p in probabilities.items():
        spot = (F.col("_total") - 1) * F.lit(float(p))
        for side, rank in (("low", F.floor(spot)), ("high", F.ceil(spot))):
            found.append(F.struct(F.lit(f"{name} {side}").alias("_spot"), rank.alias("_rank"), (spot - F.floor(spot)).alias("_share")))
    return F.explode(F.array(*found))


def order_statistics(counted: DataFrame, group: list[str], value: str, probabilities: dict[str, float]) -> DataFrame:
    """The values around each probability, by refining a histogram: ``group, _spot, _share, _value``.

    ``counted`` has one row per (group, value) with the number ``_n``. One
    aggregate counts the two upper digits of the values; its sums per first
    digit, then per second, tell in which bucket a rank falls. Only the values
    of those buckets are ordered, at most 2**22 for a rank.
    """
    fine = _digits(counted, value).groupBy(*group, "_d0", "_d1").agg(F.sum("_n").alias("_w"))
    coarse = fine.groupBy(*group, "_d0").agg(F.sum("_w").alias("_w"))
    coarse = coarse.withColumns({"_total": F.sum("_w").over(W.partitionBy(*group)), "_before": _prefix_sum("_w", group, "_d0")})
    wanted = ["_spot", "_rank", "_share"]

    def inside(rows: DataFrame, *keep: str) -> DataFrame:
        """Rows in whose bucket a rank falls, which is then counted from the bucket's start."""
        hit = (F.col("_before") <= F.col("_rank")) & (F.col("_rank") < F.col("_before") + F.col("_w"))
        return rows.filter(hit).select(*group, *keep, "_spot", (F.col("_rank") - F.col("_before")).alias("_rank"), "_share")

    def meet(rows: DataFrame, spots: DataFrame, *digits: str) -> DataFrame:
        same = [F.col(f"l.{c}") == F.col(f"r.{c}") for c in digits] + [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in group]
        return rows.alias("l").join(spots.alias("r"), same).select("l.*", *[f"r.{c}" for c in wanted])

    first = inside(coarse.select(*group, "_d0", "_w", "_before", _spots(probabilities).alias("_at")).select(*group, "_d0", "_w", "_before", "_at.*"), "_d0")
    second = inside(meet(fine.withColumn("_before", _prefix_sum("_w", [*group, "_d0"], "_d1")), first, "_d0"), "_d0", "_d1")
    # Without a group these are two rows per probability.
    values = meet(_digits(counted, value), second if group else F.broadcast(second), "_d0", "_d1").withColumnRenamed("_n", "_w")
    values = values.withColumn("_before", _prefix_sum("_w", [*group, "_spot"], value))
    return inside(values, value).withColumnRenamed(value, "_value")


def quantiles(
    df: DataFrame, group: list[str], value: str, probabilities: dict[str, float], weight: str | None = None
) -> DataFrame:
    """Exact quantiles of a long column, linear between neighbours.

    ``probabilities`` maps output column to probability. Values are counted
    before anything is ordered, so a group is never gathered whole. A ``weight``
    column says how many times a row counts. Rows without a value are left out;
    a NULL in a group column is a group.
    """
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    # Not nullable for the optimizer either: a join on digits of a nullable value
    # would filter one reading of the counts and not the other, and the table
    # would be scanned for each (tests/test_plans.py).
    known = F.coalesce(F.col(value), F.lit(0).cast("bigint")).alias(value)
    counted = df.filter(F.col(value).isNotNull()).groupBy(*group, known).agg(n.alias("_n"))
    found = order_statistics(counted, group, value, probabilities)

    def at(spot: str, column: str) -> Column:
        return F.max(F.when(F.col("_spot") == spot, F.col(column)))

    return found.groupBy(*group).agg(*[
        (at(f"{name} low", "_value") + (at(f"{name} high", "_value") - at(f"{name} low", "_value")) * at(f"{name} low", "_share")).alias(name)
        for name in probabilities
    ])
