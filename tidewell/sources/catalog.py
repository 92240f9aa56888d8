"""Catalogue counts, cached results and typed columns."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def catalog_counts(spark: SparkSession) -> dict[str, int]:
    """Number of stored tables and of temporary views."""
    found = spark.catalog.listTables()
    views = [t for t in found if t.isTemporary or t.tableType == "VIEW"]
    return {"tables": len(found) - len(views), "views": len(views)}


class ResultCache:
    """Results kept by plan for a time.

    Two frames whose plans mean the same share one kept result. A result is
    released ``seconds`` after it was first asked for, at the next call that
    notices, or when more than ``most`` are kept, the oldest first. Rows spill
    to disk and are recomputed where an executor is lost.
    """

    def __init__(self, seconds: float = 600.0, most: int = 64, clock: Callable[[], float] = time.monotonic) -> None:
        self.seconds, self.most, self._clock = seconds, most, clock
        self._kept: dict[int, list[tuple[float, DataFrame]]] = {}

    def __len__(self) -> int:
        return sum(map(len, self._kept.values()))

    def _find(self, df: DataFrame) -> DataFrame | None:
        """The kept frame of the same session whose plan means the same; equal hashes alone don't do."""
        same = (kept for _, kept in self._kept.get(df.semanticHash(), []) if kept.sparkSession is df.sparkSession and kept.sameSemantics(df))
        return next(same, None)

    def get(self, df: DataFrame) -> DataFrame:
        """The kept result of this plan; kept from now on if there was none."""
        self.expire()
        kept = self._find(df)
        if kept is None:
            kept = df.persist(StorageLevel.MEMORY_AND_DISK)
            self._kept.setdefault(df.semanticHash(), []).append((self._clock(), kept))
            self._release_while(lambda: len(self) > self.most)
        return kept

    def expire(self) -> None:
        """Release what has been kept for its time."""
        now = self._clock()
        self._release_while(lambda: len(self) > 0 and now - self._oldest()[0] >= self.seconds)

    def release(self, df: DataFrame) -> bool:
        """Release this plan's result now; False if there is none."""
        kept = self._find(df)
        if kept is not None:
            self._drop(df.semanticHash(), kept)
        return kept is not None

    def clear(self) -> None:
        self._release_while(lambda: len(self) > 0)

    def _oldest(self) -> tuple[float, int, DataFrame]:
        return min(((since, key, kept) for key, entries in self._kept.items() for since, kept in entries), key=lambda entry: entry[0])

    def _release_while(self, needed: Callable[[], bool]) -> None:
        while needed():
            _, key, kept = self._oldest()
            self._drop(key, kept)

    def _drop(self, key: int, kept: DataFrame) -> None:
        self._kept[key] = [(since, other) for since, other in self._kept[key] if other is not kept]
        if not self._kept[key]:
            del self._kept[key]
        kept.unpersist()


RESULTS = ResultCache()


def cached(df: DataFrame, cache: ResultCache = RESULTS) -> DataFrame:
    """The result of a plan, computed once while it is kept (ten minutes unless the cache says otherwise)."""
    return cache.get(df)


def coerce_dates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Text to DATE; text that is no date becomes NULL; absent columns are skipped."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast("date") for c in present})


def build_schema(df: DataFrame, date_columns: list[str]) -> DataFrame:
    """Cast to the warehouse types DATE, BIGINT, DOUBLE, BOOLEAN and STRING."""

    def target(field: T.StructField) -> T.DataType:
        if field.name in date_columns:
            return T.DateType()
        if isinstance(field.dataType, T.IntegralType):
            return T.LongType()
        if isinstance(field.dataType, (T.FractionalType, T.DecimalType)):
            return T.DoubleType()
        if isinstance(field.dataType, T.BooleanType):
            return T.BooleanType()
        return T.StringType()

    return df.select(*[F.col(f.name).cast(target(f)).alias(f.name) for f in df.schema.fields])


def column_types(df: DataFrame, table: str) -> DataFrame:
    """What a typed table holds: ``table_name, column_name, type, n_values, n_nulls``, in one pass over it."""
    names = df.columns
    row = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(c) for c in names])
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    entries = [
        F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"), F.lit(kinds[c]).alias("type"),
                 F.col(c).alias("n_values"), (F.col("_rows") - F.col(c)).alias("n_nulls"))
        for c in names
    ]
    return row.select(F.inline(F.array(*entries)))
