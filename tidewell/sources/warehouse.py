"""A lazy catalogue of tables and governed views.

``warehouse["orders"]`` builds the DataFrame on first use and keeps the plan,
not the rows. Views are found under their ``v_*_clean`` names.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Hashable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidewell.sources.schemas import DDL, schema


@dataclass(frozen=True)
class Rules:
    """Parameters of the governance rules and reports."""

    cutoff: dt.date = dt.date(2025, 12, 31)
    price_cap: float = 10000.0
    usage_as_of: dt.date = dt.date(2025, 12, 31)
    focus_module: str = "ai_insights"


class Warehouse(Mapping):
    def __init__(self, spark: SparkSession, builders: dict[str, Callable[[Warehouse], DataFrame]], rules: Rules):
        self.spark = spark
        self.rules = rules
        self._builders = dict(builders)
        self._built: dict[Hashable, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        return self.once(name, lambda: self._builder(name)(self))

    def once(self, key: Hashable, build: Callable[[], DataFrame]) -> DataFrame:
        """Keep the plan built under ``key``: analysing it anew costs driver time."""
        if key not in self._built:
            self._built[key] = build()
        return self._built[key]

    def _builder(self, name: str) -> Callable[[Warehouse], DataFrame]:
        if name in self._builders:
            return self._builders[name]
        from tidewell.plans.views import VIEWS

        return VIEWS[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def replacing(self, **builders: Callable[[Warehouse], DataFrame]) -> Warehouse:
        """Same warehouse with some tables rebuilt; the originals are untouched."""
        return Warehouse(self.spark, {**self._builders, **builders}, self.rules)


def load(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Read one table with its declared schema, so nothing is inferred."""
    return spark.read.schema(schema(name)).parquet(f"{directory}/{name}.parquet")


def from_directory(spark: SparkSession, directory: str, rules: Rules = Rules()) -> Warehouse:
    """Warehouse over ``{directory}/{table}.parquet`` files of the business schema."""
    return Warehouse(spark, {name: (lambda w, n=name: load(spark, directory, n)) for name in DDL}, rules)
