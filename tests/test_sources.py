"""Readers, types, writer."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewell.functions.session import settle
from tidewell.sources.catalog import ResultCache, build_schema, cached, catalog_counts, coerce_dates
from tidewell.sources.schemas import DDL, SCHEMAS
from tidewell.sources.sink import materialize, refresh, refresh_view
from tidewell.sources.warehouse import from_directory


def test_schemas_parse(spark):
    assert len(DDL) == 21
    assert all(len(SCHEMAS[name]) > 1 for name in DDL)


def test_coerce_dates(spark):
    df = spark.createDataFrame([("2025-01-02", "x"), ("2025-13-45", "y"), (None, "z")], "d string, v string")
    assert [r.d for r in coerce_dates(df, ["d", "absent"]).collect()] == [dt.date(2025, 1, 2), None, None]


def test_build_schema(spark):
    df = spark.sql("SELECT 1 AS i, 1.5f AS f, true AS b, 'x' AS s, '2024-01-01' AS d")
    types = dict(build_schema(df, ["d"]).dtypes)
    assert types == {"i": "bigint", "f": "double", "b": "boolean", "s": "string", "d": "date"}


def test_materialize_and_read_back(spark, business, tmp_path):
    tables = {n: business[n] for n in ("customers", "orders", "order_items")} | {"_lineage": business["returns"].limit(0)}
    report = {r.table_name: (r.n_rows, r.outcome) for r in materialize(tables, str(tmp_path)).collect()}
    assert report == {
        "customers": (11, "written"), "orders": (5, "written"), "order_items": (9, "written"), "lineage": (0, "empty"),
    }
    for name in ("customers", "orders", "order_items"):
        business[name].write.parquet(str(tmp_path / "in" / f"{name}.parquet"))
    again = from_directory(spark, str(tmp_path / "in"), business.rules)
    assert again["v_orders_clean"].count() == business["v_orders_clean"].count()


def test_partitioned_write_prunes(spark, business, tmp_path):
    materialize({"orders": business["orders"]}, str(tmp_path), partition_by={"orders": ["status"]})
    plan = spark.read.parquet(str(tmp_path / "orders")).filter("status = 'cancelled'")
    assert "PartitionFilters: [isnotnull(status" in plan._jdf.queryExecution().executedPlan().toString()


def test_views(spark, business):
    from tidewell.plans.views import VIEWS, register_views

    before = catalog_counts(spark)["views"]
    register_views(business)
    assert catalog_counts(spark)["views"] == before + len(VIEWS)
    assert spark.sql("SELECT count(*) FROM v_orders_clean").first()[0] == 2
    refresh_view("v_orders_clean", business["orders"])
    assert spark.table("v_orders_clean").count() == 5
    for name in VIEWS:
        spark.catalog.dropTempView(name)


def test_settle_cuts_lineage(business):
    kept = settle(business["orders"])
    assert kept.count() == 5
    assert "Join" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_cache_hits_expires_and_releases(spark):
    now = [0.0]
    cache = ResultCache(seconds=600, most=2, clock=lambda: now[0])

    def frame(n):
        return spark.range(n).filter("id > 3").select((F.col("id") * 2).alias("x"))

    first = cache.get(frame(10))
    now[0] = 599.0
    assert cache.get(frame(10)) is first and len(cache) == 1 and first.is_cached
    assert "InMemoryRelation" in frame(10)._jdf.queryExecution().withCachedData().toString()
    assert cache.get(frame(11)) is not first and len(cache) == 2
    now[0] = 600.0
    again = cache.get(frame(10))
    assert again is not first and not first.is_cached and again.is_cached and len(cache) == 2
    other = cache.get(frame(12))  # a third one: the oldest goes
    assert len(cache) == 2 and other.is_cached and not cache.release(frame(11))
    assert cache.release(frame(12)) and not other.is_cached and len(cache) == 1
    cache.clear()
    assert len(cache) == 0 and not again.is_cached
    assert cached(frame(13), cache) is cached(frame(13), cache)
    cache.clear()


def test_counts_of_written_tables_need_no_read(spark, business, tmp_path):
    materialize({"orders": business["orders"]}, str(tmp_path))
    spark.sparkContext.setJobGroup("writing", "writing")
    try:
        report = materialize({"orders": spark.range(7)}, str(tmp_path))
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("writing")) == 1
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert [tuple(r) for r in report.collect()] == [("orders", 7, "written")]


def test_empty_table_replaces_an_earlier_one(spark, tmp_path):
    materialize({"t": spark.range(3)}, str(tmp_path))
    report = materialize({"t": spark.range(3).filter("id > 9")}, str(tmp_path)).collect()
    assert [(r.n_rows, r.outcome) for r in report] == [(0, "empty")]
    assert spark.read.parquet(str(tmp_path / "t")).count() == 0


def test_refresh_swaps_whole_tables(spark):
    table = refresh("lookup_regions", spark.range(3))
    assert table.count() == 3
    reader = spark.table("lookup_regions")
    assert refresh("lookup_regions", spark.table("lookup_regions").select((F.col("id") + 10).alias("id"), F.lit("x").alias("more"))).columns == ["id", "more"]
    assert reader.count() == 3  # still reads the version it began with
    broken = spark.range(1000, numPartitions=4).select(F.when(F.col("id") == 900, F.raise_error(F.lit("boom")).cast("bigint")).otherwise(F.col("id")).alias("id"))
    stored = {t.name for t in spark.catalog.listTables()}
    with pytest.raises(Exception, match="boom"):
        refresh("lookup_regions", broken)
    assert sorted(r.id for r in spark.table("lookup_regions").collect()) == [10, 11, 12]
    assert {t.name for t in spark.catalog.listTables()} == stored
    for n in (4, 5):
        refresh("lookup_regions", spark.range(n))
    assert spark.table("lookup_regions").count() == 5
    versions = [t.name for t in spark.catalog.listTables() if t.name.startswith("lookup_regions__v")]
    assert len(versions) == 2
    spark.sql("DROP VIEW lookup_regions")
    for name in versions:
        spark.sql(f"DROP TABLE {name}")
