"""What the plans must look like at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tidewell.catalogue import QUERIES
from tidewell.functions.session import _SQL_SETTINGS
from tidewell.plans.reports import ecommerce, executive, product
from tidewell.sources.star import star

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_reach_the_scan(spark):
    text = plan(executive.region_share(star(spark, SF)))
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in text
    assert "lineitem" not in text  # the unused ship date costs nothing


def test_unused_enrichment_is_dropped(spark):
    text = plan(star(spark, SF)["orders"].select("order_id", "total_amount"))
    assert "Join" not in text and "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in text


def test_returns_by_category_makes_no_pairs(spark):
    text = plan(ecommerce.returns_by_category(star(spark, SF)))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["pareto_users", "flg_all"])
def test_no_whole_table_window(spark, name):
    """Windows without a partition see counts per digit or range only; rows are numbered in buckets of their keys or by ranges."""
    text = plan(QUERIES[name](spark, SF))
    windows = re.findall(r"windowspecdefinition\(([^()]*)", text)
    whole = [w for w in windows if re.match(r"\S+ ASC|\S+ DESC", w.split(", ")[0])]
    assert windows and all(re.match(r"_d0#|_part#", w) for w in whole)
    numbered = re.findall(r"row_number\(\) windowspecdefinition\(([^()]*)", text)
    assert all("_d0#" in w and "_d1#" in w for w in numbered) and (numbered or "rangepartitioning" in text)


def lineitem_scans(df) -> int:
    """How often the plan that ran reads the lines; an exchange read again doesn't count."""
    df.collect()
    first, *parts = re.split(r"== (Final|Initial) Plan ==", df._jdf.queryExecution().executedPlan().toString())
    final = first + "".join(body for kind, body in zip(parts[::2], parts[1::2]) if kind == "Final")
    return len(re.findall(r"FileScan parquet \[l_", final))


def test_quantile_reads_its_table_once(spark):
    """One reading of the lines for the quantile, one for the rows it caps."""
    assert lineitem_scans(QUERIES["nrm_cap_percentile"](spark, SF)) == 2
    assert lineitem_scans(QUERIES["flg_outlier"](spark, SF)) == 2


@pytest.mark.parametrize("name", ["cv_customers", "deg_report", "flg_all"])
def test_edits_stay_in_generated_code(spark, name):
    assert "transform(" not in QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()


def test_exact_moments_use_no_decimals_per_row(spark):
    sums = re.findall(r"partial_sum\(([^,\]]*)", plan(QUERIES["flg_outlier"](spark, SF)))
    assert sums and not any("decimal" in x for x in sums)


def test_registered_queries_apply_the_settings(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    try:
        spark.conf.set(key, "65535")
        contract.queries()["region_share"](spark, SF)
        assert all(spark.conf.get(k) == v for k, v in _SQL_SETTINGS.items())
    finally:
        spark.conf.set(key, _SQL_SETTINGS[key])


def test_hot_key_join_is_split(spark):
    """One key with a third of all rows: AQE splits it, results stay whole."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    saved = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        ids = spark.range(0, 120000, 1, 8)
        fact = ids.select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
        parent = spark.range(0, 120000, 1, 8).withColumnRenamed("id", "k")
        from tidewell.operators.exclude import exclude_orphans

        joined = exclude_orphans(fact, parent, "k").groupBy("k").agg(F.count("id").alias("n"))
        assert joined.agg(F.sum("n")).first()[0] == 120000
        rows = joined.collect()
        assert max(r.n for r in rows) >= 40000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in saved.items():
            spark.conf.set(key, value)


def test_shuffle_partitions_are_not_merged_beyond_a_tasks_memory(spark):
    """50 MB of shuffled numbers: merged to 64 MB, one task would sort and group them all."""
    settings = {"spark.sql.adaptive.coalescePartitions.minPartitionNum": "1", "spark.sql.shuffle.partitions": "64"}
    saved = {k: spark.conf.get(k, None) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        rows = spark.range(0, 1500000, 1, 8).select("id", *[F.xxhash64("id", F.lit(k)).alias(f"x{k}") for k in range(3)])
        grouped = rows.repartition("id").groupBy("id").agg(*[F.max(f"x{k}").alias(f"m{k}") for k in range(3)])
        tasks = grouped.where("m0 > m1 or m1 >= m2").select(F.spark_partition_id().alias("p")).distinct().count()
        assert 2 <= tasks < 64
    finally:
        for key, value in saved.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_nothing_is_broadcast_by_force(spark):
    """The levels of the power-user curve grow with the events."""
    text = product.pareto_users(star(spark, SF))._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" not in text


def test_lazy_queries_start_no_job(spark):
    """Quantiles and shares are plans until they are read."""
    w = star(spark, SF)
    spark.sparkContext.setJobGroup("building", "building")
    try:
        for build in (product.top_share, product.user_event_stats, product.pareto_users, product.pareto_sample, ecommerce.discount_by_segment):
            build(w)
        for name in ("flg_all", "flg_summary", "cv_reconcile", "nrm_cap_percentile"):
            QUERIES[name](spark, SF)
        assert spark.sparkContext.statusTracker().getJobIdsForGroup("building") == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
