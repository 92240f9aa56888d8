"""Planted defects are found again by the rules that look for them."""

import pytest
from pyspark.sql import functions as F

from tidewell.functions.keyhash import chosen, number_key
from tidewell.operators import degrade, flags
from tidewell.sources.star import star

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pair(spark):
    w = star(spark, SF)
    return w, degrade.degraded(w, {1998: 9, 1999: 18, 2000: 27})


def test_planted_orphans_are_flagged_exactly(pair):
    w, d = pair
    planted = w["orders"].filter(chosen("order_id", "orphan", degrade.ORPHAN_RATE)).select("order_id")
    found = flags.flags(d, "orphan_orders").select(F.col("record_id").alias("order_id"))
    assert planted.count() > 0
    assert planted.exceptAll(found).isEmpty() and found.exceptAll(planted).isEmpty()


def test_duplicates_are_tracked_and_excluded(pair):
    w, d = pair
    assert d["customers"].count() - w["customers"].count() == d["duplicate_tracking"].count()
    assert d["customers"].select("customer_id").distinct().count() == d["customers"].count()
    assert d["v_customers_clean"].count() == w["customers"].count()


def test_typo_dates_lie_beyond_the_cutoff(pair):
    w, d = pair
    moved = w["orders"].join(d["orders"].select("order_id", F.col("order_date").alias("new")), "order_id").filter(
        F.col("new") != F.col("order_date")
    )
    assert moved.filter(F.col("new") <= F.lit(w.rules.cutoff)).count() == 0


def test_combined_price_edit_equals_the_three_rules(pair):
    w, d = pair
    step = w["order_items"]
    for edit in (degrade.zeroed, degrade.negated, degrade.outlying):
        step = step.withColumn("unit_price", edit("line_id", "unit_price"))
    assert step.exceptAll(d["order_items"]).isEmpty()


def test_rates(spark):
    keys = spark.range(200000)
    share = keys.filter(chosen("id", "x", 0.05)).count() / 200000
    assert abs(share - 0.05) < 0.003


def test_line_keys_are_unique(spark):
    lines = star(spark, "/root/testdata/sf0.1")["order_items"].select("line_id")
    assert lines.distinct().count() == lines.count()
    assert spark.range(5).select(number_key("id", "id")).distinct().count() == 5


def test_report_adds_up(pair):
    rows = degrade.report(pair[0], {1998: 9, 1999: 18, 2000: 27}).collect()
    rules = sum(r.records for r in rows if r.rule != "TOTAL")
    assert rules == next(r.records for r in rows if r.category == "TOTAL")
