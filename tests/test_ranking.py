"""Distributed positions and quantiles against brute force, hot groups included."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewell.functions.ranking import cumulate, numbered, positions, quantiles


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(5)
    keys = rng.sample(range(-(2**61), 2**61), 400) + list(range(600))
    # a third of the rows share the first key
    return [("a" if i % 3 else "b", 7 if i % 3 == 0 else rng.randint(-50, 50), k) for i, k in enumerate(keys)]


def test_positions_by_two_keys(spark, skewed):
    df = spark.createDataFrame(skewed, "g string, first bigint, second bigint")
    got = {(r.g, r.first, r.second): r.nr for r in positions(df, ["g"], ["first", "second"], "nr").collect()}
    for group in ("a", "b"):
        ordered = sorted((f, s) for g, f, s in skewed if g == group)
        assert {(group, f, s): i for i, (f, s) in enumerate(ordered, 1)} == {k: v for k, v in got.items() if k[0] == group}


def test_positions_without_group(spark, skewed):
    df = spark.createDataFrame(skewed, "g string, first bigint, second bigint")
    got = {r.second: r.nr for r in positions(df, [], ["second"], "nr").collect()}
    assert got == {k: i for i, k in enumerate(sorted(s for _, _, s in skewed), 1)}


def test_cumulate(spark):
    df = spark.createDataFrame([(k, k % 4 + 1) for k in range(0, 2**45, 2**41)], "k bigint, n bigint")
    rows = sorted(cumulate(df, [], "k", "n", "before").collect())
    total = 0
    for row in rows:
        assert row.before == total
        total += row.n


def test_quantiles_match_numpy(spark):
    rng = random.Random(9)
    rows = [(g, rng.randint(0, 10**9) if rng.random() < 0.6 else 12) for g in "xyz" for _ in range(301)] + [("x", None)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    got = quantiles(df, ["g"], "v", {"q0": 0.0, "q1": 0.25, "q2": 0.5, "q99": 0.99, "q100": 1.0}).collect()
    for row in got:
        values = [v for g, v in rows if g == row.g and v is not None]
        for name, p in (("q0", 0), ("q1", 0.25), ("q2", 0.5), ("q99", 0.99), ("q100", 1)):
            assert row[name] == pytest.approx(np.quantile(values, p))


def test_weighted_quantile(spark):
    df = spark.createDataFrame([(1, 3), (5, 1)], "v bigint, n bigint")
    assert quantiles(df, [], "v", {"m": 0.5}, "n").first().m == 1.0


def test_quantiles_keep_null_groups_and_tell_empty(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 7), ("b", None)], "g string, v bigint")
    got = {r.g: (r.m, r.top) for r in quantiles(df, ["g"], "v", {"m": 0.5, "top": 1.0}).collect()}
    assert got == {None: (2.0, 3.0), "a": (7.0, 7.0)}
    assert quantiles(df.limit(0), [], "v", {"m": 0.5}).collect()[0].m is None


def test_numbered(spark, skewed):
    df = spark.createDataFrame(skewed, "g string, first bigint, second bigint").repartition(5)
    got = {(r.g, r.first, r.second): r.nr for r in numbered(df, ["g", "first", "second"], "nr").collect()}
    assert got == {k: i for i, k in enumerate(sorted((g, f, s) for g, f, s in skewed), 1)}
    assert numbered(df.limit(0), ["g", "first", "second"], "nr").collect() == []
    plan = numbered(df.withColumn("text", F.lit("x")), ["g", "first", "second"], "nr")
    plan.collect()
    assert "ReusedExchange" in plan._jdf.queryExecution().executedPlan().toString() or "rangepartitioning" in plan._jdf.queryExecution().executedPlan().toString()
