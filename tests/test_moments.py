"""Exact sums of squares, whatever the size or the order."""

import random

import pytest
from pyspark.sql import functions as F

from tidewell.functions.moments import mean_and_deviation, moments, threshold


def test_sums_are_exact_beyond_a_long(spark):
    rng = random.Random(3)
    values = [rng.randint(-(2**52) + 1, 2**52 - 1) for _ in range(300)] + [0, -1, 1, 2**24, -(2**24), 2**48, None]
    row = moments(spark.createDataFrame([(v,) for v in values], "v bigint").repartition(7), {"x": F.col("v"), "y": F.col("v") % 1000}).first()
    known = [v for v in values if v is not None]
    assert (row.x_n, row.x_sum, int(row.x_squares)) == (len(known), sum(known), sum(v * v for v in known))
    assert int(row.y_squares) == sum((abs(v) % 1000) ** 2 for v in known)


def test_deviation_and_threshold(spark):
    df = spark.createDataFrame([(v,) for v in (2, 4, 4, 4, 5, 5, 7, 9)], "v bigint")
    mean, deviation = mean_and_deviation("x")
    assert tuple(moments(df, {"x": F.col("v")}).select(mean, deviation).first()) == (5.0, 2.0)
    assert df.filter(F.col("v") >= threshold(df, F.col("v"), 2.0)).count() == 1


def test_nothing(spark):
    row = moments(spark.range(0), {"x": F.col("id")})
    mean, deviation = mean_and_deviation("x")
    assert tuple(row.select("x_n", mean, deviation).first()) == (0, None, pytest.approx(0.0)) or row.select(mean).first()[0] is None
