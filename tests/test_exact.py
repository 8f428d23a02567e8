"""Exact sums against fractions."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from seasonstar.functions import exact


def total(spark, values, parts=3):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
    return df.agg(exact.exact_total("v").alias("t")).first()["t"]


def test_groups_of_any_values(spark):
    rng = random.Random(4)
    groups = {
        "wide": [math.ldexp(rng.uniform(-1, 1), rng.randint(-130, 118)) for _ in range(400)],
        "cancel": [s * v for v in (1e30, 3.3, 1e-20, 7e15) for s in (1, -1)] + [5e-324 * 0, 1e-30],
        "thirds": [1 / 3] * 3001, "tenths": [0.1] * 1000, "negative": [-rng.random() * 10 ** rng.randint(-9, 9) for _ in range(500)],
        "ties": [2.0**53, 1.0, 2.0**-60], "ties_down": [2.0**53, 1.0], "ties_up": [2.0**53 + 2, 1.0], "halves": [2.0**53, 1.0, -(2.0**-60)],
        "zero": [0.0, -0.0], "one": [-1.5], "large": [2.0**119] * 3, "small": [2.0**-192, -(2.0**-191)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("none", None), ("thirds", None)]
    rng.shuffle(rows)
    for parts in (1, 7):
        df = spark.createDataFrame(rows, "g string, v double").repartition(parts)
        got = {r["g"]: r for r in df.groupBy("g").agg(exact.exact_total("v").alias("t"), exact.exact_average("v").alias("m")).collect()}
        assert got.pop("none")["t"] is None
        for g, r in got.items():
            want = sum(map(Fraction, groups[g]), Fraction(0))
            assert r["t"] == float(want), g
            assert r["m"] == float(want) / len(groups[g])


def test_rounding_once(spark):
    def rounded(values, digits):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return df.agg(exact.rounded_total("v", digits).alias("t")).first()["t"]

    assert rounded([12.4999996], 0) == 12.0 and rounded([12.0, 0.4999996], 0) == 12.0
    assert rounded([0.004] * 3125, 0) == 13.0 and rounded([-0.004] * 3125, 0) == -13.0
    assert rounded([0.004] * 125, 1) == 0.5 and rounded([1 / 3] * 3, 0) == 1.0


def test_what_lanes_do_not_hold(spark):
    inf = float("inf")
    assert total(spark, [1.0, inf]) == inf and total(spark, [-inf, 2.0]) == -inf
    assert math.isnan(total(spark, [inf, -inf])) and math.isnan(total(spark, [float("nan"), 1.0]))
    for value in (2.0**120, 5e-324, 1e-60):
        with pytest.raises(Exception, match="does not hold"):
            total(spark, [1.0, value])


def test_weighted_average(spark):
    rows = [(0.1, 3.0), (0.7, 1.0), (None, 5.0), (4.0, None)]
    df = spark.createDataFrame(rows, "x double, w double")
    assert df.agg(exact.weighted_average("x", "w").alias("a")).first()["a"] == float(Fraction(0.1 * 3.0) + Fraction(0.7)) / 4.0
    zero = df.select("x", F.lit(0.0).alias("w"))
    assert zero.agg(exact.weighted_average("x", "w").alias("a")).first()["a"] is None


def test_partial_sums_are_long_lanes(spark):
    df = spark.range(1000).select((F.col("id") / 7).alias("v"), (F.col("id") % 3).alias("g"))
    plan = df.groupBy("g").agg(exact.exact_total("v").alias("t"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
