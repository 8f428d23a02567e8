"""Ranks and running sums in parts of a key, against windows over the whole key and plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from seasonstar.operators.ranks import rank_in_parts, running_sum_in_parts, top_in_parts


@pytest.fixture(scope="module")
def rows(spark):
    """One key holds most rows; many ties, NULL values and a NULL key."""
    rng = random.Random(7)
    data = [(i, rng.choice(["hot"] * 8 + ["b", "c", None]), rng.choice([None, *range(300)])) for i in range(6000)]
    return spark.createDataFrame(data, "id long, k string, v long").repartition(5)


@pytest.fixture
def many_parts(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("dense", [True, False])
def test_rank_equals_the_window(rows, many_parts, descending, dense):
    order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_last()
    w = Window.partitionBy("k").orderBy(order)
    want = rows.withColumn("place", (F.dense_rank() if dense else F.rank()).over(w).cast("long"))
    assert rows_of(rank_in_parts(rows, ["k"], "v", "place", descending, dense)) == rows_of(want)


def test_rank_over_all_rows_and_top(rows, many_parts):
    w = Window.orderBy(F.col("v").desc_nulls_last())
    want = rows.withColumn("rank", F.rank().over(w).cast("long"))
    assert rows_of(rank_in_parts(rows, [], "v", "rank")) == rows_of(want)
    assert rows_of(top_in_parts(rows, [], "v", 40)) == rows_of(want.where("rank <= 40"))
    assert rank_in_parts(rows.limit(0), ["k"], "v", "rank").collect() == []
    with pytest.raises(ValueError):
        rank_in_parts(rows, ["k"], "v", "id")


def test_no_window_over_a_whole_key(spark, many_parts):
    """A million distinct values of one key: every window over rows is cut by parts."""
    df = spark.range(1_000_000).select(F.lit(1).alias("k"), F.hash("id").cast("long").alias("v"))
    ranked = rank_in_parts(df, ["k"], "v", "rank")
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.split("\n") if "Window [" in line]
    assert len(windows) == 2 and sum("_part" in line.split("windowspecdefinition(")[1].split("rank")[0] for line in windows) == 2
    top = ranked.where("rank <= 3").orderBy("rank").collect()
    assert [r["v"] for r in top] == [r["v"] for r in df.orderBy(F.col("v").desc()).limit(3).collect()]
    assert ranked.agg(F.max("rank")).first()[0] <= 1_000_000 and ranked.count() == 1_000_000


def test_running_sum(rows, many_parts):
    got = running_sum_in_parts(rows, ["k"], ["v"], "v", "so_far").collect()
    sums: dict = {}
    for r in sorted(got, key=lambda r: (r["v"] is not None, r["v"] or 0, r["id"])):
        sums[r["k"]] = sums.get(r["k"], 0) + (r["v"] or 0)
        assert r["so_far"] == sums[r["k"]]
    assert len(got) == 6000
