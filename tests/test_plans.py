"""Physical plans and independence of partitioning."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from seasonstar.catalogue import ORACLES, QUERIES, base
from seasonstar.operators import dims, extremes, series, staging
from seasonstar.plans import reports

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df)


def test_every_query_has_its_sql_counterpart():
    assert set(QUERIES) == set(ORACLES)


def test_dedup_limits_each_key_before_the_shuffle(spark):
    text = plan(QUERIES["dedup_latest"](spark, SF))
    assert text.count("WindowGroupLimit") == 2
    below = text[text.index("Exchange hashpartitioning"):]
    assert "WindowGroupLimit" in below and "Partial" in below


def test_top_k_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    text = plan(extremes.top_k_per_group(df, ["k"], [F.col("v").desc()], 5))
    assert text.count("WindowGroupLimit") == 2


def test_scan_reads_only_needed_columns_and_pushes_filters(spark):
    text = plan(QUERIES["filter_in"](spark, SF))
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in text
    assert re.search(r"PushedFilters: \[.*In\(event_type", text)
    daily = plan(base.daily_orders(spark, SF))
    assert "struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in daily
    assert "struct<c_custkey:bigint,c_nationkey:int>" in daily


@pytest.mark.parametrize("name", ["yoy_iso_week", "weekly_amounts", "monthly_yoy", "dedup_latest", "composite_key_join", "star_join"])
def test_facts_never_meet_in_one_task(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "SinglePartition" not in text and "CartesianProduct" not in text and "NestedLoop" not in text


def test_no_python_in_any_plan(spark):
    for name in ("largest_changes", "yearly_summary", "array_series_unnest", "nested_obs_unnest", "export_json"):
        text = plan(QUERIES[name](spark, SF))
        assert "Python" not in text and "Pandas" not in text


def test_level_windows_share_one_shuffle(spark):
    rows = spark.range(10).select(
        F.lit("a").alias("area_code"), F.date_add(F.lit("2020-01-05").cast("date"), (F.col("id") * 7).cast("int")).alias("week_end_date"),
        F.lit(2020).alias("iso_year"), F.col("id").cast("int").alias("iso_week"), F.col("id").cast("double").alias("fill_pct"),
    )
    both = series.prior_period(
        series.gap_safe_diff(rows, ["area_code"], "week_end_date", "fill_pct", 7), ["area_code", "iso_week"], "iso_year", ["fill_pct"]
    )
    assert plan(both).count("Exchange") == 1


def test_both_ranks_share_one_shuffle(spark):
    rows = spark.range(10).select(F.lit("a").alias("k"), F.lit("m").alias("metric"), F.col("id").alias("y"), F.col("id").cast("double").alias("value"))
    assert plan(extremes.rank_lenses(rows, ["k", "metric"], "y")).count("Exchange") == 1


def test_unpivot_scans_once(spark):
    rows = spark.read.parquet(f"{SF}/lineitem.parquet")
    long = extremes.melt_metrics(rows, ["l_orderkey"], {"q": ("l_quantity", 1), "t": ("l_tax", 2), "d": ("l_discount", 2)})
    assert plan(long).count("FileScan") == 1


def test_hot_join_key_is_split(spark):
    """A customer with a third of all orders: adaptive execution splits its partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    orders = spark.range(0, 120_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("o_custkey"), F.rand(1).alias("v")
    )
    customer = spark.range(5000).select(F.col("id").alias("c_custkey"), (F.col("id") % 25).alias("n"))
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("n").agg(F.count("*"), F.sum("v"))
        assert "skew=true" in final_plan(df)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_results_do_not_depend_on_partitioning(spark):
    days = base.daily_orders(spark, SF)

    def result(n):
        spread = days.repartition(n)
        monthly = reports.monthly_report(base.area_days(spread), full_days=base.FULL_DAYS)
        weekly = base.weekly(spread)
        return sorted(map(repr, monthly.collect())), sorted(map(repr, weekly.collect()))

    assert result(1) == result(7)


def test_dedup_and_keys_do_not_depend_on_partitioning(spark):
    events = spark.read.parquet(f"{SF}/events.parquet").select("user_id", "event_type", "ts", "event_id")
    order = [F.col("ts").desc(), F.col("event_id")]

    def result(n):
        once = staging.dedup_latest(events.repartition(n), ["user_id"], order)
        return sorted(map(repr, dims.surrogate_key(once, [F.col("user_id")], "k").collect()))

    assert result(1) == result(5)


def test_total_row_is_the_mean_over_stations(spark):
    weekly = base.weekly(base.daily_orders(spark, SF))
    wide = weekly.groupBy("iso_year", "iso_week").agg(
        F.sum(F.when(F.col("area_code") != "ALL", F.col("station_count"))).alias("parts"),
        F.max(F.when(F.col("area_code") == "ALL", F.col("station_count"))).alias("total"),
    )
    assert wide.where("parts <> total").count() == 0
