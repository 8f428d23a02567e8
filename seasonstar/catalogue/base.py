"""Level and amount series defined on the test tables.

area     region (plus the total member ALL)
station  nation, through the customer's nation
amount   daily sum of order prices per nation
level    weekly mean order price per region, as percent of 500,000
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonstar.functions.numeric import from_units, round_half_away, threshold_flag, to_units
from seasonstar.operators.joins import lookup
from seasonstar.operators.rollups import daily_area_mean, weekly_amounts, with_iso_week
from seasonstar.plans.reports import level_fact, trend
from seasonstar.sources.scratch import freeze

TOTAL = "ALL"
WET_AMOUNT = 200_000.0
FULL_DAYS = 20
LEVEL_CAPACITY = 500_000.0


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table. Its schema is read from the files once; later reads need no job for it."""
    path = f"{sf}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def areas(spark: SparkSession, sf: str) -> DataFrame:
    """Nations with the name of their region."""
    nation = table(spark, sf, "nation")
    region = table(spark, sf, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", F.col("n_name").alias("station"), F.col("r_name").alias("area_code")
    )


def daily_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Cents and number of orders per nation and day.

    The only step that touches raw rows. Both sides of the customer join are plain scans, so Spark splits
    a customer with very many orders (AQE skew join), or broadcasts a small customer table by its size.
    The days are summed before the shuffle, and names are joined to the result.
    """
    orders = table(spark, sf, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("obs_date"), to_units("o_totalprice", 2).alias("cents")
    )
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    days = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_nationkey").alias("n_nationkey"), "obs_date")
        .agg(F.sum("cents").alias("cents"), F.count("*").alias("n_orders"))
    )
    nation = table(spark, sf, "nation").withColumnRenamed("n_regionkey", "r_regionkey")
    named = lookup(lookup(days, nation, "n_nationkey"), table(spark, sf, "region"), "r_regionkey")
    return named.select(
        F.col("n_name").alias("station"), F.col("r_name").alias("area_code"), "obs_date", "cents", "n_orders"
    )


def amounts(days: DataFrame) -> DataFrame:
    """Daily amounts per station with the wet-day flag."""
    rows = days.select("station", "area_code", "obs_date", from_units("cents", 2).alias("precip_mm"))
    return rows.withColumn("is_wet_day", threshold_flag("precip_mm", WET_AMOUNT))


def levels(days: DataFrame) -> DataFrame:
    """Weekly levels per area, with total and number of orders."""
    weeks = with_iso_week(days, "obs_date").groupBy("area_code", "iso_year", "iso_week", "week_end_date").agg(
        from_units(F.sum("cents"), 2).alias("fill_twh"), F.sum("n_orders").cast("double").alias("capacity_twh")
    )
    mean = F.col("fill_twh") / F.col("capacity_twh")
    return weeks.withColumn("fill_pct", round_half_away(mean * 100.0 / LEVEL_CAPACITY, 2))


def benchmark(level: DataFrame) -> DataFrame:
    """Smallest, middle and largest level per area and week of the year (test data only)."""
    return level.groupBy("area_code", "iso_week").agg(
        F.min("fill_pct").alias("hist_min_pct"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY fill_pct)").alias("hist_median_pct"),
        F.max("fill_pct").alias("hist_max_pct"),
    )


def weekly(days: DataFrame, total=TOTAL) -> DataFrame:
    return weekly_amounts(amounts(days), "station", "area_code", total)


def area_days(days: DataFrame, total=TOTAL) -> DataFrame:
    return daily_area_mean(amounts(days), "area_code", total)


def facts(days: DataFrame) -> DataFrame:
    level = levels(days)
    return level_fact(level, benchmark(level))


def trends(days: DataFrame) -> DataFrame:
    return trend(facts(days), weekly(days, None))


def frozen_days(spark: SparkSession, sf: str) -> DataFrame:
    """`daily_orders` written once, for queries whose parts would each scan and join the raw rows."""
    return freeze(daily_orders(spark, sf), "days")
