"""Data checks. Each finding is one row; an empty table means no findings."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)


def out_of_range(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Rows whose value lies outside the range; NULLs are not findings."""
    return df.where((F.col(col) < lo) | (F.col(col) > hi))


def gaps(df: DataFrame, keys: list[str], t: str, step_days: int) -> DataFrame:
    """Stretches without data: the dates around them and the number of missing steps.

    Dates are made distinct first, so that a group holds at most one row per calendar day.
    """
    w = Window.partitionBy(*keys).orderBy(t)
    days = df.select(*keys, t).distinct().withColumn("gap_from", F.lag(t).over(w))
    span = F.datediff(F.col(t), F.col("gap_from"))
    return days.where(span > step_days).select(
        *keys, "gap_from", F.col(t).alias("gap_to"), (F.floor((span - 1) / step_days)).cast("int").alias("missing_steps")
    )


def dropped_rows(df: DataFrame, t: str, last_day) -> DataFrame:
    """Rows dated after the last day of the calendar, which inner joins to it would lose."""
    return df.where(F.col(t) > F.lit(last_day))


def quality_report(
    df: DataFrame, keys: list[str], ranges: Mapping[str, tuple[float, float]], t: str, step_days: int,
    last_day=None,
) -> DataFrame:
    """All findings on a series with `keys` + `t` as its key: check, key as JSON, detail."""
    as_key = F.to_json(F.struct(*keys, t)).alias("key")
    found = [
        duplicate_keys(df, [*keys, t]).select(F.lit("duplicate").alias("check"), as_key, F.col("n_rows").cast("string").alias("detail"))
    ]
    for col, (lo, hi) in ranges.items():
        found.append(
            out_of_range(df, col, lo, hi).select(
                F.lit("range").alias("check"), as_key, F.concat(F.lit(col + "="), F.col(col).cast("string")).alias("detail")
            )
        )
    gap_key = F.to_json(F.struct(*keys, F.col("gap_to").alias(t))).alias("key")
    found.append(
        gaps(df, keys, t, step_days).select(F.lit("gap").alias("check"), gap_key, F.col("missing_steps").cast("string").alias("detail"))
    )
    if last_day is not None:
        found.append(
            dropped_rows(df, t, last_day).select(F.lit("after_calendar").alias("check"), as_key, F.col(t).cast("string").alias("detail"))
        )
    return reduce(DataFrame.unionByName, found)
