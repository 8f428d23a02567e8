"""Records, long-form metrics and rankings."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonstar.fixed_values import DIRECTION_AMOUNT, DIRECTION_DOWN, DIRECTION_UP
from seasonstar.functions.aggregates import arg_max, arg_min
from seasonstar.functions.numeric import round_half_away


def melt_metrics(df: DataFrame, ids: list[str], metrics: Mapping[str, tuple[str, int]]) -> DataFrame:
    """Wide to long in one scan: `metric` and its rounded `value`, NULLs dropped.

    `metrics` maps each metric to its column and number of digits.
    """
    rounded = [round_half_away(c, n).alias(m) for m, (c, n) in metrics.items()]
    return (
        df.select(*ids, *rounded)
        .unpivot(ids, list(metrics), "metric", "value")
        .where(F.col("value").isNotNull())
    )


def rank_lenses(df: DataFrame, metric_keys: list[str], year_col: str, value: str = "value") -> DataFrame:
    """Rank by absolute value within each year and over all years; ties share a rank.

    The wider ranking comes first: its shuffle also serves the ranking by year.
    """
    largest = F.abs(F.col(value)).desc_nulls_last()
    overall = Window.partitionBy(*metric_keys).orderBy(largest)
    in_year = Window.partitionBy(*metric_keys, year_col).orderBy(largest)
    ranked = df.withColumn("rank_all_time", F.rank().over(overall))
    return ranked.withColumn("rank_in_year", F.rank().over(in_year))


def change_direction(metric: Column | str = "metric", value: Column | str = "value") -> Column:
    """Up or down for level metrics (`fill…`), the amount label for the others."""
    metric = F.col(metric) if isinstance(metric, str) else metric
    value = F.col(value) if isinstance(value, str) else value
    signed = F.when(value >= 0, DIRECTION_UP).otherwise(DIRECTION_DOWN)
    return F.when(metric.startswith("fill"), signed).otherwise(DIRECTION_AMOUNT)


def change_windows(df: DataFrame, t: str, metric: str = "metric") -> DataFrame:
    """First day of the period's week, and of the window the metric spans (one or four weeks)."""
    d = F.col(t)
    start = F.when(F.col(metric).endswith("4w"), F.date_sub(d, 27)).otherwise(F.date_sub(d, 6))
    return df.withColumns({"period_start": F.date_sub(d, 6), "window_start": start})


def top_k_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int, ties: bool = True, name: str = "rank") -> DataFrame:
    """The first k of each group, with equal rows sharing a rank (or without, `ties=False`).

    Spark keeps at most k ranks per group and map task before the shuffle.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    rank = F.rank() if ties else F.row_number()
    return df.withColumn(name, rank.over(w)).where(F.col(name) <= k)


def served_changes(ranked: DataFrame, in_year: int, all_time: int) -> DataFrame:
    """The rows that are near the top of their year or of all time."""
    return ranked.where((F.col("rank_in_year") <= in_year) | (F.col("rank_all_time") <= all_time))


def record(col: str, t: str, high: bool) -> tuple[Column, Column]:
    """Aggregates: the record value of a column and the earliest `t` it occurred."""
    if high:
        return F.max(col), arg_max(F.col(t), F.col(col), F.col(t))
    return F.min(col), arg_min(F.col(t), F.col(col), F.col(t))
