"""Level fact and the five reports.

Inputs are tables with one row per area and week (levels, weekly amounts) or area and day (daily means).
All functions are lazy. Windows run per area over weekly or yearly rows, which the calendar bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seasonstar.fixed_values import (
    FULL_MONTH_DAYS, METRIC_AMOUNT_1W, METRIC_AMOUNT_4W, METRIC_LEVEL_1W, METRIC_LEVEL_4W,
)
from seasonstar.functions.aggregates import arg_max, arg_min, last_by
from seasonstar.functions.calendar import date_key
from seasonstar.functions.numeric import exact_mean, pct_change, round_half_away, sum_of_means
from seasonstar.operators.extremes import change_direction, change_windows, melt_metrics, rank_lenses, record
from seasonstar.operators.rollups import monthly_amounts
from seasonstar.operators.series import (
    gap_safe_diff, lag_diff, period_normal, prior_lookup, prior_period, rolling_sum, yoy_by_lag,
)


def level_fact(level: DataFrame, benchmark: DataFrame, area: str = "area_code") -> DataFrame:
    """Weekly level with its change, the same week one year before and the benchmark of the week.

    Both windows cluster on the area, so they share one shuffle.
    """
    changed = gap_safe_diff(level, [area], "week_end_date", "fill_pct", 7)
    prior = prior_period(changed, [area, "iso_week"], "iso_year", ["fill_pct"])
    joined = prior.join(benchmark, [area, "iso_week"], "left")
    return joined.select(
        date_key("week_end_date").alias("date_key"), area, "week_end_date", "iso_year", "iso_week",
        "fill_pct", "fill_twh", "capacity_twh", "change_pp", "fill_pct_prev_year",
        round_half_away(F.col("fill_pct") - F.col("fill_pct_prev_year"), 2).alias("yoy_change_pp"),
        "hist_min_pct", "hist_median_pct", "hist_max_pct",
        round_half_away(F.col("fill_pct") - F.col("hist_median_pct"), 2).alias("deviation_from_median_pp"),
    )


def trend(fact: DataFrame, weekly: DataFrame, area: str = "area_code") -> DataFrame:
    """Level and amount of the same week side by side, each with its value one year before.

    The prior-year amount belongs to the amount series, not to the level rows, so it is looked up there
    before the one join of both series.
    """
    key = [area, "iso_year", "iso_week"]
    amounts = prior_lookup(weekly, [area, "iso_week"], "iso_year", ["precip_mm"]).select(
        *key,
        F.col("precip_mm").alias("precip_week_mm"),
        F.col("precip_mm_prev_year").alias("precip_week_prev_year_mm"),
    )
    return (
        fact.withColumnRenamed("change_pp", "week_change_pp")
        .join(amounts, key, "left")
        .select(
            area, "week_end_date", "iso_year", "iso_week", "fill_pct", "fill_twh", "capacity_twh",
            "week_change_pp", "fill_pct_prev_year", "yoy_change_pp", "hist_min_pct", "hist_median_pct",
            "hist_max_pct", "deviation_from_median_pp", "precip_week_mm", "precip_week_prev_year_mm",
        )
    )


def monthly_report(
    daily_area: DataFrame, area: str = "area_code", full_days: int = FULL_MONTH_DAYS, date_col: str = "obs_date"
) -> DataFrame:
    """Monthly amounts against the previous available year and the normal of the month.

    The normal is the mean over the months with at least `full_days` days of data.
    """
    months = monthly_amounts(daily_area, [area], date_col)
    yoy = yoy_by_lag(
        months, [area, "month"], "year", "precip_mm", 1,
        prev="precip_prev_year_mm", diff="yoy_change_mm", pct="yoy_change_pct",
    )
    normal = period_normal(yoy, [area, "month"], "precip_mm", F.col("days_with_data") >= full_days)
    return normal.withColumn("is_partial_month", F.col("days_with_data") < full_days)


def yearly_levels(fact: DataFrame, area: str = "area_code") -> DataFrame:
    """Mean, extremes with their week, largest weekly changes and last value of each ISO year."""
    week_of = (F.col("iso_week"), F.col("fill_pct"), F.col("week_end_date"))
    return fact.groupBy(area, F.col("iso_year").alias("year")).agg(
        round_half_away(exact_mean("fill_pct", 2), 1).alias("avg_fill_pct"),
        F.max("fill_pct").alias("max_fill_pct"),
        arg_max(*week_of).alias("max_fill_week"),
        F.min("fill_pct").alias("min_fill_pct"),
        arg_min(*week_of).alias("min_fill_week"),
        F.max("change_pp").alias("max_week_increase_pp"),
        F.min("change_pp").alias("max_week_decrease_pp"),
        last_by("fill_pct", "week_end_date").alias("last_fill_pct"),
        F.max("iso_week").alias("last_week"),
    )


def yearly_amounts(
    daily_area: DataFrame, area: str = "area_code", date_col: str = "obs_date", last_day: DataFrame | None = None
) -> DataFrame:
    """Totals, wettest day and the total up to the day of the year of the last observation.

    The full and the year-to-date total come from one pass over the days.
    """
    last = (daily_area.select(F.max(date_col)) if last_day is None else last_day).scalar()
    day = F.col(date_col)
    so_far = F.when(F.dayofyear(day) <= F.dayofyear(last), F.col("precip_mm"))
    return daily_area.groupBy(area, F.year(day).alias("year")).agg(
        sum_of_means("precip_mm", 0).alias("total_precip_mm"),
        round_half_away(F.max("precip_mm"), 1).alias("max_day_precip_mm"),
        arg_max(day, F.col("precip_mm"), day).alias("max_day_precip_date"),
        sum_of_means("wet_day_share", 0).alias("wet_days"),
        sum_of_means(so_far, 0).alias("precip_ytd_mm"),
    )


def yearly_summary(
    fact: DataFrame, daily_area: DataFrame, area: str = "area_code", date_col: str = "obs_date", last_day: DataFrame | None = None
) -> DataFrame:
    """Levels by ISO year beside amounts by calendar year, with the previous available year."""
    joined = yearly_levels(fact, area).join(yearly_amounts(daily_area, area, date_col, last_day), [area, "year"], "left")
    w = Window.partitionBy(area).orderBy("year")
    avg_before, ytd_before = F.lag("avg_fill_pct").over(w), F.lag("precip_ytd_mm").over(w)
    return joined.withColumns(
        {
            "avg_fill_pct_prev_year": avg_before,
            "avg_fill_yoy_pp": round_half_away(F.col("avg_fill_pct") - avg_before, 1),
            "precip_ytd_prev_year_mm": ytd_before,
            "precip_ytd_yoy_pct": round_half_away(pct_change(F.col("precip_ytd_mm"), ytd_before), 1),
        }
    )


def change_metrics(trend_rows: DataFrame, area: str = "area_code") -> DataFrame:
    """The four change lenses in long form: level and amount, over one week and over four."""
    four = lag_diff(trend_rows, [area], "week_end_date", "fill_pct", 4, "change_4w_pp")
    base = rolling_sum(four, [area], "week_end_date", "precip_week_mm", 4, "precip_4w_mm", scale=1)
    return melt_metrics(
        base,
        [area, "iso_year", "iso_week", "week_end_date"],
        {
            METRIC_LEVEL_1W: ("week_change_pp", 2),
            METRIC_LEVEL_4W: ("change_4w_pp", 2),
            METRIC_AMOUNT_1W: ("precip_week_mm", 1),
            METRIC_AMOUNT_4W: ("precip_4w_mm", 1),
        },
    )


def largest_changes(trend_rows: DataFrame, area: str = "area_code") -> DataFrame:
    """Every change with its direction, period and both ranks."""
    ranked = rank_lenses(change_metrics(trend_rows, area), [area, "metric"], "iso_year")
    return change_windows(ranked.withColumn("direction", change_direction()), "week_end_date")


def alltime_extremes(trend_rows: DataFrame, area: str = "area_code") -> DataFrame:
    """Record high and low level and record weekly amount per area, with the earliest week of each."""
    high, high_week = record("fill_pct", "week_end_date", True)
    low, low_week = record("fill_pct", "week_end_date", False)
    wet, wet_week = record("precip_week_mm", "week_end_date", True)
    return trend_rows.groupBy(area).agg(
        high.alias("record_high_fill_pct"), high_week.alias("record_high_fill_week"),
        low.alias("record_low_fill_pct"), low_week.alias("record_low_fill_week"),
        wet.alias("record_wet_week_mm"), wet_week.alias("record_wet_week"),
    )
