"""Roll-ups with total rows: day, week, month and year."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seasonstar.functions.calendar import date_key, iso_week, iso_week_end, iso_year
from seasonstar.functions.numeric import (
    exact_mean, exact_sum, from_units, round_half_away, sum_of_means, threshold_flag, to_units,
)


def with_total(df: DataFrame, time_keys: list[str], area_col: str, total_value, aggs: Mapping[str, Column]) -> DataFrame:
    """Aggregates per area and time, plus rows over all areas under `total_value`, in one pass.

    The total weighs every input row alike (not every area). An input NULL area stays NULL: the total
    is recognised by the grouping flag, not by the NULL it leaves.
    """
    kind = df.schema[area_col].dataType
    out = df.groupingSets(
        [[F.col(area_col), *[F.col(t) for t in time_keys]], [F.col(t) for t in time_keys]],
        area_col, *time_keys,
    ).agg(*[c.alias(n) for n, c in aggs.items()], F.grouping(area_col).alias("_total"))
    area = F.when(F.col("_total") == 1, F.lit(total_value).cast(kind)).otherwise(F.col(area_col))
    return out.select(area.alias(area_col), *time_keys, *aggs)


def _area_means(
    df: DataFrame, area_col: str, time_keys: list[str], scales: Mapping[str, int], total_value,
    more: Mapping[str, tuple[Column, Callable[[str], Column]]],
) -> DataFrame:
    """Means per area and time, with total rows made from the sums and counts of the areas.

    The input is read once per row: only the few area rows are combined a second time. `more` maps
    further columns to their aggregate and to the function that combines them.
    """
    parts = df.groupBy(area_col, *time_keys).agg(
        *[F.sum(to_units(c, s)).alias(c) for c, s in scales.items()],
        *[F.count(c).alias(f"_n_{c}") for c in scales],
        *[first.alias(c) for c, (first, _) in more.items()],
    )
    if total_value is not None:
        combined = {c: F.sum(c) for x in scales for c in (x, f"_n_{x}")} | {c: again(c) for c, (_, again) in more.items()}
        parts = with_total(parts, time_keys, area_col, total_value, combined)
    no_rows = F.lit(0).cast("long")
    means = [(from_units(c, s) / F.nullif(F.col(f"_n_{c}"), no_rows)).alias(c) for c, s in scales.items()]
    return parts.select(area_col, *time_keys, *means, *more)


def two_level_mean(
    df: DataFrame, entity: str, area_col: str, time_keys: list[str], sums: Mapping[str, int],
    total_value=None, digits: int = 1, count_name: str = "station_count",
) -> DataFrame:
    """Sum per entity and period, then the mean of these sums per area and period.

    `sums` gives the columns and the digits their values carry. `days_with_data` is the smallest row
    count among the entities, `count_name` their number. With `total_value` rows over all entities are
    added.
    """
    per_entity = df.groupBy(entity, area_col, *time_keys).agg(
        *[exact_sum(c, s).alias(c) for c, s in sums.items()], F.count("*").alias("days_with_data")
    )
    more = {"days_with_data": (F.min("days_with_data"), F.min), count_name: (F.count("*"), F.sum)}
    means = _area_means(per_entity, area_col, time_keys, sums, total_value, more)
    return means.withColumns({c: round_half_away(c, digits) for c in sums})


def daily_amount_fact(daily: DataFrame, threshold: float, amount: str = "precip_mm", date_col: str = "obs_date") -> DataFrame:
    """Daily amounts with their date key and wet-day flag."""
    return daily.select(
        date_key(date_col).alias("date_key"), "*", threshold_flag(amount, threshold).alias("is_wet_day")
    )


def with_iso_week(df: DataFrame, date_col: str) -> DataFrame:
    """Add ISO year, ISO week and the closing Sunday of a date."""
    return df.withColumns(
        {
            "iso_year": iso_year(date_col),
            "iso_week": iso_week(date_col),
            "week_end_date": iso_week_end(date_col),
        }
    )


def weekly_amounts(
    daily: DataFrame, station: str, area_col: str, total_value=None, date_col: str = "obs_date",
    amount: str = "precip_mm", scale: int = 2, digits: int = 1,
) -> DataFrame:
    """Weekly mean over the stations of an area, on the ISO-week key of the weekly levels.

    Expects an `is_wet_day` column; the result has `precip_mm`, `wet_days`, `days_with_data` and
    `station_count` under the area and the week.
    """
    weeks = with_iso_week(daily, date_col).withColumnRenamed(amount, "precip_mm").withColumnRenamed("is_wet_day", "wet_days")
    means = two_level_mean(
        weeks, station, area_col, ["iso_year", "iso_week", "week_end_date"],
        {"precip_mm": scale, "wet_days": 0}, total_value, digits,
    )
    return means.select(
        date_key("week_end_date").alias("date_key"), area_col, "iso_year", "iso_week", "week_end_date",
        "precip_mm", "wet_days", "days_with_data", "station_count",
    )


def daily_area_mean(
    daily: DataFrame, area_col: str, total_value=None, date_col: str = "obs_date",
    amount: str = "precip_mm", scale: int = 2,
) -> DataFrame:
    """Mean amount and wet share over the stations of an area and day, not rounded."""
    days = daily.select(
        area_col, date_col, F.col(amount).alias("precip_mm"), F.col("is_wet_day").alias("wet_day_share")
    )
    return _area_means(days, area_col, [date_col], {"precip_mm": scale, "wet_day_share": 0}, total_value, {})


def monthly_amounts(daily_area: DataFrame, keys: list[str], date_col: str = "obs_date") -> DataFrame:
    """Monthly total, wet days, largest day and number of days of an area's daily means."""
    months = daily_area.withColumns({"year": F.year(date_col), "month": F.month(date_col)})
    return months.groupBy(*keys, "year", "month").agg(
        sum_of_means("precip_mm", 1).alias("precip_mm"),
        sum_of_means("wet_day_share", 0).alias("wet_days"),
        F.max("precip_mm").alias("max_day_mm"),
        F.count("*").alias("days_with_data"),
    )


def measures(level: DataFrame, daily: DataFrame, area_col: str, year_level: str = "iso_year", date_col: str = "obs_date") -> DataFrame:
    """Level and amount measures per area and year, as a BI model would define them.

    Means of the level, of the level one year before and of the benchmark median, their differences,
    and the sums of amounts and wet days.
    """
    by_level = level.groupBy(area_col, F.col(year_level).alias("year")).agg(
        exact_mean("fill_pct", 2).alias("fill_pct"),
        exact_mean("fill_pct_prev_year", 2).alias("fill_pct_last_year"),
        exact_mean("hist_median_pct", 2).alias("_median"),
    )
    by_amount = daily.groupBy(area_col, F.year(date_col).alias("year")).agg(
        exact_sum("precip_mm", 2).alias("precip_mm"), F.sum("is_wet_day").alias("wet_days")
    )
    return by_level.join(by_amount, [area_col, "year"], "left").select(
        area_col, "year", "fill_pct", "fill_pct_last_year",
        (F.col("fill_pct") - F.col("fill_pct_last_year")).alias("fill_vs_last_year_pp"),
        (F.col("fill_pct") - F.col("_median")).alias("fill_vs_median_pp"),
        "precip_mm", "wet_days",
    )
