"""Calendar attributes computed from the date itself, so that facts need no join to a date table."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonstar.fixed_values import MONTH_NAMES, MONTH_SHORT_NAMES, SEASONS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(d: Column | str) -> Column:
    """yyyymmdd as an int."""
    d = _col(d)
    return F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)


def iso_year(d: Column | str) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), _col(d)).cast("int")


def iso_week(d: Column | str) -> Column:
    return F.weekofyear(_col(d))


def iso_day_of_week(d: Column | str) -> Column:
    """Monday 1 to Sunday 7."""
    return F.weekday(_col(d)) + 1


def iso_year_week(d: Column | str) -> Column:
    return iso_year(d) * 100 + iso_week(d)


def iso_week_end(d: Column | str) -> Column:
    """The Sunday that closes the ISO week."""
    d = _col(d)
    return F.date_add(d, 6 - F.weekday(d))


def hydro_year(d: Column | str, start_month: int = 10) -> Column:
    """Year that begins on the first of `start_month`, named by its starting year."""
    d = _col(d)
    return F.when(F.month(d) >= start_month, F.year(d)).otherwise(F.year(d) - 1)


def season(d: Column | str, labels: Sequence[str] = SEASONS) -> Column:
    """Meteorological season: `labels` for Dec-Feb, Mar-May, Jun-Aug, Sep-Nov."""
    quarter = F.floor((F.month(_col(d)) % 12) / 3).cast("int") + 1
    return F.element_at(F.array(*[F.lit(s) for s in labels]), quarter)


def month_label(d: Column | str, names: Sequence[str]) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in names]), F.month(_col(d)))


def parse_day(c: Column | str, pattern: str) -> Column:
    """Text in `pattern` to a date, NULL where the text does not parse. No time zone is involved."""
    return F.try_to_timestamp(_col(c), F.lit(pattern)).cast("date")


def utc_date(c: Column | str) -> Column:
    """ISO text with zone (or an instant) to its date in UTC, whatever the session time zone is."""
    seconds = F.unix_seconds(_col(c).try_cast("timestamp"))
    return F.date_from_unix_date(F.floor(seconds / 86400).cast("int"))


def date_spine(spark: SparkSession, d0: Column | date, d1: Column | date, name: str = "date") -> DataFrame:
    """One row per day from `d0` to `d1`, both included; none if they are in the wrong order or NULL.

    Bounds may be scalar subqueries.
    """
    lo = d0 if isinstance(d0, Column) else F.lit(d0)
    hi = d1 if isinstance(d1, Column) else F.lit(d1)
    bounds = spark.range(1).select(lo.alias("_lo"), hi.alias("_hi"))
    days = F.sequence("_lo", F.greatest("_lo", "_hi"), F.expr("interval 1 day"))  # never backwards
    return bounds.select("_hi", F.explode(days).alias(name)).where(F.col(name) <= F.col("_hi")).select(name)


def with_calendar(
    days: DataFrame,
    month_names: Sequence[str] = MONTH_NAMES,
    month_short: Sequence[str] = MONTH_SHORT_NAMES,
    season_labels: Sequence[str] = SEASONS,
    name: str = "date",
) -> DataFrame:
    """The 16 calendar and ISO-week columns for a table with one date column."""
    d = F.col(name)
    return days.select(
        date_key(d).alias("date_key"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        month_label(d, month_names).alias("month_name"),
        month_label(d, month_short).alias("month_short"),
        F.dayofmonth(d).alias("day_of_month"),
        iso_day_of_week(d).alias("iso_day_of_week"),
        F.dayofyear(d).alias("day_of_year"),
        iso_year(d).alias("iso_year"),
        iso_week(d).alias("iso_week"),
        iso_year_week(d).alias("iso_year_week"),
        iso_week_end(d).alias("week_end_date"),
        season(d, season_labels).alias("season"),
        hydro_year(d).alias("hydro_year"),
    )


def dim_date(spark: SparkSession, d0: Column | date, as_of: date, **labels) -> DataFrame:
    """Conformed date dimension from six days before `d0` to the end of the year of `as_of`."""
    lo = F.date_sub(d0, 6) if isinstance(d0, Column) else F.lit(d0 - timedelta(days=6))
    return with_calendar(date_spine(spark, lo, date(as_of.year, 12, 31)), **labels)


def date_of_key(key: Column | str) -> Column:
    """The date of a yyyymmdd key."""
    key = _col(key)
    return F.make_date(F.floor(key / 10000).cast("int"), (F.floor(key / 100) % 100).cast("int"), key % 100)
