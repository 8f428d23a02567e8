"""The layered build: raw, staging, star schema, reports, export."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonstar import fixed_values as fixed
from seasonstar.functions.calendar import date_key, date_of_key, dim_date
from seasonstar.functions.numeric import threshold_flag
from seasonstar.operators import quality, rollups, serve
from seasonstar.operators.dims import area_dim, literal_row, station_dim
from seasonstar.operators.extremes import served_changes
from seasonstar.operators.joins import keep_all, lookup
from seasonstar.plans import reports, staging_plan
from seasonstar.plans.daily_state import DailyState
from seasonstar.plans.staging_plan import Raw
from seasonstar.sources import schemas
from seasonstar.sources.readers import empty_table

Tables = dict[str, DataFrame]

AMOUNT_SCALE = 6  # digits kept of a daily amount when amounts are summed


VALUES_PER_TASK = 20_000_000  # largest station that is gathered in one task (about 1 GB of days)


def staging(raw: Raw, points: DataFrame, by_station: bool = False) -> Tables:
    """The staging layer; lazy."""
    base = staging_plan.level_base(raw.level)
    area = staging_plan.areas(raw.area)
    return {
        "stg.reservoir_weekly_base": base,
        "stg.reservoir_weekly": staging_plan.level_weekly(base),
        "stg.reservoir_benchmark": staging_plan.benchmark(raw.benchmark),
        "stg.area": area.unionByName(literal_row(area, fixed.TOTAL_AREA_ROW)),
        "stg.station": staging_plan.stations(raw, points),
        "stg.precipitation_daily": staging_plan.precipitation_daily(raw, by_station),
    }


def star(
    spark: SparkSession, stg: Tables, first_day: date | None, as_of: date, keep: Callable[[DataFrame, str], DataFrame]
) -> Tables:
    """Dimensions and facts. `keep` materialises a table under its name and returns it for further use.

    The daily series are unfolded and de-duplicated once, on the way into the daily fact; everything
    after reads the fact.

    Dates after the calendar (31 December of the year of `as_of`) have no date row and are left out.
    """
    last_day = F.lit(date(as_of.year, 12, 31))
    level = keep(stg["stg.reservoir_weekly_base"], "stg.reservoir_weekly_base")
    daily = stg["stg.precipitation_daily"]

    first = F.least(level.select(F.min("week_end_date")).scalar(), F.lit(first_day).cast("date"))
    dates = keep(dim_date(spark, first, as_of), "dw.dim_date")
    area = keep(area_dim(stg["stg.area"]), "dw.dim_area")
    station = keep(_stations(stg["stg.station"], area), "dw.dim_station")

    keys = area.select("area_code", "area_key")
    fact_level = lookup(
        reports.level_fact(level, stg["stg.reservoir_benchmark"]).where(F.col("week_end_date") <= last_day), keys, "area_code"
    ).select(
        "date_key", "area_key", "iso_year", "iso_week", "fill_pct", "fill_twh", "capacity_twh", "change_pp",
        "fill_pct_prev_year", "yoy_change_pp", "hist_min_pct", "hist_median_pct", "hist_max_pct",
        "deviation_from_median_pp",
    )
    fact_daily = keep(
        lookup(daily.where(F.col("obs_date") <= last_day), station, "station_id").select(
            date_key("obs_date").alias("date_key"), "station_key", "area_key", "precip_mm",
            threshold_flag("precip_mm", fixed.WET_DAY_MM).alias("is_wet_day"), "quality_code",
        ),
        "dw.fact_precipitation_daily",
    )
    used = _used_days(fact_daily, station)
    weekly = rollups.weekly_amounts(used, "station_key", "area_code", fixed.TOTAL_AREA, scale=AMOUNT_SCALE)
    fact_weekly = lookup(weekly, keys, "area_code").select(
        "date_key", "area_key", "iso_year", "iso_week", "precip_mm", "wet_days", "days_with_data", "station_count"
    )
    area_days = rollups.daily_area_mean(used, "area_code", fixed.TOTAL_AREA, scale=AMOUNT_SCALE)
    return {
        "dw.dim_date": dates,
        "dw.dim_area": area,
        "dw.dim_station": station,
        "dw.fact_reservoir_weekly": keep(fact_level, "dw.fact_reservoir_weekly"),
        "dw.fact_precipitation_daily": fact_daily,
        "dw.fact_precipitation_weekly": keep(fact_weekly, "dw.fact_precipitation_weekly"),
        "dw.v_precipitation_daily_area": keep(
            lookup(area_days, keys, "area_code").select(
                date_key("obs_date").alias("date_key"), "area_key", "precip_mm", "wet_day_share"
            ),
            "dw.v_precipitation_daily_area",
        ),
    }


def _stations(stg_station: DataFrame, area: DataFrame) -> DataFrame:
    return station_dim(stg_station, area).select(
        "station_key", "station_id", "station_name", "short_name", "municipality", "county", "elevation_m",
        "latitude", "longitude", "source", "use_for_area", "area_key", "area_code",
    )


def _used_days(fact_daily: DataFrame, station: DataFrame) -> DataFrame:
    """Daily amounts of the stations that count for their area."""
    used = station.where("use_for_area").select("station_key", "area_code")
    return lookup(fact_daily, used, "station_key").select(
        "station_key", "area_code", date_of_key("date_key").alias("obs_date"), "precip_mm", "is_wet_day"
    )


def report_tables(dw: Tables) -> Tables:
    """The five reports on the star schema; lazy. Total rows (`NOR`) are areas like the others."""
    names = dw["dw.dim_area"].select("area_key", "area_code")
    fact = lookup(dw["dw.fact_reservoir_weekly"], names, "area_key").withColumn("week_end_date", date_of_key("date_key"))
    weekly = lookup(dw["dw.fact_precipitation_weekly"], names, "area_key")
    area_days = lookup(dw["dw.v_precipitation_daily_area"], names, "area_key").withColumn(
        "obs_date", date_of_key("date_key")
    )
    last_day = dw["dw.fact_precipitation_daily"].select(date_of_key(F.max("date_key")))
    trend = reports.trend(fact, weekly)
    long_names = dw["dw.dim_area"].select("area_code", "area_name")
    monthly = reports.monthly_report(area_days)
    month_names = dw["dw.dim_date"].select("month", "month_short").distinct()
    return {
        "rpt.reservoir_trend": lookup(trend, long_names, "area_code"),
        "rpt.precipitation_monthly": lookup(lookup(monthly, long_names, "area_code"), month_names, "month"),
        "rpt.yearly_summary": reports.yearly_summary(fact, area_days, last_day=last_day),
        "rpt.largest_changes": lookup(reports.largest_changes(trend), long_names, "area_code"),
        "rpt.alltime_extremes": reports.alltime_extremes(trend),
    }


def build(
    spark: SparkSession, landing: str, seeds: str, as_of: date, out: str | None = None,
    sources: set[str] | None = None, json_lines: bool = False, limit: float | None = None, state: str | None = None,
) -> Tables:
    """All layers over a landing folder.

    With `limit`, damaged records are left out and listed in `stg.rejected`; a larger share of them in any source stops
    the build before a table is written. With `state`, a path that outlives the run, the daily series are kept there by
    year: only files that landed, changed or went since the last run, and the years they feed, are parsed and written
    again (records that can't be read are skipped there, so `limit` then looks at the other sources alone).

    With `out` the star schema is written there as Parquet, one folder per table, and the reports read
    the written tables; without it they stay lazy. Two things are looked up first, in one pass over the
    series: the first day with a value, and whether every station fits in a task.
    """
    def keep(df: DataFrame, name: str) -> DataFrame:
        if out is None:
            return df
        path = f"{out}/{name}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    raw = staging_plan.read_raw(spark, landing, seeds, sources, json_lines)
    if state is not None:  # the daily sources are read by their own files
        raw = replace(raw, **{n: empty_table(spark, s) for n, s in (("grid", schemas.GRID), ("observation", schemas.OBSERVATION))})
    rejected = {}
    if limit is not None:
        raw, rejected["stg.rejected"] = staging_plan.checked(raw, date(as_of.year, 12, 31), limit)
    if state is not None:
        kept = DailyState.at(spark, landing, state, json_lines)
        kept.refresh()
        points = keep(kept.points(), "stg.grid_points")
        stg = staging(raw, points) | {"stg.precipitation_daily": kept.daily(raw.point_seed)}
        first_day = stg["stg.precipitation_daily"].agg(F.min("obs_date")).first()[0]
    else:
        points = keep(staging_plan.grid_points(raw.grid), "stg.grid_points")
        profile = staging_plan.series_profile(raw, points).first()
        first_day = profile.first_day
        stg = staging(raw, points, profile.most_values <= VALUES_PER_TASK)
    dw = star(spark, stg, first_day, as_of, keep)
    return {**stg, **rejected, **dw, **report_tables(dw)}


def publish(spark: SparkSession, tables: Tables, layers: Iterable[str] = ("dw", "rpt")) -> None:
    """Save the tables of the layers to the catalog, one database per layer, for SQL users."""
    layers = set(layers)
    for layer in sorted(layers):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
    for name, df in tables.items():
        if name.split(".")[0] in layers:
            df.write.mode("overwrite").format("parquet").saveAsTable(name)


def create_views(tables: Tables) -> None:
    """Temporary views over all layers, named like the tables with `_` for the dot (`rpt_reservoir_trend`)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name.replace(".", "_"))


def table_counts(tables: Tables) -> DataFrame:
    """Row counts of the star schema."""
    stored = [n for n in tables if n.startswith("dw.") and not n.startswith("dw.v_")]
    return quality.row_counts({n: tables[n] for n in stored})


def export_areas(tables: Tables) -> DataFrame:
    """Areas with the stations that count for them; areas without any stay, with NULLs."""
    station = tables["dw.dim_station"].select(
        "area_key", "use_for_area", F.col("station_name").alias("station"), "station_id", "elevation_m",
        F.col("source").alias("precip_source"),
    )
    area = tables["dw.dim_area"].select(
        "area_key", F.col("area_code").alias("code"), F.col("area_name").alias("name"),
        F.col("area_long_name").alias("long_name"), "description",
    )
    return keep_all(area, station, "area_key", F.col("use_for_area")).select(*fixed.EXPORT_AREA_COLUMNS)


def export_documents(tables: Tables) -> DataFrame:
    """One JSON document per area: its stations and the four series in their column order."""
    changes = served_changes(tables["rpt.largest_changes"], fixed.TOP_IN_YEAR, fixed.TOP_ALL_TIME)
    source = {
        "weekly": (tables["rpt.reservoir_trend"], ["week_end_date"]),
        "monthly": (tables["rpt.precipitation_monthly"], ["year", "month"]),
        "yearly": (tables["rpt.yearly_summary"], ["year"]),
        "changes": (changes, ["metric", "rank_all_time", "week_end_date"]),
    }
    series = {
        name: serve.positional_rows(df.withColumnRenamed("area_code", "code"), "code", order, fixed.EXPORT_COLUMNS[name], name)
        for name, (df, order) in source.items()
    }
    return serve.area_documents(export_areas(tables), "code", series)


def export_meta(tables: Tables, extra: dict | None = None) -> DataFrame:
    """One row: data freshness, literals of the caller and the column order of each series."""
    days = tables["dw.fact_precipitation_daily"].select(date_of_key("date_key").alias("obs_date"))
    meta = serve.freshness_meta(tables["rpt.reservoir_trend"].select("week_end_date"), days, extra=extra)
    cols = F.struct(*[F.array(*[F.lit(c) for c in cs]).alias(n) for n, cs in fixed.EXPORT_COLUMNS.items()])
    return meta.withColumn("cols", cols)


def export(tables: Tables, path: str, extra: dict | None = None) -> None:
    """Write `areas` (one document per line) and `meta` below the path; nothing passes the driver."""
    serve.export_text(export_documents(tables), "document", f"{path}/areas")
    serve.export_json(export_meta(tables, extra), f"{path}/meta")
