"""Raw and staging layers: landed files to typed, de-duplicated tables."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonstar import fixed_values as fixed
from seasonstar.functions.aggregates import any_present
from seasonstar.functions.calendar import parse_day, utc_date
from seasonstar.functions.numeric import clamp_floor, round_half_away
from seasonstar.functions.text import area_code, part_of, pick
from seasonstar.operators import quarantine
from seasonstar.operators.series import gap_safe_diff
from seasonstar.operators.staging import dedup_latest, latest_first, nested_observations, prefer_source, series_from_array
from seasonstar.sources import schemas
from seasonstar.sources.readers import CORRUPT, LOADED_AT, SOURCE_FILE, empty_table, read_json, read_or_empty, read_seed

SOURCES = ("nve", "precip", "frost")


@dataclass(frozen=True)
class Raw:
    """The raw layer: landed rows as they are, plus the time their file landed and its path."""

    level: DataFrame
    benchmark: DataFrame
    area: DataFrame
    grid: DataFrame
    station: DataFrame
    observation: DataFrame
    point_seed: DataFrame
    station_seed: DataFrame


def read_raw(
    spark: SparkSession, landing: str, seeds: str, sources: set[str] | None = None, json_lines: bool = False
) -> Raw:
    """Read the landed files; sources that are left out or were never landed are typed empty tables.

    With `json_lines` a file may hold many records, one per line, and large files are read by many tasks.
    """
    wanted = set(SOURCES) if sources is None else set(sources)
    unknown = wanted - set(SOURCES)
    if unknown:
        raise ValueError(f"unknown sources: {sorted(unknown)}")

    def read(source: str, file: str, schema, optional: bool = False) -> DataFrame:
        if source not in wanted:
            return empty_table(spark, schema)
        reader = read_or_empty if optional else read_json
        return reader(spark, f"{landing}/{file}", schema, multiline=not json_lines)

    return Raw(
        level=read("nve", fixed.LEVEL_FILE, schemas.LEVEL),
        benchmark=read("nve", fixed.BENCHMARK_FILE, schemas.BENCHMARK),
        area=read("nve", fixed.AREA_FILE, schemas.AREA),
        grid=read("precip", fixed.GRID_FILES, schemas.GRID),
        station=read("frost", fixed.STATION_FILE, schemas.STATION, optional=True),
        observation=read("frost", fixed.OBSERVATION_FILES, schemas.OBSERVATION, optional=True),
        point_seed=read_seed(spark, f"{seeds}/{fixed.POINT_SEED_FILE}", schemas.POINT_SEED),
        station_seed=read_seed(spark, f"{seeds}/{fixed.STATION_SEED_FILE}", schemas.STATION_SEED),
    )


def corrupt_records(raw: DataFrame) -> DataFrame:
    """Records that could not be read, with their file and what could be read of them (`fields`, as JSON).

    Spark refuses to scan for the corrupt text alone, so the filter looks at the fields as well.
    """
    data = [c for c in raw.columns if c not in (CORRUPT, LOADED_AT, SOURCE_FILE)]
    fields = F.to_json(F.struct(*data))
    return raw.where(F.col(CORRUPT).isNotNull() & (F.length(fields) > 0)).select(
        SOURCE_FILE, CORRUPT, fields.alias("fields")
    )


def _rules(last_day: date) -> dict[str, dict]:
    """What is wrong with a record of each landed source. A series is left out whole, so it may end after the calendar."""
    corrupt = F.col(CORRUPT).isNotNull()

    def dated(day) -> dict:
        return {"truncated": corrupt, "undated": ~corrupt & day.isNull(), "after_calendar": ~corrupt & (day > F.lit(last_day))}

    series = quarantine.series_rules(fixed.GRID_START_PATTERN, last_day, fixed.GRID_MINUTES_PER_STEP)
    return {
        "level": dated(F.col("dato_Id").try_cast("date")),
        "grid": series | {"after_calendar": ~corrupt & (_start() > F.lit(last_day))},
        "observation": dated(utc_date("referenceTime")),
        **{name: {"truncated": corrupt} for name in ("benchmark", "area", "station")},
    }


def checked(raw: Raw, last_day: date, limit: float) -> tuple[Raw, DataFrame]:
    """The raw layer without damaged records, and these: source, file, reasons, unread text, fields as JSON.

    Each source is parsed once, on the way into the shared folder. More rejected rows of a source than the share
    `limit` raise `quarantine.TooManyRejected`, before any table is built.
    """
    good, bad = {}, []
    for source, rules in _rules(last_day).items():
        routed = quarantine.route(getattr(raw, source), rules, limit)
        good[source] = routed.data
        fields = [c for c in routed.data.columns if c not in (CORRUPT, LOADED_AT, SOURCE_FILE)]
        bad.append(
            routed.rejected.select(
                F.lit(source).alias("source"), SOURCE_FILE, quarantine.REASONS, CORRUPT, F.to_json(F.struct(*fields)).alias("fields")
            )
        )
    return replace(raw, **good), reduce(DataFrame.unionByName, bad)


def _code():
    return area_code("omrType", "omrnr", fixed.AREA_CODES)


def level_base(raw: DataFrame) -> DataFrame:
    """Latest published level per area and week, as percent. Rows without a level never hide others."""
    kept = raw.where(F.col("omrType").isin(*fixed.AREA_CODES) & F.col("fyllingsgrad").isNotNull())
    newest = dedup_latest(kept, ["omrType", "omrnr", "dato_Id"], latest_first(kept, LOADED_AT))
    return newest.select(
        _code().alias("area_code"),
        F.col("dato_Id").try_cast("date").alias("week_end_date"),
        F.col("iso_aar").alias("iso_year"),
        F.col("iso_uke").alias("iso_week"),
        round_half_away(F.col("fyllingsgrad") * 100, 2).alias("fill_pct"),
        F.col("fylling_TWh").alias("fill_twh"),
        F.col("kapasitet_TWh").alias("capacity_twh"),
        round_half_away(F.col("endring_fyllingsgrad") * 100, 2).alias("nve_change_pp"),
    )


def level_weekly(base: DataFrame) -> DataFrame:
    """Levels with the change computed from the series itself."""
    return gap_safe_diff(base, ["area_code"], "week_end_date", "fill_pct", 7)


def benchmark(raw: DataFrame) -> DataFrame:
    """Historic smallest, middle and largest level per area and ISO week."""
    kept = raw.where(F.col("omrType").isin(*fixed.AREA_CODES))
    return kept.select(
        _code().alias("area_code"),
        F.col("iso_uke").alias("iso_week"),
        round_half_away(F.col("minFyllingsgrad") * 100, 2).alias("hist_min_pct"),
        round_half_away(F.col("medianFyllingsGrad") * 100, 2).alias("hist_median_pct"),
        round_half_away(F.col("maxFyllingsgrad") * 100, 2).alias("hist_max_pct"),
    )


def areas(raw: DataFrame) -> DataFrame:
    """The areas as published, without the total member."""
    return raw.where(F.col("omrType") == fixed.AREA_KIND).select(
        _code().alias("area_code"),
        F.col("navn").alias("area_name"),
        F.col("navn_langt").alias("area_long_name"),
        F.col("beskrivelse").alias("description"),
        F.lit(fixed.AREA_TYPE).alias("area_type"),
        F.col("omrnr").alias("sort_order"),
    )


def grid_points(grid: DataFrame) -> DataFrame:
    """One row per coordinate pair of the series: its height, first day with a value, number of values.

    The values are counted in the arrays as they are, without unfolding them. The first day survives
    de-duplication, as a value is only ever replaced by another value.
    """
    is_series = F.col("Theme") == fixed.GRID_THEME
    no_data = F.coalesce(F.col("NoDataValue").cast("double"), F.lit(float("nan")))
    at = F.array_position(F.transform("Data", lambda v: v.isNotNull() & (v != no_data)), F.lit(True)).cast("int")
    return grid.groupBy("X", "Y").agg(
        any_present("Altitude").alias("elevation_m"),
        F.min(F.when(is_series & (at > 0), F.date_add(_start(), at - 1))).alias("first_day"),
        F.sum(F.when(is_series, F.size("Data"))).alias("n_values"),
    )


def _at_point(points: DataFrame, raw: Raw, how: str) -> DataFrame:
    return raw.point_seed.join(points, (F.col("X") == F.col("utm33_x")) & (F.col("Y") == F.col("utm33_y")), how)


def stations(raw: Raw, points: DataFrame) -> DataFrame:
    """Grid points and observing stations, with the flag that says which of them count for their area."""
    grid = _at_point(points, raw, "left").select(
        F.col("point_id").alias("station_id"),
        F.col("name").alias("station_name"),
        F.col("name").alias("short_name"),
        "elevation_m", "latitude", "longitude", "area_code",
        F.lit(fixed.GRID_SOURCE_LABEL).alias("source"),
        F.lit(True).alias("_primary"),
    )
    place = F.col("geometry.coordinates")  # [longitude, latitude]
    observing = raw.station.join(raw.station_seed, F.col("id") == F.col("station_id")).select(
        "station_id",
        F.col("name").alias("station_name"),
        F.col("shortName").alias("short_name"),
        "municipality", "county",
        F.col("masl").alias("elevation_m"),
        pick(place, 2).alias("latitude"),
        pick(place, 1).alias("longitude"),
        "area_code",
        F.lit(fixed.STATION_SOURCE_LABEL).alias("source"),
        F.lit(False).alias("_primary"),
    )
    every = observing.unionByName(grid, allowMissingColumns=True)
    flagged = prefer_source(every, "area_code", "_primary", raw.point_seed.select("area_code"))
    return flagged.select(
        "station_id", "station_name", "short_name", "municipality", "county", "elevation_m", "latitude",
        "longitude", "area_code", "source", "use_for_area",
    )


def _known_series(raw: Raw) -> DataFrame:
    """The array-encoded series of known points, still one row per series."""
    return raw.grid.where(F.col("Theme") == fixed.GRID_THEME).join(
        raw.point_seed.select(F.col("point_id").alias("station_id"), "utm33_x", "utm33_y"),
        (F.col("utm33_x") == F.col("X")) & (F.col("utm33_y") == F.col("Y")),
    )


def grid_daily(raw: Raw, by_station: bool = False) -> DataFrame:
    """Array-encoded series as one row per point and day; sentinel values are NULL."""
    series = _known_series(raw)
    long = series_from_array(
        series.repartition("station_id") if by_station else series, ["station_id", LOADED_AT], _start(), "Data",
        "precip_mm", "obs_date", F.col("NoDataValue").cast("double"),
    )
    return long.withColumn("quality_code", F.lit(None).cast("int"))


def _start():
    return parse_day("StartDate", fixed.GRID_START_PATTERN)


def observed_daily(raw: Raw, by_station: bool = False) -> DataFrame:
    """Nested observations as one row per station and day; -1 (not measurable) is 0, NULL stays NULL."""
    rows = raw.observation.withColumn("station_id", part_of("sourceId", ":", 1))
    return nested_observations(
        rows.repartition("station_id") if by_station else rows, "observations", wanted_observation(F.col("o"))
    ).select(
        "station_id",
        utc_date("referenceTime").alias("obs_date"),
        clamp_floor("o.value", 0.0).alias("precip_mm"),
        F.col("o.qualityCode").alias("quality_code"),
        LOADED_AT,
    )


def wanted_observation(o):
    return (o["elementId"] == fixed.OBSERVATION_ELEMENT) & (o["timeOffset"] == fixed.OBSERVATION_OFFSET)


def series_profile(raw: Raw, points: DataFrame) -> DataFrame:
    """One row: the first day with a value, and the number of values of the station that has most."""
    grid = _at_point(points, raw, "inner").select(F.col("point_id").alias("station_id"), "first_day", "n_values")
    seen = F.exists("observations", lambda o: wanted_observation(o) & o["value"].isNotNull())
    observed = raw.observation.select(
        part_of("sourceId", ":", 1).alias("station_id"),
        F.when(seen, utc_date("referenceTime")).alias("first_day"),
        F.size("observations").cast("long").alias("n_values"),
    )
    per_station = grid.unionByName(observed).groupBy("station_id").agg(
        F.min("first_day").alias("first_day"), F.sum("n_values").alias("n_values")
    )
    return per_station.agg(
        F.min("first_day").alias("first_day"), F.coalesce(F.max("n_values"), F.lit(0)).alias("most_values")
    )


def precipitation_daily(raw: Raw, by_station: bool = False) -> DataFrame:
    """Latest value per station and day over both sources.

    With `by_station` the series are gathered per station while they are still arrays: few rows are
    shuffled, the days are sorted once, and they stay together for the weekly sums. It needs every
    station to fit in a task. Otherwise the days are unfolded first and shuffled by station and day,
    after each task has dropped what it can, so that a station with very many copies is spread.

    The value of the file that landed last wins, and the smallest among files that landed in the same
    millisecond; the file path is left behind, as it would be most of what the shuffle carries.
    """
    both = grid_daily(raw, by_station).unionByName(observed_daily(raw, by_station))
    kept = both.where(F.col("precip_mm").isNotNull())
    newest = dedup_latest(kept, ["station_id", "obs_date"], latest_first(kept, LOADED_AT))
    return newest.select("station_id", "obs_date", "precip_mm", "quality_code")
