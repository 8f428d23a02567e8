"""The daily series as incremental tables: files that landed, changed or went decide which years are unfolded again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonstar import fixed_values as fixed
from seasonstar.functions.aggregates import any_present
from seasonstar.functions.calendar import parse_day, utc_date
from seasonstar.functions.numeric import clamp_floor
from seasonstar.functions.text import part_of
from seasonstar.operators.staging import dedup_latest, latest_first, nested_observations, series_from_array
from seasonstar.plans.staging_plan import wanted_observation
from seasonstar.sources import schemas
from seasonstar.sources.manifest import IncrementalTable, Refresh
from seasonstar.sources.readers import LOADED_AT, SOURCE_FILE, read_json

_GRID = "X long, Y long, obs_date date, precip_mm double, elevation_m int, _loaded_at timestamp, year int"
_OBSERVED = "station_id string, obs_date date, precip_mm double, quality_code int, _loaded_at timestamp, year int"


def _grid_rows(raw: DataFrame) -> DataFrame:
    """Days of array series under their coordinates; a seed that names new points needs no file to be read again."""
    series = raw.where(F.col("Theme") == fixed.GRID_THEME).withColumnRenamed("Altitude", "elevation_m")
    long = series_from_array(
        series, ["X", "Y", "elevation_m", LOADED_AT, SOURCE_FILE], parse_day("StartDate", fixed.GRID_START_PATTERN),
        "Data", "precip_mm", "obs_date", F.col("NoDataValue").cast("double"),
    )
    dated = long.where(F.col("obs_date").isNotNull()).withColumn("year", F.year("obs_date"))
    return dated.select("X", "Y", "obs_date", "precip_mm", "elevation_m", LOADED_AT, "year", SOURCE_FILE)


def _observed_rows(raw: DataFrame) -> DataFrame:
    rows = raw.withColumn("station_id", part_of("sourceId", ":", 1)).withColumn("obs_date", utc_date("referenceTime"))
    values = nested_observations(rows, "observations", wanted_observation(F.col("o"))).select(
        "station_id", "obs_date", clamp_floor("o.value", 0.0).alias("precip_mm"),
        F.col("o.qualityCode").alias("quality_code"), LOADED_AT, F.year("obs_date").alias("year"), SOURCE_FILE,
    )
    return values.where(F.col("precip_mm").isNotNull() & F.col("obs_date").isNotNull())


@dataclass(frozen=True)
class DailyState:
    """Both daily sources, kept by year below one path; the second is optional and may never have landed."""

    spark: SparkSession
    grid: IncrementalTable
    observed: IncrementalTable

    @classmethod
    def at(cls, spark: SparkSession, landing: str, path: str, json_lines: bool = False) -> "DailyState":
        def table(name, files, schema, rows, keys):
            newest = [F.col("precip_mm").isNull(), F.col(LOADED_AT).desc_nulls_last(), F.col("precip_mm")]
            return IncrementalTable(
                spark, f"{landing}/{files}", f"{path}/{name}", lambda paths: read_json(spark, paths, schema, not json_lines),
                rows, "year", ["year", *keys, "obs_date"], newest,
            )

        return cls(
            spark, table("grid", fixed.GRID_FILES, schemas.GRID, _grid_rows, ["X", "Y"]),
            table("observed", fixed.OBSERVATION_FILES, schemas.OBSERVATION, _observed_rows, ["station_id"]),
        )

    def refresh(self) -> dict[str, Refresh]:
        return {"grid": self.grid.refresh(), "observed": self.observed.refresh()}

    def _rows(self, table: IncrementalTable, empty: str) -> DataFrame:
        return table.table() if table.facts.latest_version() else self.spark.createDataFrame([], empty)

    def points(self) -> DataFrame:
        """One row per coordinate pair with its height."""
        return self._rows(self.grid, _GRID).groupBy("X", "Y").agg(any_present("elevation_m").alias("elevation_m"))

    def daily(self, point_seed: DataFrame) -> DataFrame:
        """Latest value per station and day over both sources."""
        at = point_seed.select(F.col("point_id").alias("station_id"), F.col("utm33_x").alias("X"), F.col("utm33_y").alias("Y"))
        grid = self._rows(self.grid, _GRID).join(at, ["X", "Y"]).withColumn("quality_code", F.lit(None).cast("int"))
        columns = ["station_id", "obs_date", "precip_mm", "quality_code", LOADED_AT]
        both = grid.select(columns).unionByName(self._rows(self.observed, _OBSERVED).select(columns))
        kept = both.where(F.col("precip_mm").isNotNull())
        newest = dedup_latest(kept, ["station_id", "obs_date"], latest_first(kept, LOADED_AT))
        return newest.select("station_id", "obs_date", "precip_mm", "quality_code")
