"""Dimensions and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonstar.sources.scratch import freeze

_PART_SHIFT = 33  # monotonically_increasing_id keeps the partition above bit 33, the position below


def surrogate_key(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Dense key 1, 2, 3 … in `order` (which must be total).

    The table is range-partitioned on `order`; positions inside each range are frozen in the shared folder and
    shifted by the number of rows in the ranges before. The plan is the same for any number of rows.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("*", F.monotonically_increasing_id().alias("_at"))
    )
    placed = freeze(placed, "surrogate")
    part = F.shiftright("_at", _PART_SHIFT)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range, as many as there are shuffle partitions: safe to number and broadcast
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")).alias("_before"))
    )
    position = F.col("_at").bitwiseAND(F.lit((1 << _PART_SHIFT) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select((F.col("_before") + position + 1).alias(name), *df.columns)
    )


def literal_row(like: DataFrame, row: dict) -> DataFrame:
    """A one-row table with the columns and types of `like`."""
    cols = [F.lit(row.get(f.name)).cast(f.dataType).alias(f.name) for f in like.schema.fields]
    return like.sparkSession.range(1).select(*cols)


def area_dim(areas: DataFrame, total_row: dict | None = None, order: str = "sort_order", name: str = "area_key") -> DataFrame:
    """Areas, with the total member if one is given, numbered in sort order (ties by all columns)."""
    rows = areas if total_row is None else areas.unionByName(literal_row(areas, total_row))
    ties = [c for c in sorted(areas.columns) if c != order]
    return surrogate_key(rows, [F.col(c).asc_nulls_last() for c in [order, *ties]], name)


def station_dim(stations: DataFrame, areas: DataFrame, key: str = "station_id", name: str = "station_key") -> DataFrame:
    """Stations of known areas, numbered by station id, with the key of their area."""
    numbered = stations.join(areas.select("area_code", "area_key"), "area_code")
    ties = [c for c in sorted(numbered.columns) if c != key]
    return surrogate_key(numbered, [F.col(c).asc_nulls_last() for c in [key, *ties]], name)
