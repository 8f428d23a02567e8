"""Cleaning operators: latest-wins, array and nested series, preferred source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonstar.functions.numeric import sentinel_to_null


def dedup_latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in `order` (which must be total to be repeatable).

    The filter on the row number makes Spark keep one row per key and map task before the shuffle, so a
    key that holds a large share of all rows sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_first(df: DataFrame, loaded_at: str) -> list[Column]:
    """Total order for `dedup_latest`: newest load first, then all remaining columns."""
    rest = [c for c in sorted(df.columns) if c != loaded_at]
    return [F.col(loaded_at).desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in rest]]


def series_from_array(
    df: DataFrame,
    id_cols: list[str],
    start: Column,
    arr_col: str,
    value_name: str,
    date_name: str,
    sentinel: Column | None = None,
) -> DataFrame:
    """One row per array position, dated `start` plus the position in days.

    A value equal to the sentinel becomes NULL without moving the later dates. Rows multiply here, so
    join and filter before, while there is still one row per array.
    """
    slim = df.select(
        *id_cols, start.alias("_start"), arr_col, (sentinel if sentinel is not None else F.lit(None)).alias("_sentinel")
    )
    long = slim.select(*id_cols, "_start", "_sentinel", F.posexplode(arr_col).alias("_pos", "_value"))
    value = sentinel_to_null("_value", F.col("_sentinel")) if sentinel is not None else F.col("_value")
    return long.select(*id_cols, F.date_add("_start", F.col("_pos")).alias(date_name), value.alias(value_name))


def nested_observations(df: DataFrame, arr_col: str, where: Column | None = None, name: str = "o") -> DataFrame:
    """One row per struct of the array, as column `name`; `where` may use its fields (`o.value`)."""
    rest = [c for c in df.columns if c != arr_col]
    out = df.select(*rest, F.explode(arr_col).alias(name))
    return out if where is None else out.where(where)


def prefer_source(
    points: DataFrame, key: str, is_primary: str, primary_keys: DataFrame | None = None,
    out: str = "use_for_area", salts: int = 16,
) -> DataFrame:
    """Flag primary rows, and fallback rows of keys that have no primary row.

    `primary_keys` (default: the keys of the primary rows) names the keys that count as covered. They
    are spread over `salts` copies and every point looks into one of them, so a key with a large share
    of the points is split; where the key table is small Spark broadcasts it and nothing is shuffled.
    """
    covered = points.where(F.col(is_primary)) if primary_keys is None else primary_keys
    covered = (
        covered.select(F.col(key).alias("_key"))
        .where(F.col("_key").isNotNull())
        .distinct()
        .select("_key", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt_key"))
    )
    salted = points.withColumn("_salt", F.pmod(F.xxhash64(*points.columns), F.lit(salts)).cast("int"))
    joined = salted.join(
        covered, (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_salt_key")), "left"
    )
    flag = F.coalesce(F.col(is_primary), F.lit(False)) | F.col("_key").isNull()
    return joined.select(*points.columns, flag.alias(out))
