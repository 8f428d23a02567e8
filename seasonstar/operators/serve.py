"""Serving: nested rows per key, JSON documents, freshness."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nest_by(df: DataFrame, key: str, order: list[str], cols: list[str], name: str = "rows", chunk: str | None = None) -> DataFrame:
    """One row per key with its rows as an array of structs, sorted by `order`.

    Meant for report tables, whose groups are bounded by the calendar (53 weeks or 366 days a year).
    With `chunk` (a year column, say) there is one row per key and chunk, for keys with long histories.
    """
    return _nested(df, key, order, F.struct(*cols), name, chunk)


def positional_rows(df: DataFrame, key: str, order: list[str], cols: list[str], name: str = "rows", chunk: str | None = None) -> DataFrame:
    """As `nest_by`, with the rows as JSON text `[[c1,c2,…],…]` in the column order given."""
    nested = _nested(df, key, order, row_as_array(cols), name, chunk)
    return nested.withColumn(name, F.concat(F.lit("["), F.concat_ws(",", name), F.lit("]")))


def _nested(df: DataFrame, key: str, order: list[str], item: Column, name: str, chunk: str | None) -> DataFrame:
    by = [key, *([chunk] if chunk else [])]
    entry = F.struct(F.struct(*order).alias("o"), item.alias("v"))
    nested = df.groupBy(*by).agg(F.array_sort(F.collect_list(entry)).alias("_rows"))
    return nested.select(*by, F.col("_rows.v").alias(name))


def row_as_array(cols: list[str]) -> Column:
    """The columns of a row as one JSON array text; dates become ISO text, NULL becomes null."""
    items = []
    for c in cols:
        boxed = F.to_json(F.array(F.col(c)))  # "[value]": a scalar has no JSON text of its own
        items.append(F.substring(boxed, F.lit(2), F.length(boxed) - 2))
    return F.concat(F.lit("["), F.concat_ws(",", *items), F.lit("]"))


def area_documents(areas: DataFrame, key: str, series: Mapping[str, DataFrame]) -> DataFrame:
    """One JSON text per area: its attributes, and each series as `[[…],…]` (empty where it has none).

    `areas` has one or more rows per key (an area without station, or with several); they become the
    list `areas`. Each series is a result of `positional_rows` with its rows under the series' name.
    """
    described = areas.select(key, row_as_object(areas.columns).alias("_a")).groupBy(key).agg(
        F.concat_ws(",", F.array_sort(F.collect_list("_a"))).alias("_areas")
    )
    joined = reduce(lambda a, s: a.join(s, key, "left"), series.values(), described)
    parts = [F.concat(F.lit('"areas":['), F.col("_areas"), F.lit("]"))]
    parts += [F.concat(F.lit(f'"{n}":'), F.coalesce(F.col(n), F.lit("[]"))) for n in series]
    return joined.select(key, F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("document"))


def row_as_object(cols: list[str]) -> Column:
    """The columns of a row as one JSON object text, NULL fields kept."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def export_json(df: DataFrame, path: str) -> None:
    """Write one JSON document per row, in UTF-8, NULL fields kept, dates as ISO text."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def export_text(df: DataFrame, col: str, path: str) -> None:
    """Write a text column that already holds one document per row."""
    df.select(col).write.mode("overwrite").text(path)


def freshness_meta(
    level: DataFrame, amounts: DataFrame, level_date: str = "week_end_date", amount_date: str = "obs_date",
    extra: Mapping | None = None,
) -> DataFrame:
    """One row: last level date, last amount date, and literal columns passed in by the caller."""
    return level.sparkSession.range(1).select(
        level.select(F.max(level_date)).scalar().alias("last_week_end"),
        amounts.select(F.max(amount_date)).scalar().alias("last_precip_date"),
        *[F.lit(v).alias(k) for k, v in (extra or {}).items()],
    )
