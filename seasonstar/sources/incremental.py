"""What to fetch, how to land it, and how to merge revised rows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonstar.operators.staging import dedup_latest
from seasonstar.sources.readers import union_by_name


def wanted_periods(entities: DataFrame, first_year: int, as_of: date, name: str = "year") -> DataFrame:
    """Every entity with every year up to that of `as_of` (row-local, no join)."""
    years = F.array(*[F.lit(y) for y in range(first_year, as_of.year + 1)]).cast("array<int>")
    return entities.select("*", F.explode(years).alias(name))


def period_end(year: Column | str, as_of: date, exclusive: bool = False) -> Column:
    """31 December for a closed year (or the first day after it, `exclusive`), `as_of` for the open one."""
    year = F.col(year) if isinstance(year, str) else year
    closed = F.make_date(year + 1, F.lit(1), F.lit(1)) if exclusive else F.make_date(year, F.lit(12), F.lit(31))
    return F.when(year < as_of.year, closed).otherwise(F.lit(as_of))


def pending_partitions(
    wanted: DataFrame, landed: DataFrame, keys: list[str], period_col: str, open_from, force: bool = False
) -> DataFrame:
    """Wanted keys that have not landed yet, plus those of the open period; all of them with `force`."""
    if force:
        return wanted
    done = landed.select(*keys).where(F.col(period_col) < F.lit(open_from)).distinct()
    return wanted.join(done, on=keys, how="left_anti").select(*wanted.columns)


def land(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Write to Parquet and replace only the partitions that occur in `df`.

    The rebalance hint gathers each partition for few files, and lets Spark split one that is far larger
    than the others, by its measured size.
    """
    (
        df.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def upsert_latest(old: DataFrame, new: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The latest row per key over both tables; columns are unioned by name."""
    return dedup_latest(union_by_name(old, new), keys, order)


def upsert_partitions(
    spark: SparkSession, path: str, new: DataFrame, keys: list[str], order: list, partition_by: list[str]
) -> None:
    """Merge revised rows into a landed table and rewrite only the partitions they touch.

    `keys` must include the partition columns, so that a key never moves between partitions.
    """
    missing = [c for c in partition_by if c not in keys]
    if missing:
        raise ValueError(f"partition columns must be part of the key: {missing}")
    old = touched_partitions(spark.read.parquet(path), new, partition_by)
    land(upsert_latest(old, new, keys, order), path, partition_by)


LISTED_PARTITIONS = 1000


def touched_partitions(table: DataFrame, new: DataFrame, partition_by: list[str]) -> DataFrame:
    """The rows of a partitioned table that lie in the partitions of `new`.

    Up to LISTED_PARTITIONS partitions are listed: their values go into the filter, so that other folders
    are never opened, and their combinations are broadcast, so that the table is not shuffled. More are
    matched by an ordinary semi join.
    """
    touched = new.select(*partition_by).distinct()
    listed = touched.limit(LISTED_PARTITIONS + 1).collect()
    if len(listed) <= LISTED_PARTITIONS:
        touched = F.broadcast(new.sparkSession.createDataFrame(listed, touched.schema))
        for c in partition_by:
            values = {r[c] for r in listed}
            match = F.col(c).isin(*(values - {None}))
            table = table.where(match | F.col(c).isNull() if None in values else match)
        if len(partition_by) == 1:
            return table
    same = [F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in partition_by]
    return table.alias("old").join(touched.alias("new"), same, "left_semi")
