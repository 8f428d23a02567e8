"""Ranks and running sums in groups too large for one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonstar.sources.scratch import freeze

_PART, _N, _BEFORE, _INSIDE = "_part", "_n", "_before", "_inside"


def _same(left: DataFrame, right: DataFrame, columns: dict[str, str]) -> Column:
    return reduce(Column.__and__, (left[a].eqNullSafe(right[b]) for a, b in columns.items()), F.lit(True))


def _counts_before(values: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The sum of `_n` over the rows before each row of its key in `order` (total within a key), as `_before`.

    Rows are dealt by ranges of key and order, so a large key lies in many parts. Each part adds up its own rows; what lies
    in the parts before is added from one row per key and part. Where a part begins must not change between the
    two uses, so the parts are frozen.
    """
    placed = freeze(values.repartitionByRange(*keys, *order).withColumn(_PART, F.spark_partition_id()), "ranges")
    inside = Window.partitionBy(_PART, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    earlier = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy(_PART, *keys).agg(F.sum(_N).alias(_N))
    parts = parts.select(
        F.col(_PART).alias("_of"), *(F.col(k).alias(f"_key_{k}") for k in keys), F.sum(_N).over(earlier).alias(_BEFORE)
    )
    rows = placed.withColumn(_INSIDE, F.sum(_N).over(inside))
    joined = rows.join(parts, _same(rows, parts, {_PART: "_of"} | {k: f"_key_{k}" for k in keys}))
    zero = F.lit(0).cast("long")
    return joined.select(*values.columns, (F.coalesce(_INSIDE, zero) + F.coalesce(_BEFORE, zero)).alias(_BEFORE))


def rank_in_parts(df: DataFrame, keys: list[str], by: str, name: str, descending: bool = True, dense: bool = False) -> DataFrame:
    """Add `rank()` (or `dense_rank()`) of `by` within `keys`, NULLs last, without a window over a whole key.

    Rows with equal values share a rank, so values are counted first: each task sends a value once, however often it
    stands there. The distinct values are ranked in ranges and looked up by the rows; that join splits hot values (AQE), or
    broadcasts the ranks where they are few. A null key is a key. `name` must not be a column of `df`.
    """
    if name in df.columns:
        raise ValueError(f"{name} is a column already")
    order = F.col(by).desc_nulls_last() if descending else F.col(by).asc_nulls_last()
    values = df.groupBy(*keys, by).agg((F.lit(1).cast("long") if dense else F.count("*")).alias(_N))
    ranks = _counts_before(values, keys, [order])
    ranks = ranks.select(*(F.col(c).alias(f"_rank_{c}") for c in [*keys, by]), (F.col(_BEFORE) + 1).alias(name))
    joined = df.join(ranks, _same(df, ranks, {c: f"_rank_{c}" for c in [*keys, by]}))
    return joined.select(*(df[c] for c in df.columns), name)


def top_in_parts(df: DataFrame, keys: list[str], by: str, k: int, name: str = "rank", descending: bool = True) -> DataFrame:
    """The rows whose rank is `k` or better, ties included, with their rank."""
    return rank_in_parts(df, keys, by, name, descending).where(F.col(name) <= k)


def running_sum_in_parts(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """Add the sum of the whole-number column `value` up to and including each row, in `order` within `keys`.

    Rows with equal `order` count one after the other in the order of all other columns; NULLs come first and count
    as 0. Parts of a key are summed by different tasks.
    """
    ties = [F.col(c) for c in sorted(set(df.columns) - set(order) - set(keys))]
    zero = F.lit(0).cast("long")
    rows = df.withColumn(_N, F.coalesce(F.col(value).cast("long"), zero))
    summed = _counts_before(rows, keys, [*(F.col(c).asc_nulls_first() for c in order), *ties])
    return summed.select(*df.columns, (F.col(_BEFORE) + F.col(_N)).alias(name))
