"""Time-series operators on tables with one row per entity and date.

An entity has at most one row per calendar day (36,525 in a century), however many raw rows it has, as
the raw rows are aggregated before. A window per entity is bounded by the calendar, therefore.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonstar.functions.numeric import from_units, pct_change, round_half_away, to_units


def gap_safe_diff(
    df: DataFrame, keys: list[str], t: str, x: str, step_days: int, n: int = 2, out: str = "change_pp",
    bucket_days: int | None = None,
) -> DataFrame:
    """Change since the previous row, only where that row is exactly `step_days` earlier.

    With `bucket_days` the series of one entity is cut into stretches of that many days, and the last
    `step_days` of a stretch are copied into the next as context: same result, and no entity has to fit
    in one task. Needs `bucket_days >= step_days`.
    """
    if bucket_days is None:
        w = Window.partitionBy(*keys).orderBy(t)
        return df.withColumn(out, _step_change(F.col(t), F.col(x), w, step_days, n))
    if bucket_days < step_days:
        raise ValueError("bucket_days must be at least step_days")
    day = F.unix_date(F.col(t))
    bucket = F.floor(day / bucket_days).cast("long")
    near_end = F.floor((day + step_days) / bucket_days).cast("long")
    spread = df.withColumn("_bucket", F.explode(F.array_distinct(F.array(bucket, near_end))))
    w = Window.partitionBy(*keys, "_bucket").orderBy(t)
    changed = spread.withColumn(out, _step_change(F.col(t), F.col(x), w, step_days, n))
    return changed.where(F.col("_bucket") == bucket).drop("_bucket")


def _step_change(t: Column, x: Column, w, step_days: int, n: int) -> Column:
    on_step = F.datediff(t, F.lag(t).over(w)) == step_days
    return F.when(on_step, round_half_away(x - F.lag(x).over(w), n))


def lag_diff(
    df: DataFrame, keys: list[str], t: str, x: str, n: int, out: str, max_span_days: int | None = None
) -> DataFrame:
    """Difference to the n-th row before, whatever its date; `max_span_days` sets a limit on the span."""
    w = Window.partitionBy(*keys).orderBy(t)
    diff = F.col(x) - F.lag(x, n).over(w)
    if max_span_days is not None:
        diff = F.when(F.datediff(F.col(t), F.lag(t, n).over(w)) <= max_span_days, diff)
    return df.withColumn(out, diff)


def rolling_sum(
    df: DataFrame, keys: list[str], t: str, x: str, n: int, out: str, scale: int = 2, min_periods: int = 1
) -> DataFrame:
    """Sum over the row and the n-1 rows before it. NULLs are skipped; early rows have partial sums.

    `scale` is the number of digits the values carry. Rows with fewer than `min_periods` rows in reach
    get NULL.
    """
    w = Window.partitionBy(*keys).orderBy(t).rowsBetween(-(n - 1), 0)
    total = from_units(F.sum(to_units(x, scale)).over(w), scale)
    if min_periods > 1:
        total = F.when(F.count(F.lit(1)).over(w) >= min_periods, total)
    return df.withColumn(out, total)


def prior_period(
    df: DataFrame, keys: list[str], year_col: str, cols: list[str], n: int = 1, suffix: str = "_prev_year"
) -> DataFrame:
    """The value of the same key `n` years before, NULL where that year is absent.

    `keys` holds the entity and the position in the year (ISO week). A RANGE frame of exactly `n` years
    back finds the row without a self-join: one pass, and a group has one row per year.
    """
    w = Window.partitionBy(*keys).orderBy(year_col).rangeBetween(-n, -n)
    return df.withColumns({c + suffix: F.first(c).over(w) for c in cols})


def prior_lookup(
    df: DataFrame, keys: list[str], year_col: str, cols: list[str], n: int = 1, suffix: str = "_prev_year"
) -> DataFrame:
    """Table of (keys, year) with the values of that year and of `n` years before, for a join.

    Unlike `prior_period` it also has the years in which only the earlier value exists. Every row is sent
    once to its own year and once `n` years ahead, and the two meet in one aggregation.
    """
    kinds = {c: df.schema[c].dataType for c in cols}
    empty = {c: F.lit(None).cast(kinds[c]) for c in cols}
    own = F.struct(
        F.col(year_col).alias(year_col), *[F.col(c).alias(c) for c in cols], *[empty[c].alias(c + suffix) for c in cols]
    )
    ahead = F.struct(
        (F.col(year_col) + n).alias(year_col), *[empty[c].alias(c) for c in cols], *[F.col(c).alias(c + suffix) for c in cols]
    )
    sent = df.select(*keys, F.inline(F.array(own, ahead)))
    return sent.groupBy(*keys, year_col).agg(*[F.max(c).alias(c) for x in cols for c in (x, x + suffix)])


def same_period_last_year(
    df: DataFrame, keys: list[str], date_col: str, cols: list[str], suffix: str = "_prev_year"
) -> DataFrame:
    """The value on the same calendar date one year before; 29 February looks at 28 February.

    Groups are entity and day of the year, one year back is a RANGE frame; the 29 February is grouped
    with the 28th and never serves as the earlier value.
    """
    d = F.col(date_col)
    leap_day = (F.month(d) == 2) & (F.dayofmonth(d) == 29)
    marked = df.withColumns(
        {
            "_leap": leap_day,
            "_year": F.year(d),
            "_month": F.month(d),
            "_day": F.when(leap_day, 28).otherwise(F.dayofmonth(d)),
        }
    )
    w = Window.partitionBy(*keys, "_month", "_day").orderBy("_year").rangeBetween(-1, -1)
    earlier = {c + suffix: F.max(F.when(~F.col("_leap"), F.col(c))).over(w) for c in cols}
    return marked.withColumns(earlier).drop("_leap", "_year", "_month", "_day")


def yoy_by_lag(
    df: DataFrame, keys: list[str], year_col: str, col: str, digits: int = 1,
    prev: str | None = None, diff: str | None = None, pct: str | None = None,
) -> DataFrame:
    """Previous available year: its value, the difference and the percent change.

    Unlike `prior_period` a missing year is skipped. Pass a name to get a column; with none given all
    three are added as `<col>_prev`, `<col>_yoy` and `<col>_yoy_pct`.
    """
    if prev is diff is pct is None:
        prev, diff, pct = f"{col}_prev", f"{col}_yoy", f"{col}_yoy_pct"
    w = Window.partitionBy(*keys).orderBy(year_col)
    before = F.lag(col).over(w)
    new = {}
    if prev:
        new[prev] = before
    if diff:
        new[diff] = round_half_away(F.col(col) - before, digits)
    if pct:
        new[pct] = round_half_away(pct_change(F.col(col), before), digits)
    return df.withColumns(new)


def period_normal(
    df: DataFrame, by: list[str], x: str, complete: Column, out: str = "normal_mm", scale: int = 1, digits: int = 1
) -> DataFrame:
    """Mean of `x` over the complete rows of each group, on every row of the group."""
    w = Window.partitionBy(*by)
    kept = F.when(complete, F.col(x))
    count = F.count(kept).over(w)
    total = from_units(F.sum(to_units(kept, scale)).over(w), scale)
    return df.withColumn(out, round_half_away(total / F.nullif(count, F.lit(0).cast("long")), digits))


def ytd_filter(df: DataFrame, date_col: str, last_day: DataFrame | None = None, cutoff: str = "day_of_year") -> DataFrame:
    """Keep of every year only the days up to the position of the last date.

    The last date is that of `last_day` (one row, one column) or of `df`, read as a scalar subquery.
    `cutoff="month_day"` compares month and day, so a leap day does not move the limit.
    """
    if cutoff not in ("day_of_year", "month_day"):
        raise ValueError(f"unknown cutoff: {cutoff}")

    def position(d: Column) -> Column:
        return F.dayofyear(d) if cutoff == "day_of_year" else F.month(d) * 100 + F.dayofmonth(d)

    last = df.select(F.max(date_col)) if last_day is None else last_day
    return df.where(position(F.col(date_col)) <= position(last.scalar()))


def ytd_to(
    df: DataFrame, keys: list[str], date_col: str, x: str, cutoff: str = "day_of_year",
    out: str = "ytd", scale: int = 2, last_day: DataFrame | None = None,
) -> DataFrame:
    """Sum per key and year up to the position of the last date in the data."""
    kept = ytd_filter(df, date_col, last_day, cutoff)
    return kept.groupBy(*keys, F.year(date_col).alias("year")).agg(
        from_units(F.sum(to_units(x, scale)), scale).alias(out)
    )
