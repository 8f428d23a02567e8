"""Rounding, guards, flags and reproducible sums.

Sums of doubles depend on the order in which partitions arrive. All sums and means here therefore add
whole units (value * 10^scale as a long): the result is the same for any partitioning, the aggregation
buffer stays a primitive long inside whole-stage codegen, and an overflow raises under ANSI mode
instead of giving a wrong number.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MEAN_SCALE = 9


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _units_of_magnitude(c: Column, n: int) -> Column:
    """|c| * 10^n rounded to a long, halves up: half of floor(2y) + 1, in which doubling is exact."""
    return F.shiftright(F.floor(F.abs(c) * (2.0 * 10**n)) + 1, 1)


def to_units(c: Column | str, scale: int) -> Column:
    """`c * 10^scale` as a long, halves rounded away from zero."""
    c = _col(c)
    return F.signum(c).cast("long") * _units_of_magnitude(c, scale)


def from_units(units: Column | str, scale: int) -> Column:
    return _col(units) / float(10**scale)


def round_half_away(c: Column | str, n: int) -> Column:
    """Round the binary value half away from zero.

    Spark's own `round` works on the decimal rendering of a double (1.005 -> 1.01 at two digits), while
    this rounds the stored value (1.005 is slightly below the half, so 1.0).
    """
    c = _col(c)
    return F.signum(c) * _units_of_magnitude(c, n) / float(10**n)


def pct_change(cur: Column | str, prev: Column | str) -> Column:
    """Percent change against `prev`; NULL where `prev` is NULL or 0. Not rounded."""
    return (_col(cur) / F.nullif(_col(prev), F.lit(0.0)) - 1) * F.lit(100.0)


def threshold_flag(c: Column | str, t: float) -> Column:
    """1 where `c >= t`, else 0 (also for NULL), so that SUM counts and AVG gives a share."""
    return F.when(_col(c) >= F.lit(t), 1).otherwise(0)


def sentinel_to_null(c: Column | str, sentinel) -> Column:
    """NULL where the value equals the sentinel; the sentinel may be a column (one per row)."""
    s = sentinel if isinstance(sentinel, Column) else F.lit(sentinel)
    return F.nullif(_col(c), s)


def clamp_floor(c: Column | str, lo: float) -> Column:
    """Raise values below `lo` to `lo`. NULL stays NULL (`greatest` alone would turn it into `lo`)."""
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(lo)))


def exact_sum(c: Column | str, scale: int) -> Column:
    """Aggregate: sum at a fixed number of digits, independent of row order."""
    return from_units(F.sum(to_units(c, scale)), scale)


def sum_of_means(c: Column | str, digits: int) -> Column:
    """Aggregate: rounded sum of computed values, such as means, that have no last digit.

    Each value counts as a decimal with MEAN_SCALE digits and the decimals are added exactly. A thousand
    of them are off by less than half of the sixth digit, so the sum is first freed of that error by
    rounding to six digits: thirds that add up to a half round as a half, and sums that lie further than
    that below a half round down.
    """
    total = F.sum(_col(c).cast(f"decimal(38,{MEAN_SCALE})"))
    return F.round(F.round(total, MEAN_SCALE - 3), digits).cast("double")


def exact_mean(c: Column | str, scale: int) -> Column:
    """Aggregate: `exact_sum` divided by the number of non-NULL values."""
    c = _col(c)
    return exact_sum(c, scale) / F.nullif(F.count(c), F.lit(0).cast("long"))


def weighted_mean(x: Column | str, w: Column | str, scale: int = 6) -> Column:
    """Aggregate: sum(x*w) / sum(w) over the rows where both are present."""
    x, w = _col(x), _col(w)
    both = x.isNotNull() & w.isNotNull()
    weight = exact_sum(F.when(both, w), scale)
    return exact_sum(F.when(both, x * w), scale) / F.nullif(weight, F.lit(0.0))
