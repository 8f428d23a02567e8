"""Aggregates that carry a companion value, with stated NULL and tie rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def arg_min(arg: Column | str, val: Column | str, tie: Column | str) -> Column:
    """`arg` at the smallest `val`; rows with a NULL in either are skipped, the smallest `tie` wins."""
    arg, val = _col(arg), _col(val)
    return F.min_by(arg, F.when(arg.isNotNull() & val.isNotNull(), F.struct(val, _col(tie))))


def arg_max(arg: Column | str, val: Column | str, tie: Column | str) -> Column:
    """`arg` at the largest numeric `val`; rows with a NULL are skipped, the smallest `tie` wins."""
    arg, val = _col(arg), _col(val)
    return F.min_by(arg, F.when(arg.isNotNull() & val.isNotNull(), F.struct(-val, _col(tie))))


def last_by(val: Column | str, t: Column | str) -> Column:
    """The value at the greatest `t` among the rows where both are present."""
    val, t = _col(val), _col(t)
    return F.max_by(val, F.when(val.isNotNull(), t))


def any_present(c: Column | str) -> Column:
    """Any non-NULL value of the group."""
    return F.any_value(_col(c), F.lit(True))
