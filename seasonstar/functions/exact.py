"""Sums and means of doubles that are exact until they are rounded once, whatever the order of rows.

A double is a whole number of 2^LOWEST steps as long as it has no bit below that place. Its absolute value is cut into lanes
of LANE_BITS bits at fixed places; the lanes, with its sign, are summed as longs, which is exact and stays in
whole-stage codegen with map-side combining. Only the sums of a group are put together, as one decimal of more than 70
bits and a bit for whatever lies below, and rounded to the nearest double. No number of digits has to be given.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from seasonstar.functions.numeric import round_half_away

#: Bits of a lane: a long holds the sum of 2^39 of them, and an overflow raises. Places of the lowest and above the highest bit.
LANE_BITS, LOWEST, HIGHEST = 24, -192, 120

_STARTS = range(LOWEST, HIGHEST, LANE_BITS)
_WIDE = "decimal(38,0)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _below(size: Column, place: int) -> Column:
    """What a value has below a place; the remainder of doubles is exact."""
    return size % F.lit(2.0**place)


def _lane(c: Column, start: int) -> Column:
    size = F.abs(c)
    part = _below(size, start + LANE_BITS) - _below(size, start)
    return (F.signum(c) * part * F.lit(2.0**-start)).cast("long")


def _carried(sums: Column) -> Column:
    """Lanes with carries moved up, the lowest first, and what is left above; all but the last are 0 to 2^LANE_BITS - 1."""
    zero = F.struct(F.lit(0).cast("long").alias("up"), F.array().cast("array<long>").alias("lanes"))

    def step(acc: Column, lane: Column) -> Column:
        t = lane + acc["up"]
        low = t.bitwiseAND(F.lit((1 << LANE_BITS) - 1).cast("long"))
        return F.struct(F.shiftright(t, LANE_BITS).alias("up"), F.concat(acc["lanes"], F.array(low)).alias("lanes"))

    return F.aggregate(sums, zero, step, lambda acc: F.concat(acc["lanes"], F.array(acc["up"])))


def _nearest(lanes: Column) -> Column:
    """The double nearest to carried lanes of a sum that is not negative."""
    zero = F.struct(F.lit(0).cast(_WIDE).alias("head"), F.lit(LOWEST + LANE_BITS * len(_STARTS)).alias("place"), F.lit(0).alias("rest"))

    def step(acc: Column, lane: Column) -> Column:
        room = acc["head"] < F.lit(Decimal(1 << 72)).cast(_WIDE)
        head = F.when(room, (acc["head"] * F.lit(1 << LANE_BITS).cast("decimal(8,0)")).cast(_WIDE) + lane.cast("decimal(19,0)")).otherwise(acc["head"])
        return F.struct(
            head.cast(_WIDE).alias("head"), F.when(room, acc["place"] - LANE_BITS).otherwise(acc["place"]).alias("place"),
            F.when(room | (lane == 0), acc["rest"]).otherwise(F.lit(1)).alias("rest"),
        )

    def whole(acc: Column) -> Column:
        head = (acc["head"] * F.lit(2).cast("decimal(1,0)")).cast(_WIDE) + acc["rest"].cast("decimal(1,0)")
        return head.cast("double") * F.pow(F.lit(2.0), acc["place"] + LANE_BITS - 1)

    return F.aggregate(F.reverse(lanes), zero, step, whole)


def exact_total(c: Column | str) -> Column:
    """Aggregate: the double nearest to the exact sum of the stored values; NULL without any.

    With NaN or infinite values the result is NaN or infinite as in a plain sum. Values of 2^HIGHEST or more, or with a
    bit below 2^LOWEST (of amounts, only those below 1e-41 can have one), raise an error: none is ever cut.
    """
    c = _col(c).cast("double")
    finite = F.abs(c) < F.lit(float("inf"))
    held = F.when(finite, c)
    sums = F.array(*[F.coalesce(F.sum(_lane(held, start)), F.lit(0).cast("long")) for start in _STARTS])
    lanes = _carried(sums)
    negative = F.element_at(lanes, -1) < 0
    other = _carried(F.transform(sums, lambda s: -s))
    total = F.when(negative, -_nearest(other)).otherwise(_nearest(lanes))
    outside = F.count_if(finite & ((F.abs(c) >= F.lit(2.0**HIGHEST)) | (_below(F.abs(c), LOWEST) != 0)))
    failed = F.raise_error(F.lit("a value has bits that an exact sum does not hold")).cast("double")
    return (
        F.when(F.count(c) == 0, F.lit(None).cast("double"))
        .when(F.count_if(~finite) > 0, F.sum(F.when(~finite, c)))
        .when(outside > 0, failed)
        .otherwise(total)
    )


def exact_average(c: Column | str) -> Column:
    """Aggregate: `exact_total` divided by the number of non-NULL values."""
    return exact_total(c) / F.nullif(F.count(_col(c)), F.lit(0).cast("long"))


def rounded_total(c: Column | str, digits: int) -> Column:
    """Aggregate: `exact_total`, rounded half away from zero."""
    return round_half_away(exact_total(c), digits)


def dot(x: Column | str, w: Column | str) -> Column:
    """Aggregate: the exact sum of the rounded products."""
    return exact_total(_col(x) * _col(w))


def weighted_average(x: Column | str, w: Column | str) -> Column:
    """Aggregate: sum(x·w) / sum(w) over the rows where both are present; NULL where the weights add up to 0."""
    x, w = _col(x), _col(w)
    both = reduce(Column.__and__, (x.isNotNull(), w.isNotNull()))
    return dot(F.when(both, x), w) / F.nullif(exact_total(F.when(both, w)), F.lit(0.0))
