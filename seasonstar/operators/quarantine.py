"""Routing of damaged records: one pass sends each row to the data or, with its reasons, to the rejected rows."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from seasonstar.functions.calendar import parse_day
from seasonstar.sources.schemas import CORRUPT
from seasonstar.sources.scratch import scratch_path

REASONS = "_reasons"
_REJECTED = "_rejected"


class TooManyRejected(RuntimeError):
    """More rows were rejected than the caller allows; `routed` has them."""

    def __init__(self, routed: "Routed", limit: float):
        self.routed = routed
        found = ", ".join(f"{name} {n}" for name, n in sorted(routed.counts.items()) if n)
        super().__init__(f"{routed.n_rejected} of {routed.n_rows} rows rejected, more than {limit:.2%}: {found}")


@dataclass(frozen=True)
class Routed:
    """Both sides as stored, and what was counted while they were written."""

    data: DataFrame
    rejected: DataFrame
    counts: dict[str, int]
    n_rows: int
    n_rejected: int


def route(df: DataFrame, rules: Mapping[str, Column], limit: float | None = None) -> Routed:
    """Send rows that meet any of the rules to `rejected`, with the names of the rules they meet in `_reasons`.

    A rule that is NULL for a row is not met. The table is computed once: it is written to the shared folder in
    two parts, and the rows each rule met are counted on the way (`Observation`), so the counts need no pass of
    their own and both sides can be read any number of times. With `limit`, a larger share of rejected rows raises
    `TooManyRejected` before anything is built from the data; the stored rows can be looked at then.
    """
    clash = [c for c in df.columns if c in (REASONS, _REJECTED)]
    if clash:
        raise ValueError(f"reserved column names: {clash}")
    met = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    reasons = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in met.items()]))
    marked = df.withColumn(REASONS, reasons if met else F.array().cast("array<string>"))
    marked = marked.withColumn(_REJECTED, F.size(REASONS) > 0)
    seen = Observation()
    counts = [F.count_if(F.array_contains(REASONS, name)).alias(f"rule_{i}") for i, name in enumerate(met)]
    counted = marked.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(_REJECTED).alias("rejected"), *counts)
    path = scratch_path(df.sparkSession, "routed")
    counted.write.partitionBy(_REJECTED).parquet(path)
    stored = df.sparkSession.read.schema(marked.schema).parquet(path)
    routed = Routed(
        data=stored.where(~F.col(_REJECTED)).select(*df.columns),
        rejected=stored.where(_REJECTED).select(*df.columns, REASONS),
        counts={name: seen.get[f"rule_{i}"] for i, name in enumerate(met)},
        n_rows=seen.get["n"],
        n_rejected=seen.get["rejected"],
    )
    if limit is not None and routed.n_rejected > limit * routed.n_rows:
        raise TooManyRejected(routed, limit)
    return routed


def counts_table(routed: DataFrame) -> DataFrame:
    """reason and n_rows of rejected rows; a row with several reasons counts for each."""
    return routed.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(F.count("*").alias("n_rows"))


def series_rules(start_pattern: str, last_day: date, step: int, corrupt: str = CORRUPT) -> dict[str, Column]:
    """What may be wrong with a landed array series (StartDate, EndDate, TimeResolution in minutes, Data).

    truncated       the record could not be read
    undated         its first day is missing or no date
    wrong_step      its steps are not `step` minutes long, or its values are not one for each day up to EndDate
    after_calendar  its last value lies after the last day of the calendar
    """
    start, end = parse_day("StartDate", start_pattern), parse_day("EndDate", start_pattern)
    readable = F.col(corrupt).isNull()
    n_days = F.datediff(end, start) + 1
    last = F.date_add(start, F.size("Data") - 1)
    return {
        "truncated": ~readable,
        "undated": readable & start.isNull(),
        "wrong_step": readable & ((F.col("TimeResolution") != step) | (n_days != F.size("Data"))),
        "after_calendar": readable & (last > F.lit(last_day)),
    }
