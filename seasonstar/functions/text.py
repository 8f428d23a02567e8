"""Text, array and code helpers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def area_code(kind: Column | str, nr: Column | str, mapping: Mapping[str, str]) -> Column:
    """Readable code for a (kind, number) pair.

    `mapping` gives one text per kind; `{nr}` in it stands for the number. Other kinds give NULL.
    """
    kind, nr = _col(kind), _col(nr)
    out = None
    for value, text in mapping.items():
        head, mark, tail = text.partition("{nr}")
        code = F.concat(F.lit(head), nr.cast("string"), F.lit(tail)) if mark else F.lit(text)
        out = F.when(kind == value, code) if out is None else out.when(kind == value, code)
    return out


def register_area_code(spark: SparkSession, mapping: Mapping[str, str], name: str = "area_code") -> None:
    """The same mapping as a temporary SQL function, which Spark inlines into the query."""
    branches = []
    for kind, text in mapping.items():
        head, mark, tail = text.partition("{nr}")
        code = f"concat({_quoted(head)}, nr, {_quoted(tail)})" if mark else _quoted(text)
        branches.append(f"WHEN kind = {_quoted(kind)} THEN {code}")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(kind STRING, nr INT) RETURNS STRING "
        f"RETURN CASE {' '.join(branches)} END"
    )


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def part_of(c: Column | str, sep: str, n: int) -> Column:
    """The n-th part (1-based) of a separated text, empty when there are fewer parts."""
    return F.split_part(_col(c), F.lit(sep), F.lit(n))


def pick(arr: Column | str, n: int) -> Column:
    """The n-th element (1-based) of an array, NULL beyond its end."""
    return F.get(_col(arr), F.lit(n - 1))
