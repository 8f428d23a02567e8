"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def keep_all(left: DataFrame, right: DataFrame, key: str, where: Column | None = None) -> DataFrame:
    """Left outer join of a short table with a long one; `where` limits the right rows that match.

    The matches are an inner join, in which Spark may broadcast the short side or split a skewed key of
    the long one (a left outer join allows neither). Left rows without a match come from an anti join
    with the distinct keys of the long side. Join keys that are NULL match nothing.
    """
    right = right if where is None else right.where(where)
    matched = left.join(right, key)
    seen = right.select(key).distinct()
    lonely = left.join(seen, key, "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)


def lookup(facts: DataFrame, dim: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """Fact to dimension join on equal names, without a broadcast hint.

    Spark broadcasts the dimension where its measured size is below the session's threshold; beyond it
    the join sorts both sides, and adaptive execution splits partitions that are skewed.
    """
    return facts.join(dim, key, how)
