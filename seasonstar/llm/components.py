"""Connected components of a link table by rounds of hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seasonstar.llm.common import store


def components(links: DataFrame) -> DataFrame:
    """The smallest node that each linked node can reach, as node, root.

    `links` has columns a, b. In each round every node hooks to its smallest neighbour if that is smaller, chains of hooks
    are shortened until each node points to its root, and the links are redrawn between roots; roots without a link are
    done. The rest shrinks by at least half a round or so whatever the shape, a chain included. Hot nodes meet only in
    minima, which tasks take before the shuffle, and in joins whose larger side Spark can split.
    Every round's tables are written to the shared folder, so a lost executor costs no earlier round.
    """
    rest = store(links.select("a", "b").filter("a <> b").distinct(), "links")
    roots: DataFrame | None = None
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
        hooks = store(nearest.select("node", F.least("node", "near").alias("root")), "hooks")
        while True:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("top"))
            longer = hooks.join(up, "root")
            if longer.filter("top <> root").isEmpty():
                break
            hooks = store(longer.select("node", F.col("top").alias("root")), "hooks")
        if roots is None:
            roots = hooks
        else:
            up = hooks.select(F.col("node").alias("root"), F.col("root").alias("top"))
            roots = store(
                roots.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root")), "roots"
            )
        left = hooks.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = hooks.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        drawn = rest.join(left, "a").join(right, "b").filter("ra <> rb")
        drawn = drawn.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()
        rest = store(drawn, "links")
    if roots is None:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
