"""Mixing sources to target weights by weighted fair queueing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seasonstar.llm.common import WORD, fresh, store

#: Virtual time is cut into so many buckets a unit; all targets are served at time 1.
BUCKETS = 2048


def targets(sizes: DataFrame, weights: Sequence[int], share: tuple[int, int], most: int) -> DataFrame:
    """Target size of each source.

    Sources by code point, null last, take the weights in turn and share `share[0] / share[1]` of all sizes; a target stops
    at `most` times its source's size and the excess is shared by weight among the others until none is above. Sources
    are sorted by size per weight, so those that stop come first and one pass finds where that ends. All sums are
    exact integers (in units of 1 / share[1]); one row per source is sorted in one task.
    """
    up, down = share
    order = Window.orderBy(F.col("source").asc_nulls_last())
    source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    listed = source.withColumn("source_no", F.row_number().over(order)).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") - 1) % len(weights) + 1).cast("long")
    )
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), "source_no")
    so_far, every = by_room.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy()
    cap = F.col("source_size") * (most * down)
    filled = (
        listed.withColumn("place", F.row_number().over(by_room))
        .withColumn("rest", F.sum("source_size").over(every) * up - F.sum(cap).over(so_far) + cap)
        .withColumn("rest_weight", F.sum("weight").over(every) - F.sum("weight").over(so_far) + F.col("weight"))
        .withColumn("open", cap * F.col("rest_weight") > F.col("rest") * F.col("weight"))
        .withColumn("first", F.min(F.when(F.col("open"), F.struct("place", "rest", "rest_weight"))).over(every))
    )
    shared = (F.col("first.rest") * F.col("weight")).cast("double") / (F.col("first.rest_weight") * down)
    full = F.col("source_size").cast("double") * most
    target = F.when(F.col("place") >= F.col("first.place"), shared).otherwise(full)
    return filled.select("source", "source_no", "source_size", target.alias("target"))


def _bucket(finish: Column) -> Column:
    """Place of a finish time in an ordered set of buckets: even up to time 2, in growing steps beyond."""
    late = F.floor(F.log2(finish / 2) * 64) + (2 * BUCKETS + 1)
    return F.when(finish <= 2, F.floor(finish * BUCKETS)).otherwise(late)


def mix(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: tuple[int, int] = (3, 2), most: int = 2, seed: str = "mix"
) -> DataFrame:
    """How many words a mix takes of each document, as `decide` says, without the hash of the text."""
    return decide(docs, weights, share, most, seed).drop("text_hash")


def decide(
    docs: DataFrame, weights: Sequence[int] = (3, 1, 2), share: tuple[int, int] = (3, 2), most: int = 2, seed: str = "mix"
) -> DataFrame:
    """How many words a mix takes of each document: one row per row of `docs`.

    Size is the number of words. Within its source a document's place is a hash of seed and `doc_id`; its virtual finish
    time is the words of its source up to and with it, over its source's target. The source may be gone through `most`
    times, each round after the other. All these passes are put in order of finish time (then source, round, hash) and
    taken, whole, as long as their words together stay within the budget.

    The sums within a source are taken per block of hashes first, so a source with a third of all rows is spread over
    4096 blocks; the order is cut into buckets of virtual time, which hold about equally many words, and only the bucket
    with the end of the budget is sorted.

    `docs` needs `doc_id`, `text`, `source`. A null or blank text has size 0 and is not taken. A null source is a source,
    the last; a null `doc_id` is hashed as an empty one. Rows equal in `doc_id`, source and text are interchangeable. No
    rows give no rows. Result: doc_id, source, text_hash, size, source_size, target, taken.
    """
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    sizes = docs.select("doc_id", "source", F.xxhash64("text").alias("text_hash"), size.alias("size"), key.alias("key"))
    sizes = store(sizes.withColumn("block", F.substring("key", 1, 3)), "mix-sizes")

    source = targets(sizes, weights, share, most)
    blocks = sizes.groupBy("source", "block").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(Window.partitionBy("source_no").orderBy("block")) - F.col("words")
    blocks = blocks.withColumnRenamed("source", "of").join(source, F.col("of").eqNullSafe(F.col("source")))
    blocks = blocks.select(
        F.col("of"), F.col("block").alias("at"), "source_no", "source_size", "target", before.alias("before")
    )
    inner = Window.partitionBy("source_no", "block").orderBy("key", "doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, 0)
    placed = sizes.join(blocks, F.col("of").eqNullSafe(F.col("source")) & (F.col("at") == F.col("block")))
    placed = placed.withColumn("reached", F.col("before") + F.sum("size").over(inner))
    placed = store(placed.drop("of", "at", "before", "block"), "mix-placed")

    def finish(turn: Column) -> Column:
        return (F.col("source_size") * turn + F.col("reached")) / F.col("target")

    live = (F.col("size") > 0) & (F.col("target") > 0)
    turns = placed.filter(live).withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(most - 1))))
    turns = turns.withColumn("finish", finish(F.col("turn"))).withColumn("bucket", _bucket(F.col("finish")))
    budget = sizes.agg(F.floor(F.sum("size") * share[0] / share[1]).alias("n")).first()["n"] or 0
    upto = F.sum("words").over(Window.orderBy("bucket"))
    served = turns.groupBy("bucket").agg(F.sum("size").alias("words")).withColumn("upto", upto)
    end = served.filter(F.col("upto") > budget).orderBy("bucket").first()
    if end is None:
        taken = F.when(live, F.col("size") * most).otherwise(0)
        return placed.select("doc_id", "source", "text_hash", "size", "source_size", "target", taken.cast("long").alias("taken"))
    order = ("finish", "source_no", "turn", "key", "doc_id", "size")
    last = (
        turns.filter(F.col("bucket") == end["bucket"])
        .withColumn("upto", F.sum("size").over(Window.orderBy(*order)) + (end["upto"] - end["words"]))
        .filter(F.col("upto") <= budget)
        .select(F.struct(*order).alias("place"))
        .agg(F.max("place").alias("place"))
        .first()["place"]
    )

    def within(turn: int) -> Column:
        """Whether a pass ends before the end of the budget."""
        at, bucket = finish(F.lit(turn)), _bucket(finish(F.lit(turn)))
        if last is None:
            return bucket < end["bucket"]
        place = F.struct(at.alias("finish"), "source_no", F.lit(turn).alias("turn"), "key", "doc_id", "size")
        edge = F.struct(
            F.lit(last["finish"]).alias("finish"), F.lit(last["source_no"]).alias("source_no"),
            F.lit(last["turn"]).alias("turn"), F.lit(last["key"]).alias("key"),
            F.lit(last["doc_id"]).cast(placed.schema["doc_id"].dataType).alias("doc_id"),
            F.lit(last["size"]).cast("long").alias("size"),
        )
        return (bucket < end["bucket"]) | ((bucket == end["bucket"]) & (place <= edge))

    times = sum((F.when(within(t), 1).otherwise(0) for t in range(most)), F.lit(0))
    taken = F.when(live, F.col("size") * times).otherwise(0)
    return placed.select("doc_id", "source", "text_hash", "size", "source_size", "target", taken.cast("long").alias("taken"))


def apply_mix(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of `docs`, each as often as the mix takes it. Rows with the same `doc_id`, source and text get the larger number.

    Decisions without a hash of the text, as `mix` gives them, tell texts apart by their size only.
    """
    by_text = "text_hash" in decisions.columns
    size = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long")
    mark = F.xxhash64("text") if by_text else size
    times = F.floor(F.col("taken") / F.col("size")).cast("int")
    ids, sources, marks, n, copy = fresh(docs, "of_id", "of_source", "of_mark", "times", "copy")
    key = F.col("doc_id").alias(ids), F.col("source").alias(sources), F.col("text_hash" if by_text else "size").alias(marks)
    times = decisions.filter("taken > 0").groupBy(*key).agg(F.max(times).alias(n))
    same = docs["doc_id"].eqNullSafe(times[ids]) & docs["source"].eqNullSafe(times[sources]) & (mark == times[marks])
    out = docs.join(times, same).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n))))
    return out.select(*docs.columns)


#: The same mix as one SQL statement.
MIX_SQL = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
per_source AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
listed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS source_no FROM per_source),
weighed AS (
  SELECT *, [3, 1, 2][((source_no - 1) % 3 + 1)::INT] AS weight FROM listed),
ordered AS (
  SELECT *, row_number() OVER (ORDER BY source_size / weight, source_no) AS place FROM weighed),
rests AS (
  SELECT a.place, any_value(a.source_size) * 4 AS cap, any_value(a.weight) AS weight,
         (SELECT sum(source_size) FROM ordered) * 3 - coalesce(sum(b.source_size * 4) FILTER (b.place < a.place), 0) AS rest,
         sum(b.weight) FILTER (b.place >= a.place) AS rest_weight
  FROM ordered a, ordered b GROUP BY a.place),
edge AS (
  SELECT place, rest, rest_weight FROM rests WHERE cap * rest_weight > rest * weight ORDER BY place LIMIT 1),
targets AS (
  SELECT o.source, o.source_no, o.source_size,
         CASE WHEN o.place >= e.place THEN (e.rest * o.weight)::DOUBLE / (e.rest_weight * 2)::DOUBLE
              ELSE o.source_size * 2.0::DOUBLE END AS target
  FROM ordered o LEFT JOIN edge e ON true),
placed AS (
  SELECT s.doc_id, s.size, s.key, t.source_no, t.source_size, t.target,
         row_number() OVER () AS row_no,
         sum(s.size) OVER (PARTITION BY t.source_no ORDER BY s.key, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) AS reached
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
turns AS (
  SELECT *, (source_size * turn + reached)::DOUBLE / target AS finish
  FROM placed, (VALUES (0), (1)) v(turn) WHERE size > 0 AND target > 0),
summed AS (
  SELECT row_no, size,
         sum(size) OVER (ORDER BY finish, source_no, turn, key, doc_id, size) AS upto
  FROM turns),
taken AS (
  SELECT row_no, sum(size) AS taken FROM summed
  WHERE upto <= (SELECT floor(sum(size) * 3 / 2) FROM sizes) GROUP BY row_no)
SELECT p.doc_id, p.size, p.source_size, p.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM placed p LEFT JOIN taken t USING (row_no)
"""
