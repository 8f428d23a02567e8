"""Sources, unions, joins, deduplication, keys and checks on whole tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonstar.catalogue.base import areas, daily_orders, frozen_days, levels, table
from seasonstar.catalogue.registry import query
from seasonstar.catalogue.sql_parts import with_parts
from seasonstar.functions.exact import rounded_total
from seasonstar.functions.numeric import exact_sum, from_units, sum_of_means, to_units
from seasonstar.operators import quality
from seasonstar.operators.dims import area_dim, surrogate_key as number_rows
from seasonstar.operators.joins import keep_all, lookup
from seasonstar.operators.ranks import rank_in_parts
from seasonstar.operators.serve import freshness_meta as freshness
from seasonstar.operators.staging import dedup_latest as latest, prefer_source
from seasonstar.sources.incremental import pending_partitions, period_end, upsert_latest as upsert, wanted_periods
from seasonstar.sources.readers import union_by_name as by_name

ALL_ROW = {"area_code": "ALL", "sort_order": -1}


@query("SELECT l_orderkey, CAST(SUM(l_quantity) AS DOUBLE) AS quantity FROM lineitem GROUP BY l_orderkey")
def sum_below_half(spark, sf):
    """Sums that end in .4996 round down: each line carries its share of 0.4996 besides its whole quantity."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", F.col("l_quantity").cast("double").alias("quantity"))
    shares = lines.join(lines.groupBy("l_orderkey").agg(F.count("*").alias("n")), "l_orderkey")
    value = F.col("quantity") + F.lit(0.4996) / F.col("n")
    return shares.groupBy("l_orderkey").agg(sum_of_means(value, 0).alias("quantity"))


@query(
    """SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment
       FROM customer
       UNION ALL BY NAME
       SELECT s_suppkey AS id, s_acctbal AS acctbal, s_name AS name, s_nationkey AS nationkey FROM supplier"""
)
def union_by_name(spark, sf):
    customer = table(spark, sf, "customer").toDF("id", "name", "nationkey", "acctbal", "segment")
    supplier = table(spark, sf, "supplier").toDF("id", "name", "nationkey", "acctbal")
    return by_name(customer, supplier.select("acctbal", "id", "nationkey", "name"))


def _parties(spark, sf):
    customer = table(spark, sf, "customer").select(
        F.lit("customer").alias("source"), F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("balance"), F.lit(None).cast("int").alias("quality_code"),
    )
    supplier = table(spark, sf, "supplier").select(
        F.lit("supplier").alias("source"), F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("balance"), F.lit(None).cast("int").alias("quality_code"),
    )
    return customer.unionByName(supplier)


_PARTIES_SQL = """
    SELECT 'customer' AS source, c_custkey AS id, c_nationkey AS nationkey, c_acctbal AS balance,
           CAST(NULL AS INTEGER) AS quality_code
    FROM customer
    UNION ALL SELECT 'supplier', s_suppkey, s_nationkey, s_acctbal, NULL FROM supplier"""


@query(_PARTIES_SQL)
def source_union(spark, sf):
    return _parties(spark, sf)


@query(_PARTIES_SQL)
def empty_source_union(spark, sf):
    parties = _parties(spark, sf)
    absent = spark.createDataFrame([], T.StructType([f for f in parties.schema.fields if f.name != "quality_code"]))
    return by_name(parties, absent)


@query(
    """SELECT row_number() OVER (ORDER BY sort_order, area_code) AS area_key, area_code, sort_order
       FROM (SELECT r_name AS area_code, r_regionkey AS sort_order FROM region UNION ALL SELECT 'ALL', -1)"""
)
def area_with_total(spark, sf):
    rows = table(spark, sf, "region").select(F.col("r_name").alias("area_code"), F.col("r_regionkey").alias("sort_order"))
    return area_dim(rows, ALL_ROW)


@query("SELECT row_number() OVER (ORDER BY n_name, n_nationkey) AS nation_key, n_nationkey, n_name FROM nation")
def surrogate_key(spark, sf):
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    return number_rows(nation, [F.col("n_name").asc_nulls_last(), F.col("n_nationkey")], "nation_key")


@query(
    """SELECT row_number() OVER (ORDER BY c_acctbal NULLS LAST, c_custkey) AS customer_key, c_custkey, c_acctbal
       FROM customer"""
)
def surrogate_key_large(spark, sf):
    customer = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return number_rows(customer, [F.col("c_acctbal").asc_nulls_last(), F.col("c_custkey")], "customer_key")


@query(
    """SELECT l_returnflag, l_linestatus, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price,
              CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty, COUNT(*) AS n_rows
       FROM lineitem GROUP BY ALL"""
)
def group_by_all(spark, sf):
    return table(spark, sf, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        exact_sum("l_extendedprice", 2).alias("sum_price"), exact_sum("l_quantity", 2).alias("sum_qty"),
        F.count("*").alias("n_rows"),
    )


@query(
    """SELECT r_name AS area_code, CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, COUNT(*) AS n_orders
       FROM orders, customer, nation, region
       WHERE o_custkey = c_custkey AND c_nationkey = n_nationkey AND n_regionkey = r_regionkey
       GROUP BY r_name"""
)
def star_join(spark, sf):
    """Orders are summed per customer first: the sums arrive already partitioned for the join."""
    per_customer = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.sum(to_units("o_totalprice", 2)).alias("cents"), F.count("*").alias("n"))
    )
    customer = table(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey"))
    named = lookup(lookup(per_customer, customer, "c_custkey"), areas(spark, sf), "n_nationkey")
    return named.groupBy("area_code").agg(
        from_units(F.sum("cents"), 2).alias("total"), F.sum("n").alias("n_orders")
    )


@query(
    """SELECT s.l_partkey, s.l_suppkey, s.qty, r.returned_qty, r.first_return
       FROM (SELECT l_partkey, l_suppkey, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS qty
             FROM lineitem GROUP BY ALL) s
       LEFT JOIN (SELECT l_partkey, l_suppkey, CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS returned_qty,
                         MIN(CAST(l_shipdate AS DATE)) AS first_return
                  FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL) r
              ON r.l_partkey = s.l_partkey AND r.l_suppkey = s.l_suppkey"""
)
def composite_key_join(spark, sf):
    """Both sides are summed per key pair first, so a frequent pair is one row on either side."""
    line = table(spark, sf, "lineitem")
    pair = ["l_partkey", "l_suppkey"]
    sold = line.groupBy(*pair).agg(exact_sum("l_quantity", 2).alias("qty"))
    returned = line.where(F.col("l_returnflag") == "R").groupBy(*pair).agg(
        exact_sum("l_quantity", 2).alias("returned_qty"), F.min(F.to_date("l_shipdate")).alias("first_return")
    )
    return lookup(sold, returned, pair, "left")


@query(
    """SELECT n_nationkey, n_name, c_custkey, c_acctbal
       FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal > 9900 AND c_mktsegment = 'BUILDING'"""
)
def area_left_station(spark, sf):
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    served = (F.col("c_acctbal") > 9900) & (F.col("c_mktsegment") == "BUILDING")
    return keep_all(nation, customer, "n_nationkey", served).select("n_nationkey", "n_name", "c_custkey", "c_acctbal")


@query(
    """SELECT MAX(CAST(o_orderdate AS DATE)) AS last_day, COUNT(*) AS n_orders FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"""
)
def semi_join_max(spark, sf):
    per_customer = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_orderdate").alias("last"), F.count("*").alias("n"))
    )
    segment = table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING").select("c_custkey")
    return lookup(per_customer, segment, "c_custkey", "left_semi").agg(
        F.to_date(F.max("last")).alias("last_day"), F.sum("n").alias("n_orders")
    )


@query(
    f"""WITH p AS (SELECT source, id, nationkey, source = 'customer' AND balance > 9900 AS is_primary
                   FROM ({_PARTIES_SQL}))
        SELECT source, id, nationkey, is_primary,
               is_primary OR nationkey NOT IN (SELECT nationkey FROM p WHERE is_primary) AS use_for_area
        FROM p"""
)
def fallback_source(spark, sf):
    primary = (F.col("source") == "customer") & (F.col("balance") > 9900)
    points = _parties(spark, sf).select("source", "id", "nationkey", primary.alias("is_primary"))
    return prefer_source(points, "nationkey", "is_primary")


@query(
    """SELECT user_id, event_date, event_id, ts, event_type, value FROM (
         SELECT *, CAST(ts AS DATE) AS event_date,
                row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
         FROM events) WHERE rn = 1"""
)
def dedup_latest(spark, sf):
    return latest(_dated_events(spark, sf), ["user_id", "event_date"], _newest())


def _newest():
    return [F.col("ts").desc_nulls_last(), F.col("event_id").desc_nulls_last()]


def _dated_events(spark, sf):
    return table(spark, sf, "events").select(
        "user_id", F.to_date("ts").alias("event_date"), "event_id", "ts", "event_type", "value"
    )


@query(
    """SELECT user_id, event_date, event_id, ts, event_type, value,
              CASE WHEN event_type = 'click' THEN 'revision' END AS batch
       FROM (SELECT *, CAST(ts AS DATE) AS event_date,
                    max(ts) OVER (PARTITION BY user_id, CAST(ts AS DATE)) AS newest FROM events)
       WHERE ts = newest
       QUALIFY event_id = max(event_id) OVER (PARTITION BY user_id, event_date)"""
)
def upsert_latest(spark, sf):
    """Clicks arrive as a later batch with one more column and replace older rows of their key."""
    events = _dated_events(spark, sf)
    is_click = F.col("event_type").eqNullSafe("click")
    revised = events.where(is_click).withColumn("batch", F.lit("revision"))
    return upsert(events.where(~is_click), revised, ["user_id", "event_date"], _newest())


@query(
    with_parts(
        "days",
        body="""SELECT n_name AS station, CAST(y AS INTEGER) AS year,
                       CASE WHEN y < 2002 THEN make_date(y, 12, 31) ELSE DATE '2002-06-30' END AS period_end
                FROM nation, range(1994, 2003) AS g(y)
                WHERE y >= 2001 OR NOT EXISTS (SELECT 1 FROM days WHERE station = n_name AND year(obs_date) = y)""",
    )
)
def incremental_pending(spark, sf):
    as_of = date(2002, 6, 30)
    stations = table(spark, sf, "nation").select(F.col("n_name").alias("station"))
    landed = daily_orders(spark, sf).select("station", F.year("obs_date").alias("year"))
    wanted = wanted_periods(stations, 1994, as_of)
    pending = pending_partitions(wanted, landed, ["station", "year"], "year", 2001)
    return pending.withColumn("period_end", period_end("year", as_of))


@query(
    """SELECT (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders) AS last_week_end,
              (SELECT MAX(CAST(ts AS DATE)) FROM events) AS last_precip_date, FALSE AS demo"""
)
def freshness_meta(spark, sf):
    orders = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("week_end_date"))
    events = table(spark, sf, "events").select(F.to_date("ts").alias("obs_date"))
    return freshness(orders, events, extra={"demo": False})


_COUNTED = ["customer", "orders", "lineitem", "events", "documents", "conversations"]


@query(" UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS n_rows FROM {t}" for t in _COUNTED))
def row_counts(spark, sf):
    return quality.row_counts({t: table(spark, sf, t) for t in _COUNTED})


@query(
    """SELECT user_id, CAST(ts AS DATE) AS event_date, COUNT(*) AS n_rows FROM events GROUP BY ALL HAVING COUNT(*) > 1"""
)
def dq_duplicates(spark, sf):
    return quality.duplicate_keys(_dated_events(spark, sf), ["user_id", "event_date"])


@query(
    with_parts(
        "levels",
        body="SELECT area_code, week_end_date, fill_pct FROM levels WHERE NOT fill_pct BETWEEN 20 AND 80",
    )
)
def dq_range(spark, sf):
    weeks = levels(daily_orders(spark, sf)).select("area_code", "week_end_date", "fill_pct")
    return quality.out_of_range(weeks, "fill_pct", 20.0, 80.0)


_GAPS_SQL = """
    SELECT station, gap_from, gap_to, CAST(date_diff('day', gap_from, gap_to) - 1 AS INTEGER) AS missing_steps
    FROM (SELECT station, obs_date AS gap_to, lag(obs_date) OVER (PARTITION BY station ORDER BY obs_date) AS gap_from
          FROM days)
    WHERE gap_to > gap_from + 1"""


@query(with_parts("days", body=_GAPS_SQL))
def dq_gaps(spark, sf):
    return quality.gaps(daily_orders(spark, sf), ["station"], "obs_date", 1)


@query(
    with_parts(
        "days",
        body=f"""SELECT 'gap' AS "check", '{{"station":"' || station || '","obs_date":"' || gap_to || '"}}' AS key,
                        CAST(missing_steps AS VARCHAR) AS detail
                 FROM ({_GAPS_SQL})
                 UNION ALL
                 SELECT 'after_calendar', '{{"station":"' || station || '","obs_date":"' || obs_date || '"}}',
                        CAST(obs_date AS VARCHAR)
                 FROM days WHERE obs_date > DATE '2000-12-31'
                 UNION ALL
                 SELECT 'range', '{{"station":"' || station || '","obs_date":"' || obs_date || '"}}',
                        'n_orders=' || n_orders
                 FROM days WHERE n_orders > 3""",
    )
)
def quality_report(spark, sf):
    days = frozen_days(spark, sf)
    return quality.quality_report(days, ["station"], {"n_orders": (1, 3)}, "obs_date", 1, date(2000, 12, 31))


@query(
    """SELECT l_suppkey, l_linenumber,
              round(CAST(sum(CAST(l_extendedprice / 3 * 1099511627776.0 AS HUGEINT)) AS DOUBLE) / 1099511627776.0, 4) AS total
       FROM lineitem GROUP BY l_suppkey, l_linenumber"""
)
def exact_sums(spark, sf):
    """Thirds of prices added exactly and rounded once; no digits are given for the values."""
    lines = table(spark, sf, "lineitem").groupBy("l_suppkey", "l_linenumber")
    return lines.agg(rounded_total(F.col("l_extendedprice") / 3, 4).alias("total"))


@query(
    """SELECT l_orderkey, l_linenumber, l_linestatus,
              rank() OVER (PARTITION BY l_linestatus ORDER BY l_extendedprice DESC) AS price_rank,
              dense_rank() OVER (ORDER BY l_quantity) AS quantity_rank
       FROM lineitem"""
)
def huge_group_ranks(spark, sf):
    """Ranks in groups that hold a half or all of the lines, made in parts."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus", "l_extendedprice", "l_quantity")
    ranked = rank_in_parts(lines, ["l_linestatus"], "l_extendedprice", "price_rank")
    ranked = rank_in_parts(ranked, [], "l_quantity", "quantity_rank", descending=False, dense=True)
    return ranked.drop("l_extendedprice", "l_quantity")
