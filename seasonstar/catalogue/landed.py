"""Sources and sinks: tables derived from the test tables are landed in the shared folder and read back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonstar.catalogue.base import amounts, daily_orders, table
from seasonstar.catalogue.registry import query
from seasonstar.catalogue.sql_parts import with_parts
from seasonstar.functions.calendar import parse_day
from seasonstar.functions.numeric import to_units
from seasonstar.operators import quarantine
from seasonstar.operators.staging import dedup_latest, latest_first, series_from_array
from seasonstar.sources.incremental import land, upsert_partitions
from seasonstar.sources.manifest import IncrementalTable
from seasonstar.sources.readers import LOADED_AT, SOURCE_FILE, read_json, read_seed
from seasonstar.sources.scratch import scratch_path
from seasonstar.sources.snapshots import SnapshotTable
from seasonstar.streaming.landing import land_new_files, latest_landed

NO_DATA = -9999.0


def _schema(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


@query(
    """SELECT event_id, CAST(ts AS DATE) AS event_date, user_id, event_type, value, props, TRUE AS has_file FROM events"""
)
def landed_json_scan(spark, sf):
    """Events written as JSON lines and scanned with a declared schema and file lineage."""
    path = scratch_path(spark, "json")
    events = table(spark, sf, "events")
    events.withColumn("event_date", F.to_date("ts")).drop("ts").write.json(path)
    kinds = _schema("event_id bigint, user_id bigint, event_type string, value double, props string, event_date date")
    rows = read_json(spark, path, kinds, multiline=False)
    return rows.select(
        "event_id", "event_date", "user_id", "event_type", "value", "props",
        F.col(SOURCE_FILE).endswith(".json").alias("has_file"),
    )


@query("SELECT event_id, CASE WHEN event_id % 2 = 0 THEN value + 1 ELSE value - 1 END AS value FROM events")
def later_file_wins(spark, sf):
    """Events landed twice, half of them with a larger value the second time and half with a smaller one."""
    path = scratch_path(spark, "revised")
    events = table(spark, sf, "events").select("event_id", "value")
    revised = F.when(F.col("event_id") % 2 == 0, F.col("value") + 1).otherwise(F.col("value") - 1)
    events.write.json(path)
    events.withColumn("value", revised).write.mode("append").json(path)
    rows = read_json(spark, path, events.schema, multiline=False).select("event_id", "value", LOADED_AT)
    return dedup_latest(rows, ["event_id"], latest_first(rows, LOADED_AT)).drop(LOADED_AT)


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def seed_csv_scan(spark, sf):
    """Customers written as CSV with a header and read as a seed."""
    path = scratch_path(spark, "seed")
    customer = table(spark, sf, "customer")
    customer.write.option("header", True).csv(path)
    return read_seed(spark, path, customer.schema)


@query(
    with_parts(
        "amt",
        body="""SELECT station, obs_date, precip_mm FROM amt""",
    )
)
def landed_array_series(spark, sf):
    """One JSON object per station and year with a dense array (sentinel for missing days), unfolded again.

    An array is bounded by the 366 days of its year.
    """
    by_year = amounts(daily_orders(spark, sf)).groupBy("station", F.year("obs_date").alias("year")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.dayofyear("obs_date"), "precip_mm"))).alias("by_day")
    )
    first = F.make_date("year", F.lit(1), F.lit(1))
    n_days = F.datediff(F.make_date(F.col("year") + 1, F.lit(1), F.lit(1)), first)
    dense = F.transform(F.sequence(F.lit(1), n_days), lambda i: F.coalesce(F.try_element_at("by_day", i), F.lit(NO_DATA)))
    path = scratch_path(spark, "grid")
    by_year.select(
        "station", F.date_format(first, "dd.MM.yyyy HH:mm:ss").alias("StartDate"), F.lit(NO_DATA).alias("NoDataValue"),
        dense.alias("Data"),
    ).write.json(path)
    kinds = _schema("station string, StartDate string, NoDataValue double, Data array<double>")
    landed = read_json(spark, path, kinds, multiline=False)
    start = parse_day("StartDate", "dd.MM.yyyy HH:mm:ss")
    series = series_from_array(landed, ["station"], start, "Data", "precip_mm", "obs_date", F.col("NoDataValue"))
    return series.where(F.col("precip_mm").isNotNull())


@query(
    with_parts(
        "amt",
        body="""SELECT area_code, CAST(year(obs_date) AS INTEGER) AS year, station, obs_date,
                       CASE WHEN year(obs_date) >= 2001 THEN precip_mm + 1 ELSE precip_mm END AS precip_mm
                FROM amt""",
    )
)
def landed_partitions(spark, sf):
    """Daily amounts landed per area and year; the open year arrives again, revised, and replaces itself."""
    path = scratch_path(spark, "land")
    keys = ["area_code", "year"]
    rows = amounts(daily_orders(spark, sf)).select(
        "area_code", F.year("obs_date").alias("year"), "station", "obs_date", "precip_mm"
    )
    land(rows, path, keys)
    landed = spark.read.parquet(path)
    land(landed.where("year >= 2001").withColumn("precip_mm", F.col("precip_mm") + 1), path, keys)
    return spark.read.parquet(path)


@query(
    """SELECT CAST(ts AS DATE) AS event_date, user_id, event_id, event_type, value
       FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                                  ORDER BY event_type = 'click' DESC, event_id DESC) = 1"""
)
def landed_upsert(spark, sf):
    """Clicks arrive later and win over older rows of their user and day; only their days are rewritten."""
    path = scratch_path(spark, "upsert")
    events = table(spark, sf, "events").select(
        F.to_date("ts").alias("event_date"), "user_id", "event_id", "event_type", "value"
    )
    is_click = F.col("event_type").eqNullSafe("click")
    order = [is_click.desc(), F.col("event_id").desc()]
    keys = ["event_date", "user_id"]
    land(events.where(~is_click), path, ["event_date"])
    upsert_partitions(spark, path, events.where(is_click), keys, order, ["event_date"])
    return latest_landed(spark, path, keys, order).select("event_date", "user_id", "event_id", "event_type", "value")


@query(
    """SELECT user_id, CAST(ts AS DATE) AS event_date, event_id, event_type, value
       FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1"""
)
def stream_landing(spark, sf):
    """Two arrivals of files, each picked up once by an incremental stream; the latest row per key wins."""
    source, target, mark = (scratch_path(spark, n) for n in ("arrivals", "landed", "mark"))
    events = table(spark, sf, "events")
    is_click = F.col("event_type").eqNullSafe("click")
    for arrival in (~is_click, is_click):
        events.where(arrival).write.mode("append").parquet(source)
        land_new_files(spark, source, events.schema, target, mark, file_format="parquet")
    rows = spark.read.parquet(target).withColumn("event_date", F.to_date("ts"))
    order = [F.col("ts").desc_nulls_last(), F.col("event_id").desc()]
    return dedup_latest(rows, ["user_id", "event_date"], order).select(
        "user_id", "event_date", "event_id", "event_type", "value"
    )


@query(
    """SELECT CAST(ts AS DATE) AS event_date, user_id, event_id, event_type, value
       FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                                  ORDER BY event_type = 'click' DESC, event_id DESC) = 1"""
)
def snapshot_upsert(spark, sf):
    """Clicks merged into a versioned table by day, after a writer that died before its commit."""
    events = table(spark, sf, "events").select(
        F.to_date("ts").alias("event_date"), "user_id", "event_id", "event_type", "value"
    )
    is_click = F.col("event_type").eqNullSafe("click")
    order = [is_click.desc(), F.col("event_id").desc()]
    days = SnapshotTable(spark, scratch_path(spark, "days"), ["event_date"])
    days.upsert(events.where(~is_click), ["event_date", "user_id"], order)
    days.write(events.withColumn("value", F.lit(-1.0)), "never-finished")
    days.upsert(events.where(is_click), ["event_date", "user_id"], order)
    return days.read().select("event_date", "user_id", "event_id", "event_type", "value")


@query(
    """SELECT v.version, c_nationkey, CAST(count(*) AS BIGINT) AS n_customers,
              CAST(CASE WHEN v.version = 2 AND c_nationkey % 5 = 0 THEN 2 ELSE 1 END AS INTEGER) AS written_in
       FROM customer, (VALUES (1), (2)) v(version)
       WHERE v.version = 1 OR c_nationkey % 5 <> 0 OR c_custkey % 2 = 0
       GROUP BY v.version, c_nationkey"""
)
def snapshot_versions(spark, sf):
    """Customers by nation; a second version halves every fifth nation. Both versions stay readable."""
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nations = SnapshotTable(spark, scratch_path(spark, "nations"), ["c_nationkey"])
    nations.replace(customer)
    first = nations.partitions().select(F.lit(1).alias("version"), "c_nationkey", "written_in")
    fifth = F.col("c_nationkey") % 5 == 0
    nations.replace(customer.where(fifth & (F.col("c_custkey") % 2 == 0)), customer.where(fifth))
    wrote = first.union(nations.partitions().select(F.lit(2).alias("version"), "c_nationkey", "written_in"))
    rows = nations.read(1).withColumn("version", F.lit(1)).unionByName(nations.read(2).withColumn("version", F.lit(2)))
    counted = rows.groupBy("version", "c_nationkey").agg(F.count("*").alias("n_customers"))
    return counted.join(wrote, ["version", "c_nationkey"])


@query(
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(count(*) AS BIGINT) AS n_orders,
              CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)
                       + CASE WHEN year(o_orderdate) = 1999 AND o_orderkey % 10 = 0 THEN 100 ELSE 0 END) AS BIGINT) AS cents,
              CAST(CASE WHEN year(o_orderdate) = 1999 THEN 2 ELSE 1 END AS INTEGER) AS written_in
       FROM orders GROUP BY year(o_orderdate)"""
)
def incremental_refresh(spark, sf):
    """Orders landed by year as JSON lines; revisions of one year land later, and only that year is computed again."""
    landing = scratch_path(spark, "landing")
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_totalprice", F.year("o_orderdate").alias("folder")
    )
    kinds = orders.drop("folder").schema

    def rows(raw):
        return raw.select("o_orderkey", "o_totalprice", LOADED_AT, SOURCE_FILE, F.year("o_orderdate").alias("order_year"))

    years = IncrementalTable(
        spark, f"{landing}/*/*.json", scratch_path(spark, "years"),
        read=lambda paths: read_json(spark, paths, kinds, multiline=False), rows=rows, period="order_year",
        keys=["order_year", "o_orderkey"], order=[F.col(LOADED_AT).desc(), F.col("o_totalprice")],
    )
    orders.write.partitionBy("folder").json(landing)
    years.refresh()
    revised = orders.where("folder = 1999 and o_orderkey % 10 = 0").withColumn("o_totalprice", F.col("o_totalprice") + 1)
    revised.write.mode("append").partitionBy("folder").json(landing)
    years.refresh()
    sums = years.table().groupBy("order_year").agg(F.count("*").alias("n_orders"), F.sum(to_units("o_totalprice", 2)).alias("cents"))
    return sums.join(years.facts.partitions().select("order_year", "written_in"), "order_year")


@query(
    """WITH r AS (SELECT o_orderkey % 50 AS damage, CAST(o_orderdate AS DATE) AS d,
                         1 + o_orderkey % 3 - CASE WHEN o_orderkey % 50 = 3 THEN 1 ELSE 0 END AS n FROM orders),
            f AS (SELECT damage = 1 AS truncated, damage = 2 AS undated, damage IN (3, 4) AS wrong_step,
                         damage NOT IN (1, 2) AND d + CAST(n - 1 AS INTEGER) > DATE '2000-06-30' AS after_calendar FROM r),
            c AS (SELECT 'truncated' AS reason, count(*) FILTER (truncated) AS n_rows FROM f
                  UNION ALL SELECT 'undated', count(*) FILTER (undated) FROM f
                  UNION ALL SELECT 'wrong_step', count(*) FILTER (wrong_step) FROM f
                  UNION ALL SELECT 'after_calendar', count(*) FILTER (after_calendar) FROM f
                  UNION ALL SELECT 'none', count(*) FILTER (NOT (truncated OR undated OR wrong_step OR after_calendar)) FROM f)
       SELECT reason, n_rows, n_rows AS observed FROM c WHERE n_rows > 0"""
)
def quarantine_counts(spark, sf):
    """Orders landed as short series, some of them damaged: rows per reason, as stored and as observed while storing."""
    n = (1 + F.col("o_orderkey") % 3).cast("int")
    day, damage = F.to_date("o_orderdate"), F.col("o_orderkey") % 50
    pattern = "dd.MM.yyyy HH:mm:ss"
    start, end = (F.date_format(d, pattern) for d in (day, F.date_add(day, n - 1)))
    record = F.to_json(
        F.struct(
            F.when(damage == 2, "unknown").otherwise(start).alias("StartDate"), end.alias("EndDate"),
            F.when(damage == 4, 60).otherwise(1440).alias("TimeResolution"),
            F.array_repeat("o_totalprice", n - F.when(damage == 3, 1).otherwise(0)).alias("Data"),
        )
    )
    path = scratch_path(spark, "damaged")
    table(spark, sf, "orders").select(F.when(damage == 1, F.left(record, F.length(record) / 2)).otherwise(record)).write.text(path)
    kinds = _schema("StartDate string, EndDate string, TimeResolution int, Data array<double>")
    routed = quarantine.route(
        read_json(spark, path, kinds, multiline=False), quarantine.series_rules(pattern, date(2000, 6, 30), step=1440)
    )
    kept = routed.data.agg(F.lit("none").alias("reason"), F.count("*").alias("n_rows"))
    stored = quarantine.counts_table(routed.rejected).union(kept)
    seen = routed.counts | {"none": routed.n_rows - routed.n_rejected}
    observed = F.create_map(*(F.lit(x) for pair in seen.items() for x in pair))
    return stored.where("n_rows > 0").withColumn("observed", observed[F.col("reason")].cast("long"))
