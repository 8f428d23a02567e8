"""Projections, casts, scalar functions, date and array functions on whole tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from seasonstar.catalogue.base import FULL_DAYS, WET_AMOUNT, amounts, area_days, areas, daily_orders, levels, table
from seasonstar.catalogue.registry import query
from seasonstar.catalogue.sql_parts import with_parts
from seasonstar.fixed_values import MONTH_NAMES, MONTH_SHORT_NAMES, SEASONS
from seasonstar.functions.aggregates import any_present
from seasonstar.functions.calendar import (
    date_spine, dim_date as build_dim_date, hydro_year, iso_week_end, parse_day, season, utc_date,
)
from seasonstar.functions.numeric import clamp_floor as clamp
from seasonstar.functions.numeric import round_half_away, sentinel_to_null
from seasonstar.functions.text import area_code, part_of, pick, register_area_code
from seasonstar.operators.extremes import change_windows as windows
from seasonstar.operators.staging import nested_observations, series_from_array
from seasonstar.operators.rollups import daily_amount_fact

CODES = {"AFRICA": "NO{nr}", "ASIA": "NOR"}
SPINE_AS_OF = date(2001, 12, 31)


@query(
    """SELECT event_id, CAST(ts AS DATE) AS event_date, CAST(user_id AS INTEGER) AS user_id,
              CAST(value AS DOUBLE) AS value, event_type
       FROM events"""
)
def typed_events(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.to_date("ts").alias("event_date"), F.col("user_id").try_cast("int").alias("user_id"),
        F.col("value").try_cast("double").alias("value"), "event_type",
    )


@query(
    """SELECT l_orderkey, l_linenumber, ROUND(l_discount * 100 / 3, 0) AS r0, ROUND(l_discount * 100 / 3, 1) AS r1,
              ROUND(l_discount * 100 / 3, 2) AS r2, ROUND(l_tax * 100, 2) AS tax_pct
       FROM lineitem"""
)
def round_pct(spark, sf):
    third = F.col("l_discount") * 100 / 3
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", *[round_half_away(third, n).alias(f"r{n}") for n in (0, 1, 2)],
        round_half_away(F.col("l_tax") * 100, 2).alias("tax_pct"),
    )


@query(
    """SELECT c_custkey, CASE r_name WHEN 'AFRICA' THEN 'NO' || CAST(n_nationkey AS VARCHAR)
                                     WHEN 'ASIA' THEN 'NOR' END AS code
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
)
def area_code_map(spark, sf):
    named = table(spark, sf, "customer").join(areas(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
    return named.select("c_custkey", area_code("area_code", "n_nationkey", CODES).alias("code"))


@query(
    """SELECT c_custkey, CASE r_name WHEN 'AFRICA' THEN 'NO' || CAST(n_nationkey AS VARCHAR)
                                     WHEN 'ASIA' THEN 'NOR' END AS code
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
)
def area_code_in_sql(spark, sf):
    """The same mapping as a function of SQL users."""
    register_area_code(spark, CODES)
    named = table(spark, sf, "customer").join(areas(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
    return named.selectExpr("c_custkey", "area_code(area_code, n_nationkey) AS code")


@query(
    f"""SELECT d AS day,
              {SEASONS}[1 + CAST(floor((month(d) % 12) / 3) AS INTEGER)] AS season,
              CAST(year(d - INTERVAL 9 MONTH) AS INTEGER) AS hydro_year
       FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"""
)
def season_hydro_year(spark, sf):
    days = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select("day", season("day").alias("season"), hydro_year("day").alias("hydro_year"))


@query(
    with_parts(
        "amt",
        body="""SELECT CAST(strftime(obs_date, '%Y%m%d') AS INTEGER) AS date_key, station, area_code, obs_date,
                       precip_mm, is_wet_day FROM amt""",
    )
)
def wet_day_flag(spark, sf):
    days = amounts(daily_orders(spark, sf)).drop("is_wet_day")
    return daily_amount_fact(days, WET_AMOUNT)


@query(
    with_parts(
        "area_days",
        body="""SELECT area_code, CAST(year(obs_date) AS INTEGER) AS year, CAST(month(obs_date) AS INTEGER) AS month,
                       COUNT(*) AS days_with_data, COUNT(*) < 20 AS is_partial_month
                FROM area_days WHERE area_code <> 'ALL' GROUP BY ALL""",
    )
)
def monthly_partial(spark, sf):
    days = area_days(daily_orders(spark, sf), None)
    counted = days.groupBy("area_code", F.year("obs_date").alias("year"), F.month("obs_date").alias("month")).agg(
        F.count("*").alias("days_with_data")
    )
    return counted.withColumn("is_partial_month", F.col("days_with_data") < FULL_DAYS)


@query("SELECT event_id, event_type, value FROM events WHERE event_type IN ('click', 'view') AND value IS NOT NULL")
def filter_in(spark, sf):
    wanted = F.col("event_type").isin("click", "view") & F.col("value").isNotNull()
    return table(spark, sf, "events").select("event_id", "event_type", "value").where(wanted)


@query(
    """SELECT p_partkey, CASE WHEN p_type LIKE 'S%' THEN 'starts with S' WHEN p_type LIKE '%Y' THEN 'ends with Y'
                              ELSE 'other' END AS direction
       FROM part"""
)
def like_direction(spark, sf):
    kind = F.col("p_type")
    label = F.when(kind.startswith("S"), "starts with S").when(kind.endswith("Y"), "ends with Y").otherwise("other")
    return table(spark, sf, "part").select("p_partkey", label.alias("direction"))


@query(
    """SELECT strptime(strftime(o_orderdate, '%d.%m.%Y %H:%M:%S'), '%d.%m.%Y %H:%M:%S')::DATE AS start_date, o_orderkey
       FROM orders"""
)
def parse_start_date(spark, sf):
    text = F.date_format("o_orderdate", "dd.MM.yyyy HH:mm:ss")
    return table(spark, sf, "orders").select("o_orderkey", parse_day(text, "dd.MM.yyyy HH:mm:ss").alias("start_date"))


@query("SELECT event_id, CAST(ts AS DATE) AS obs_date FROM events", name="utc_date")
def utc_date_of_text(spark, sf):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z"))
    return table(spark, sf, "events").select("event_id", utc_date(text).alias("obs_date"))


@query("SELECT event_id, CAST(ts - INTERVAL 2 HOUR AS DATE) AS obs_date FROM events")
def utc_date_of_offset_text(spark, sf):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))
    return table(spark, sf, "events").select("event_id", utc_date(text).alias("obs_date"))


@query(
    with_parts(
        "levels",
        body="""SELECT area_code, week_end_date, m AS metric, week_end_date - 6 AS period_start,
                       CASE WHEN m = 'fill_4w' THEN week_end_date - 27 ELSE week_end_date - 6 END AS window_start
                FROM levels, (VALUES ('fill_1w'), ('fill_4w')) v(m)""",
    )
)
def change_windows(spark, sf):
    metric = F.explode(F.array(F.lit("fill_1w"), F.lit("fill_4w"))).alias("metric")
    weeks = levels(daily_orders(spark, sf)).select("area_code", "week_end_date", metric)
    return windows(weeks, "week_end_date")


@query(
    """SELECT vec_id, DATE '2020-01-01' + CAST(i - 1 AS INTEGER) AS obs_date, CAST(embedding[i] AS DOUBLE) AS value
       FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)"""
)
def array_series_unnest(spark, sf):
    rows = table(spark, sf, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))
    return series_from_array(rows, ["vec_id"], F.lit(date(2020, 1, 1)), "embedding", "value", "obs_date")


@query(
    """SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first_value, CAST(embedding[2] AS DOUBLE) AS second_value,
              CAST(embedding[100] AS DOUBLE) AS beyond_end
       FROM embeddings"""
)
def array_pick(spark, sf):
    return table(spark, sf, "embeddings").select(
        "vec_id", *[pick("embedding", n).cast("double").alias(name)
                    for n, name in ((1, "first_value"), (2, "second_value"), (100, "beyond_end"))],
    )


@query(
    """SELECT l_orderkey, l_linenumber, 'quantity' AS element, l_quantity AS value FROM lineitem
       WHERE l_linestatus = 'F' AND l_quantity >= 10
       UNION ALL
       SELECT l_orderkey, l_linenumber, 'tax', l_tax FROM lineitem WHERE l_linestatus = 'F' AND l_tax >= 10"""
)
def nested_obs_unnest(spark, sf):
    """Observations nested per line (built row by row, nothing is collected), then unnested by element."""
    def entry(element, value, offset):
        return F.struct(F.lit(element).alias("elementId"), F.col(value).alias("value"), offset.alias("timeOffset"))

    offset = F.col("l_linestatus")
    nested = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.array(
            entry("quantity", "l_quantity", offset), entry("price", "l_extendedprice", offset),
            entry("tax", "l_tax", offset),
        ).alias("observations"),
    )
    wanted = F.col("o.elementId").isin("quantity", "tax") & (F.col("o.timeOffset") == "F") & (F.col("o.value") >= 10)
    return nested_observations(nested, "observations", wanted).select(
        "l_orderkey", "l_linenumber", F.col("o.elementId").alias("element"), F.col("o.value").alias("value")
    )


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_props(spark, sf):
    parsed = F.from_json("props", "k int")
    return table(spark, sf, "events").select("event_id", parsed["k"].alias("k"))


@query("SELECT c_custkey, split_part(c_name, '#', 1) AS kind, split_part(c_name, '#', 2) AS number FROM customer")
def split_part_key(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", part_of("c_name", "#", 1).alias("kind"), part_of("c_name", "#", 2).alias("number")
    )


@query("SELECT l_orderkey, l_linenumber, NULLIF(l_discount, 0.0) AS discount FROM lineitem")
def sentinel_null(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", sentinel_to_null("l_discount", 0.0).alias("discount")
    )


@query(
    """SELECT l_returnflag, COUNT(*) FILTER (WHERE NULLIF(l_discount, 0.0) IS NULL) AS n_null, COUNT(*) AS n_rows
       FROM lineitem GROUP BY l_returnflag"""
)
def sentinel_null_counts(spark, sf):
    missing = sentinel_to_null("l_discount", 0.0).isNull()
    return table(spark, sf, "lineitem").groupBy("l_returnflag").agg(
        F.count_if(missing).alias("n_null"), F.count("*").alias("n_rows")
    )


@query("SELECT c_custkey, CASE WHEN c_acctbal IS NOT NULL THEN GREATEST(c_acctbal, 0) END AS balance FROM customer")
def clamp_floor(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", clamp("c_acctbal", 0.0).alias("balance"))


@query(
    """SELECT c_nationkey, MIN(n_name) AS nation_name, COUNT(*) AS n_customers
       FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY c_nationkey"""
)
def any_value_meta(spark, sf):
    named = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return named.groupBy("c_nationkey").agg(any_present("n_name").alias("nation_name"), F.count("*").alias("n_customers"))


@query(
    """SELECT CAST(d AS DATE) AS date
       FROM generate_series((SELECT CAST(LEAST((SELECT MIN(o_orderdate) FROM orders), (SELECT MIN(ts) FROM events)) AS DATE) - 6),
                            (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders), INTERVAL 1 DAY) AS s(d)""",
    name="date_spine",
)
def date_spine_of_data(spark, sf):
    orders, events = table(spark, sf, "orders"), table(spark, sf, "events")
    first = F.least(
        orders.select(F.to_date(F.min("o_orderdate"))).scalar(), events.select(F.to_date(F.min("ts"))).scalar()
    )
    return date_spine(spark, F.date_sub(first, 6), orders.select(F.to_date(F.max("o_orderdate"))).scalar())


@query(
    """SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS date, CAST(year(d) AS INTEGER) AS year,
              CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
              {months}[month(d)] AS month_name, {short_months}[month(d)] AS month_short,
              CAST(day(d) AS INTEGER) AS day_of_month, CAST(isodow(d) AS INTEGER) AS iso_day_of_week,
              CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(strftime(d, '%G') AS INTEGER) AS iso_year,
              CAST(strftime(d, '%V') AS INTEGER) AS iso_week, CAST(strftime(d, '%G%V') AS INTEGER) AS iso_year_week,
              CAST(date_trunc('week', d) + INTERVAL 6 DAY AS DATE) AS week_end_date,
              {seasons}[month(d) % 12 // 3 + 1] AS season,
              CAST(year(d - INTERVAL 9 MONTH) AS INTEGER) AS hydro_year
       FROM (SELECT CAST(s AS DATE) AS d
             FROM generate_series((SELECT CAST(MIN(o_orderdate) AS DATE) - 6 FROM orders), DATE '2001-12-31',
                                  INTERVAL 1 DAY) AS g(s))""".format(
        months=MONTH_NAMES, short_months=MONTH_SHORT_NAMES, seasons=SEASONS
    )
)
def dim_date(spark, sf):
    first = table(spark, sf, "orders").select(F.to_date(F.min("o_orderdate"))).scalar()
    return build_dim_date(spark, first, SPINE_AS_OF)


@query(
    """SELECT l_shipdate::DATE AS ship_date, CAST(date_trunc('week', l_shipdate) AS DATE) + 6 AS week_end_date,
              COUNT(*) AS n_lines
       FROM lineitem GROUP BY ALL"""
)
def iso_week_ends(spark, sf):
    lines = table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("ship_date")).agg(F.count("*").alias("n_lines"))
    return lines.select("ship_date", iso_week_end("ship_date").alias("week_end_date"), "n_lines")
