"""Roll-ups, series operators, extremes, facts and reports on the level and amount series."""

from __future__ import annotations

from pyspark.sql import functions as F

from seasonstar.catalogue import base
from seasonstar.catalogue.base import FULL_DAYS, TOTAL, daily_orders, table
from seasonstar.catalogue.registry import query
from seasonstar.catalogue.sql_parts import with_parts
from seasonstar.fixed_values import TOP_ALL_TIME, TOP_IN_YEAR
from seasonstar.functions.numeric import round_half_away, weighted_mean
from seasonstar.operators import extremes, rollups, series, serve
from seasonstar.plans import reports


@query(with_parts("area_weeks", body="SELECT * FROM area_weeks"))
def weekly_amounts(spark, sf):
    return base.weekly(daily_orders(spark, sf), None)


@query(with_parts("all_weeks", body="SELECT * FROM all_weeks"))
def total_row_grouping_sets(spark, sf):
    return base.weekly(daily_orders(spark, sf), TOTAL)


@query(with_parts("area_days", body="SELECT * FROM area_days"))
def daily_area_mean(spark, sf):
    return base.area_days(daily_orders(spark, sf))


@query(with_parts("months", body="SELECT * FROM months"))
def monthly_amounts(spark, sf):
    return rollups.monthly_amounts(base.area_days(daily_orders(spark, sf)), ["area_code"])


_NORMAL = """ROUND(CAST(SUM(CAST(CASE WHEN days_with_data >= 20 THEN precip_mm END AS DECIMAL(28,1)))
                        OVER (PARTITION BY area_code, month) AS DOUBLE)
                   / NULLIF(COUNT(*) FILTER (WHERE days_with_data >= 20) OVER (PARTITION BY area_code, month), 0), 1)"""


@query(with_parts("months", body=f"SELECT *, {_NORMAL} AS normal_mm FROM months"))
def month_normal(spark, sf):
    months = rollups.monthly_amounts(base.area_days(daily_orders(spark, sf)), ["area_code"])
    return series.period_normal(months, ["area_code", "month"], "precip_mm", F.col("days_with_data") >= FULL_DAYS)


@query(
    with_parts(
        "months",
        body=f"""SELECT * EXCLUDE (before), before AS precip_prev_year_mm, ROUND(precip_mm - before, 1) AS yoy_change_mm,
                        ROUND((precip_mm / NULLIF(before, 0) - 1) * CAST(100 AS DOUBLE), 1) AS yoy_change_pct,
                        {_NORMAL} AS normal_mm, days_with_data < 20 AS is_partial_month
                 FROM (SELECT *, lag(precip_mm) OVER (PARTITION BY area_code, month ORDER BY year) AS before FROM months)""",
    )
)
def monthly_yoy(spark, sf):
    return reports.monthly_report(base.area_days(daily_orders(spark, sf)), full_days=FULL_DAYS)


@query(
    with_parts(
        "amt",
        body="""SELECT area_code, CAST(year(obs_date) AS INTEGER) AS year, CAST(SUM(amount) AS DOUBLE) AS ytd
                FROM amt WHERE dayofyear(obs_date) <= (SELECT dayofyear(MAX(obs_date)) FROM amt)
                GROUP BY ALL""",
    )
)
def ytd_to_same_day(spark, sf):
    return series.ytd_to(base.amounts(base.frozen_days(spark, sf)), ["area_code"], "obs_date", "precip_mm")


@query(
    with_parts(
        "amt",
        body="""SELECT area_code, CAST(year(obs_date) AS INTEGER) AS year, CAST(SUM(amount) AS DOUBLE) AS ytd
                FROM amt WHERE strftime(obs_date, '%m%d') <= (SELECT strftime(MAX(obs_date), '%m%d') FROM amt)
                GROUP BY ALL""",
    )
)
def ytd_to_same_month_day(spark, sf):
    return series.ytd_to(base.amounts(base.frozen_days(spark, sf)), ["area_code"], "obs_date", "precip_mm", "month_day")


@query(
    with_parts(
        "fact", "area_days",
        body="""
        , first_max AS (SELECT area_code, iso_year, iso_week FROM fact
            QUALIFY row_number() OVER (PARTITION BY area_code, iso_year ORDER BY fill_pct DESC, week_end_date) = 1),
        first_min AS (SELECT area_code, iso_year, iso_week FROM fact
            QUALIFY row_number() OVER (PARTITION BY area_code, iso_year ORDER BY fill_pct, week_end_date) = 1),
        latest AS (SELECT area_code, iso_year, fill_pct FROM fact
            QUALIFY row_number() OVER (PARTITION BY area_code, iso_year ORDER BY week_end_date DESC) = 1),
        wettest AS (SELECT area_code, year(obs_date) AS y, obs_date FROM area_days
            QUALIFY row_number() OVER (PARTITION BY area_code, year(obs_date) ORDER BY precip_mm DESC, obs_date) = 1),
        lv AS (SELECT area_code, iso_year,
                   ROUND(CAST(SUM(CAST(fill_pct AS DECIMAL(28,2))) AS DOUBLE) / COUNT(*), 1) AS avg_fill_pct,
                   MAX(fill_pct) AS max_fill_pct, MIN(fill_pct) AS min_fill_pct,
                   MAX(change_pp) AS max_week_increase_pp, MIN(change_pp) AS max_week_decrease_pp,
                   MAX(iso_week) AS last_week
               FROM fact GROUP BY ALL),
        total AS (SELECT area_code, year(obs_date) AS y,
                   CAST(ROUND(ROUND(SUM(CAST(ROUND(precip_mm, 9) AS DECIMAL(38,9))), 6), 0) AS DOUBLE) AS total_precip_mm,
                   ROUND(MAX(precip_mm), 1) AS max_day_precip_mm,
                   CAST(ROUND(ROUND(SUM(CAST(ROUND(wet_day_share, 9) AS DECIMAL(38,9))), 6), 0) AS DOUBLE) AS wet_days
                FROM area_days GROUP BY ALL),
        ytd AS (SELECT area_code, year(obs_date) AS y,
                   CAST(ROUND(ROUND(SUM(CAST(ROUND(precip_mm, 9) AS DECIMAL(38,9))), 6), 0) AS DOUBLE) AS precip_ytd_mm
                FROM area_days WHERE dayofyear(obs_date) <= (SELECT dayofyear(MAX(obs_date)) FROM area_days)
                GROUP BY ALL),
        years AS (
            SELECT lv.area_code, lv.iso_year AS year, lv.avg_fill_pct, lv.max_fill_pct,
                   first_max.iso_week AS max_fill_week, lv.min_fill_pct, first_min.iso_week AS min_fill_week,
                   lv.max_week_increase_pp, lv.max_week_decrease_pp, latest.fill_pct AS last_fill_pct, lv.last_week,
                   total.total_precip_mm, total.max_day_precip_mm, wettest.obs_date AS max_day_precip_date,
                   total.wet_days, ytd.precip_ytd_mm
            FROM lv
            JOIN first_max USING (area_code, iso_year) JOIN first_min USING (area_code, iso_year)
            JOIN latest USING (area_code, iso_year)
            LEFT JOIN total ON total.area_code = lv.area_code AND total.y = lv.iso_year
            LEFT JOIN wettest ON wettest.area_code = lv.area_code AND wettest.y = lv.iso_year
            LEFT JOIN ytd ON ytd.area_code = lv.area_code AND ytd.y = lv.iso_year)
        SELECT years.*, lag(avg_fill_pct) OVER t AS avg_fill_pct_prev_year,
               ROUND(avg_fill_pct - lag(avg_fill_pct) OVER t, 1) AS avg_fill_yoy_pp,
               lag(precip_ytd_mm) OVER t AS precip_ytd_prev_year_mm,
               ROUND((precip_ytd_mm / NULLIF(lag(precip_ytd_mm) OVER t, 0) - 1) * CAST(100 AS DOUBLE), 1)
                   AS precip_ytd_yoy_pct
        FROM years WINDOW t AS (PARTITION BY area_code ORDER BY year)""",
    )
)
def yearly_summary(spark, sf):
    days = base.frozen_days(spark, sf)
    return reports.yearly_summary(base.facts(days), base.area_days(days, None))


@query(
    with_parts(
        "trend",
        body="""SELECT area_code, hi.v AS record_high_fill_pct, hi.d AS record_high_fill_week,
                       lo.v AS record_low_fill_pct, lo.d AS record_low_fill_week,
                       wet.v AS record_wet_week_mm, wet.d AS record_wet_week
                FROM (SELECT area_code, fill_pct AS v, week_end_date AS d FROM trend QUALIFY
                      row_number() OVER (PARTITION BY area_code ORDER BY fill_pct DESC, week_end_date) = 1) hi
                JOIN (SELECT area_code, fill_pct AS v, week_end_date AS d FROM trend QUALIFY
                      row_number() OVER (PARTITION BY area_code ORDER BY fill_pct, week_end_date) = 1) lo
                USING (area_code)
                JOIN (SELECT area_code, precip_week_mm AS v, week_end_date AS d FROM trend
                      WHERE precip_week_mm IS NOT NULL QUALIFY
                      row_number() OVER (PARTITION BY area_code ORDER BY precip_week_mm DESC, week_end_date) = 1) wet
                USING (area_code)""",
    )
)
def alltime_extremes(spark, sf):
    return reports.alltime_extremes(base.trends(base.frozen_days(spark, sf)))


@query(
    with_parts(
        "levels",
        body="""SELECT c.area_code, c.week_end_date, c.iso_year, c.iso_week, c.fill_pct,
                       p.fill_pct AS fill_pct_prev_year, ROUND(c.fill_pct - p.fill_pct, 2) AS yoy_change_pp
                FROM levels c LEFT JOIN levels p
                  ON p.area_code = c.area_code AND p.iso_week = c.iso_week AND p.iso_year = c.iso_year - 1""",
    )
)
def yoy_iso_week(spark, sf):
    level = base.levels(daily_orders(spark, sf)).select("area_code", "week_end_date", "iso_year", "iso_week", "fill_pct")
    prior = series.prior_period(level, ["area_code", "iso_week"], "iso_year", ["fill_pct"])
    return prior.withColumn("yoy_change_pp", round_half_away(F.col("fill_pct") - F.col("fill_pct_prev_year"), 2))


_DAILY_CHANGE = with_parts(
    "amt",
    body="""SELECT c.station, c.obs_date, c.precip_mm, ROUND(c.precip_mm - p.precip_mm, 2) AS change_mm
            FROM amt c LEFT JOIN amt p ON p.station = c.station AND p.obs_date = c.obs_date - 1""",
)


@query(_DAILY_CHANGE)
def gap_safe_diff(spark, sf):
    days = base.amounts(daily_orders(spark, sf)).select("station", "obs_date", "precip_mm")
    return series.gap_safe_diff(days, ["station"], "obs_date", "precip_mm", 1, out="change_mm")


@query(_DAILY_CHANGE)
def gap_safe_diff_split(spark, sf):
    days = base.amounts(daily_orders(spark, sf)).select("station", "obs_date", "precip_mm")
    return series.gap_safe_diff(days, ["station"], "obs_date", "precip_mm", 1, out="change_mm", bucket_days=90)


@query(
    with_parts(
        "levels",
        body="""SELECT area_code, week_end_date, fill_pct,
                       ROUND(fill_pct - lag(fill_pct, 4) OVER (PARTITION BY area_code ORDER BY week_end_date), 2) AS change_4w_pp
                FROM levels""",
    )
)
def lag4_diff(spark, sf):
    level = base.levels(daily_orders(spark, sf)).select("area_code", "week_end_date", "fill_pct")
    diff = series.lag_diff(level, ["area_code"], "week_end_date", "fill_pct", 4, "change_4w_pp")
    return diff.withColumn("change_4w_pp", round_half_away("change_4w_pp", 2))


@query(
    with_parts(
        "levels",
        body="""SELECT area_code, week_end_date, fill_pct,
                       CAST(SUM(CAST(fill_pct AS DECIMAL(28,2))) OVER (PARTITION BY area_code ORDER BY week_end_date
                            ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS DOUBLE) AS fill_4w
                FROM levels""",
    )
)
def rolling_4w_sum(spark, sf):
    level = base.levels(daily_orders(spark, sf)).select("area_code", "week_end_date", "fill_pct")
    return series.rolling_sum(level, ["area_code"], "week_end_date", "fill_pct", 4, "fill_4w")


@query(
    with_parts(
        "area_days",
        body="""SELECT c.area_code, c.obs_date, c.precip_mm, p.precip_mm AS precip_mm_prev_year
                FROM area_days c LEFT JOIN area_days p
                  ON p.area_code = c.area_code AND p.obs_date = CAST(c.obs_date - INTERVAL 12 MONTH AS DATE)""",
    )
)
def same_period_last_year(spark, sf):
    days = base.area_days(daily_orders(spark, sf)).select("area_code", "obs_date", "precip_mm")
    return series.same_period_last_year(days, ["area_code"], "obs_date", ["precip_mm"])


@query(with_parts("fact", body="SELECT * FROM fact"))
def level_fact(spark, sf):
    return base.facts(base.frozen_days(spark, sf))


@query(
    with_parts(
        "fact",
        body="""SELECT area_code, week_end_date, iso_week, fill_pct, hist_min_pct, hist_median_pct, hist_max_pct,
                       deviation_from_median_pp FROM fact""",
    )
)
def benchmark_deviation(spark, sf):
    level = base.levels(base.frozen_days(spark, sf)).select("area_code", "week_end_date", "iso_week", "fill_pct")
    joined = level.join(base.benchmark(level), ["area_code", "iso_week"], "left")
    return joined.withColumn(
        "deviation_from_median_pp", round_half_away(F.col("fill_pct") - F.col("hist_median_pct"), 2)
    )


@query(with_parts("trend", body="SELECT * FROM trend"))
def trend_with_amount(spark, sf):
    return base.trends(base.frozen_days(spark, sf))


@query(with_parts("lenses", body="SELECT * FROM lenses"))
def unpivot_metrics(spark, sf):
    return reports.change_metrics(base.trends(base.frozen_days(spark, sf)))


@query(with_parts("ranked", body="SELECT * FROM ranked"))
def largest_changes(spark, sf):
    return reports.largest_changes(base.trends(base.frozen_days(spark, sf)))


@query(with_parts("ranked", body="SELECT * FROM ranked WHERE rank_in_year <= 5 OR rank_all_time <= 10"))
def largest_changes_topk(spark, sf):
    ranked = reports.largest_changes(base.trends(base.frozen_days(spark, sf)))
    return extremes.served_changes(ranked, TOP_IN_YEAR, TOP_ALL_TIME)


@query(
    with_parts(
        "ranked",
        body="""SELECT area_code, metric, iso_year, iso_week, week_end_date, value, rank_in_year
                FROM ranked WHERE rank_in_year <= 5""",
    )
)
def topk_in_year(spark, sf):
    metrics = reports.change_metrics(base.trends(base.frozen_days(spark, sf)))
    order = [F.abs("value").desc_nulls_last()]
    return extremes.top_k_per_group(metrics, ["area_code", "metric", "iso_year"], order, TOP_IN_YEAR, name="rank_in_year")


@query(
    with_parts(
        "levels",
        body=""", w AS (SELECT r_name AS area_code, COUNT(*) AS w FROM customer JOIN nation ON c_nationkey = n_nationkey
                        JOIN region ON n_regionkey = r_regionkey GROUP BY r_name)
                SELECT week_end_date, ROUND(CAST(SUM(CAST(fill_pct AS DECIMAL(28,2)) * w) AS DOUBLE)
                                            / CAST(SUM(w) AS DOUBLE), 2) AS fill_pct
                FROM levels JOIN w USING (area_code) GROUP BY week_end_date""",
    )
)
def capacity_weighted_mean(spark, sf):
    customer, nations = table(spark, sf, "customer"), base.areas(spark, sf)
    per_nation = customer.groupBy("c_nationkey").agg(F.count("*").alias("n"))
    weights = per_nation.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("area_code").agg(
        F.sum("n").cast("double").alias("w")
    )
    weighted = base.levels(daily_orders(spark, sf)).join(weights, "area_code")
    return weighted.groupBy("week_end_date").agg(round_half_away(weighted_mean("fill_pct", "w"), 2).alias("fill_pct"))


@query(
    with_parts(
        "fact", "amt",
        body=""", a AS (SELECT area_code, iso_year AS year,
                     CAST(SUM(CAST(fill_pct AS DECIMAL(28,2))) AS DOUBLE) / COUNT(fill_pct) AS fill_pct,
                     CAST(SUM(CAST(fill_pct_prev_year AS DECIMAL(28,2))) AS DOUBLE)
                         / NULLIF(COUNT(fill_pct_prev_year), 0) AS fill_pct_last_year,
                     CAST(SUM(CAST(hist_median_pct AS DECIMAL(28,2))) AS DOUBLE) / COUNT(hist_median_pct) AS med
                  FROM fact GROUP BY ALL),
                b AS (SELECT area_code, CAST(year(obs_date) AS INTEGER) AS year, CAST(SUM(amount) AS DOUBLE) AS precip_mm,
                             CAST(SUM(is_wet_day) AS BIGINT) AS wet_days FROM amt GROUP BY ALL)
                SELECT a.area_code, a.year, fill_pct, fill_pct_last_year, fill_pct - fill_pct_last_year AS fill_vs_last_year_pp,
                       fill_pct - med AS fill_vs_median_pp, precip_mm, wet_days
                FROM a LEFT JOIN b ON b.area_code = a.area_code AND b.year = a.year""",
    )
)
def bi_measures(spark, sf):
    days = base.frozen_days(spark, sf)
    return rollups.measures(base.facts(days), base.amounts(days), "area_code")


def _level_rows(spark, sf):
    level = base.levels(daily_orders(spark, sf))
    return level.select(
        "area_code", "week_end_date", "iso_year", "iso_week", F.col("fill_pct").cast("decimal(10,2)").alias("fill_pct")
    )


_ROW_TEXT = """'["' || week_end_date || '",' || iso_year || ',' || iso_week || ',' || CAST(fill_pct AS DECIMAL(10,2)) || ']'"""


@query(
    with_parts(
        "levels",
        body=f"""SELECT area_code, '[' || string_agg({_ROW_TEXT}, ',' ORDER BY week_end_date) || ']' AS weekly
                 FROM levels GROUP BY area_code""",
    )
)
def nest_weekly_by_area(spark, sf):
    cols = ["week_end_date", "iso_year", "iso_week", "fill_pct"]
    return serve.positional_rows(_level_rows(spark, sf), "area_code", ["week_end_date"], cols, "weekly")


@query(
    with_parts(
        "levels",
        body=f"""SELECT area_code, iso_year, '[' || string_agg({_ROW_TEXT}, ',' ORDER BY week_end_date) || ']' AS weekly
                 FROM levels GROUP BY area_code, iso_year""",
    )
)
def nest_weekly_by_area_year(spark, sf):
    cols = ["week_end_date", "iso_year", "iso_week", "fill_pct"]
    return serve.positional_rows(_level_rows(spark, sf), "area_code", ["week_end_date"], cols, "weekly", chunk="iso_year")


@query(
    with_parts(
        "levels",
        body=f"""SELECT area_code, '{{"areas":[{{"area_code":"' || area_code || '"}}],"weekly":['
                        || string_agg({_ROW_TEXT}, ',' ORDER BY week_end_date) || ']}}' AS document
                 FROM levels GROUP BY area_code""",
    )
)
def export_json(spark, sf):
    rows = _level_rows(spark, sf)
    cols = ["week_end_date", "iso_year", "iso_week", "fill_pct"]
    weekly = serve.positional_rows(rows, "area_code", ["week_end_date"], cols, "weekly")
    regions = table(spark, sf, "region").select(F.col("r_name").alias("area_code"))
    return serve.area_documents(regions, "area_code", {"weekly": weekly})

