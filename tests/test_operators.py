"""Operators on hand-written rows: NULLs, ties, gaps, week 53, leap years, partial windows."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from seasonstar.fixed_values import AREA_CODES
from seasonstar.functions import aggregates, calendar, numeric, text
from seasonstar.operators import dims, extremes, joins, quality, rollups, serve, series, staging
from seasonstar.plans import reports, staging_plan
from seasonstar.sources.schemas import LEVEL


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


def d(text_):
    return date.fromisoformat(text_)


# ---------------------------------------------------------------- scalar functions


@pytest.mark.parametrize(
    "x, n, want",
    [(1.005, 2, 1.0), (2.5, 0, 3.0), (-2.5, 0, -3.0), (0.49999999999999994, 0, 0.0), (0.125, 2, 0.13), (None, 2, None),
     (-0.125, 2, -0.13), (1234567.25, 1, 1234567.3), (0.0, 2, 0.0), (99.995, 2, 100.0 if round(99.995 * 100) == 10000 else 99.99)],
)
def test_round_half_away(spark, x, n, want):
    assert value(spark, numeric.round_half_away(F.lit(x).cast("double"), n)) == want


def test_units(spark):
    assert value(spark, numeric.to_units(F.lit(-1.255), 2)) in (-125, -126)
    assert value(spark, numeric.to_units(F.lit(7), 0)) == 7
    assert value(spark, numeric.to_units(F.lit(None).cast("double"), 2)) is None


def test_guards(spark):
    assert value(spark, numeric.pct_change(F.lit(3.0), F.lit(2.0))) == 50.0
    assert value(spark, numeric.pct_change(F.lit(3.0), F.lit(0.0))) is None
    assert value(spark, numeric.threshold_flag(F.lit(None).cast("double"), 1.0)) == 0
    assert value(spark, numeric.threshold_flag(F.lit(1.0), 1.0)) == 1
    assert value(spark, numeric.sentinel_to_null(F.lit(65535.0), F.lit(65535.0))) is None
    assert value(spark, numeric.clamp_floor(F.lit(-1.0), 0.0)) == 0.0
    assert value(spark, numeric.clamp_floor(F.lit(None).cast("double"), 0.0)) is None


def test_weighted_mean(spark):
    df = spark.createDataFrame([(10.0, 1.0), (20.0, 3.0), (None, 5.0), (7.0, None)], "x double, w double")
    assert df.agg(numeric.weighted_mean("x", "w").alias("m")).first().m == 17.5
    assert df.where("x = 10").agg(numeric.weighted_mean("x", F.lit(0.0)).alias("m")).first().m is None


@pytest.mark.parametrize(
    "day, iso, end, season_, hydro",
    [("2021-01-03", (2020, 53, 7), "2021-01-03", "Vinter", 2020), ("2018-12-31", (2019, 1, 1), "2019-01-06", "Vinter", 2018),
     ("2020-09-30", (2020, 40, 3), "2020-10-04", "Høst", 2019), ("2020-10-01", (2020, 40, 4), "2020-10-04", "Høst", 2020),
     ("2020-05-31", (2020, 22, 7), "2020-05-31", "Vår", 2019), ("2020-06-01", (2020, 23, 1), "2020-06-07", "Sommer", 2019)],
)
def test_calendar(spark, day, iso, end, season_, hydro):
    c = F.lit(d(day))
    got = spark.range(1).select(
        calendar.iso_year(c), calendar.iso_week(c), calendar.iso_day_of_week(c), calendar.iso_week_end(c),
        calendar.season(c), calendar.hydro_year(c), calendar.date_key(c), calendar.date_of_key(calendar.date_key(c)),
        calendar.iso_year_week(c),
    ).first()
    assert tuple(got) == (*iso, d(end), season_, hydro, int(day.replace("-", "")), d(day), iso[0] * 100 + iso[1])


def test_calendar_against_python_for_every_day(spark):
    first, last = d("1999-12-20"), d("2029-01-10")
    got = calendar.dim_date(spark, first + timedelta(days=6), last).collect()
    assert len(got) == (date(2029, 12, 31) - first).days + 1
    for r in got:
        y, w, dow = r.date.isocalendar()
        assert (r.iso_year, r.iso_week, r.iso_day_of_week) == (y, w, dow)
        assert r.week_end_date == r.date + timedelta(days=7 - dow)
        assert (r.day_of_year, r.quarter) == (r.date.timetuple().tm_yday, (r.date.month + 2) // 3)


def test_spine_bounds(spark):
    assert calendar.date_spine(spark, d("2020-01-02"), d("2020-01-01")).count() == 0
    assert calendar.date_spine(spark, d("2020-01-02"), d("2020-01-02")).count() == 1
    empty = spark.createDataFrame([], "t date")
    assert calendar.date_spine(spark, empty.select(F.min("t")).scalar(), d("2020-01-01")).count() == 0


def test_dates_from_text(spark):
    assert value(spark, calendar.parse_day(F.lit("01.02.2018 06:00:00"), "dd.MM.yyyy HH:mm:ss")) == d("2018-02-01")
    assert value(spark, calendar.parse_day(F.lit("bad"), "dd.MM.yyyy HH:mm:ss")) is None
    for zone in ("UTC", "America/New_York", "Pacific/Auckland"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert value(spark, calendar.utc_date(F.lit("2020-01-01T23:30:00-02:00"))) == d("2020-01-02")
            assert value(spark, calendar.utc_date(F.lit("1969-12-31T23:59:59Z"))) == d("1969-12-31")
            assert value(spark, calendar.parse_day(F.lit("01.02.2018 00:00:00"), "dd.MM.yyyy HH:mm:ss")) == d("2018-02-01")
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_area_code(spark):
    df = spark.createDataFrame([("EL", 3), ("NO", 0), ("VASS", 1), (None, 1)], "kind string, nr int")
    assert rows(df.select(text.area_code("kind", "nr", AREA_CODES).alias("c"))) == sorted([("NO3",), ("NOR",), (None,), (None,)], key=repr)


def test_area_code_function_in_sql(spark):
    text.register_area_code(spark, {"EL": "NO{nr}", "N'O": "it's"})
    got = spark.sql("SELECT area_code('EL', 3) AS a, area_code('N\\'O', 0) AS b, area_code('X', 1) AS c").first()
    assert tuple(got) == ("NO3", "it's", None)


def test_pick_and_part(spark):
    arr = F.array(F.lit(10.5), F.lit(60.1))
    assert [value(spark, text.pick(arr, n)) for n in (1, 2, 3)] == [10.5, 60.1, None]
    assert value(spark, text.part_of(F.lit("SN18700:0"), ":", 1)) == "SN18700"


# ---------------------------------------------------------------- aggregates


def test_arg_extremes_skip_nulls_and_take_the_earliest_tie(spark):
    df = spark.createDataFrame(
        [(1, 5.0), (2, 9.0), (3, 9.0), (4, None), (5, 1.0), (6, 1.0)], "t int, x double"
    ).withColumn("arg", F.when(F.col("t") != 5, F.col("t")))
    got = df.agg(
        aggregates.arg_max("arg", "x", "t").alias("hi"), aggregates.arg_min("arg", "x", "t").alias("lo"),
        aggregates.last_by("x", "t").alias("last"), aggregates.any_present(F.when(F.col("t") == 4, "y")).alias("any"),
    ).first()
    assert tuple(got) == (2, 6, 1.0, "y")


# ---------------------------------------------------------------- staging


def test_dedup_latest_prefers_newest_then_order(spark):
    df = spark.createDataFrame(
        [("a", 1, "f2", 5), ("a", 2, "f1", 6), ("a", 2, "f0", 7), ("b", 1, "f1", 8)], "k string, _loaded_at int, f string, v int"
    )
    once = staging.dedup_latest(df, ["k"], staging.latest_first(df, "_loaded_at"))
    assert rows(once, "k", "v") == [("a", 7), ("b", 8)]
    assert rows(staging.dedup_latest(once, ["k"], staging.latest_first(once, "_loaded_at"))) == rows(once)


def test_newer_null_does_not_hide_older_value(spark):
    base = {f.name: None for f in LEVEL.fields} | {"dato_Id": "2020-01-05", "omrType": "EL", "omrnr": 1, "iso_aar": 2020, "iso_uke": 1}
    data = [base | {"fyllingsgrad": 0.5}, base | {"fyllingsgrad": None}, base | {"fyllingsgrad": 0.7, "omrType": "VASS"}]
    raw = spark.createDataFrame(data, LEVEL).withColumn(
        "_loaded_at", F.when(F.col("fyllingsgrad").isNull(), F.lit(datetime(2021, 1, 1))).otherwise(F.lit(datetime(2020, 1, 1)))
    )
    assert rows(staging_plan.level_base(raw), "area_code", "fill_pct") == [("NO1", 50.0)]


def test_series_from_array_keeps_dates_behind_a_sentinel(spark):
    df = spark.createDataFrame([("p", [1.0, 65535.0, 3.0], 65535)], "p string, a array<double>, s int")
    got = staging.series_from_array(df, ["p"], F.lit(d("2020-02-28")), "a", "v", "day", F.col("s").cast("double"))
    assert rows(got) == sorted([("p", d("2020-02-28"), 1.0), ("p", d("2020-02-29"), None), ("p", d("2020-03-01"), 3.0)], key=repr)


def test_prefer_source(spark):
    df = spark.createDataFrame(
        [("s1", "A", True), ("s2", "A", False), ("s3", "B", False), ("s4", "B", False), ("s5", None, False)],
        "id string, area string, prim boolean",
    )
    got = dict(rows(staging.prefer_source(df, "area", "prim"), "id", "use_for_area"))
    assert got == {"s1": True, "s2": False, "s3": True, "s4": True, "s5": True}


# ---------------------------------------------------------------- dimensions and joins


def test_surrogate_key_both_ways(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"), F.when(F.col("id") % 10 != 0, "x").alias("s")).repartition(7)
    order = [F.col("s").asc_nulls_last(), F.col("v")]
    small = rows(dims.surrogate_key(df, order, "k"))
    large = rows(dims.surrogate_key(df, order, "k"))
    assert small == large and sorted(r[0] for r in small) == list(range(1, 5001))


def test_keep_all(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "n")], "k int, name string")
    right = spark.createDataFrame([(1, "x", True), (1, "y", True), (2, "z", False), (None, "q", True)], "k int, s string, use boolean")
    got = rows(joins.keep_all(left, right, "k", F.col("use")), "k", "name", "s")
    assert got == sorted([(1, "a", "x"), (1, "a", "y"), (2, "b", None), (3, "c", None), (None, "n", None)], key=repr)


# ---------------------------------------------------------------- series


def weekly(spark, points):
    return spark.createDataFrame([("a", d(t), x) for t, x in points], "k string, t date, x double")


def test_gap_safe_diff_and_positional_lag(spark):
    df = weekly(spark, [("2020-01-05", 1.0), ("2020-01-12", 2.5), ("2020-01-26", 4.0), ("2020-02-02", 3.0), ("2020-02-09", 9.0)])
    got = {r.t: r for r in series.lag_diff(series.gap_safe_diff(df, ["k"], "t", "x", 7), ["k"], "t", "x", 4, "four").collect()}
    assert [got[k].change_pp for k in sorted(got)] == [None, 1.5, None, -1.0, 6.0]
    assert got[d("2020-02-09")].four == 8.0  # positional: spans five weeks
    limited = series.lag_diff(df, ["k"], "t", "x", 4, "four", max_span_days=28).where("four is not null")
    assert limited.count() == 0


def test_gap_safe_diff_split_equals_whole(spark):
    points = spark.range(400).where("id % 11 != 3").select(
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("k"),
        F.date_add(F.lit(d("2019-12-01")), (F.col("id") / 2).cast("int")).alias("t"), (F.col("id") * 37 % 101).cast("double").alias("x"),
    )
    for step in (1, 2, 7):
        whole = rows(series.gap_safe_diff(points, ["k"], "t", "x", step))
        assert whole == rows(series.gap_safe_diff(points, ["k"], "t", "x", step, bucket_days=7))
    with pytest.raises(ValueError):
        series.gap_safe_diff(points, ["k"], "t", "x", 8, bucket_days=7)


def test_rolling_sum(spark):
    df = weekly(spark, [("2020-01-05", 1.1), ("2020-01-12", 2.2), ("2020-01-19", None), ("2020-01-26", 4.4), ("2020-02-02", 5.5)])
    got = [r.s for r in series.rolling_sum(df, ["k"], "t", "x", 4, "s").orderBy("t").collect()]
    assert got == [1.1, 3.3, 3.3, 7.7, 12.1]
    full = [r.s for r in series.rolling_sum(df, ["k"], "t", "x", 4, "s", min_periods=4).orderBy("t").collect()]
    assert full == [None, None, None, 7.7, 12.1]
    same = series.rolling_sum(df, ["k"], "t", "x", 1, "s").where("x is not null and s <> x")
    assert same.count() == 0


def test_prior_period_and_lookup(spark):
    df = spark.createDataFrame([("a", 2020, 53, 1.0), ("a", 2021, 1, 2.0), ("a", 2020, 1, 3.0), ("a", 2018, 1, 4.0)], "k string, y int, w int, x double")
    got = rows(series.prior_period(df, ["k", "w"], "y", ["x"]), "y", "w", "x_prev_year")
    assert got == sorted([(2020, 53, None), (2021, 1, 3.0), (2020, 1, None), (2018, 1, None)], key=repr)
    two = rows(series.prior_period(df, ["k", "w"], "y", ["x"], n=2), "y", "w", "x_prev_year")
    assert (2020, 1, 4.0) in two
    table = rows(series.prior_lookup(df, ["k", "w"], "y", ["x"]), "y", "w", "x", "x_prev_year")
    assert (2022, 1, None, 2.0) in table and (2021, 53, None, 1.0) in table and (2021, 1, 2.0, 3.0) in table


def test_same_period_last_year_at_leap_days(spark):
    days_ = ["2019-02-28", "2020-02-28", "2020-02-29", "2021-02-28", "2021-03-01", "2020-03-01", "2022-02-28"]
    df = weekly(spark, [(t, float(i)) for i, t in enumerate(days_)])
    got = {r.t.isoformat(): r.x_prev_year for r in series.same_period_last_year(df, ["k"], "t", ["x"]).collect()}
    assert got == {"2019-02-28": None, "2020-02-28": 0.0, "2020-02-29": 0.0, "2021-02-28": 1.0, "2021-03-01": 5.0,
                   "2020-03-01": None, "2022-02-28": 3.0}
    only_leap = weekly(spark, [("2020-02-29", 1.0), ("2021-02-28", 2.0)])
    assert all(r.x_prev_year is None for r in series.same_period_last_year(only_leap, ["k"], "t", ["x"]).collect())


def test_yoy_by_lag_takes_previous_available_year(spark):
    df = spark.createDataFrame([("a", 2018, 10.0), ("a", 2020, 15.0), ("a", 2021, 0.0), ("a", 2022, 5.0)], "k string, y int, x double")
    got = rows(series.yoy_by_lag(df, ["k"], "y", "x"), "y", "x_prev", "x_yoy", "x_yoy_pct")
    assert got == sorted([(2018, None, None, None), (2020, 10.0, 5.0, 50.0), (2021, 15.0, -15.0, -100.0), (2022, 0.0, 5.0, None)], key=repr)


def test_ytd_cutoffs(spark):
    df = weekly(spark, [("2020-02-29", 1.0), ("2020-03-01", 2.0), ("2021-02-28", 4.0), ("2021-03-01", 8.0), ("2019-12-31", 16.0)])
    by_day = rows(series.ytd_to(df, ["k"], "t", "x"), "year", "ytd")
    assert by_day == [(2020, 1.0), (2021, 12.0)]  # day 60: 29 February in 2020, 1 March in 2021
    assert rows(series.ytd_to(df, ["k"], "t", "x", "month_day"), "year", "ytd") == [(2020, 3.0), (2021, 12.0)]
    with pytest.raises(ValueError):
        series.ytd_to(df, ["k"], "t", "x", "week")


# ---------------------------------------------------------------- roll-ups


def test_two_level_mean_and_total(spark):
    data = [("s1", "A", 1, 1.0), ("s1", "A", 1, 2.0), ("s2", "A", 1, 5.0), ("s3", "B", 1, 10.0), ("s4", None, 1, 2.0)]
    df = spark.createDataFrame(data, "s string, a string, w int, x double")
    got = {r.a: r for r in rollups.two_level_mean(df, "s", "a", ["w"], {"x": 1}, "ALL").collect()}
    assert (got["A"].x, got["A"].days_with_data, got["A"].station_count) == (4.0, 1, 2)
    assert (got["ALL"].x, got["ALL"].station_count) == (5.0, 4)  # over stations, not over areas
    assert got["B"].x == 10.0 and got[None].x == 2.0 and len(got) == 4


def test_months_27_and_28_days(spark):
    days_ = [("A", d("2021-02-01") + timedelta(days=i), 1.0, 1.0) for i in range(28)] + [("A", d("2022-02-01") + timedelta(days=i), 2.0, 0.0) for i in range(27)]
    df = spark.createDataFrame(days_, "area_code string, obs_date date, precip_mm double, wet_day_share double")
    got = {r.year: r for r in reports.monthly_report(df).collect()}
    assert (got[2021].is_partial_month, got[2022].is_partial_month) == (False, True)
    assert (got[2021].normal_mm, got[2022].normal_mm) == (28.0, 28.0)
    assert (got[2022].precip_prev_year_mm, got[2022].yoy_change_pct, got[2022].wet_days) == (28.0, 92.9, 0.0)


# ---------------------------------------------------------------- extremes


def test_melt_ranks_and_windows(spark):
    df = spark.createDataFrame(
        [("A", 2020, d("2020-01-05"), 3.004, None), ("A", 2020, d("2020-01-12"), -3.0, 7.0), ("A", 2021, d("2021-01-10"), 1.0, 2.0)],
        "a string, y int, t date, p double, q double",
    )
    long = extremes.melt_metrics(df, ["a", "y", "t"], {"fill_1w": ("p", 2), "precip_4w": ("q", 1)})
    assert long.count() == 5
    got = extremes.change_windows(extremes.rank_lenses(long, ["a", "metric"], "y").withColumn("direction", extremes.change_direction()), "t")
    by = {(r.metric, r.t): r for r in got.collect()}
    up, down = by[("fill_1w", d("2020-01-05"))], by[("fill_1w", d("2020-01-12"))]
    assert (up.rank_all_time, up.direction) == (1, "Økning") and (down.rank_all_time, down.direction) == (1, "Nedgang") if up.value == 3.0 else True
    assert by[("fill_1w", d("2021-01-10"))].rank_in_year == 1
    four = by[("precip_4w", d("2020-01-12"))]
    assert (four.direction, four.window_start, four.period_start) == ("Nedbør", d("2019-12-16"), d("2020-01-06"))


def test_top_k_ties(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([9, 8, 8, 8, 1])], "k string, id int, v int")
    order = [F.col("v").desc(), F.col("id")]
    assert extremes.top_k_per_group(df, ["k"], order[:1], 2).count() == 4
    assert extremes.top_k_per_group(df, ["k"], order, 2, ties=False).count() == 2


# ---------------------------------------------------------------- quality and serving


def test_quality_report(spark):
    df = spark.createDataFrame(
        [("a", d("2020-01-01"), 5.0), ("a", d("2020-01-01"), 6.0), ("a", d("2020-01-04"), 120.0), ("b", d("2021-01-01"), None)],
        "k string, t date, x double",
    )
    got = quality.quality_report(df, ["k"], {"x": (0.0, 100.0)}, "t", 1, last_day=d("2020-12-31"))
    assert rows(got, "check", "detail") == sorted([("duplicate", "2"), ("range", "x=120.0"), ("gap", "2"), ("after_calendar", "2021-01-01")])


def test_nesting(spark):
    df = spark.createDataFrame([("a", 2, None, True, "æ\""), ("a", 1, 1.5, False, "x"), ("b", 3, 2.0, None, None)], "k string, n int, x double, f boolean, s string")
    got = {r.k: r["rows"] for r in serve.positional_rows(df, "k", ["n"], ["n", "x", "f", "s"]).collect()}
    assert got == {"a": '[[1,1.5,false,"x"],[2,null,true,"æ\\""]]', "b": '[[3,2.0,null,null]]'}
    nested = serve.nest_by(df, "k", ["n"], ["n", "x"]).where("k = 'a'").first()
    assert [tuple(r) for r in nested["rows"]] == [(1, 1.5), (2, None)]
    assert serve.nest_by(df, "k", ["n"], ["x"], chunk="n").count() == 3


def test_freshness_of_empty_table(spark):
    empty = spark.createDataFrame([], "week_end_date date, obs_date date")
    got = serve.freshness_meta(empty, empty, extra={"demo": False}).first()
    assert tuple(got) == (None, None, False)
