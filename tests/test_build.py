"""The layered build over landed files, against values computed by hand in plain Python."""

from __future__ import annotations

import dataclasses
import json
import re
from collections import defaultdict
from datetime import date, timedelta
from fractions import Fraction

import pytest

from seasonstar.plans import star
from tests import fixtures as fx

FIRST, LAST, AS_OF = date(2019, 1, 1), date(2021, 2, 27), date(2021, 3, 1)
GAP = "2020-06-14"


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("landing")
    landing = fx.write_landing(root / "data", FIRST, LAST, observers=True, skip_weeks={GAP})
    return star.build(spark, landing, fx.write_seeds(root / "seeds"), AS_OF, out=str(root / "out"))


def used_days():
    """(area, station, day, mm) of the stations that count, from the fixture's formulas."""
    rows = []
    for d in fx.days(FIRST, LAST):
        for i, (point, area, _, _) in enumerate(fx.POINTS):
            if not (d.day == 13 and i == 1):
                rows.append((area, point, d, float(fx.rain(i, d))))
        value = fx.observed(d)
        if value is not None:
            rows.append(("NO3", "SN3", d, max(value, 0.0)))
    return rows


def half_up(x, n):
    """Halves away from zero; exact for fractions, on the binary value for floats."""
    scaled = abs(x) * 10**n
    whole = int(scaled) + (1 if scaled - int(scaled) >= 0.5 else 0)
    return (whole if x >= 0 else -whole) / 10**n


def exact(mm):
    return Fraction(str(mm))


def test_dimensions(built):
    dates = built["dw.dim_date"]
    first_sunday = date(2019, 1, 6)
    assert dates.count() == (date(2021, 12, 31) - (min(first_sunday, FIRST) - timedelta(days=6))).days + 1
    areas = [(r.area_key, r.area_code) for r in built["dw.dim_area"].orderBy("area_key").collect()]
    assert areas == [(1, "NOR"), (2, "NO1"), (3, "NO2"), (4, "NO3")]
    stations = {r.station_id: r for r in built["dw.dim_station"].collect()}
    assert [s for s, r in sorted(stations.items()) if r.use_for_area] == ["P_NO1", "P_NO2", "P_NO2B", "SN3"]
    assert stations["P_NO2"].elevation_m == 301 and stations["P_NO2"].municipality is None
    assert (stations["SN3"].latitude, stations["SN3"].longitude) == (59.9, 10.75)
    assert sorted(r.station_key for r in stations.values()) == [1, 2, 3, 4, 5]


def test_profile_and_both_ways_to_gather(spark, tmp_path):
    landing = fx.write_landing(tmp_path / "data", date(2020, 1, 13), date(2020, 2, 1), observers=True)
    raw = star.staging_plan.read_raw(spark, landing, fx.write_seeds(tmp_path / "seeds"))

    def profile_of(some):
        return tuple(star.staging_plan.series_profile(some, star.staging_plan.grid_points(some.grid)).first())

    profile = star.staging_plan.series_profile(raw, star.staging_plan.grid_points(raw.grid)).first()
    assert (profile.first_day, profile.most_values) == (date(2020, 1, 13), 60)
    only = dataclasses.replace(raw, grid=raw.grid.where("X = 1001"), observation=raw.observation.limit(0))
    assert profile_of(only) == (date(2020, 1, 14), 20)  # starts with the sentinel
    none = dataclasses.replace(only, grid=only.grid.limit(0))
    assert profile_of(none) == (None, 0)
    twice = dataclasses.replace(raw, grid=raw.grid.union(raw.grid), observation=raw.observation.union(raw.observation))
    ways = [sorted(map(repr, star.staging_plan.precipitation_daily(twice, by).collect())) for by in (False, True)]
    assert ways[0] == ways[1] and len(ways[0]) > 60
    plan = star.staging_plan.precipitation_daily(raw, True)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(station_id" in plan and not re.search(r"hashpartitioning\(station_id\S+, obs_date", plan)


def test_daily_fact(built):
    got = {(r.station_key, r.date_key): r for r in built["dw.fact_precipitation_daily"].collect()}
    keys = {r.station_id: r.station_key for r in built["dw.dim_station"].collect()}
    want = {(keys[s], int(f"{d:%Y%m%d}")): mm for _, s, d, mm in used_days()}
    assert {k: got[k].precip_mm for k in want} == want
    assert all(r.is_wet_day == (1 if r.precip_mm >= 1 else 0) for r in got.values())
    extra = [k for k in got if k not in want]
    assert {k[0] for k in extra} == {keys["SN1"]}


def test_weekly_fact_with_total(built):
    weeks = defaultdict(lambda: defaultdict(lambda: [0.0, 0, 0]))
    for area, station, d, mm in used_days():
        y, w, _ = d.isocalendar()
        for a in (area, "NOR"):
            cell = weeks[(a, y, w)][station]
            cell[0] += exact(mm)
            cell[1] += mm >= 1
            cell[2] += 1
    codes = {r.area_key: r.area_code for r in built["dw.dim_area"].collect()}
    got = {(codes[r.area_key], r.iso_year, r.iso_week): r for r in built["dw.fact_precipitation_weekly"].collect()}
    assert set(got) == set(weeks)
    for key, stations in weeks.items():
        row, cells = got[key], list(stations.values())
        assert row.precip_mm == half_up(sum(c[0] for c in cells) / len(cells), 1), key
        assert row.wet_days == half_up(sum(c[1] for c in cells) / len(cells), 1)
        assert row.days_with_data == min(c[2] for c in cells)
        assert row.station_count == len(cells)


def test_level_fact(built):
    codes = {r.area_key: r.area_code for r in built["dw.dim_area"].collect()}
    got = {(codes[r.area_key], r.date_key): r for r in built["dw.fact_reservoir_weekly"].collect()}
    level = {}
    for r in fx.level_rows(FIRST, LAST):
        if r["omrType"] != "VASS" and r["dato_Id"] != GAP:
            code = "NOR" if r["omrType"] == "NO" else f"NO{r['omrnr']}"
            level[(code, date.fromisoformat(r["dato_Id"]))] = half_up(r["fyllingsgrad"] * 100, 2)
    assert len(got) == len(level)
    for (code, d), pct in level.items():
        row = got[(code, int(f"{d:%Y%m%d}"))]
        assert row.fill_pct == pct
        before = level.get((code, d - timedelta(days=7)))
        assert row.change_pp == (None if before is None else half_up(pct - before, 2))
        y, w, _ = d.isocalendar()
        prev = [v for (c, e), v in level.items() if c == code and e.isocalendar()[:2] == (y - 1, w)]
        assert row.fill_pct_prev_year == (prev[0] if prev else None)
        nr = 0 if code == "NOR" else int(code[2:])
        median = half_up((0.4 + nr / 100 + w / 1000) * 100, 2)
        assert row.hist_median_pct == median
        assert row.deviation_from_median_pp == half_up(pct - median, 2)


def area_days():
    cells = defaultdict(list)
    for area, _, d, mm in used_days():
        cells[(area, d)].append(exact(mm))
        cells[("NOR", d)].append(exact(mm))
    return {k: (sum(v) / len(v), Fraction(sum(x >= 1 for x in v), len(v))) for k, v in cells.items()}


def test_monthly_report(built):
    months = defaultdict(list)
    for (area, d), v in area_days().items():
        months[(area, d.year, d.month)].append(v)
    got = {(r.area_code, r.year, r.month): r for r in built["rpt.precipitation_monthly"].collect()}
    assert set(got) == set(months)
    total = {k: half_up(sum(x[0] for x in v), 1) for k, v in months.items()}
    for k, v in months.items():
        row = got[k]
        assert row.precip_mm == total[k]
        assert row.wet_days == half_up(sum(x[1] for x in v), 0)
        assert row.days_with_data == len(v) and row.is_partial_month == (len(v) < 28)
        assert row.max_day_mm == pytest.approx(float(max(x[0] for x in v)), rel=1e-12)
        before = total.get((k[0], k[1] - 1, k[2]))
        assert row.precip_prev_year_mm == before
        complete = [exact(total[q]) for q in months if q[0] == k[0] and q[2] == k[2] and len(months[q]) >= 28]
        want = half_up(float(sum(complete)) / len(complete), 1) if complete else None
        assert row.normal_mm == want
    assert got[("NO1", 2021, 2)].is_partial_month and got[("NO1", 2021, 2)].month_short == "Feb"


def test_yearly_summary(built):
    got = {(r.area_code, r.year): r for r in built["rpt.yearly_summary"].collect()}
    assert set(got) == {(a, y) for a in ("NO1", "NO2", "NO3", "NOR") for y in (2019, 2020, 2021)}
    days = area_days()
    last = max(d for _, d in days)
    cutoff = last.timetuple().tm_yday
    for (area, year), row in got.items():
        of_year = {d: v[0] for (a, d), v in days.items() if a == area and d.year == year}
        ytd = sum(v for d, v in of_year.items() if d.timetuple().tm_yday <= cutoff)
        assert row.precip_ytd_mm == half_up(ytd, 0)
        assert row.max_day_precip_mm == half_up(max(of_year.values()), 1)
        assert row.max_day_precip_date == min(d for d, v in of_year.items() if v == max(of_year.values()))
        if year > 2019:
            assert row.avg_fill_pct_prev_year == got[(area, year - 1)].avg_fill_pct


def test_largest_changes_and_extremes(built):
    rows = built["rpt.largest_changes"].collect()
    groups = defaultdict(list)
    for r in rows:
        assert r.rank_in_year <= r.rank_all_time
        groups[(r.area_code, r.metric)].append(r)
        if r.metric.startswith("precip"):
            assert r.direction == "Nedbør"
        else:
            assert r.direction == ("Økning" if r.value >= 0 else "Nedgang")
        span = 27 if r.metric.endswith("4w") else 6
        assert r.window_start == r.week_end_date - timedelta(days=span)
    for members in groups.values():
        for r in members:
            assert r.rank_all_time == 1 + sum(abs(m.value) > abs(r.value) for m in members)
            same_year = [m for m in members if m.iso_year == r.iso_year]
            assert r.rank_in_year == 1 + sum(abs(m.value) > abs(r.value) for m in same_year)
    trend = built["rpt.reservoir_trend"].collect()
    for r in built["rpt.alltime_extremes"].collect():
        mine = [t for t in trend if t.area_code == r.area_code]
        assert r.record_high_fill_pct == max(t.fill_pct for t in mine)
        assert r.record_high_fill_week == min(t.week_end_date for t in mine if t.fill_pct == r.record_high_fill_pct)
        wet = [t for t in mine if t.precip_week_mm is not None]
        assert r.record_wet_week == min(t.week_end_date for t in wet if t.precip_week_mm == r.record_wet_week_mm)


def test_trend_prior_year_amount(built):
    codes = {r.area_key: r.area_code for r in built["dw.dim_area"].collect()}
    amounts = {(codes[r.area_key], r.iso_year, r.iso_week): r.precip_mm for r in built["dw.fact_precipitation_weekly"].collect()}
    rows = built["rpt.reservoir_trend"].collect()
    assert len(rows) == built["dw.fact_reservoir_weekly"].count()
    for r in rows:
        assert r.precip_week_mm == amounts.get((r.area_code, r.iso_year, r.iso_week))
        assert r.precip_week_prev_year_mm == amounts.get((r.area_code, r.iso_year - 1, r.iso_week))


def test_export(built, tmp_path):
    star.export(built, str(tmp_path), {"demo": True})
    lines = [line for f in (tmp_path / "areas").glob("part-*") for line in f.read_text("utf-8").splitlines()]
    docs = {d["areas"][0]["code"]: d for d in map(json.loads, lines)}
    assert set(docs) == {"NOR", "NO1", "NO2", "NO3"}
    assert docs["NOR"]["areas"][0]["station"] is None and len(docs["NO2"]["areas"]) == 2
    assert docs["NOR"]["areas"][0]["description"] == "Sum av alle elspotområder"
    weekly = docs["NO1"]["weekly"]
    assert [w[0] for w in weekly] == sorted(w[0] for w in weekly) and len(weekly[0]) == 11
    served = docs["NO1"]["changes"]
    assert all(c[6] <= 5 or c[7] <= 10 for c in served)
    assert isinstance(docs["NO1"]["monthly"][0][6], bool)
    meta = [json.loads(line) for f in (tmp_path / "meta").glob("part-*") for line in f.read_text("utf-8").splitlines()]
    assert meta[0]["demo"] is True and meta[0]["last_precip_date"] == "2021-02-27" and meta[0]["cols"]["weekly"][0] == "week_end_date"


def test_optional_source_absent_gives_same_grid_rows(spark, built, tmp_path):
    landing = fx.write_landing(tmp_path / "data", FIRST, LAST, observers=False, skip_weeks={GAP})
    plain = star.build(spark, landing, fx.write_seeds(tmp_path / "seeds"), AS_OF, out=str(tmp_path / "out"))
    cols = ["date_key", "precip_mm"]

    def of_point(tables):
        key = tables["dw.dim_station"].where("station_id = 'P_NO1'").select("station_key")
        return sorted(map(tuple, tables["dw.fact_precipitation_daily"].join(key, "station_key").select(*cols).collect()))

    assert of_point(plain) == of_point(built)
    assert plain["dw.dim_station"].count() == 3
    assert sorted(plain["dw.fact_precipitation_daily"].columns) == sorted(built["dw.fact_precipitation_daily"].columns)


def test_counts_and_source_choice(spark, built, tmp_path):
    counts = {r.table_name: r.n_rows for r in star.table_counts(built).collect()}
    assert counts["dw.dim_area"] == 4 and counts["dw.fact_precipitation_daily"] > 0 and len(counts) == 6
    landing = fx.write_landing(tmp_path / "data", date(2020, 1, 1), date(2020, 3, 1), observers=True)
    only = star.build(spark, landing, fx.write_seeds(tmp_path / "seeds"), AS_OF, sources={"nve", "precip"})
    assert only["dw.dim_station"].count() == 3
    with pytest.raises(ValueError):
        star.build(spark, landing, str(tmp_path / "seeds"), AS_OF, sources={"other"})


def test_publish(spark, built):
    star.publish(spark, built)
    joined = spark.sql(
        """SELECT a.area_code, max(f.precip_mm) AS wettest FROM dw.fact_precipitation_weekly f
           JOIN dw.dim_area a USING (area_key) GROUP BY ALL"""
    )
    star.create_views(built)
    reported = spark.sql("SELECT area_code, max(precip_week_mm) FROM rpt_reservoir_trend GROUP BY ALL")
    assert {r[0] for r in joined.collect()} == {r[0] for r in reported.collect()}
