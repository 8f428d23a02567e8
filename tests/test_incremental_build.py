"""The build on kept daily series, and the build that leaves damaged records out."""

from __future__ import annotations

import json
import os
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from seasonstar.operators import quarantine
from seasonstar.plans import star
from seasonstar.plans.daily_state import DailyState
from tests import fixtures as fx

FIRST, LAST, AS_OF = date(2019, 11, 1), date(2021, 2, 27), date(2021, 3, 1)
COMPARED = ["dw.dim_date", "dw.dim_station", "dw.fact_precipitation_daily", "dw.fact_precipitation_weekly", "rpt.precipitation_monthly"]


def rows_of(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()), key=repr)


def land(path: Path, record: dict, when: int) -> None:
    path.write_text(json.dumps(record), encoding="utf-8")
    os.utime(path, (when, when))


def test_build_on_kept_series_equals_the_full_build(spark, tmp_path):
    landing, seeds = fx.write_landing(tmp_path / "data", FIRST, LAST, observers=True), fx.write_seeds(tmp_path / "seeds")
    for path in Path(landing).rglob("*.json"):
        os.utime(path, (1_600_000_000, 1_600_000_000))
    state = str(tmp_path / "state")

    def both(name):
        full = star.build(spark, landing, seeds, AS_OF, out=str(tmp_path / f"{name}-full"))
        kept = star.build(spark, landing, seeds, AS_OF, out=str(tmp_path / f"{name}-kept"), state=state)
        for table in COMPARED:
            assert rows_of(full[table]) == rows_of(kept[table]), table

    both("first")
    # a revised year of one point lands: another value on one day, and a day that had none
    day = json.loads(Path(f"{landing}/nve_gts/P_NO2_2020.json").read_text())
    values = [v if i != 40 else 77.5 for i, v in enumerate(day["Data"])]
    land(Path(f"{landing}/nve_gts/P_NO2_2020_revised.json"), day | {"Data": [5.5 if v == fx.NO_DATA else v for v in values]}, 1_600_000_100)
    done = DailyState.at(spark, landing, state).refresh()
    assert done["observed"].version is None and done["grid"].periods == [2020]
    assert {p.rsplit("_", 1)[-1] for p in done["grid"].files} == {"2020.json", "revised.json"} and len(done["grid"].files) == 4
    wrote = DailyState.at(spark, landing, state).grid.facts.partitions().collect()
    assert {r["year"]: r["written_in"] for r in wrote} == {2019: 1, 2020: 2, 2021: 1}
    both("second")


def test_damaged_records_are_left_out_and_listed(spark, tmp_path):
    landing, seeds = fx.write_landing(tmp_path / "data", FIRST, LAST), fx.write_seeds(tmp_path / "seeds")
    good = star.build(spark, landing, seeds, AS_OF, out=str(tmp_path / "good"), limit=0.0)
    assert good["stg.rejected"].count() == 0
    folder = Path(landing) / "nve_gts"
    record = json.loads((folder / "P_NO1_2020.json").read_text())
    (folder / "cut.json").write_text(json.dumps(record)[:500], encoding="utf-8")
    land(folder / "undated.json", record | {"StartDate": "soon"}, 1_600_000_000)
    land(folder / "short.json", record | {"Data": record["Data"][:-1]}, 1_600_000_000)
    land(folder / "hourly.json", record | {"TimeResolution": 60}, 1_600_000_000)
    land(folder / "late.json", record | {"StartDate": "01.01.2022 06:00:00", "EndDate": "31.12.2022 06:00:00", "Data": [1.0] * 365}, 1_600_000_000)
    with pytest.raises(quarantine.TooManyRejected, match="5 of 14 rows.*after_calendar 1, truncated 1, undated 1, wrong_step 2"):
        star.build(spark, landing, seeds, AS_OF, out=str(tmp_path / "stopped"), limit=0.1)
    assert not (tmp_path / "stopped").exists()
    built = star.build(spark, landing, seeds, AS_OF, out=str(tmp_path / "built"), limit=0.5)
    found = {(r["_source_file"].rsplit("/", 1)[1], *r["_reasons"]) for r in built["stg.rejected"].collect()}
    assert found == {
        ("cut.json", "truncated"), ("undated.json", "undated"), ("short.json", "wrong_step"), ("hourly.json", "wrong_step"),
        ("late.json", "after_calendar"),
    }
    for table in COMPARED:
        assert rows_of(good[table]) == rows_of(built[table]), table


def test_route(spark):
    df = spark.createDataFrame([(i, None if i % 7 == 0 else i) for i in range(100)], "id long, v long")
    rules = {"null": F.col("v").isNull(), "even": F.col("v") % 2 == 0, "never": F.lit(None).cast("boolean")}
    routed = quarantine.route(df, rules)
    assert routed.counts == {"null": 15, "even": sum(i % 2 == 0 and i % 7 > 0 for i in range(100)), "never": 0}
    assert routed.n_rows == 100 and routed.data.columns == df.columns
    assert {r["id"] for r in routed.data.collect()} == {i for i in range(100) if i % 2 and i % 7}
    assert routed.n_rejected == routed.rejected.count() == 100 - routed.data.count()
    table = {r["reason"]: r["n_rows"] for r in quarantine.counts_table(routed.rejected).collect()}
    assert table == {k: n for k, n in routed.counts.items() if n}
    empty = quarantine.route(df.limit(0), rules, limit=0.0)
    assert (empty.n_rows, empty.n_rejected, empty.data.collect(), empty.rejected.collect()) == (0, 0, [], [])
    assert quarantine.route(df, {}).data.count() == 100
    with pytest.raises(quarantine.TooManyRejected) as e:
        quarantine.route(df, rules, limit=0.2)
    assert e.value.routed.rejected.count() == routed.n_rejected
    with pytest.raises(ValueError):
        quarantine.route(df.withColumn("_reasons", F.lit(1)), rules)
