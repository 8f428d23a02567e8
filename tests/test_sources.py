"""Readers, incremental landing and streaming on files written by the test."""

from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonstar.plans import staging_plan
from seasonstar.sources import incremental, readers, schemas, scratch
from seasonstar.streaming import landing
from tests import fixtures as fx


def test_json_array_lineage_and_missing_fields(spark, tmp_path):
    fx.write_json(tmp_path / "a.json", [{"navn": "NO 1", "omrType": "EL", "omrnr": 1}, {"navn": "Ø", "extra": 5}])
    fx.write_json(tmp_path / "b.json", [])
    got = readers.read_json(spark, str(tmp_path / "*.json"), schemas.AREA).orderBy("navn").collect()
    assert [(r.navn, r.omrnr, r.beskrivelse) for r in got] == [("NO 1", 1, None), ("Ø", None, None)]
    assert all(r._source_file.endswith("a.json") and r._loaded_at is not None and r._corrupt_record is None for r in got)
    assert len({r._loaded_at for r in got}) == 1  # the rows of one file


def test_corrupt_record_is_kept_as_text(spark, tmp_path):
    (tmp_path / "bad.json").write_text('{"navn": "x", ')
    raw = readers.read_json(spark, str(tmp_path / "bad.json"), schemas.AREA)
    got = raw.collect()
    found = staging_plan.corrupt_records(raw)
    assert found.count() == 1 and found.first()._source_file.endswith("bad.json")
    assert len(got) == 1 and got[0].navn is None and got[0]._corrupt_record


def test_json_lines(spark, tmp_path):
    (tmp_path / "l.json").write_text("".join(json.dumps({"navn": f"n{i}", "omrnr": i}) + "\n" for i in range(5)))
    assert readers.read_json(spark, str(tmp_path / "l.json"), schemas.AREA, multiline=False).count() == 5


def test_optional_source(spark, tmp_path):
    empty = readers.read_or_empty(spark, str(tmp_path / "none/*.json"), schemas.OBSERVATION)
    assert empty.count() == 0
    fx.write_json(tmp_path / "some.json", [])
    present = readers.read_or_empty(spark, str(tmp_path / "some.json"), schemas.OBSERVATION)
    assert present.count() == 0 and [(f.name, f.dataType) for f in present.schema] == [(f.name, f.dataType) for f in empty.schema]


def test_seed_header_is_checked(spark, tmp_path):
    fx.write_seeds(tmp_path)
    got = readers.read_seed(spark, str(tmp_path / "precip_points.csv"), schemas.POINT_SEED).collect()
    assert got[0].comment == "a, comment" and got[0].utm33_x == 1000 and got[0].name.startswith("Sjø")
    (tmp_path / "wrong.csv").write_text("station,area_code,comment\ns,a,c\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_seed(spark, str(tmp_path / "wrong.csv"), schemas.STATION_SEED).collect()


def test_pending_partitions(spark):
    points = spark.createDataFrame([("p",), ("q",)], "point string")
    landed = spark.createDataFrame([("p", 2019), ("p", 2021), ("q", 2020)], "point string, year int")
    as_of = date(2021, 5, 1)
    wanted = incremental.wanted_periods(points, 2019, as_of)
    pending = incremental.pending_partitions(wanted, landed, ["point", "year"], "year", 2021)
    got = sorted(tuple(r) for r in pending.withColumn("end", incremental.period_end("year", as_of)).collect())
    assert got == [("p", 2020, date(2020, 12, 31)), ("p", 2021, as_of), ("q", 2019, date(2019, 12, 31)), ("q", 2021, as_of)]
    ends = wanted.select(incremental.period_end("year", as_of, exclusive=True).alias("e")).distinct()
    assert {r.e for r in ends.collect()} == {date(2020, 1, 1), date(2021, 1, 1), as_of}
    assert incremental.pending_partitions(wanted, landed, ["point", "year"], "year", 2021, force=True).count() == 6


def test_land_replaces_only_written_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([("p", 2020, 1), ("p", 2021, 2), ("q", 2020, 3)], "point string, year int, v int")
    incremental.land(first, path, ["point", "year"])
    incremental.land(spark.createDataFrame([("p", 2021, 20)], first.schema), path, ["point", "year"])
    got = spark.read.parquet(path).select("point", "year", "v").collect()
    assert sorted(map(tuple, got)) == [("p", 2020, 1), ("p", 2021, 20), ("q", 2020, 3)]


def test_upsert(spark, tmp_path):
    old = spark.createDataFrame([("a", 2020, 1, 1.0), ("b", 2020, 1, 2.0), ("c", 2021, 1, 3.0)], "k string, year int, ver int, x double")
    new = spark.createDataFrame([("a", 2020, 2, 9.0, "n"), ("d", 2020, 1, 4.0, "n")], "k string, year int, ver int, x double, note string")
    order = [F.col("ver").desc(), F.col("x")]
    got = incremental.upsert_latest(old, new, ["k", "year"], order)
    assert sorted((r.k, r.x, r.note) for r in got.collect()) == [("a", 9.0, "n"), ("b", 2.0, None), ("c", 3.0, None), ("d", 4.0, "n")]
    again = incremental.upsert_latest(old, old, ["k", "year"], order)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, old.collect()))
    path = str(tmp_path / "t")
    incremental.land(old, path, ["year"])
    untouched = {f.name for f in (tmp_path / "t/year=2021").iterdir()}
    incremental.upsert_partitions(spark, path, new.drop("note"), ["k", "year"], order, ["year"])
    assert sorted((r.k, r.x) for r in spark.read.parquet(path).collect()) == [("a", 9.0), ("b", 2.0), ("c", 3.0), ("d", 4.0)]
    assert {f.name for f in (tmp_path / "t/year=2021").iterdir()} == untouched
    with pytest.raises(ValueError):
        incremental.upsert_partitions(spark, path, new, ["k"], order, ["year"])


def test_only_touched_partitions_are_opened(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = [(a, y, i, float(i)) for i, (a, y) in enumerate([("p", 2019), ("p", 2020), ("q", 2020), ("q", 2021), (None, 2020)])]
    df = spark.createDataFrame(rows, "area string, year int, id int, x double")
    incremental.land(df, path, ["area", "year"])
    new = spark.createDataFrame([("p", 2020, 9, 1.0), (None, 2020, 8, 1.0)], df.schema)
    old = incremental.touched_partitions(spark.read.parquet(path), new, ["area", "year"])
    assert sorted(r.id for r in old.collect()) == [1, 4]
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan[plan.index("PartitionFilters: ["):][:80]
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    monkeypatch.setattr(incremental, "LISTED_PARTITIONS", 1)
    many = incremental.touched_partitions(spark.read.parquet(path), new, ["area", "year"])
    assert sorted(r.id for r in many.collect()) == [1, 4]
    monkeypatch.undo()
    one = incremental.touched_partitions(spark.read.parquet(path), new, ["area"])
    assert sorted(r.id for r in one.collect()) == [0, 1, 4]
    assert incremental.wanted_periods(df.select("area"), 2030, date(2021, 1, 1)).count() == 0


def test_stream_lands_each_file_once(spark, tmp_path):
    src, target, mark = tmp_path / "src", str(tmp_path / "landed"), str(tmp_path / "mark")
    src.mkdir()
    def drop(name, data):
        (src / name).write_text("".join(json.dumps(r) + "\n" for r in data))

    kind = T.StructType.fromDDL("k string, ver int, x double")
    drop("1.json", [{"k": "a", "ver": 1, "x": 1.0}, {"k": "b", "ver": 1, "x": 2.0}])
    landing.land_new_files(spark, str(src), kind, target, mark, partition_by=["k"])
    drop("2.json", [{"k": "a", "ver": 2, "x": 5.0}])
    landing.land_new_files(spark, str(src), kind, target, mark, partition_by=["k"])
    landing.land_new_files(spark, str(src), kind, target, mark, partition_by=["k"])
    assert spark.read.parquet(target).count() == 3
    latest = landing.latest_landed(spark, target, ["k"], [F.col("ver").desc(), F.col("x")])
    assert sorted((r.k, r.x) for r in latest.collect()) == [("a", 5.0), ("b", 2.0)]
    assert all(r._source_file.endswith(".json") for r in spark.read.parquet(target).collect())


def test_scratch_folder_is_that_of_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert scratch.shared_dir(spark) == named
    frozen = scratch.freeze(spark.range(3), "t")
    assert frozen.count() == 3 and all(named in f for f in frozen.inputFiles())


def test_cluster_without_shared_folder_is_told_so(spark, monkeypatch):
    monkeypatch.setattr(scratch, "shared_dir", lambda _: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.freeze(spark.range(3), "t")


def test_other_read_errors_are_not_hidden(spark):
    with pytest.raises(Exception, match="nosuchscheme"):
        readers.read_or_empty(spark, "nosuchscheme:///x", schemas.AREA)
