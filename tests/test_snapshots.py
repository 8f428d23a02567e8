"""Versioned tables: commits, writers that die, readers in between; the incremental table on top of them."""

from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from seasonstar.sources.manifest import IncrementalTable, landed_files
from seasonstar.sources.readers import LOADED_AT, read_json
from seasonstar.sources.snapshots import HOME, SnapshotTable

ROWS = "area string, year int, id long, v double"


def frame(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


FIRST = [("a", 2020, 1, 1.0), ("a", 2021, 2, 2.0), ("b", 2020, 3, 3.0), (None, 2020, 4, 4.0), ("01", 2020, 5, None)]


@pytest.fixture
def table(spark, tmp_path):
    t = SnapshotTable(spark, str(tmp_path / "t"), ["area", "year"])
    assert t.latest_version() == 0 and t.versions().collect() == [] and t.read_partitions(frame(spark, FIRST)) is None
    assert t.replace(frame(spark, FIRST)) == 1
    return t


def test_replace_touches_its_partitions_only(spark, table):
    assert rows_of(table.read()) == sorted(FIRST, key=repr) and table.read().schema == frame(spark, []).schema
    assert table.replace(frame(spark, [("a", 2020, 9, 9.0), (None, 2020, 8, None)])) == 2
    now = [r for r in FIRST if r[:2] not in (("a", 2020), (None, 2020))] + [("a", 2020, 9, 9.0), (None, 2020, 8, None)]
    assert rows_of(table.read()) == sorted(now, key=repr)
    assert rows_of(table.read(1)) == sorted(FIRST, key=repr)
    assert rows_of(table.versions()) == [(1, 5, 5, 5), (2, 5, 5, 2)]


def test_replaced_partitions_may_be_left_empty(spark, table):
    gone = frame(spark, [("b", 2020, 0, 0.0), ("z", 1999, 0, 0.0)])
    table.replace(frame(spark, []), gone)
    assert rows_of(table.read()) == sorted((r for r in FIRST if r[0] != "b"), key=repr)
    table.replace(frame(spark, []), frame(spark, FIRST))
    assert rows_of(table.read()) == []
    table.replace(frame(spark, FIRST[:1]))
    assert rows_of(table.read()) == FIRST[:1]


def test_upsert_keeps_the_latest_row_and_other_partitions(spark, table):
    order = [F.col("v").desc_nulls_last()]
    table.upsert(frame(spark, [("a", 2020, 1, 0.5), ("a", 2020, 7, 7.0), ("c", 2022, 1, 1.0)]), ["area", "year", "id"], order)
    assert rows_of(table.read()) == sorted([*FIRST, ("a", 2020, 7, 7.0), ("c", 2022, 1, 1.0)], key=repr)
    assert [r["written"] for r in table.versions().orderBy("version").collect()] == [5, 2]
    with pytest.raises(ValueError):
        table.upsert(frame(spark, FIRST), ["id"], order)
    fresh = SnapshotTable(spark, table.path + "-fresh", ["year"])
    assert fresh.upsert(frame(spark, FIRST * 2), ["year", "id"], order) == 1
    assert rows_of(fresh.read()) == sorted(FIRST, key=repr)


def test_a_writer_that_dies_leaves_the_table_as_it_was(spark, table, monkeypatch):
    reader = table.read()

    def dies(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(table, "finish", dies)
        with pytest.raises(KeyboardInterrupt):
            table.replace(frame(spark, [("a", 2020, 9, 9.0)]))
    assert rows_of(table.read()) == rows_of(reader) == sorted(FIRST, key=repr)
    (lost,) = table.unlisted()
    # also one that dies while the list is written: its folder holds no finished file
    os.makedirs(f"{table.path}/commits/_version=2/_temporary/0")
    assert table.latest_version() == 1 and rows_of(table.read()) == sorted(FIRST, key=repr)
    os.removedirs(f"{table.path}/commits/_version=2/_temporary/0")
    assert table.replace(frame(spark, [("a", 2020, 9, 9.0)])) == 2
    assert rows_of(reader) == sorted(FIRST, key=repr)  # an open reader keeps its version
    assert table.vacuum(keep=2) == [lost]
    assert rows_of(reader) == sorted(FIRST, key=repr)
    table.replace(frame(spark, FIRST))
    assert len(table.vacuum()) == 2 and rows_of(table.read()) == sorted(FIRST, key=repr) and table.vacuum() == []
    with pytest.raises(Exception, match="ATH"):
        table.read(1).collect()


def test_two_writers_from_one_version(spark, table):
    other = SnapshotTable(spark, table.path, ["area", "year"])
    other.latest_version = lambda: 0  # it started before the first commit
    with pytest.raises(Exception, match="already exists"):
        other.replace(frame(spark, [("a", 2020, 9, 9.0)]))
    assert rows_of(table.read()) == sorted(FIRST, key=repr)


def test_only_listed_folders_are_read(spark, table):
    table.replace(frame(spark, [("a", 2020, 9, 9.0)]))
    read = table.read_partitions(frame(spark, [("a", 2020, 0, 0.0)]))
    assert rows_of(read) == [("a", 2020, 9, 9.0)]
    plan = read._jdf.queryExecution().executedPlan().toString().lower()
    assert "dynamicpruning" in plan  # the folders to open follow from the list, while the query runs


def test_reserved_names(spark, table):
    with pytest.raises(ValueError):
        table.replace(frame(spark, FIRST).withColumn(HOME, F.lit(1)))


# the incremental table

LANDED = "station string, day string, mm double"


class Feed:
    """Landed JSON files of (station, day, mm), one record per line."""

    def __init__(self, spark, tmp_path):
        self.spark, self.folder, self.clock = spark, tmp_path / "landing", 1_700_000_000
        self.folder.mkdir()
        self.read_files: list[list[str]] = []
        self.table = self.incremental(tmp_path / "state")

    def land(self, name, rows):
        path = self.folder / name
        path.write_text("\n".join(json.dumps(dict(zip(("station", "day", "mm"), r))) for r in rows))
        self.clock += 10
        os.utime(path, (self.clock, self.clock))

    def incremental(self, out):
        def read(paths):
            self.read_files.append(sorted(p.rsplit("/", 1)[1] for p in paths))
            return read_json(self.spark, paths, self.spark.createDataFrame([], LANDED).schema, multiline=False)

        def rows(raw):
            day = F.col("day").try_cast("date")
            return raw.select("station", day.alias("day"), "mm", LOADED_AT, "_source_file", F.year(day).alias("year")).where("mm is not null")

        order = [F.col(LOADED_AT).desc(), "mm"]
        return IncrementalTable(self.spark, f"{self.folder}/*.json", str(out), read, rows, "year", ["station", "day"], order)

    def refresh(self):
        self.read_files.clear()
        return self.table.refresh()

    def equals_full_build(self, tmp_path):
        full = self.incremental(tmp_path / f"full-{self.clock}")
        full.refresh()
        return rows_of(self.table.table()) == rows_of(full.table())


def test_a_new_file_reads_and_writes_its_year_only(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    for station in "ab":
        for year in (2019, 2020, 2021):
            feed.land(f"{station}_{year}.json", [(station, f"{year}-01-{d:02}", d / 10) for d in range(1, 20)])
    first = feed.refresh()
    assert first.version == 1 and first.periods == [2019, 2020, 2021] and len(first.files) == 6
    assert feed.refresh().version is None and not feed.read_files  # nothing landed: nothing is parsed

    feed.land("a_2020_revised.json", [("a", "2020-01-05", 99.0), ("a", "2020-02-01", 1.0)])
    second = feed.refresh()
    assert second.periods == [2020] and [f.rsplit("/", 1)[1] for f in second.files] == ["a_2020.json", "a_2020_revised.json", "b_2020.json"]
    assert feed.read_files == [["a_2020_revised.json"], ["a_2020.json", "a_2020_revised.json", "b_2020.json"]]
    assert rows_of(feed.table.facts.versions()) == [(1, 3, 114, 3), (2, 3, 115, 1)]
    got = {(r["station"], str(r["day"])): r["mm"] for r in feed.table.table().collect()}
    assert got["a", "2020-01-05"] == 99.0 and got["a", "2020-02-01"] == 1.0 and len(got) == 115
    assert feed.equals_full_build(tmp_path)


def test_changed_removed_and_odd_files(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    assert feed.refresh().version is None and landed_files(spark, f"{feed.folder}/*.json").collect() == []
    feed.land("a.json", [("a", "2019-12-31", 1.0), ("a", "2020-01-01", 2.0)])
    feed.land("b.json", [("b", "2020-01-01", 3.0), ("b", "no date", 4.0)])
    feed.land("empty.json", [])
    feed.land("void.json", [("c", "2021-01-01", None)])
    assert feed.refresh().periods == [2019, 2020] and feed.equals_full_build(tmp_path)
    assert feed.refresh().version is None
    feed.land("a.json", [("a", "2021-05-05", 7.0)])  # moves from two years to a third
    assert feed.refresh().periods == [2019, 2020, 2021] and feed.equals_full_build(tmp_path)
    (feed.folder / "b.json").unlink()
    feed.refresh()
    assert [r["station"] for r in feed.table.table().collect()] == ["a"] and feed.equals_full_build(tmp_path)
    (feed.folder / "a.json").unlink()
    feed.refresh()
    assert feed.table.table().collect() == []


def test_a_run_that_dies_before_the_manifest_is_done_again(spark, tmp_path, monkeypatch):
    feed = Feed(spark, tmp_path)
    feed.land("a.json", [("a", "2019-01-01", 1.0)])
    feed.refresh()
    feed.land("b.json", [("a", "2019-01-01", 2.0), ("a", "2020-01-01", 3.0)])

    def dies(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(feed.table.manifest, "replace", dies)
        with pytest.raises(KeyboardInterrupt):
            feed.refresh()
    assert feed.refresh().periods == [2019, 2020] and feed.equals_full_build(tmp_path)
