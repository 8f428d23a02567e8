"""Incremental tables: what landed since the last run decides which periods are computed again."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seasonstar.operators.staging import dedup_latest
from seasonstar.sources.readers import SOURCE_FILE
from seasonstar.sources.scratch import freeze
from seasonstar.sources.snapshots import SnapshotTable

_FILE = ["file", "modified", "size"]


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """The files a path or glob names: place, name as rows carry it, modification time, size. Their content is not read."""
    try:
        found = spark.read.format("binaryFile").load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "place string, file string, modified timestamp, size long")
    return found.select(
        F.col("path").alias("place"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_modification_time").alias("modified"), F.col("_metadata.file_size").alias("size"),
    )


@dataclass(frozen=True)
class Refresh:
    """What a run did: its version of the table (None: nothing to do), files parsed, periods computed."""

    version: int | None = None
    new_files: list[str] = field(default_factory=list)
    files: list[str] = field(default_factory=list)
    periods: list = field(default_factory=list)


@dataclass
class IncrementalTable:
    """A de-duplicated table over landed files, kept by period below `out`.

    `read` reads a list of files, with their names in `_source_file`; `rows` turns what was read into the table's rows,
    keeping `_source_file`, with a column `period`. One row per key stays, the first in `order`. The table is a
    `SnapshotTable` by period, and so is the manifest: which file, of which time and size, feeds which period with how
    many rows. The order of commits is table, then manifest; a run that dies in between is done again by the next one.
    """

    spark: SparkSession
    landing: str
    out: str
    read: Callable[[list[str]], DataFrame]
    rows: Callable[[DataFrame], DataFrame]
    period: str
    keys: list[str]
    order: list[Column]

    def __post_init__(self) -> None:
        self.facts = SnapshotTable(self.spark, f"{self.out}/table", [self.period])
        self.manifest = SnapshotTable(self.spark, f"{self.out}/manifest", [self.period])

    def table(self) -> DataFrame:
        return self.facts.read()

    def _known(self) -> DataFrame | None:
        return self.manifest.read() if self.manifest.latest_version() else None

    def _fed(self, landed: DataFrame) -> DataFrame:
        """Manifest rows of landed files: one per file and period; a file without rows has one without a period."""
        places = [r["place"] for r in landed.select("place").collect()]
        found = self.rows(self.read(places)) if places else None
        if found is None:
            return landed.select(*_FILE, "place").withColumn(self.period, F.lit(None).cast("int")).withColumn("n_rows", F.lit(0).cast("long"))
        counted = found.groupBy(F.col(SOURCE_FILE).alias("_fed"), F.col(self.period)).agg(F.count("*").alias("n_rows"))
        joined = landed.join(counted, F.col("file") == F.col("_fed"), "left")
        return joined.select(*_FILE, "place", self.period, F.coalesce("n_rows", F.lit(0).cast("long")).alias("n_rows"))

    def refresh(self) -> Refresh:
        """Compute again the periods that new, changed or removed files feed, from the files that feed them.

        Files that feed none of these periods are neither read nor parsed, and other periods are not written. The
        lists of files pass the driver, as they do whenever Spark reads files; rows don't.
        """
        landed = freeze(landed_files(self.spark, self.landing), "landed-files")
        known = self._known()
        if known is None:
            new, gone = landed, None
        else:
            new = landed.join(known.select(*_FILE).distinct(), _FILE, "left_anti").select(landed.columns)
            gone = known.join(landed, _FILE, "left_anti")
        if new.isEmpty() and (gone is None or gone.isEmpty()):
            return Refresh()
        fed = freeze(self._fed(new), "fed")
        touched = fed.select(self.period)
        if gone is not None:
            touched = touched.union(gone.select(self.period))
        touched = freeze(touched.distinct(), "touched")
        same = F.col(f"fed.{self.period}").eqNullSafe(F.col(f"touched.{self.period}"))
        feeding = fed
        if known is not None:
            old = known.join(landed.select(*_FILE), _FILE, "left_semi").select(fed.columns)
            feeding = fed.union(old.alias("fed").join(touched.alias("touched"), same, "left_semi"))
        feeding = freeze(feeding, "feeding")
        files = [r["place"] for r in feeding.where("n_rows > 0").select("place").distinct().orderBy("place").collect()]
        periods = [r[0] for r in touched.where(F.col(self.period).isNotNull()).orderBy(self.period).collect()]
        if files:
            rows = self.rows(self.read(files)).alias("fed").join(touched.alias("touched"), same, "left_semi")
            version = self.facts.replace(dedup_latest(rows, self.keys, self.order).drop(SOURCE_FILE), touched)
        elif self.facts.latest_version():
            version = self.facts.replace(self.facts.read().limit(0), touched)
        else:
            version = None
        self.manifest.replace(feeding, touched)
        return Refresh(version, [r["place"] for r in new.select("place").orderBy("place").collect()], files, periods)
