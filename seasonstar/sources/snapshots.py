"""Versioned tables: partitions are replaced in one commit, and readers see the version before or after it."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonstar.operators.staging import dedup_latest
from seasonstar.sources.readers import union_by_name
from seasonstar.sources.scratch import freeze

HOME = "_home"
VERSION = "_version"


class SnapshotTable:
    """A Parquet table partitioned by `partition_by`, below one path.

    rows/_home=<id>/<partition>/…   rows as one commit wrote them; a file never changes
    commits/_version=<n>/…          one file: every partition of the version, the commit its rows are from, their number

    A commit writes its rows below a new id and then the list of partitions, as a single file that Spark moves into
    place when it is complete. Until then readers see the version before, whatever happened to the writer, and a
    version that is being read stays as it is until `vacuum`. One writer at a time: of two that start from the same
    version, the second one fails. The list has one row per partition, so it is small beside the table, but one task
    writes it: tables of more than some million partitions should be cut into several.
    """

    def __init__(self, spark: SparkSession, path: str, partition_by: list[str]):
        self.spark, self.path, self.partition_by = spark, path.rstrip("/"), list(partition_by)

    # versions

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.parquet(f"{self.path}/commits")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def latest_version(self) -> int:
        """The number of the last finished commit, 0 before the first one."""
        commits = self._commits()
        return 0 if commits is None else commits.agg(F.max(VERSION)).first()[0] or 0

    def versions(self) -> DataFrame:
        """version, partitions, rows and partitions written by it, of every commit."""
        commits = self._commits()
        if commits is None:
            return self.spark.createDataFrame([], "version int, partitions long, n_rows long, written long")
        listed = F.col(HOME).isNotNull()
        return commits.groupBy(F.col(VERSION).cast("int").alias("version")).agg(
            F.count_if(listed).alias("partitions"), F.coalesce(F.sum("_rows"), F.lit(0)).alias("n_rows"),
            F.count_if(listed & (F.col(HOME) == F.col("_commit"))).alias("written"),
        )

    def partitions(self) -> DataFrame:
        """Each partition of the last version with its number of rows and the version that wrote it."""
        found = self._listed(None)
        if found is None:
            raise ValueError(f"no finished commit below {self.path}")
        heads = self._commits().where(F.col(HOME).isNull())
        wrote = heads.select(F.col("_commit").alias(HOME), F.col(VERSION).cast("int").alias("written_in"))
        return found[0].join(wrote, HOME).select(*self.partition_by, F.col("_rows").alias("n_rows"), "written_in")

    def _listed(self, version: int | None) -> tuple[DataFrame, T.StructType] | None:
        """The partitions of a version with the commits that hold them, and the table's schema."""
        version = self.latest_version() if version is None else version
        if not version:
            return None
        listed = self.spark.read.parquet(f"{self.path}/commits/{VERSION}={version}")
        head = listed.where(F.col(HOME).isNull()).select("_schema").first()
        return listed.where(F.col(HOME).isNotNull()), T.StructType.fromJson(json.loads(head[0]))

    # reading

    def _rows(self, listed: DataFrame, schema: T.StructType) -> DataFrame:
        """The rows of listed partitions.

        All keys are folders. The list is joined by plain equality, so that Spark prunes the folders by it while the
        query runs; partitions with a null key, which equality can't find, are joined on their own.
        """
        kinds = {f.name: f.dataType for f in schema.fields}
        fields = [f for f in schema.fields if f.name not in self.partition_by]
        fields += [T.StructField(HOME, T.StringType()), *(T.StructField(c, kinds[c]) for c in self.partition_by)]
        rows = self.spark.read.schema(T.StructType(fields)).parquet(f"{self.path}/rows")
        wanted = listed.where(F.col("_rows") > 0)  # pruning needs a condition here
        some_null = reduce(Column.__or__, (F.col(c).isNull() for c in self.partition_by))
        found = []
        for part, equal in ((~some_null, Column.__eq__), (some_null, Column.eqNullSafe)):
            left, right = rows.where(part).alias("rows"), wanted.where(part).select(HOME, *self.partition_by).alias("listed")
            same = [equal(F.col(f"rows.{c}"), F.col(f"listed.{c}")) for c in self.partition_by]
            found.append(left.join(right, [F.col(f"rows.{HOME}") == F.col(f"listed.{HOME}"), *same], "left_semi").select(schema.names))
        return found[0].unionByName(found[1])

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of the last commit, or of an earlier one."""
        found = self._listed(version)
        if found is None:
            raise ValueError(f"no finished commit below {self.path}")
        return self._rows(*found)

    def read_partitions(self, touched: DataFrame) -> DataFrame | None:
        """The rows of the partitions that occur in `touched`; None before the first commit."""
        found = self._listed(None)
        if found is None:
            return None
        listed, schema = found
        return self._rows(self._matching(listed, touched, "left_semi"), schema)

    def _matching(self, listed: DataFrame, touched: DataFrame, how: str) -> DataFrame:
        keys = touched.select(*(F.col(c).alias(f"_new_{c}") for c in self.partition_by)).distinct()
        same: Column = F.lit(True)
        for c in self.partition_by:
            same &= F.col(c).eqNullSafe(F.col(f"_new_{c}"))
        return listed.join(keys, same, how)

    # writing

    def write(self, df: DataFrame, commit: str) -> None:
        """First half of a commit: the rows, where no reader looks yet."""
        df.hint("rebalance", *self.partition_by).write.partitionBy(*self.partition_by).parquet(f"{self.path}/rows/{HOME}={commit}")

    def finish(self, schema: T.StructType, commit: str, replaced: DataFrame | None = None) -> int:
        """Second half: list the partitions written, in place of those of the same keys and of `replaced`."""
        version = self.latest_version()
        before = self._listed(version)
        kinds = {f.name: f.dataType for f in schema.fields}
        fields = [T.StructField(c, kinds[c]) for c in self.partition_by]
        rows = self.spark.read.schema(T.StructType([*fields, T.StructField(HOME, T.StringType())])).parquet(f"{self.path}/rows")
        written = rows.where(F.col(HOME) == commit).groupBy(*self.partition_by, HOME).agg(F.count("*").alias("_rows"))
        listed = written.select(*self.partition_by, HOME, "_rows")
        if before is not None:
            gone = written.select(*self.partition_by)
            gone = gone if replaced is None else gone.union(replaced.select(*self.partition_by))
            kept = self._matching(before[0], gone, "left_anti")
            listed = listed.unionByName(kept.select(*self.partition_by, HOME, "_rows"))
        head = self.spark.range(1).select(
            *(F.lit(None).cast(f.dataType).alias(f.name) for f in fields), F.lit(None).cast("string").alias(HOME),
            F.lit(None).cast("long").alias("_rows"), F.lit(commit).alias("_commit"), F.lit(schema.json()).alias("_schema"),
        )
        listed = listed.withColumn("_commit", F.lit(commit)).withColumn("_schema", F.lit(None).cast("string"))
        head.unionByName(listed).coalesce(1).write.mode("error").parquet(f"{self.path}/commits/{VERSION}={version + 1}")
        return version + 1

    def replace(self, df: DataFrame, replaced: DataFrame | None = None) -> int:
        """Commit `df` in place of the partitions it touches, and of those in `replaced`, which may be left empty.

        The partitions of all others are neither read nor written. Gives the new version.
        """
        clash = [c for c in df.columns if c in (HOME, VERSION)]
        if clash:
            raise ValueError(f"reserved column names: {clash}")
        commit = uuid.uuid4().hex
        self.write(df, commit)
        return self.finish(df.schema, commit, replaced)

    def upsert(self, new: DataFrame, keys: list[str], order: list[Column]) -> int:
        """Merge revised rows: the first row per key in `order` counts; only the partitions of `new` are rewritten.

        `keys` must include the partition columns, so that a key never moves between partitions. A column that only one
        side has is NULL on the other.
        """
        missing = [c for c in self.partition_by if c not in keys]
        if missing:
            raise ValueError(f"partition columns must be part of the key: {missing}")
        new = freeze(new, "revised")  # read twice: for its partitions and for its rows
        old = self.read_partitions(new)
        return self.replace(dedup_latest(new if old is None else union_by_name(old, new), keys, order))

    # cleaning

    def unlisted(self, keep: int = 1) -> list[str]:
        """Commits with rows that none of the last `keep` versions lists: older ones, and those never finished."""
        folders = self._folders(f"{self.path}/rows")
        written = {name.removeprefix(f"{HOME}=") for name in folders if name.startswith(f"{HOME}=")}
        commits, last = self._commits(), self.latest_version()
        if commits is None:
            return sorted(written)
        used = commits.where((F.col(VERSION) > last - keep) & F.col(HOME).isNotNull()).select(HOME).distinct()
        return sorted(written - {r[0] for r in used.collect()})

    def vacuum(self, keep: int = 1) -> list[str]:
        """Delete the rows of `unlisted` commits, and what lists older versions. No writer may be at work."""
        gone = self.unlisted(keep)
        last = self.latest_version()
        old = [f"commits/{name}" for name in self._folders(f"{self.path}/commits") if self._number(name) <= last - keep]
        for name in [*old, *(f"rows/{HOME}={c}" for c in gone)]:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        return gone

    @staticmethod
    def _number(name: str) -> int:
        digits = name.removeprefix(f"{VERSION}=")
        return int(digits) if digits.isdigit() else 1 << 62

    def _folders(self, path: str) -> list[str]:
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []
