"""Readers for landed JSON and CSV, with load metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonstar.sources.schemas import CORRUPT, with_corrupt

LOADED_AT = "_loaded_at"
SOURCE_FILE = "_source_file"


def with_lineage(df: DataFrame) -> DataFrame:
    """Add the time each row's file landed and the file itself, so that a later file counts as newer."""
    return df.select(
        "*", F.col("_metadata.file_modification_time").alias(LOADED_AT), F.col("_metadata.file_path").alias(SOURCE_FILE)
    )


def read_json(spark: SparkSession, path: str | list[str], schema: T.StructType, multiline: bool = True) -> DataFrame:
    """JSON files (a glob or a list), one row per element of a top-level array or per object.

    Fields a file lacks are NULL, so files of different age are unioned by name. A record that cannot be
    read keeps its text in `_corrupt_record`. A pretty-printed file or array is parsed by one task, so
    large feeds should land as many files or as JSON lines (`multiline=False`), which Spark splits.
    """
    reader = (
        spark.read.schema(with_corrupt(schema))
        .option("multiLine", multiline)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    return with_lineage(reader.json(path))


def empty_table(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed table without rows, in the shape `read_json` gives."""
    meta = [T.StructField(LOADED_AT, T.TimestampType()), T.StructField(SOURCE_FILE, T.StringType())]
    return spark.createDataFrame([], T.StructType([*with_corrupt(schema).fields, *meta]))


def read_or_empty(spark: SparkSession, path: str | list[str], schema: T.StructType, multiline: bool = True) -> DataFrame:
    """`read_json`, or a typed empty table where an optional source was never landed."""
    try:
        return read_json(spark, path, schema, multiline)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_table(spark, schema)


def read_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV lookup table with a header; columns are matched by position and checked by name."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def union_by_name(*tables: DataFrame) -> DataFrame:
    """All rows of all tables; a column that one of them lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
