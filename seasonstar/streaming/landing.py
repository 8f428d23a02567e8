"""Files that arrive between runs are picked up once each and appended to a landed table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seasonstar.operators.staging import dedup_latest
from seasonstar.sources.readers import LOADED_AT, SOURCE_FILE


def land_new_files(
    spark: SparkSession, source: str, schema: T.StructType, target: str, checkpoint: str,
    file_format: str = "json", options: dict[str, str] | None = None, partition_by: list[str] | None = None,
    files_per_batch: int | None = None,
) -> None:
    """Append every file of `source` not seen before to the Parquet table `target`, then stop.

    The checkpoint remembers the files, and the file sink commits whole batches, so a run that is
    repeated after a failure neither skips nor doubles a file.
    """
    reader = spark.readStream.format(file_format).schema(schema).options(**(options or {}))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.load(source).select(
        "*", F.current_timestamp().alias(LOADED_AT), F.col("_metadata.file_path").alias(SOURCE_FILE)
    )
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.start(target).awaitTermination()


def latest_landed(spark: SparkSession, target: str, keys: list[str], order: list[Column]) -> DataFrame:
    """The current state of a landed table: revisions may reach back any time, the latest row wins."""
    return dedup_latest(spark.read.parquet(target), keys, order)
