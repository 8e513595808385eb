"""Text and parquet files, read once or watched."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_lines(
    spark: SparkSession,
    path: str,
    stream: bool = False,
    files_per_trigger: int | None = None,
    col: str = "line",
) -> DataFrame:
    """Lines of text files. As a stream the folder is watched and each new file is read exactly once:
    which files were read is kept in the query's checkpoint, so a restart goes on after them.

    How often the folder is looked at is the trigger of the query (``every`` of
    :func:`rillstone.streaming.runner.start`).
    """
    reader = spark.readStream if stream else spark.read
    reader = reader.option("lineSep", "\n")
    if stream and files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.text(path).select(F.col("value").alias(col))


def read_rows_stream(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """Rows of parquet files as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
