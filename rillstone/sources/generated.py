"""Rows from literals, number sequences and a clock."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """A small bounded input written in the program."""
    return spark.createDataFrame(list(rows), schema)


def sequence(spark: SparkSession, lo: int, hi: int, parts: int | None = None) -> DataFrame:
    """The numbers ``lo`` to ``hi``, both included, made in parallel."""
    return spark.range(lo, hi + 1, 1, parts).withColumnRenamed("id", "n")


def generate(
    spark: SparkSession, rows_per_second: int = 1, parts: int = 1, **columns: Column
) -> DataFrame:
    """An endless stream on a clock with computed columns, e.g. ``n=random_int(100)`` or ``id=F.uuid()``."""
    clock = (
        spark.readStream.format("rate")
        .option("rowsPerSecond", rows_per_second)
        .option("numPartitions", parts)
        .load()
    )
    return clock.select(
        F.col("timestamp").alias("ts"), F.col("value").alias("seq"), *[c.alias(n) for n, c in columns.items()]
    )
