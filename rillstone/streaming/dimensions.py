"""Dimensions that change while a stream runs: snapshots by version, and each micro-batch uses the newest."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from rillstone.operators.joins import lookup_join
from rillstone.operators.skew import BROADCAST_BYTES
from rillstone.sinks.tables import folders, write_once

VERSION = "version"


def publish(dim: DataFrame, path: str, version: int) -> None:
    """Write a snapshot. It counts once it is whole: Spark's note of success is the last file written."""
    dim.write.mode("overwrite").parquet(f"{path}/{VERSION}={version}")


def newest(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest whole snapshot, if there is one."""
    whole = folders(spark, path, VERSION, holding="_SUCCESS")
    return spark.read.parquet(f"{path}/{VERSION}={max(whole)}") if whole else None


def lookup_latest(
    dim: str, out: str, keys: Sequence[str], broadcast_bytes: int = BROADCAST_BYTES
) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: append the rows with the columns of the newest snapshot, NULL where it has no such key.

    The snapshot is read anew in every micro-batch, and is broadcast only within ``broadcast_bytes``. A micro-batch that is
    delivered again after a failure uses the snapshot of that time. Before the first snapshot nothing can be looked up,
    which is an error rather than rows of NULLs. Keys of a snapshot are unique.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        snapshot = newest(df.sparkSession, dim)
        if snapshot is None:
            raise ValueError(f"no snapshot of the dimension in {dim} yet")
        write_once(lookup_join(df, snapshot, list(keys), broadcast_bytes=broadcast_bytes), out, batch_id)

    return write
