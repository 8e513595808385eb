"""Aggregates and joins for keys of very unequal size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: a side of a join is broadcast only if Catalyst's estimate of it stays below this
BROADCAST_BYTES = 32 * 1024 * 1024

#: pieces a large side's key is spread over in a shuffled lookup
SALTS = 16


def spread_salt(df: DataFrame, salts: int = SALTS) -> Column:
    """A salt from the row and the task that reads it: copies of one row differ too, and a task that
    runs again gives the same salts."""
    hashable = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return F.pmod(F.xxhash64(*hashable, F.spark_partition_id()), F.lit(salts)).cast("int")


def every_salt(salts: int = SALTS) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of the optimized plan: file sizes and row widths, no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def salted_sum(
    df: DataFrame, keys: Sequence[str], value: str, spread: Sequence[str], buckets: int = 10
) -> DataFrame:
    """Sum per key in two steps: per key and salt, then per key.

    The salt is a hash of the ``spread`` columns, so a task that runs again salts the same way.
    """
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(buckets)))
    partial = salted.groupBy(*keys, "_salt").agg(F.sum(value).alias(value))
    return partial.groupBy(*keys).agg(F.sum(value).alias(value))


def salted_sides(left: DataFrame, right: DataFrame, salts: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides of a join whose left rows are spread over ``salts`` pieces per key, with every right
    row in each piece; and the column to add to the join key. Inner and left joins stay the same."""
    if salts <= 1:
        return left, right, []
    return left.withColumn("_salt", spread_salt(left, salts)), right.withColumn("_salt", every_salt(salts)), ["_salt"]


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "left",
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Join rows to a dimension by equal keys.

    A dimension whose estimated size is within ``broadcast_bytes`` is broadcast and the rows stay
    where they are. Otherwise both sides are shuffled, each row once: adaptive execution splits the partitions of
    hot keys. Where it is switched off, each key's rows are spread over ``salts`` pieces and every dimension row is
    repeated once per piece.
    """
    if how not in ("left", "inner"):
        raise ValueError("a lookup is a left or an inner join")
    if estimated_bytes(dim) <= broadcast_bytes:
        return df.join(F.broadcast(dim), list(on), how)
    settings = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled")
    if all(df.sparkSession.conf.get(name, "true") == "true" for name in settings):
        return df.join(dim, list(on), how)
    left, right, salt = salted_sides(df, dim, salts)
    return left.join(right, [*on, *salt], how).drop(*salt)
