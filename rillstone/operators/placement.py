"""Where rows go: explicit repartitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def round_robin(df: DataFrame, n: int) -> DataFrame:
    return df.repartition(n)


def random_spread(df: DataFrame, n: int) -> DataFrame:
    """Spread without regard to content but the same way on a retry: by a hash of the row and its place
    in what is read, so that equal rows spread too."""
    hashable = [f.name for f in df.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    return df.repartition(n, F.xxhash64(*hashable, F.monotonically_increasing_id()))


def by_key(df: DataFrame, n: int, *keys: str) -> DataFrame:
    return df.repartition(n, *keys)


def by_rule(df: DataFrame, target: Column, n: int) -> DataFrame:
    """The row goes to exactly the partition ``target`` names (0 to n - 1)."""
    return df.repartitionById(n, target.cast("int"))


def replicate(df: DataFrame, n: int, copy: str = "copy_no") -> DataFrame:
    """Every row once in each of ``n`` partitions."""
    copies = df.withColumn(copy, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return copies.repartitionById(n, F.col(copy))


def fewer(df: DataFrame, n: int) -> DataFrame:
    """Merge partitions without a shuffle."""
    return df.coalesce(n)
