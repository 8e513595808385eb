"""Tables in the shared file system that a micro-batch can be written to again without harm.

Each micro-batch owns the folder ``batch_id=N`` and overwrites it when it is replayed after a
failure, so every row is there exactly once. An upsert table is the same log of micro-batches read
as the last row per key: writing costs what the batch costs, whatever the size of the table, but for the folding of
the log every so many micro-batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

BATCH = "batch_id"


#: an upsert log is folded every so many micro-batches; it never has more than twice as many folders
FOLD_EVERY = 20


def folders(spark: SparkSession, path: str, name: str = BATCH, holding: str | None = None) -> list[int]:
    """The numbers N of the folders ``name=N`` of a table (those that hold a file of a given name)."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(root):
        return []
    found = [s.getPath() for s in store.listStatus(root) if s.getPath().getName().startswith(f"{name}=")]
    if holding:
        found = [p for p in found if store.exists(spark._jvm.org.apache.hadoop.fs.Path(p, holding))]
    return [int(p.getName().split("=")[1]) for p in found]


def forget(spark: SparkSession, path: str, before: int) -> None:
    """Remove the folders of micro-batches before a number."""
    for number in folders(spark, path):
        if number < before:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{BATCH}={number}")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_once(df: DataFrame, path: str, batch_id: int) -> None:
    """Put the rows of one micro-batch in place of an earlier attempt at the same micro-batch."""
    df.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")


def to_table_once(path: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: append every micro-batch exactly once."""
    return lambda df, batch_id: write_once(df, path, batch_id)


def read_once(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(BATCH)


def read_batches(spark: SparkSession, path: str, first: int, last: int) -> DataFrame:
    """The rows of micro-batches from ``first`` on and before ``last``, with their number."""
    folders = [f"{path}/{BATCH}={i}" for i in range(first, last)]
    return spark.read.option("basePath", path).parquet(*folders)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key; combined before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*order, *[c for c in rest if c not in order])
    return (
        df.groupBy(*keys)
        .agg(F.max(row).alias("_last"))
        .select(*[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in df.columns])
    )


def upsert(updates: DataFrame, path: str, keys: Sequence[str], order: str, batch_id: int, fold_every: int = FOLD_EVERY) -> None:
    """Insert or replace by primary key: the last row by ``order`` wins, then the later micro-batch.

    Every ``fold_every`` micro-batches the current row of every key is written with the micro-batch, and what was written
    before the fold before goes; until then a reader that began earlier may still be reading it, and a micro-batch that
    is delivered again finds the same rows to fold.
    """
    rows = last_per_key(updates, keys, [order])
    if batch_id and batch_id % fold_every == 0:
        spark = updates.sparkSession
        before = read_batches(spark, path, batch_id - fold_every, batch_id)
        both = before.unionByName(rows.withColumn(BATCH, F.lit(batch_id)))
        rows = last_per_key(both, keys, [BATCH]).drop(BATCH)
        write_once(rows, path, batch_id)
        forget(spark, path, batch_id - fold_every)
    else:
        write_once(rows, path, batch_id)


def to_upsert(path: str, keys: Sequence[str], order: str, fold_every: int = FOLD_EVERY) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: :func:`upsert` of every micro-batch."""
    return lambda df, batch_id: upsert(df, path, keys, order, batch_id, fold_every)


def read_latest(
    spark: SparkSession, path: str, keys: Sequence[str], before: int | None = None, since: int = 0
) -> DataFrame:
    """The current row per key, from micro-batch ``since`` on. With ``before``, as of before that micro-batch: then the
    folders in between are read by name, and the rest of the log is not even listed."""
    if before is None:
        log = spark.read.parquet(path).where(F.col(BATCH) >= since)
    else:
        log = read_batches(spark, path, since, before)
    return last_per_key(log, keys, [BATCH]).drop(BATCH)


def compact(spark: SparkSession, path: str, keys: Sequence[str], target: str) -> None:
    """Write the current rows to a new table, under the number of the newest micro-batch in them,
    so the stream can go on there."""
    log = spark.read.parquet(path)
    newest = log.agg(F.max(BATCH)).first()[0]
    write_once(read_latest(spark, path, keys), target, newest)


def to_kv_latest(path: str, hash_name: str, field: str, value: str, order: str) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: keep the newest value per field of a named hash."""
    def write(df: DataFrame, batch_id: int) -> None:
        pairs = df.select(
            F.lit(hash_name).alias("hash"),
            F.col(field).cast("string").alias("field"),
            F.col(value).cast("string").alias("value"),
            F.col(order).alias("written"),
        )
        upsert(pairs, path, ["hash", "field"], "written", batch_id)

    return write
