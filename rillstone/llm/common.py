"""Column helpers and the shared-folder cut that the operators have in common."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rillstone.session import fresh_path

SPACE = r"[\x20\x09-\x0D]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often ``body`` mentions it."""
    return F.transform(F.array(value), body)[0]


def whole_text(text: str = "text") -> Column:
    """The text, a NULL as an empty one."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and no other letter touched. ``lower`` does the same, and faster, unless another
    letter has a lower case too."""
    return F.when(text.rlike(r"[\p{IsUppercase}\p{Lt}&&[^A-Z]]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))


def split_words(text: Column, between: str = SPACE) -> Column:
    return F.array_remove(F.split(text, between), "")


def row_key(*cols: str) -> Column:
    """A number that tells apart rows with one id but different texts; rows equal in both are one document."""
    return F.xxhash64(*cols)


def spare(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before those that a column of the rows has already."""
    used, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in used:
            name = "_" + name
        used.add(name.lower())
        out.append(name)
    return out


def columns_of(df: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in df.columns]


def marked(docs: DataFrame, wanted: DataFrame, doc: str, text: str, how: str, extra: str | None = None) -> tuple[DataFrame, str]:
    """Documents joined to rows of (doc, key, ...) by id and text hash, and the name under which ``extra`` comes along."""
    mine, theirs, of, more = spare(docs, "_mine", "_theirs", "_of", "_more")
    right = wanted.select(F.col("doc").alias(theirs), F.col("key").alias(of), *([F.col(extra).alias(more)] if extra else []))
    keyed = docs.withColumn(mine, row_key(doc, text))
    same = (F.col(mine) == F.col(of)) & F.col(doc).cast("bigint").eqNullSafe(F.col(theirs))
    return keyed.join(right, same, how).select(*columns_of(docs), *([more] if extra else [])), more


#: the bit field: bits for each hash, and how many it has at most (4 MB, which two million hashes fill to an eighth)
HASH_BITS, MOST_BITS = 16, 1 << 25


def probes(h: Column, bits: int) -> list[Column]:
    """The two bits of a hash."""
    return [F.pmod(h, F.lit(bits)), F.pmod(F.shiftright(h, 32), F.lit(bits))]


def bit_field(hashes: DataFrame, most: int = MOST_BITS) -> tuple[Column, int] | None:
    """The bits of all hashes (a column ``hash``) as a constant array of longs, and their number; None without rows."""
    n = hashes.count()
    if not n:
        return None
    bits = max(64, min(1 << (HASH_BITS * n - 1).bit_length(), most))
    set_bits = hashes.select(F.explode(F.array(*probes(F.col("hash"), bits))).alias("bit"))
    longs = [0] * (bits // 64)  # no more rows than longs
    for at, value in set_bits.groupBy(F.expr("bit div 64").alias("at")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(bit % 64 AS INT))")).alias("value")
    ).collect():
        longs[at] = value
    return F.split(F.lit(",".join(map(str, longs))), ",").cast("array<bigint>"), bits


def in_field(h: Column, field: tuple[Column, int]) -> Column:
    """Whether both bits of a hash are set: always for the field's own hashes, and seldom for others."""
    longs, bits = field

    def is_set(bit: Column) -> Column:
        return F.getbit(F.get(longs, F.shiftright(bit, 6).cast("int")), F.pmod(bit, F.lit(64)).cast("int")) == 1

    first, second = probes(h, bits)
    return is_set(first) & is_set(second)


#: while it is on, the shuffle files of a write go as soon as it is done, instead of when the driver next collects garbage
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: folders that operators wrote for themselves, until they are discarded
_folders: list[str] = []


def cut(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read from there: what follows starts from files that
    outlive any executor, and its size is known to the optimizer. The shuffle files behind them go."""
    spark = df.sparkSession
    path, before = fresh_path(spark, name), spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    _folders.append(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession) -> None:
    """Remove what operators have written for themselves so far. Only when the results built on it are written."""
    while _folders:
        folder = spark._jvm.org.apache.hadoop.fs.Path(_folders.pop())
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def mix64(x: np.ndarray) -> np.ndarray:
    """A fixed bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
