"""Keyed state with expiry, last-n lists and timers, over rows in arrival order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from rillstone.operators.scan import BLOCK, BLOCK_ROWS, CUTS, REAL, block_at, with_blocks, with_cuts
from rillstone.timeunits import as_micros, epoch_micros, interval


def rolling_ttl(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    ts: str,
    ttl: str,
    value: str,
    out: str = "running",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Running sum per key that starts over when the key was silent for ``ttl`` or longer.

    A split key (see :mod:`~rillstone.operators.scan`) hands two things to each next block: the time
    of its last row and the sum that is still alive. They become the block's first row.
    """
    keys, micros = list(keys), as_micros(ttl)
    rows = (
        with_blocks(df, keys, seq, block_rows)
        .withColumn("_at", epoch_micros(ts))
        .withColumn("_v", F.coalesce(F.col(value), F.lit(0)))
        .withColumn(REAL, F.lit(1))
    )

    def alive(blocks: DataFrame, out: str) -> DataFrame:
        """Within each block: the sum since the last silence, and whether the row ended one."""
        inside = Window.partitionBy(*keys, BLOCK).orderBy(REAL, seq)
        upto = inside.rowsBetween(Window.unboundedPreceding, 0)
        marked = blocks.withColumn(
            "_fresh", F.coalesce(F.col("_at") - F.lag("_at").over(inside) >= micros, F.lit(False))
        ).withColumn("_sum", F.sum("_v").over(upto))
        dead = F.last(F.when(F.col("_fresh"), F.col("_sum") - F.col("_v")), ignorenulls=True)
        return marked.withColumn(out, F.col("_sum") - F.coalesce(dead.over(upto), F.lit(0)))

    big = rows.where(F.col(BLOCK) > 0).select(*keys, seq, BLOCK, "_at", "_v", REAL)
    ends = (
        alive(big, "_alive")
        .groupBy(*keys, BLOCK)
        .agg(
            F.min(F.struct(seq, "_at"))["_at"].alias("_first_at"),
            F.max(F.struct(seq, "_at"))["_at"].alias("_last_at"),
            F.max(F.struct(seq, "_alive"))["_alive"].alias("_tail"),
            F.max("_fresh").alias("_broken"),
        )
    )
    along = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(BLOCK)
    previous = F.lag("_last_at").over(along)
    ends = ends.withColumn("_prev_at", previous).withColumn(
        "_reset",
        (
            F.col("_broken")
            | F.col("_prev_at").isNull()
            | (F.col("_first_at") - F.col("_prev_at") >= micros)
        ).cast("int"),
    )
    ends = ends.withColumn(
        "_stretch", F.sum("_reset").over(along.rowsBetween(Window.unboundedPreceding, 0))
    )
    in_stretch = Window.partitionBy(*keys, "_stretch").orderBy(BLOCK)
    ends = ends.withColumn(
        "_open", F.sum("_tail").over(in_stretch.rowsBetween(Window.unboundedPreceding, 0))
    )
    inherited = (
        ends.select(*keys, BLOCK, F.col("_prev_at").alias("_at"), F.lag("_open").over(along).alias("_v"))
        .where(F.col("_at").isNotNull())
        .withColumn(REAL, F.lit(0))
    )
    both = rows.unionByName(inherited, allowMissingColumns=True)
    return alive(both, out).where(F.col(REAL) == 1).select(*df.columns, out)


def last_n(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    value: str,
    n: int = 10,
    out: str = "last_values",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Per row the last ``n`` values of its key, oldest first. Blocks repeat the ``n - 1`` rows before them."""
    keys = list(keys)
    rows = with_blocks(df, keys, seq, block_rows).withColumn(REAL, F.lit(1))
    newest_first = Window.partitionBy(*keys, BLOCK).orderBy(F.col(seq).desc())
    tails = (
        rows.where(F.col(BLOCK) > 0)
        .select(*keys, BLOCK, seq, value)
        .withColumn("_r", F.row_number().over(newest_first))
        .where(F.col("_r") < n)
        .groupBy(*keys, BLOCK)
        .agg(F.sort_array(F.collect_list(F.struct(seq, value))).alias("_tail"))
    )
    # every block has a row, so n - 1 earlier blocks hold the n - 1 earlier rows
    earlier = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(BLOCK).rowsBetween(-(n - 1), -1)
    repeated = (
        tails.withColumn("_before", F.flatten(F.collect_list("_tail").over(earlier)))
        .where(F.size("_before") > 0)
        .select(
            *keys,
            BLOCK,
            F.explode(F.slice("_before", F.greatest(F.size("_before") - n + 2, F.lit(1)), n - 1)).alias("_b"),
        )
        .select(*keys, BLOCK, f"_b.{seq}", f"_b.{value}", F.lit(0).alias(REAL))
    )
    frame = Window.partitionBy(*keys, BLOCK).orderBy(seq).rowsBetween(-(n - 1), 0)
    return (
        rows.unionByName(repeated, allowMissingColumns=True)
        .select(*df.columns, REAL, F.collect_list(value).over(frame).alias(out))
        .where(F.col(REAL) == 1)
        .drop(REAL)
    )


def last_within(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    ts: str,
    ttl: str,
    value: str,
    out: str = "live_values",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Per row the key's values that arrived less than ``ttl`` ago, oldest first.

    A split key is cut along ``ts``, and each row is copied to the later blocks that start while it lives. A row's
    list is as long as the key has rows in ``ttl``, so the result grows with their product.
    """
    keys, micros = list(keys), as_micros(ttl)
    rows = (
        with_cuts(df, keys, ts, block_rows)
        .withColumn("_at", epoch_micros(ts))
        .withColumn("_seq", F.col(seq))
        .withColumn("_value", F.col(value))
        .withColumn(REAL, F.lit(1))
    )
    later = F.explode(F.sequence(F.col(BLOCK) + 1, block_at(F.col("_at") + (micros - 1))))
    copies = (
        rows.where((F.col(BLOCK) > 0) & (block_at(F.col("_at") + (micros - 1)) > F.col(BLOCK)))
        .select(*keys, later.alias(BLOCK), "_seq", "_value", "_at", F.lit(0).alias(REAL))
    )
    frame = Window.partitionBy(*keys, BLOCK).orderBy("_at").rangeBetween(-(micros - 1), 0)
    lists = (
        rows.drop(CUTS).unionByName(copies, allowMissingColumns=True)
        .withColumn("_live", F.collect_list(F.struct("_at", "_seq", "_value")).over(frame))
        .where(F.col(REAL) == 1)
    )
    # rows of the very same time share a frame; those that arrived later are not there yet
    arrived = F.filter(F.sort_array("_live"), lambda x: x["_seq"] <= F.col("_seq"))
    return lists.select(*df.columns, F.transform(arrived, lambda x: x["_value"]).alias(out))


def delayed(
    df: DataFrame, keys: Sequence[str], ts: str, delay: str, out: str = "fires_at"
) -> DataFrame:
    """Timers set ``delay`` after each row: one firing per key and time."""
    return df.select(*keys, (F.col(ts) + interval(delay)).alias(out)).distinct()
