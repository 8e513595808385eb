"""Top-n per window. ``row_number() <= n`` lets Spark keep only n rows per group and task before
the shuffle, so a large group shrinks where it is read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rillstone.operators.scan import count
from rillstone.operators.windows import slide
from rillstone.timeunits import interval_text


def top_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank_no"
) -> DataFrame:
    """The first ``n`` rows per key in the given order, with their rank from 1."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(rank, F.row_number().over(w))
        .where(F.col(rank) <= n)
        .withColumn(rank, F.col(rank).cast("bigint"))
    )


def window_topn(
    df: DataFrame,
    ts: str,
    size: str,
    keys: Sequence[str],
    by: str,
    n: int,
    tie: Sequence[str],
) -> DataFrame:
    """The ``n`` rows with the largest ``by`` per key and tumbling window; ``tie`` settles equal ones."""
    w = F.window(ts, interval_text(size))
    placed = df.withColumn("_w", w).select(
        F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *df.columns
    )
    order = [F.col(by).desc(), *[F.col(t).asc() for t in tie]]
    return top_n(placed, ["window_start", *keys], order, n)


def hot_items(
    df: DataFrame,
    ts: str,
    size: str,
    step: str,
    n: int = 3,
    item: str = "item",
    category: str = "category",
    event: str = "event_type",
) -> DataFrame:
    """Most frequent items per category, event and sliding window, ranked; ties by item."""
    counts = slide(df, ts, size, step, {"hits": count()}, [event, item, category])
    # the start alone names the window; first in line, it also makes the sort cheap
    groups = ["window_start", category, event]
    return top_n(counts, groups, [F.col("hits").desc(), F.col(item).asc()], n)
