"""Count, tumbling, sliding and session windows.

Time windows are aligned to 1970-01-01 UTC and half-open. Every function takes the time column, so
a processing-time window is the same call on a column filled with ``current_timestamp()``.
Measures are :class:`~rillstone.operators.scan.Fold`: they combine before the shuffle and in steps,
so a window or key with a large share of the rows is never gathered in one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rillstone.operators.scan import BLOCK_ROWS, Fold, count, highest, scan
from rillstone.session import written
from rillstone.timeunits import as_micros, epoch_micros, interval, interval_text

#: rows in one element of a collected window; longer windows come out in several numbered parts
PART_ROWS = 100_000

#: gap-wide slots in one stretch of a key that is put in order in one task
STRETCH_SLOTS = 1_000_000


def with_event_time(df: DataFrame, col: str, delay: str, name: str | None = None) -> DataFrame:
    """Event time from a field, with a watermark trailing the newest row by ``delay``."""
    name = name or col
    return df.withColumn(name, F.col(col).cast("timestamp")).withWatermark(name, interval_text(delay))


def least_watermark(sources: Sequence[DataFrame], ts: str, delays: str | Sequence[str]) -> DataFrame:
    """Several streams as one, with the least of their watermarks: each trails the newest row of its own source, so a
    source that lags, or is silent, holds windows open until it has caught up. ``ts`` is a timestamp; one delay for all
    sources or one each.

    (Spark's setting ``spark.sql.streaming.multipleWatermarkPolicy`` must be ``min``, as it is unless changed; ``max`` goes on
    without the slower sources and loses their rows.)
    """
    delays = [delays] * len(sources) if isinstance(delays, str) else list(delays)
    timed = [s.withWatermark(ts, interval_text(d)) for s, d in zip(sources, delays, strict=True)]
    return reduce(DataFrame.unionByName, timed)


def _merged(folds: Mapping[str, Fold]) -> list[Column]:
    return [fold.merge(fold.lift).alias(name) for name, fold in folds.items()]


def _merged_again(folds: Mapping[str, Fold]) -> list[Column]:
    return [fold.merge(F.col(name)).alias(name) for name, fold in folds.items()]


def _bounds(names: Sequence[str], window: str = "_w") -> list[Column]:
    return [
        F.col(f"{window}.start").alias("window_start"),
        F.col(f"{window}.end").alias("window_end"),
        *[F.col(n) for n in names],
    ]


def count_window(
    df: DataFrame,
    n: int,
    seq: str,
    folds: Mapping[str, Fold],
    keys: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every ``n`` rows (of a key, or of the whole input) in arrival order; an incomplete tail waits.

    ``window_no`` counts the windows of a key from 0.
    """
    keys = list(keys)
    numbered = scan(df, keys, seq, {"_i": count()}, block_rows=block_rows).withColumn(
        "window_no", F.floor((F.col("_i") - 1) / n).cast("bigint")
    )
    return (
        numbered.groupBy(*keys, "window_no")
        .agg(F.count(F.lit(1)).alias("_rows"), *_merged(folds))
        .where(F.col("_rows") == n)
        .drop("_rows")
    )


def count_window_apply(
    df: DataFrame,
    n: int,
    seq: str,
    cols: Sequence[str],
    apply: Column,
    out: str,
    keys: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Count windows whose function sees all ``n`` rows: an expression over the array ``rows``."""
    keys = list(keys)
    numbered = scan(df, keys, seq, {"_i": count()}, block_rows=block_rows).withColumn(
        "window_no", F.floor((F.col("_i") - 1) / n).cast("bigint")
    )
    buffers = numbered.groupBy(*keys, "window_no").agg(
        F.sort_array(F.collect_list(F.struct(seq, *cols))).alias("rows")
    )
    return buffers.where(F.size("rows") == n).select(*keys, "window_no", apply.alias(out))


def tumble(
    df: DataFrame,
    ts: str,
    size: str,
    folds: Mapping[str, Fold],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Tumbling windows; on a stream put :func:`with_event_time` first."""
    names = [*keys, *folds]
    grouped = df.groupBy(F.window(ts, interval_text(size)).alias("_w"), *keys)
    return grouped.agg(*_merged(folds)).select(*_bounds(names))


def slide(
    df: DataFrame,
    ts: str,
    size: str,
    step: str,
    folds: Mapping[str, Fold],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Sliding windows. In batch, rows are first combined per step, and only those sums are copied
    into the ``size / step`` windows they belong to."""
    names = [*keys, *folds]
    sliding = lambda c: F.window(c, interval_text(size), interval_text(step)).alias("_w")
    if df.isStreaming or as_micros(size) % as_micros(step):
        return df.groupBy(sliding(ts), *keys).agg(*_merged(folds)).select(*_bounds(names))
    panes = (
        df.groupBy(F.window(ts, interval_text(step)).alias("_w"), *keys)
        .agg(*_merged(folds))
        .select(F.col("_w.start").alias("_pane"), *names)
    )
    return panes.groupBy(sliding("_pane"), *keys).agg(*_merged_again(folds)).select(*_bounds(names))


def _chained(
    df: DataFrame, partition: Sequence[str], micros: int, folds: Mapping[str, Fold], by: str
) -> DataFrame:
    """Join spans ``_from`` to ``_to`` that follow each other within the gap, per partition."""
    along = Window.partitionBy(*(partition or [F.lit(0)])).orderBy("_from")
    quiet = epoch_micros("_from") - epoch_micros(F.lag("_to").over(along)) > micros
    return (
        df.withColumn("_new", F.coalesce(quiet.cast("int"), F.lit(1)))
        .withColumn(by, F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(*partition, by)
        .agg(F.min("_from").alias("_from"), F.max("_to").alias("_to"), *_merged_again(folds))
    )


def session(
    df: DataFrame,
    ts: str,
    gap: str,
    folds: Mapping[str, Fold],
    keys: Sequence[str] = (),
    stretch_slots: int = STRETCH_SLOTS,
) -> DataFrame:
    """Session windows: a row more than ``gap`` after the last one opens a new session.

    In batch, rows in the same gap-wide slot are always in the same session, so they are combined
    first. The slots of a key are put in order stretch by stretch, and only the first and the last
    session of a stretch can go on in another one: just these are ordered per key.
    """
    keys, names = list(keys), [*keys, *folds]
    if df.isStreaming:
        grouped = df.groupBy(F.session_window(ts, interval_text(gap)).alias("_w"), *keys)
        return grouped.agg(*_merged(folds)).select(*_bounds(names))
    micros = as_micros(gap)
    slots = (
        df.where(F.col(ts).isNotNull())
        .groupBy(*keys, F.floor(epoch_micros(ts) / micros).alias("_slot"))
        .agg(F.min(ts).alias("_from"), F.max(ts).alias("_to"), *_merged(folds))
        .withColumn("_stretch", F.floor(F.col("_slot") / stretch_slots))
        .drop("_slot")
    )
    stretch = [*keys, "_stretch"]
    last_of_stretch = F.max("_no").over(Window.partitionBy(*stretch))
    local = _chained(slots, stretch, micros, folds, by="_no").withColumn("_last", last_of_stretch)
    at_edge = (F.col("_no") == 1) | (F.col("_no") == F.col("_last"))
    spans = ["_from", "_to", *names]
    joined = _chained(local.where(at_edge).select(*spans), keys, micros, folds, by="_no").select(*spans)
    return (
        local.where(~at_edge)
        .select(*spans)
        .unionByName(joined)
        .select(F.col("_from").alias("window_start"), (F.col("_to") + interval(gap)).alias("window_end"), *names)
    )


def tumble_rows(
    df: DataFrame,
    ts: str,
    size: str,
    seq: str,
    cols: Sequence[str],
    keys: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The rows of each window with their ``position`` in it by arrival, from 1: one row per window and element,
    however many a window has."""
    keys = list(keys)
    start = F.window(ts, interval_text(size))
    placed = df.select(
        *keys, seq, *[c for c in cols if c not in keys and c != seq], start.alias("_w")
    ).select("*", F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"))
    where = [*keys, "window_start", "window_end"]
    return scan(placed.drop("_w"), where, seq, {"position": count()}, block_rows=block_rows)


def tumble_collect(
    df: DataFrame,
    ts: str,
    size: str,
    seq: str,
    cols: Sequence[str],
    keys: Sequence[str] = (),
    most: int = PART_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """All rows of each window, in arrival order, as the array ``rows``.

    An array is one value in one task, so a window of more than ``most`` rows is an error; :func:`tumble_rows` takes
    windows of any size.
    """
    where = [*keys, "window_start", "window_end"]
    numbered = tumble_rows(df, ts, size, seq, cols, keys, block_rows)
    fits = F.assert_true(F.col("position") <= most, F.lit(f"a window has more than {most} rows"))
    return (
        numbered.where(fits.isNull())
        .groupBy(*where)
        .agg(F.sort_array(F.collect_list(F.struct(seq, *cols))).alias("rows"))
        .select("window_start", "window_end", *keys, "rows")
    )


def window_history(
    df: DataFrame,
    ts: str,
    size: str,
    folds: Mapping[str, Fold],
    keys: Sequence[str],
    with_bounds: bool = True,
) -> DataFrame:
    """Per window the measures, and as ``<name>_so_far`` the key's total up to and with that window.

    The second step runs over one row per key and window.
    """
    windows = tumble(df, ts, size, folds, keys)
    so_far = (
        Window.partitionBy(*keys)
        .orderBy("window_start")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    history = windows.select(
        "*", *[fold.merge(F.col(n)).over(so_far).alias(f"{n}_so_far") for n, fold in folds.items()]
    )
    return history if with_bounds else history.drop("window_start", "window_end")


def with_lateness(
    df: DataFrame,
    ts: str,
    size: str,
    delay: str,
    seq: str,
    late: str = "is_late",
    block_rows: int = BLOCK_ROWS,
    newest_before: int | None = None,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Mark rows whose window was complete before they arrived: its end is not after the newest
    time seen in earlier rows less ``delay``; ``tie`` settles equal arrivals. ``newest_before`` is that time, in microseconds, from
    before this input."""
    seen = scan(
        df, [], seq, {"_newest": highest(epoch_micros(ts))}, inclusive=False, tie=tie, block_rows=block_rows
    )
    micros = as_micros(size)
    at = epoch_micros(ts)
    window_end = at - F.pmod(at, F.lit(micros)) + micros
    newest = F.greatest("_newest", F.lit(newest_before).cast("bigint"))
    is_late = F.coalesce(window_end <= newest - as_micros(delay), F.lit(False))
    return seen.withColumn(late, is_late).drop("_newest")


def split_late(
    df: DataFrame,
    ts: str,
    size: str,
    delay: str,
    seq: str,
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """``(on_time, late)`` rows in the order of arrival ``seq``, from one marked table in the shared folder; where the
    mark alone will do, :func:`with_lateness` gives both in one pass."""
    marked = written(with_lateness(df, ts, size, delay, seq, "_late", block_rows), "marked")
    return marked.where(~F.col("_late")).drop("_late"), marked.where("_late").drop("_late")
