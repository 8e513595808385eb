"""Batch operators inside ``foreachBatch``, with what they must remember in a table of their own.

Running aggregates go through the same split scan as in batch, so a key may have any share of a
micro-batch. What the touched keys have reached is written per micro-batch; a replayed micro-batch
reads only what earlier ones wrote, and writes the same again.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rillstone.operators.rolling import changes_of, distinct_folds, with_first_appearances
from rillstone.operators.scan import BLOCK_ROWS, Fold, count, ends, scan, total
from rillstone.operators.state import last_n, last_within, rolling_ttl
from rillstone.operators.windows import with_lateness
from rillstone.sinks.tables import BATCH, FOLD_EVERY, forget, last_per_key, read_batches, read_latest, upsert, write_once
from rillstone.timeunits import as_micros, epoch_micros

OnBatch = Callable[[DataFrame, int], None]

#: every so many micro-batches the reached values of all keys are written, not only of the touched ones,
#: so that no more than this many micro-batches are read back and older ones can be removed
SNAPSHOT_EVERY = 20


def _reached(spark: SparkSession, held: str, keys: Sequence[str], batch_id: int) -> DataFrame | None:
    if batch_id == 0:
        return None
    snapshot = (batch_id - 1) // SNAPSHOT_EVERY * SNAPSHOT_EVERY
    return read_latest(spark, held, keys, before=batch_id, since=snapshot)


def _reach(
    df: DataFrame, held: str, keys: Sequence[str], folds: Mapping[str, Fold], initial: DataFrame | None, batch_id: int
) -> None:
    every_key = batch_id % SNAPSHOT_EVERY == 0
    write_once(ends(df, keys, folds, initial, every_key), held, batch_id)


def _once_read(write: OnBatch) -> OnBatch:
    """Keep the micro-batch while it is used several times."""
    def kept(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            write(df, batch_id)
        finally:
            df.unpersist()

    return kept


def rolling_batches(
    out: str,
    held: str,
    keys: Sequence[str],
    seq: str,
    folds: Mapping[str, Fold],
    block_rows: int = BLOCK_ROWS,
) -> OnBatch:
    """Running aggregates per row, appended to ``out``; ``held`` keeps what each key has reached."""
    def write(df: DataFrame, batch_id: int) -> None:
        initial = _reached(df.sparkSession, held, keys, batch_id)
        running = scan(df, keys, seq, folds, block_rows=block_rows, initial=initial)
        write_once(running, out, batch_id)
        _reach(df, held, keys, folds, initial, batch_id)

    return _once_read(write)


def distinct_batches(
    out: str,
    held: str,
    pairs: str,
    keys: Sequence[str],
    seq: str,
    value: str,
    hits: str = "hits",
    distinct: str = "distinct_values",
    block_rows: int = BLOCK_ROWS,
) -> OnBatch:
    """Running row and distinct counts per row; ``held`` keeps the counts per key and ``pairs`` which
    (key, value) have appeared."""
    def write(df: DataFrame, batch_id: int) -> None:
        spark, folds = df.sparkSession, distinct_folds(hits, distinct)
        initial = _reached(spark, held, keys, batch_id)
        known = spark.read.parquet(pairs).where(F.col(BATCH) < batch_id) if batch_id else None
        both = with_first_appearances(df, keys, seq, value, known)
        new = both.where(F.col("_row") == 0).select(*keys, F.col("_value").alias(value))
        write_once(new, pairs, batch_id)
        running = scan(
            both.drop("_value"), keys, seq, folds, tie=["_row"], block_rows=block_rows, initial=initial, sized_by=df
        )
        write_once(running.where(F.col("_row") == 1).drop("_row", "_first"), out, batch_id)
        _reach(both, held, keys, folds, initial, batch_id)

    return _once_read(write)


def mark_late_batches(out: str, held: str, ts: str, size: str, delay: str, seq: str) -> OnBatch:
    """Rows with ``is_late``, by the newest time of all rows before them in this and earlier
    micro-batches; ``held`` gets one row per micro-batch, the newest time up to it."""
    def write(df: DataFrame, batch_id: int) -> None:
        newest = None
        if batch_id:
            newest = read_batches(df.sparkSession, held, batch_id - 1, batch_id).first()["newest"]  # one number
        marked = with_lateness(df, ts, size, delay, seq, newest_before=newest)
        write_once(marked.drop(ts), out, batch_id)
        here = df.agg(F.greatest(F.max(epoch_micros(ts)), F.lit(newest).cast("bigint")).alias("newest"))
        write_once(here, held, batch_id)

    return _once_read(write)


def changelog_batches(out: str, held: str, keys: Sequence[str], seq: str, value: str, block_rows: int = BLOCK_ROWS) -> OnBatch:
    """The changelog of a grouped sum (see :func:`rillstone.operators.rolling.changelog`); ``held`` keeps the sums."""
    folds = {"_sum": total("_v"), "_n": count()}

    def write(df: DataFrame, batch_id: int) -> None:
        initial = _reached(df.sparkSession, held, keys, batch_id)
        slim = df.select(*keys, seq, F.coalesce(F.col(value), F.lit(0)).alias("_v"))
        sums = scan(slim, keys, seq, folds, block_rows=block_rows, initial=initial)
        write_once(changes_of(sums, keys, seq, value), out, batch_id)
        _reach(slim, held, keys, folds, initial, batch_id)

    return _once_read(write)


def _before(spark: SparkSession, held: str, batch_id: int) -> DataFrame | None:
    """All that the micro-batch before has carried on."""
    return read_batches(spark, held, batch_id - 1, batch_id).drop(BATCH) if batch_id else None


def _carry(rows: DataFrame, held: str, batch_id: int) -> None:
    """Put down what the next micro-batch needs; what this one was given is kept until that one is done."""
    write_once(rows, held, batch_id)
    forget(rows.sparkSession, held, batch_id - 1)


def carry_batches(out: str, held: str, run: Callable[[DataFrame], DataFrame], keep: Callable[[DataFrame], DataFrame]) -> OnBatch:
    """A batch operator that looks back a bounded way. ``run`` gets the rows carried on from earlier micro-batches
    and this one's and keeps the column ``_new``; its new rows are appended to ``out``. ``keep`` chooses, from the same
    rows, those that later ones can still need: they are all the state there is, and replace what was carried before.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        rows = df.withColumn("_new", F.lit(True))
        before = _before(df.sparkSession, held, batch_id)
        if before is not None:
            rows = rows.unionByName(before.withColumn("_new", F.lit(False)), allowMissingColumns=True)
        write_once(run(rows).where("_new").drop("_new"), out, batch_id)
        _carry(keep(rows).drop("_new"), held, batch_id)

    return _once_read(write)


def _recent(rows: DataFrame, ts: str, micros: int) -> DataFrame:
    """Rows not older than so many microseconds before the newest one."""
    newest = rows.select(F.max(epoch_micros(ts)).alias("_newest"))
    return rows.where(epoch_micros(ts) > newest.scalar() - micros)


def live_list_batches(
    out: str, held: str, keys: Sequence[str], seq: str, ts: str, ttl: str, value: str, delay: str = "0 seconds",
    name: str = "live_values", block_rows: int = BLOCK_ROWS,
) -> OnBatch:
    """Per row the key's values that arrived less than ``ttl`` ago (see :func:`rillstone.operators.state.last_within`).
    Carried on are the elements that are alive, each by its own time; rows come at most ``delay`` behind the newest."""
    span = as_micros(ttl) + as_micros(delay)
    return carry_batches(
        out, held,
        lambda rows: last_within(rows, keys, seq, ts, ttl, value, name, block_rows),
        lambda rows: _recent(rows, ts, span),
    )


def ttl_batches(
    out: str, held: str, keys: Sequence[str], seq: str, ts: str, ttl: str, value: str, delay: str = "0 seconds",
    name: str = "running", block_rows: int = BLOCK_ROWS,
) -> OnBatch:
    """Running sums that start over after a silence of ``ttl`` (see :func:`rillstone.operators.state.rolling_ttl`). Carried on
    is one row per key that is alive, its last one with the sum in place of the value; keys that are silent go."""
    span = as_micros(ttl) + as_micros(delay)

    def write(df: DataFrame, batch_id: int) -> None:
        rows = df.withColumn("_new", F.lit(True))
        before = _before(df.sparkSession, held, batch_id)
        if before is not None:
            rows = rows.unionByName(before.withColumn("_new", F.lit(False)), allowMissingColumns=True)
        sums = rolling_ttl(rows, keys, seq, ts, ttl, value, name, block_rows)
        write_once(sums.where("_new").drop("_new"), out, batch_id)
        last = last_per_key(sums.select(*keys, seq, ts, F.col(name).alias(value)), keys, [seq])
        _carry(_recent(last, ts, span), held, batch_id)

    return _once_read(write)


def last_n_batches(
    out: str, held: str, keys: Sequence[str], seq: str, value: str, n: int = 10, name: str = "last_values", block_rows: int = BLOCK_ROWS
) -> OnBatch:
    """Per row the key's last ``n`` values. Carried on are the last ``n - 1`` rows of a key."""
    newest_first = Window.partitionBy(*keys).orderBy(F.col(seq).desc())

    def keep(rows: DataFrame) -> DataFrame:  # cut to n - 1 rows per key and task before the shuffle
        return rows.withColumn("_r", F.row_number().over(newest_first)).where(F.col("_r") < n).drop("_r")

    return carry_batches(out, held, lambda rows: last_n(rows, keys, seq, value, n, name, block_rows), keep)


def count_window_batches(
    out: str, held: str, n: int, seq: str, folds: Mapping[str, Fold], keys: Sequence[str] = (), block_rows: int = BLOCK_ROWS
) -> OnBatch:
    """Every ``n`` rows of a key (see :func:`rillstone.operators.windows.count_window`). Carried on is one row per key: the
    number of its open window, how many rows that has, and its measures so far."""
    keys = list(keys)

    def merged() -> list[Column]:
        return [F.sum("_rows").alias("_rows"), *[fold.merge(F.col(name)).alias(name) for name, fold in folds.items()]]

    def write(df: DataFrame, batch_id: int) -> None:
        before = _before(df.sparkSession, held, batch_id)
        initial = None if before is None else before.select(*keys, (F.col("window_no") * n + F.col("_rows")).alias("_i"))
        numbered = scan(df, keys, seq, {"_i": count()}, block_rows=block_rows, initial=initial)
        number = F.floor((F.col("_i") - 1) / n).cast("bigint").alias("window_no")
        lifted = numbered.select(*keys, number, F.lit(1).cast("bigint").alias("_rows"), *[f.lift.alias(name) for name, f in folds.items()])
        parts = (lifted if before is None else lifted.unionByName(before)).groupBy(*keys, "window_no").agg(*merged())
        write_once(parts.where(F.col("_rows") == n).drop("_rows"), out, batch_id)
        last = last_per_key(parts, keys, ["window_no"])
        full = F.col("_rows") == n
        opened = last.select(
            *keys,
            F.when(full, F.col("window_no") + 1).otherwise(F.col("window_no")).alias("window_no"),
            F.when(full, F.lit(0).cast("bigint")).otherwise(F.col("_rows")).alias("_rows"),
            *[F.when(~full, F.col(name)).alias(name) for name in folds],
        )
        _carry(opened, held, batch_id)

    return _once_read(write)


def distinct_state_batches(held: str, keys: Sequence[str], value: str, kind: str = "bitmap") -> OnBatch:
    """Row and distinct counts per key, for :func:`distinct_states`, as states that merge.

    ``bitmap``: exact, for whole numbers; one bitmap of 4 KiB per key and 32,768 neighbouring numbers that occur.
    ``sketch``: HyperLogLog, for values of any kind; one small sketch per key, with an error of about 2 %.
    Rows are combined before the shuffle, only touched keys are written, and no value is ever read again.
    """
    keys = list(keys)
    if kind not in ("bitmap", "sketch"):
        raise ValueError(f"kind is bitmap or sketch, not {kind}")
    parts = [*keys, "_bucket"]

    def write(df: DataFrame, batch_id: int) -> None:
        spark, there = df.sparkSession, F.col(value).isNotNull()
        if kind == "bitmap":
            bucket = F.when(there, F.bitmap_bucket_number(value))
            state = F.bitmap_construct_agg(F.bitmap_bit_position(value))
            merge = F.bitmap_or_agg("_state")
        else:
            bucket, state, merge = F.lit(None).cast("bigint"), F.hll_sketch_agg(value), F.hll_union_agg("_state")
        rows = df.withColumn("_bucket", bucket)
        fresh = rows.groupBy(*parts).agg(F.count(F.lit(1)).alias("_hits"), F.when(F.count(value) > 0, state).alias("_state"))
        if batch_id:
            known = read_latest(spark, held, parts, before=batch_id, since=_since(batch_id))
            touched = known.join(fresh.select(*[F.col(c).alias("_k_" + c) for c in parts]), null_safe_on(parts), "left_semi")
            both = fresh.unionByName(touched.select(*fresh.columns))
            fresh = both.groupBy(*parts).agg(F.sum("_hits").alias("_hits"), merge.alias("_state"))
        upsert(fresh.withColumn("_order", F.lit(batch_id)), held, parts, "_order", batch_id)

    return _once_read(write)


def _since(batch_id: int) -> int:
    """The fold of an upsert log that all current rows are in or after."""
    return (batch_id - 1) // FOLD_EVERY * FOLD_EVERY


def null_safe_on(names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & F.col(name).eqNullSafe(F.col("_k_" + name))
    return condition


def distinct_states(spark: SparkSession, held: str, keys: Sequence[str], hits: str = "hits", distinct: str = "distinct_values", kind: str = "bitmap") -> DataFrame:
    """The counts that :func:`distinct_state_batches` has reached."""
    now = read_latest(spark, held, [*keys, "_bucket"])
    size = F.bitmap_count("_state") if kind == "bitmap" else F.hll_sketch_estimate("_state")
    return now.groupBy(*keys).agg(F.sum("_hits").alias(hits), F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias(distinct))


def multiset_batches(held: str, keys: Sequence[str], value: str, is_insert: str) -> OnBatch:
    """Consume a changelog: per key the multiset of values that are in, as counts per value, so that any aggregate can
    take values out again. A value whose count has come to zero stays as a row of the log."""
    parts = [*keys, value]

    def write(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        change = F.sum(F.when(F.col(is_insert), 1).otherwise(-1)).alias("_n")
        fresh = df.where(F.col(value).isNotNull()).groupBy(*parts).agg(change)
        if batch_id:
            known = read_latest(spark, held, parts, before=batch_id, since=_since(batch_id))
            touched = known.join(fresh.select(*[F.col(c).alias("_k_" + c) for c in parts]), null_safe_on(parts), "left_semi")
            fresh = fresh.unionByName(touched.select(*fresh.columns)).groupBy(*parts).agg(F.sum("_n").alias("_n"))
        upsert(fresh.withColumn("_order", F.lit(batch_id)), held, parts, "_order", batch_id)

    return _once_read(write)


def multiset_totals(
    spark: SparkSession, held: str, keys: Sequence[str], value: str, n: str = "n", total: str = "total", least: str = "least", most: str = "most"
) -> DataFrame:
    """Count, sum, minimum and maximum of the values that are in."""
    now = read_latest(spark, held, [*keys, value]).where(F.col("_n") > 0)
    return now.groupBy(*keys).agg(
        F.sum("_n").alias(n), F.sum(F.col(value) * F.col("_n")).cast("bigint").alias(total), F.min(value).alias(least), F.max(value).alias(most)
    )
