"""Window and interval joins, changing dimensions, lookups and ranges."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rillstone.functions.text import ip_number
from rillstone.operators.scan import BLOCK_ROWS, Fold, latest, scan
from rillstone.operators.skew import (
    BROADCAST_BYTES,
    estimated_bytes,
    lookup,
    salted_sides,
)
from rillstone.timeunits import as_micros, epoch_micros, interval, interval_text


def _placed(df: DataFrame, ts: str, size: str) -> DataFrame:
    """The row's tumbling window. One struct column: on a stream it keeps the watermark."""
    return df.withColumn("_w", F.window(ts, interval_text(size)))


def window_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    size: str,
    how: str = "inner",
    left_ts: str = "ts",
    right_ts: str = "ts",
    salts: int = 1,
) -> DataFrame:
    """All pairs with equal key in the same tumbling window; ``how='left'`` keeps unmatched left rows.

    The window is part of the join key, which spreads a key's rows over time; what is still too large
    adaptive execution splits. ``salts`` splits beforehand: the left rows of a key and window go to so
    many tasks and the right rows to each of them.
    """
    if how not in ("inner", "left"):
        raise ValueError("window joins are inner or left")
    right_side = _placed(right, right_ts, size)
    if right_ts == left_ts:
        right_side = right_side.withColumnRenamed(right_ts, "_right_ts")
    left_side, right_side, salt = salted_sides(_placed(left, left_ts, size), right_side, salts)
    joined = left_side.join(right_side, [*on, "_w", *salt], how).drop(*salt)
    return joined.select(
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        *[F.col(c) for c in joined.columns if c != "_w"],
    )


def window_cogroup(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    size: str,
    left_folds: Mapping[str, Fold],
    right_folds: Mapping[str, Fold],
    ts: str = "ts",
) -> DataFrame:
    """Both sides of each key and window, met in one group: measures of the left and of the right rows.

    A group that only one side has is there too. One aggregation over the tagged union of the sides,
    combined before the shuffle; neither side's rows are listed in memory.
    """
    def side(df: DataFrame, folds: Mapping[str, Fold]) -> DataFrame:
        return _placed(df, ts, size).select(
            *on, "_w", *[fold.lift.alias(name) for name, fold in folds.items()]
        )

    both = side(left, left_folds).unionByName(side(right, right_folds), allowMissingColumns=True)
    folds = {**left_folds, **right_folds}
    return (
        both.groupBy(*on, "_w")
        .agg(*[fold.merge(F.col(name)).alias(name) for name, fold in folds.items()])
        .select(
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            *on,
            *folds,
        )
    )


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    lo: str | int,
    hi: str | int,
    hi_open: bool = True,
    left_ts: str = "ts",
    right_ts: str = "right_ts",
    salts: int = 1,
) -> DataFrame:
    """Pairs with equal key and ``right_ts`` from ``left_ts + lo`` up to ``left_ts + hi``.

    In batch, time is cut into slots as long as the interval and the slot becomes part of the key:
    a right row meets at most two slots, and one key's rows spread over as many tasks as it has
    slots (``salts`` as in :func:`window_join`). On a stream the plain condition is kept, from which
    Spark derives what state to drop.
    """
    lo_us, hi_us = as_micros(lo), as_micros(hi)
    if left.isStreaming or right.isStreaming:
        l, r = left.alias("l"), right.alias("r")
        upper = F.col(f"r.{right_ts}") < F.col(f"l.{left_ts}") + interval(hi_us)
        if not hi_open:
            upper = F.col(f"r.{right_ts}") <= F.col(f"l.{left_ts}") + interval(hi_us)
        condition = (F.col(f"r.{right_ts}") >= F.col(f"l.{left_ts}") + interval(lo_us)) & upper
        for key in on:
            condition = condition & (F.col(f"l.{key}") == F.col(f"r.{key}"))
        return l.join(r, condition, "inner").select("l.*", *[f"r.{c}" for c in right.columns if c not in on])
    width = max(hi_us - lo_us, 1)
    left_at, right_at = epoch_micros(left_ts), epoch_micros(right_ts)
    slot = lambda at: F.floor(at / width)
    slotted_left = left.withColumn("_slot", slot(left_at)).withColumn("_l", left_at)
    slotted_right = right.withColumn("_r", right_at).withColumn(
        "_slot", F.explode(F.sequence(slot(F.col("_r") - hi_us), slot(F.col("_r") - lo_us)))
    )
    before_end = F.col("_r") < F.col("_l") + hi_us if hi_open else F.col("_r") <= F.col("_l") + hi_us
    slotted_left, slotted_right, salt = salted_sides(slotted_left, slotted_right, salts)
    return (
        slotted_left.join(slotted_right, [*on, "_slot", *salt], "inner")
        .where((F.col("_r") >= F.col("_l") + lo_us) & before_end)
        .drop("_slot", "_l", "_r", *salt)
    )


def dim_asof_join(
    facts: DataFrame,
    changes: DataFrame,
    key: str,
    seq: str,
    value: str,
    op: str = "op",
    deleted: str = "DELETE",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Each fact with the dimension value that was current when the fact arrived.

    ``changes`` holds inserts, updates and deletes in the same arrival order ``seq``. No change yet,
    or a delete last, gives NULL. Facts and changes are scanned together, so a dimension key may
    have any share of the facts.
    """
    known = changes.select(
        key,
        seq,
        F.lit(True).alias("_change"),
        F.when(F.col(op) != deleted, F.col(value)).alias("_value"),
    )
    both = facts.withColumn("_change", F.lit(False)).unionByName(known, allowMissingColumns=True)
    current = latest(seq, F.col("_value"), when=F.col("_change"))
    out = scan(both, [key], seq, {"_current": current}, tie=["_change"], block_rows=block_rows)
    return out.where(~F.col("_change")).select(*facts.columns, F.col("_current.value").alias(value))


def lookup_join(
    df: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    defaults: Mapping[str, object] | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Enrich rows from a dimension with one row per key; a miss is NULL or the given default.

    Input order is whatever ``seq`` column the rows carry; the join does not depend on it.
    """
    joined = lookup(df, dim, on, "left", broadcast_bytes)
    for name, default in (defaults or {}).items():
        joined = joined.withColumn(name, F.coalesce(F.col(name), F.lit(default)))
    return joined


def cell_of(degrees: str | Column, cell: float) -> Column:
    return F.floor((F.col(degrees) if isinstance(degrees, str) else degrees) / F.lit(cell))


def geo_enrich(
    df: DataFrame,
    grid: DataFrame,
    cell: float,
    lon: str = "lon",
    lat: str = "lat",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Region columns for a longitude and latitude, from a grid of ``(cell_x, cell_y, ...)``."""
    celled = df.withColumn("cell_x", cell_of(lon, cell)).withColumn("cell_y", cell_of(lat, cell))
    return lookup(celled, grid, ["cell_x", "cell_y"], "left", broadcast_bytes).drop("cell_x", "cell_y")


def range_lookup(
    df: DataFrame,
    rules: DataFrame,
    number: str,
    start: str = "range_start",
    end: str = "range_end",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """The row of ``rules`` whose closed range holds ``number``; NULL columns where none does.

    Ranges do not overlap. Rules are sorted into classes by their width, 8 bits to a class. The number line of
    a class is cut into buckets of its greatest width, so a rule touches two buckets and a bucket has some hundred
    rules at most, be the ranges narrow or as wide as the line. Each class present (8 at most) is a hash join on
    the bucket; the joins follow each other over the same rows.
    """
    extra = [c for c in rules.columns if c not in (start, end)]
    bits = F.ceil(F.log2(F.col(end).cast("double") - F.col(start).cast("double") + 1))
    classed = rules.where(F.col(end) >= F.col(start)).withColumn(
        "_shift", F.least(F.greatest(F.ceil(bits / 8) * 8, F.lit(8)), F.lit(56)).cast("int")
    )
    shifts = sorted(r[0] for r in classed.select("_shift").distinct().collect())  # 7 numbers at most
    if not shifts:
        return df.select("*", *[F.lit(None).cast(rules.schema[c].dataType).alias(c) for c in extra])
    small = 3 * estimated_bytes(rules) <= broadcast_bytes
    out = df.withColumn("_rule", F.lit(None).cast(classed.select(F.struct(*extra).alias("r")).schema["r"].dataType))
    for shift in shifts:
        buckets = F.sequence(F.shiftright(start, shift), F.shiftright(end, shift))
        right = classed.where(F.col("_shift") == shift).select(
            F.explode(buckets).alias("_bucket"), F.col(start).alias("_from"), F.col(end).alias("_to"), F.struct(*extra).alias("_found")
        )
        inside = (F.shiftright(number, shift) == F.col("_bucket")) & F.col(number).between(F.col("_from"), F.col("_to"))
        joined = out.join(F.broadcast(right) if small else right, inside, "left")
        out = joined.withColumn("_rule", F.coalesce("_rule", "_found")).drop("_bucket", "_from", "_to", "_found")
    return out.select(*df.columns, *[F.col(f"_rule.{c}").alias(c) for c in extra])


def ip_lookup(df: DataFrame, rules: DataFrame, ip: str, **options: object) -> DataFrame:
    """:func:`range_lookup` for a dotted address column."""
    numbered = df.withColumn("_ip", ip_number(F.col(ip)))
    return range_lookup(numbered, rules, "_ip", **options).drop("_ip")
