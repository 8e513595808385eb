"""Running aggregates over an ordered key, safe for keys that hold a large share of all rows.

A running aggregate is ``agg(...) OVER (PARTITION BY key ORDER BY seq)``. Written that way, all
rows of one key are sorted in one task, which a key with a third of the table does not survive.
Here a key with more than ``block_rows`` rows is cut along ``seq`` into blocks:

1. count rows per key (map-side combined, the one job that always runs before the plan is made). If no key is
   over the limit, the plain window is the plan. Otherwise the rows are written to the shared folder, so that an
   expensive input is computed twice at most, and dealt by range of (key, ``seq``) to tasks that sort them and
   number them as they lie: every ``block_rows`` of them are a block, however uneven ``seq`` is and however many
   blocks a key has. No list of cuts is made or searched, so the work for a row does not grow with the blocks;
2. aggregate each block of those keys (map-side combined), and run the same aggregate over the
   block totals: what a block inherits from all earlier blocks of its key;
3. put that inherited value into the block as a first row and window over (key, block).

Keys under the limit stay in one piece (block 0) and never take part in step 2. Two shuffles move full
rows, by range and by block; the others move one row per key or per block. The rows are written with their blocks before
anything reads them, so all steps see the same blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rillstone.session import written
from rillstone.timeunits import epoch_micros

#: rows of one key that one task sorts and scans; more than this and the key is split
BLOCK_ROWS = 2_000_000

BLOCK, CUTS, REAL = "_block", "_cuts", "_real"

#: rows that a task puts in order at least, where blocks are smaller
_PART_ROWS = 50_000

#: ``monotonically_increasing_id`` counts the rows of a task in these bits
_IN_TASK = 2**33

#: cuts that are looked through at a time: a place is found by the first cuts of all groups, then in one group
_GROUP = 64


@dataclass(frozen=True)
class Fold:
    """An aggregate that can be taken in parts: ``merge`` over rows equals ``merge`` over parts."""

    lift: Column
    merge: Callable[[Column], Column]


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def total(value: str | Column) -> Fold:
    return Fold(_col(value), F.sum)


def count() -> Fold:
    return Fold(F.lit(1).cast("bigint"), F.sum)


def lowest(value: str | Column) -> Fold:
    return Fold(_col(value), F.min)


def highest(value: str | Column) -> Fold:
    return Fold(_col(value), F.max)


def earliest(order: str | Column, value: Column) -> Fold:
    """The value of the first row; comes out as a struct ``(at, value)``."""
    return Fold(F.struct(_col(order).alias("at"), value.alias("value")), F.min)


def latest(order: str | Column, value: Column, when: Column | None = None) -> Fold:
    """The value of the last row (for which ``when`` holds), as a struct ``(at, value)``."""
    pair = F.struct(_col(order).alias("at"), value.alias("value"))
    return Fold(pair if when is None else F.when(when, pair), F.max)


def position(df: DataFrame, seq: str) -> Column:
    """``seq`` as a whole number: timestamps count microseconds, numbers stay as they are."""
    kind = df.schema[seq].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return epoch_micros(seq)
    if isinstance(kind, T.IntegralType):
        return F.col(seq).cast("bigint")
    raise TypeError(f"order column {seq} must be integral or a timestamp, not {kind.simpleString()}")


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], prefix: str) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[prefix + key])
    return condition


def block_at(at: Column) -> Column:
    """The block of a large key that a position belongs to: 1 plus the number of cuts up to it."""
    groups = F.size(F.filter(F.col(f"{CUTS}.heads"), lambda cut: cut <= at))
    first = F.greatest(groups - 1, F.lit(0)) * _GROUP
    inside = F.filter(F.slice(f"{CUTS}.cuts", first + 1, F.lit(_GROUP)), lambda cut: cut <= at)
    return (first + F.size(inside) + 1).cast("bigint")


def _large_keys(stored: DataFrame, keys: Sequence[str], at: Column, block_rows: int) -> DataFrame:
    """Keys over the limit, as ``_big_<key>``, with their cuts: quantiles that part them into ``n / block_rows`` blocks."""
    counted = stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block_rows)
    large = written(counted.select(*[F.col(k).alias("_big_" + k) for k in keys], "_n"), "large-keys")
    most = large.agg(F.max("_n")).first()[0] or 0
    pieces = max(2, -(-most // block_rows))
    rows = stored.select(*keys, at.alias("_at"))
    rows = rows.join(large, null_safe(rows, large, keys, "_big_")) if keys else rows.withColumn("_n", large.scalar())
    shares = [i / pieces for i in range(1, pieces)]
    quantiles = F.percentile_approx("_at", shares, max(10_000, 50 * pieces))
    parted = rows.groupBy(*["_big_" + k for k in keys], "_n").agg(quantiles.alias("_q"))
    wanted = F.ceil(F.col("_n") / block_rows)
    picked = F.transform(
        F.sequence(F.lit(1).cast("bigint"), wanted - 1),
        lambda j: F.get("_q", (F.floor(j * pieces / wanted) - 1).cast("int")),
    )
    cuts = parted.select(*["_big_" + k for k in keys], F.sort_array(F.array_distinct(picked)).alias("_c"))
    heads = F.transform(
        F.sequence(F.lit(0), F.floor((F.size("_c") - 1) / _GROUP).cast("int")), lambda g: F.get("_c", g * _GROUP)
    )
    return written(cuts.select(*["_big_" + k for k in keys], F.struct(heads.alias("heads"), F.col("_c").alias("cuts")).alias(CUTS)), "cuts")


def _most_and_all(df: DataFrame, keys: Sequence[str]) -> tuple[int, int]:
    """Rows of the largest key, and of all."""
    most, rows = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).agg(F.max("_n"), F.sum("_n")).first()
    return most or 0, rows or 0


def with_blocks(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    block_rows: int = BLOCK_ROWS,
    sized_by: DataFrame | None = None,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Add ``_block``: 0 for keys within the limit, else a number above 0 that grows with ``seq`` (and ``tie``). A block has
    ``block_rows`` rows at most; the numbers of a key's blocks have gaps.

    ``sized_by`` is what to count first instead of ``df``, if that is cheaper and about as large.
    """
    keys = list(keys)
    position(df, seq)  # an order that is neither a number nor a time is an error
    most, rows = _most_and_all(df if sized_by is None else sized_by, keys)
    if most <= block_rows:
        return df.select("*", F.lit(0).cast("bigint").alias(BLOCK))
    stored = written(df, "unordered")
    if keys:
        counted = stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block_rows)
        large = written(counted.select(*[F.col(k).alias("_big_" + k) for k in keys], "_n"), "large-keys")
        placed = stored.join(large, null_safe(stored, large, keys, "_big_"), "left")
    else:
        placed = stored.withColumn("_n", F.lit(rows))
    order = [*keys, seq, *tie]
    parts = -(-rows // min(max(block_rows, _PART_ROWS), BLOCK_ROWS))
    numbered = (
        placed.select(*[F.col(c) for c in df.columns], F.col("_n").isNotNull().alias("_large"))
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_no", F.monotonically_increasing_id())
    )
    block = F.expr(f"_no - _no % {_IN_TASK} + (_no % {_IN_TASK}) div {block_rows} + 1")
    blocks = numbered.select(*[F.col(c) for c in df.columns], F.when(F.col("_large"), block).otherwise(0).alias(BLOCK))
    return written(blocks, "blocks")


def with_cuts(df: DataFrame, keys: Sequence[str], seq: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Add ``_block``: 0 for keys within the limit, else a number from 1 that grows with ``seq``, without gaps; and ``_cuts``,
    where the key is cut (NULL for block 0), from which :func:`block_at` finds the block of any other place. Rows of one key with
    one ``seq`` value stay together. For keys of not too many blocks: every row looks through them.
    """
    keys, at = list(keys), position(df, seq)
    if _most_and_all(df, keys)[0] <= block_rows:
        none = F.lit(None).cast("struct<heads:array<bigint>,cuts:array<bigint>>")
        return df.select("*", F.lit(0).cast("bigint").alias(BLOCK), none.alias(CUTS))
    stored = written(df, "ordered")
    large = _large_keys(stored, keys, at, block_rows)
    if keys:
        placed = stored.join(large, null_safe(stored, large, keys, "_big_"), "left")
    else:  # one row at most, so it is a scalar subquery and not a join
        placed = stored.withColumn(CUTS, large.scalar())
    block = F.when(F.col(CUTS).isNull(), F.lit(0).cast("bigint")).otherwise(block_at(at))
    return placed.select(*[F.col(c) for c in df.columns], block.alias(BLOCK), CUTS)


def scan(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    folds: Mapping[str, Fold],
    *,
    inclusive: bool = True,
    tie: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
    initial: DataFrame | None = None,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Add one running column per fold: over the key's rows up to this one, or before this one.

    ``seq`` is the arrival order (unique per key, or made so by the ``tie`` columns). ``initial``
    holds what keys start from: the key columns and one column per fold. ``sized_by``: see
    :func:`with_blocks`.
    """
    keys = list(keys)
    lifted = with_blocks(df, keys, seq, block_rows, sized_by=sized_by, tie=tie)
    for name, fold in folds.items():
        lifted = lifted.withColumn(name, fold.lift)

    def merged(windowed: Callable[[Column], Column]) -> list[Column]:
        return [windowed(fold.merge(F.col(name))).alias(name) for name, fold in folds.items()]

    totals = lifted.where(F.col(BLOCK) > 0).groupBy(*keys, BLOCK).agg(*merged(lambda c: c))
    starts = None
    if initial is not None:
        starts = initial.select(*keys, F.lit(0).cast("bigint").alias(BLOCK), *folds)
        totals = totals.unionByName(starts)
    per_key = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(BLOCK)
    before = per_key.rowsBetween(Window.unboundedPreceding, -1)
    inherited = totals.select(*keys, BLOCK, *merged(lambda c: c.over(before)))
    if starts is not None:
        inherited = inherited.where(F.col(BLOCK) > 0).unionByName(starts)

    first = inherited.withColumn(REAL, F.lit(0))
    rows = lifted.withColumn(REAL, F.lit(1)).unionByName(first, allowMissingColumns=True)
    running = (
        Window.partitionBy(*keys, BLOCK)
        .orderBy(REAL, seq, *tie)
        .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    )
    return (
        rows.select(*df.columns, REAL, *merged(lambda c: c.over(running)))
        .where(F.col(REAL) == 1)
        .drop(REAL)
    )


def ends(
    df: DataFrame,
    keys: Sequence[str],
    folds: Mapping[str, Fold],
    initial: DataFrame | None = None,
    every_key: bool = False,
) -> DataFrame:
    """What each key of ``df`` (or every key, also those only in ``initial``) has reached after its last
    row: the next input's ``initial``."""
    def merged(last: Column) -> list[Column]:
        return [last, *[fold.merge(F.col(name)).alias(name) for name, fold in folds.items()]]

    lifted = df.select(
        *keys, F.lit(True).alias("_here"), *[fold.lift.alias(name) for name, fold in folds.items()]
    )
    here = lifted.groupBy(*keys).agg(*merged(F.max("_here").alias("_here")))
    if initial is not None:
        held = initial.select(*keys, F.lit(False).alias("_here"), *folds)
        here = here.unionByName(held).groupBy(*keys).agg(*merged(F.max("_here").alias("_here")))
    return (here if every_key else here.where("_here")).drop("_here")
