"""Rolling keyed aggregates: one output row per input row, carrying the updated aggregate.

``seq`` is the arrival order. All of them go through :func:`rillstone.operators.scan.scan`, so a
key may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from rillstone.operators.scan import (
    BLOCK_ROWS,
    Fold,
    count,
    earliest,
    highest,
    lowest,
    null_safe,
    position,
    scan,
    total,
)


def rolling(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    folds: Mapping[str, Fold],
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Running aggregates per key, by one or several key columns."""
    return scan(df, keys, seq, folds, block_rows=block_rows)


def rolling_extreme(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    by: str,
    largest: bool = True,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Running max (or min) of ``by``; every other column keeps the value of the key's first row."""
    others = [c for c in df.columns if c not in keys and c not in (seq, by)]
    first = F.struct(*others) if others else F.struct(F.col(by))
    out = scan(
        df,
        keys,
        seq,
        {"_best": (highest if largest else lowest)(by), "_first": earliest(seq, first)},
        block_rows=block_rows,
    )
    return out.select(
        *keys, seq, F.col("_best").alias(by), *[F.col(f"_first.value.{c}").alias(c) for c in others]
    )


def rolling_by(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    by: str,
    largest: bool = True,
    first_on_tie: bool = True,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The whole row that has the running max (or min) of ``by``; ties go to the first or the latest row.

    ``<seq>_at`` names the row that was taken. Rows whose ``by`` is NULL are never taken; before any other
    row all columns are NULL.
    """
    others = [c for c in df.columns if c not in keys and c != seq]
    earlier_wins = F.lit(-1 if first_on_tie == largest else 1) * position(df, seq)
    row = F.when(
        F.col(by).isNotNull(),
        F.struct(F.col(by).alias("by"), earlier_wins.alias("rank"), F.struct(seq, *others).alias("row")),
    )
    out = scan(
        df, keys, seq, {"_best": (highest if largest else lowest)(row)}, block_rows=block_rows
    )
    return out.select(
        *keys,
        seq,
        F.col(f"_best.row.{seq}").alias(f"{seq}_at"),
        *[F.col(f"_best.row.{c}").alias(c) for c in others],
    )


def with_first_appearances(
    df: DataFrame, keys: Sequence[str], seq: str, value: str, known: DataFrame | None = None
) -> DataFrame:
    """The rows (``_row`` 1, ``_first`` 0) and, just before each first appearance of a (key, value), an
    extra row (``_row`` 0, ``_first`` 1). Pairs in ``known`` have appeared already.

    First appearances come from a map-side combined ``min(seq)``, so no (key, value) pair is gathered
    in one task.
    """
    keys = list(keys)
    firsts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.min(seq).alias(seq))
    if known is not None:
        seen = known.select(*[F.col(c).alias("_seen_" + c) for c in (*keys, value)])
        firsts = firsts.join(seen, null_safe(firsts, seen, [*keys, value], "_seen_"), "left_anti")
    extra = firsts.select(
        *keys, seq, F.col(value).alias("_value"), F.lit(0).alias("_row"), F.lit(1).cast("bigint").alias("_first")
    )
    rows = df.withColumn("_row", F.lit(1)).withColumn("_first", F.lit(0).cast("bigint"))
    return rows.unionByName(extra, allowMissingColumns=True)


def distinct_folds(hits: str, distinct: str) -> dict[str, Fold]:
    return {hits: total(F.col("_row").cast("bigint")), distinct: total("_first")}


def rolling_distinct(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    value: str,
    hits: str = "hits",
    distinct: str = "distinct_values",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Running row count and running number of different ``value``s per key."""
    both = with_first_appearances(df, keys, seq, value).drop("_value")
    folds = distinct_folds(hits, distinct)
    # a key has at most one extra row per row, so counting the rows is near enough
    out = scan(both, keys, seq, folds, tie=["_row"], block_rows=block_rows, sized_by=df)
    return out.where(F.col("_row") == 1).drop("_row", "_first")


def changelog(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    value: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The updates a grouped sum sends downstream: ``(false, old)`` then ``(true, new)`` per input row.

    The first row of a key has no old value to take back. ``value`` is a whole number or a decimal,
    so that taking it off the sum gives the old sum exactly; NULL adds nothing.
    """
    sums = scan(
        df.select(*keys, seq, F.coalesce(F.col(value), F.lit(0)).alias("_v")),
        keys,
        seq,
        {"_sum": total("_v"), "_n": count()},
        block_rows=block_rows,
    )
    return changes_of(sums, keys, seq, value)


def changes_of(sums: DataFrame, keys: Sequence[str], seq: str, value: str) -> DataFrame:
    """The changelog of running sums ``_sum`` that took in ``_v`` as a key's row number ``_n``."""
    old = F.when(F.col("_n") > 1, F.struct(F.lit(False).alias("op"), (F.col("_sum") - F.col("_v")).alias("v")))
    new = F.struct(F.lit(True).alias("op"), F.col("_sum").alias("v"))
    return (
        sums.select(*keys, seq, F.explode(F.array_compact(F.array(old, new))).alias("_c"))
        .select(*keys, seq, F.col("_c.op").alias("is_insert"), F.col("_c.v").alias(value))
    )


def retracting_total(
    changes: DataFrame,
    keys: Sequence[str],
    seq: str,
    value: str,
    op: str = "is_insert",
    out: str = "total",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Running total, per row of a changelog, of the values that are in: inserted ones count, retracted ones no longer.

    Of the changes with one ``seq`` the retraction comes first, as in :func:`changelog`.
    """
    signed = F.when(F.col(op), F.col(value)).otherwise(-F.col(value))
    return scan(changes, keys, seq, {out: total(signed)}, tie=[op], block_rows=block_rows)
