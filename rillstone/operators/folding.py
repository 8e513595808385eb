"""Running aggregates with a user's own combine function.

``combine(a, b)`` is any associative function of two values, such as a rule for two rows of a key; it need not
commute, and no built-in aggregate has to exist for it. Rows of a key are combined in arrival order. A key over
``block_rows`` is cut along the order into blocks (see :mod:`rillstone.operators.scan`), which associativity allows:

1. every block of a large key is combined to one value, in its own task;
2. the values of a key's blocks are combined from block to block: what each inherits from those before it;
3. every block runs through its rows again, beginning with what it inherits.

Tasks stream over sorted Arrow batches and hold one value at a time. Keys within the limit take step 3 alone.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rillstone.operators.scan import BLOCK, BLOCK_ROWS, REAL, with_blocks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

Combine = Callable[[Any, Any], Any]


def _along(df: DataFrame, group: Sequence[str], order: Sequence[str], value: str, schema: T.StructType, combine: Combine, emit: str) -> DataFrame:
    """``value`` replaced by the running combination over each group in order. ``emit`` "rows": one row per row;
    "before": each with the combination of the earlier rows (NULL for the first); "last": one row per group."""
    placed = (df.repartition(*group) if group else df.repartition(1)).sortWithinPartitions(*group, *order)
    shape = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, last = None, None, None
        for batch in batches:
            keys = list(zip(*[batch.column(g).to_pylist() for g in group], strict=True)) if group else [()] * batch.num_rows
            out, ends = [], []
            for i, (key, v) in enumerate(zip(keys, batch.column(value).to_pylist(), strict=True)):
                before = state if key == at and at is not None else None
                if before is None and at is not None and key != at:
                    ends.append((i - 1, state))
                # a NULL is no value: the combination so far stays
                state = v if before is None else before if v is None else combine(before, v)
                at = key
                out.append(before if emit == "before" else state)
            if emit == "last":
                done = [batch.slice(i, 1) if i >= 0 else last for i, _ in ends]
                if done:
                    yield _with(pa.Table.from_batches(done), value, [s for _, s in ends], shape)
                last = batch.slice(batch.num_rows - 1, 1) if batch.num_rows else last
            else:
                yield _with(pa.Table.from_batches([batch]), value, out, shape)
        if emit == "last" and last is not None:
            yield _with(pa.Table.from_batches([last]), value, [state], shape)

    return placed.mapInArrow(run, schema)


def _with(table: pa.Table, value: str, values: list, shape: pa.Schema) -> pa.RecordBatch:
    columns = [
        pa.array(values, f.type) if f.name == value else table.column(f.name).combine_chunks().cast(f.type) for f in shape
    ]
    return pa.RecordBatch.from_arrays(columns, schema=shape)


def rolling_combine(
    df: DataFrame,
    keys: Sequence[str],
    seq: str,
    value: str | Column,
    combine: Combine,
    out: str = "combined",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every row with ``out``: the combination of ``value`` over the key's rows up to this one.

    ``value`` is what a row contributes, of the same type as the result (a struct comes to ``combine`` as a dict).
    A NULL contributes nothing. ``seq`` is unique per key.
    """
    keys = list(keys)
    rows = with_blocks(df.withColumn(out, F.col(value) if isinstance(value, str) else value), keys, seq, block_rows)
    rows = rows.withColumn(REAL, F.lit(1))
    slim = rows.where(F.col(BLOCK) > 0).select(*keys, BLOCK, seq, out)
    totals = _along(slim, [*keys, BLOCK], [seq], out, slim.schema, combine, "last").drop(seq)
    inherited = _along(totals, keys, [BLOCK], out, totals.schema, combine, "before").where(F.col(out).isNotNull())
    both = rows.unionByName(inherited.withColumn(REAL, F.lit(0)), allowMissingColumns=True)
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in both.schema.fields])
    running = _along(both, [*keys, BLOCK], [REAL, seq], out, nullable, combine, "rows")
    return running.where(F.col(REAL) == 1).select(*df.columns, out)
