"""Per-row keyed state on streams.

Batch operators run unchanged on streams where Spark allows it (windows, joins, grouped sums). The
ones here give one row per input row and need what the key has seen so far, which Spark keeps in its
state store. ``step`` gets one key's rows of a micro-batch in arrival order as a pandas frame, works
on whole columns, and returns the output and the new state. How many rows that can be is bounded by
the source's per-trigger limit. Where one key gets a large share of the rows, use
:mod:`rillstone.streaming.batches`, which splits it, or, if a row per input row is not needed,
``groupBy`` in update mode, which combines before the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, types as T
from pyspark.sql.streaming.state import GroupStateTimeout

Step = Callable[[pd.DataFrame, tuple | None], tuple[pd.DataFrame, tuple]]


def with_state(
    df: DataFrame, keys: Sequence[str], seq: str, step: Step, out: T.StructType, state: T.StructType
) -> DataFrame:
    """Run ``step`` over each key's rows with the key's state."""
    names = out.fieldNames()

    def on_rows(key, frames, group):
        rows = pd.concat(list(frames), ignore_index=True).sort_values(seq, kind="stable", ignore_index=True)
        result, after = step(rows, group.get if group.exists else None)
        group.update(after)
        yield result[names]

    return df.groupBy(*keys).applyInPandasWithState(
        on_rows, out, state, "append", GroupStateTimeout.NoTimeout
    )


def _schema(df: DataFrame, cols: Sequence[str], *more: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([*[df.schema[c] for c in cols], *[T.StructField(n, t) for n, t in more]])


def _state(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


def rolling_sum_stream(df: DataFrame, keys: Sequence[str], seq: str, value: str, out: str) -> DataFrame:
    """Running sum of a whole-number column."""
    def step(rows, before):
        sums = rows[value].fillna(0).astype("int64").cumsum() + (before[0] if before else 0)
        return rows.assign(**{out: sums}), (int(sums.iloc[-1]),)

    slim = df.select(*keys, seq, value)
    return with_state(
        slim, keys, seq, step, _schema(slim, [*keys, seq], (out, T.LongType())), _state(("total", T.LongType()))
    )


def changelog_stream(df: DataFrame, keys: Sequence[str], seq: str, value: str) -> DataFrame:
    """``(is_insert, value)``: the old sum taken back and the new one, per input row."""
    def step(rows, before):
        amounts = rows[value].fillna(0).astype("int64")
        sums = amounts.cumsum() + (before[0] if before else 0)
        new = rows.assign(is_insert=True, **{value: sums})
        old = rows.assign(is_insert=False, **{value: sums - amounts})
        if before is None:
            old = old.iloc[1:]
        return pd.concat([old, new]).sort_values([seq, "is_insert"]), (int(sums.iloc[-1]),)

    slim = df.select(*keys, seq, value)
    out = _schema(slim, [*keys, seq], ("is_insert", T.BooleanType()), (value, T.LongType()))
    return with_state(slim, keys, seq, step, out, _state(("total", T.LongType())))


def last_n_stream(
    df: DataFrame, keys: Sequence[str], seq: str, value: str, n: int = 10, out: str = "last_values"
) -> DataFrame:
    """The key's last ``n`` values per row, oldest first."""
    kind = T.ArrayType(df.schema[value].dataType)

    def step(rows, before):
        values = [*(before[0] if before else []), *rows[value].tolist()]
        held = len(values) - len(rows)
        lists = [values[max(0, i + 1 - n) : i + 1] for i in range(held, len(values))]
        return rows.assign(**{out: lists}), (values[len(values) - min(len(values), n - 1) :],)

    slim = df.select(*keys, seq, value)
    return with_state(slim, keys, seq, step, _schema(slim, [*keys, seq], (out, kind)), _state(("held", kind)))


def rolling_ttl_stream(
    df: DataFrame, keys: Sequence[str], seq: str, at: str, ttl: int, value: str, out: str = "running"
) -> DataFrame:
    """Running sum that starts over after a silence of ``ttl``; ``at`` is the row's time in microseconds."""
    def step(rows, before):
        last_at, alive = before if before else (None, 0)
        times, amounts = rows[at].to_numpy("int64"), rows[value].fillna(0).to_numpy("int64")
        previous = np.concatenate([[times[0] if last_at is None else last_at], times[:-1]])
        fresh = times - previous >= ttl
        sums = np.cumsum(amounts) + alive
        # what a silence wipes out: the sum before the latest fresh row
        wiped = np.where(fresh, sums - amounts, np.int64(0))
        latest = np.maximum.accumulate(np.where(fresh, np.arange(len(rows)), -1))
        running = sums - np.where(latest >= 0, wiped[latest], 0)
        return rows.assign(**{out: running}), (int(times[-1]), int(running[-1]))

    slim = df.select(*keys, seq, at, value)
    return with_state(
        slim, keys, seq, step,
        _schema(slim, [*keys, seq], (out, T.LongType())),
        _state(("last_at", T.LongType()), ("alive", T.LongType())),
    )


def count_window_stream(
    df: DataFrame, n: int, seq: str, value: str, keys: Sequence[str], out: str
) -> DataFrame:
    """Per key the sum of every ``n`` rows, once they are complete."""
    def step(rows, before):
        seen, open_sum = before if before else (0, 0)
        number = (seen + np.arange(len(rows))) // n
        sums = rows[value].fillna(0).astype("int64").groupby(number).sum()
        sums.iloc[0] += open_sum
        seen += len(rows)
        done = sums[sums.index < seen // n]
        rest = 0 if seen % n == 0 else int(sums.iloc[-1])
        result = pd.DataFrame({"window_no": done.index.astype("int64"), out: done.to_numpy()})
        for key in keys:
            result[key] = rows[key].iloc[0]
        return result, (seen, rest)

    slim = df.select(*keys, seq, value)
    schema = _schema(slim, keys, ("window_no", T.LongType()), (out, T.LongType()))
    return with_state(
        slim, keys, seq, step, schema, _state(("seen", T.LongType()), ("open_sum", T.LongType()))
    )


def dim_asof_stream(
    events: DataFrame, key: str, seq: str, is_change: str, value: str
) -> DataFrame:
    """Facts with the dimension value current at their arrival, from one stream of facts and changes.

    ``is_change`` tells them apart; a change with NULL ``value`` deletes. Facts keep their columns.
    """
    kind = events.schema[value].dataType

    def step(rows, before):
        changes = rows[is_change].to_numpy(bool)
        latest = np.maximum.accumulate(np.where(changes, np.arange(len(rows)), -1))
        values = rows[value].to_numpy(object)
        held = before[0] if before else None
        current = np.array([values[i] if i >= 0 else held for i in latest], dtype=object)
        now = current[-1]
        return rows.assign(**{value: current})[~changes], (None if pd.isna(now) else now,)

    facts = [c for c in events.columns if c not in (is_change, value)]
    return with_state(
        events, [key], seq, step, _schema(events, facts, (value, kind)), _state(("current", kind))
    )
