"""Keyed state and timers in Spark's state store, by ``transformWithState``.

* :func:`expiring_list`, :func:`expiring_map`: what a key has seen lately by the clock. Each element and each map entry has a
  time to live of its own, and the state store drops what has expired, entries of silent keys too. They are for queries
  that run on (``every``): by the clock there is always something left to expire, so a run to the end has none.
* :func:`top_timers`: a timer per key and time bucket; when the watermark passes the bucket's end its ``n`` largest rows
  come out. The state is a heap of ``n`` rows per open bucket, never all rows. Keys are spread over ``salts``, so a
  hot key's rows are reduced in several tasks; :func:`merged_top` ranks the few rows that fire.

These need the RocksDB state store (:func:`rocksdb`). For expiry by event time, and for keys that get a large share
of a micro-batch, see :mod:`rillstone.streaming.batches`.
"""

from __future__ import annotations

import heapq
import sys
from collections import defaultdict
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from rillstone.operators.topn import top_n
from rillstone.timeunits import as_micros

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state in RocksDB, on the executors' disks."""
    before = spark.conf.get(_PROVIDER)
    spark.conf.set(_PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:  # a query has its own copy of the settings once it is started
        yield
    finally:
        spark.conf.set(_PROVIDER, before)


def _fields(df: DataFrame, *names: str) -> list[T.StructField]:
    return [T.StructField(n, df.schema[n].dataType) for n in names]


def _named(rows: Iterator[pd.DataFrame], columns: list[str]) -> Iterator[pd.DataFrame]:
    """The frames with their columns' names: computed columns come without."""
    for frame in rows:
        yield frame.set_axis(columns, axis=1)


class ExpiringList(StatefulProcessor):
    """Rows come out with the elements of the key's list that are alive, this row's included, oldest first."""

    def __init__(self, columns: list[str], keys: list[str], seq: str, value: str, out: str, state: T.StructType, ttl_ms: int):
        self.columns, self.keys, self.seq, self.value, self.out, self.state, self.ttl_ms = columns, keys, seq, value, out, state, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.list = handle.getListState("alive", self.state, ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        alive = [e[0] for e in self.list.get()] if self.list.exists() else []
        for frame in _named(rows, self.columns):  # one Arrow batch at a time; only the list itself is held
            frame = frame.sort_values(self.seq, kind="stable")
            values = frame[self.value].tolist()
            lists = [[*alive, *values[: i + 1]] for i in range(len(values))]
            self.list.appendList([(v,) for v in values])
            alive += values
            result = frame[[self.seq]].assign(**{k: v for k, v in zip(self.keys, key, strict=True)})
            result[self.out] = lists
            yield result[[*self.keys, self.seq, self.out]]

    def close(self) -> None:
        pass


def expiring_list(df: DataFrame, keys: Sequence[str], seq: str, value: str, ttl: str, out: str = "live_values") -> DataFrame:
    """Per row the key's values that arrived less than ``ttl`` ago by the clock."""
    keys, slim = list(keys), df.select(*keys, seq, value)
    schema = T.StructType([*_fields(slim, *keys, seq), T.StructField(out, T.ArrayType(df.schema[value].dataType))])
    processor = ExpiringList(slim.columns, keys, seq, value, out, T.StructType(_fields(slim, value)), as_micros(ttl) // 1000)
    return slim.groupBy(*keys).transformWithStateInPandas(processor, schema, "Append", "processingTime")


class ExpiringMap(StatefulProcessor):
    """Rows come out with the running sum of their entry in the key's map. An entry expires when it is not written
    to for the time to live."""

    def __init__(self, columns: list[str], keys: list[str], seq: str, field: str, value: str, out: str, kind: T.StructType, ttl_ms: int):
        self.columns, self.keys, self.seq, self.field, self.value, self.out, self.kind, self.ttl_ms = columns, keys, seq, field, value, out, kind, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.map = handle.getMapState("sums", self.kind, "total bigint", ttlDurationMs=self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in _named(rows, self.columns):
            frame = frame.sort_values(self.seq, kind="stable")
            sums = frame[self.value].fillna(0).astype("int64").groupby(frame[self.field]).cumsum()
            for field in frame[self.field].unique():
                here = frame[self.field] == field
                before = self.map.getValue((field,))[0] if self.map.containsKey((field,)) else 0
                sums[here] += before
                self.map.updateValue((field,), (int(sums[here].iloc[-1]),))
            result = frame[[self.seq, self.field]].assign(**{k: v for k, v in zip(self.keys, key, strict=True)})
            result[self.out] = sums
            yield result[[*self.keys, self.seq, self.field, self.out]]

    def close(self) -> None:
        pass


def expiring_map(df: DataFrame, keys: Sequence[str], seq: str, field: str, value: str, ttl: str, out: str = "running") -> DataFrame:
    """Per row the running sum of the key's map entry ``field``, which starts over once the entry has expired.
    Rows whose ``field`` is NULL take no part."""
    keys, slim = list(keys), df.where(F.col(field).isNotNull()).select(*keys, seq, field, value)
    schema = T.StructType([*_fields(slim, *keys, seq, field), T.StructField(out, T.LongType())])
    processor = ExpiringMap(slim.columns, keys, seq, field, value, out, T.StructType(_fields(slim, field)), as_micros(ttl) // 1000)
    return slim.groupBy(*keys).transformWithStateInPandas(processor, schema, "Append", "processingTime")


class TopTimers(StatefulProcessor):
    """A heap of ``n`` rows per open bucket and a timer at the bucket's end."""

    def __init__(self, columns: list[str], keys: list[str], at: str, by: str, tie: str, rest: list[str], size_ms: int, n: int, state: T.StructType):
        self.columns, self.keys, self.at, self.by, self.tie, self.rest = columns, keys, at, by, tie, rest
        self.size_ms, self.n, self.state = size_ms, n, state

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.heaps = handle.getMapState("heaps", "ends bigint", T.StructType([T.StructField("rows", T.ArrayType(self.state))]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found: dict[int, list[tuple]] = defaultdict(list)
        for frame in _named(rows, self.columns):
            frame = frame[frame[self.at].notna() & frame[self.by].notna()]
            ends = (frame[self.at] // self.size_ms + 1) * self.size_ms
            for end, part in frame.groupby(ends):
                best = part.sort_values([self.by, self.tie], ascending=[False, True]).head(self.n)
                found[int(end)] = self.best(found[int(end)] + [tuple(r) for r in best[[self.by, self.tie, *self.rest]].itertuples(index=False)])
        watermark = timerValues.getCurrentWatermarkInMs()
        for end, fresh in found.items():
            if end <= watermark:
                continue  # late: the bucket has fired
            held = [tuple(r) for r in self.heaps.getValue((end,))[0]] if self.heaps.containsKey((end,)) else []
            if not held:
                self.handle.registerTimer(end)
            rows_ = [tuple(v.item() if hasattr(v, "item") else v for v in r) for r in self.best(held + fresh)]
            self.heaps.updateValue((end,), (rows_,))
        return iter(())

    def best(self, rows: list[tuple]) -> list[tuple]:
        return heapq.nsmallest(self.n, rows, key=lambda r: (-r[0], r[1]))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        rows = [tuple(r) for r in self.heaps.getValue((end,))[0]]
        self.heaps.removeKey((end,))
        result = pd.DataFrame(rows, columns=[self.by, self.tie, *self.rest]).assign(
            ends=end, **{k: v for k, v in zip(self.keys, key, strict=True)}
        )
        yield result[[*self.keys, "ends", self.by, self.tie, *self.rest]]

    def close(self) -> None:
        pass


def top_timers(
    df: DataFrame, keys: Sequence[str], ts: str, size: str, by: str, tie: str, n: int, rest: Sequence[str] = (), salts: int = 1
) -> DataFrame:
    """When the watermark on ``ts`` (a timestamp) passes the end of a time bucket: the bucket's ``n`` rows with the largest
    ``by`` per key and salt, as keys, ends (milliseconds), by, tie and rest. ``tie`` settles equal ones and spreads the
    rows over the salts. Rows without a time or ``by`` take no part."""
    keys, rest = list(keys), list(rest)
    slim = df.select(*keys, F.pmod(F.xxhash64(tie), F.lit(salts)).cast("int").alias("_salt"), F.unix_millis(ts).alias("_at"), by, tie, *rest)
    state = T.StructType(_fields(slim, by, tie, *rest))
    schema = T.StructType([*_fields(slim, *keys, "_salt"), T.StructField("ends", T.LongType()), *_fields(slim, by, tie, *rest)])
    processor = TopTimers(slim.columns, [*keys, "_salt"], "_at", by, tie, rest, as_micros(size) // 1000, n, state)
    return slim.groupBy(*keys, "_salt").transformWithStateInPandas(processor, schema, "Append", "eventTime").drop("_salt")


def merged_top(fired: DataFrame, keys: Sequence[str], by: str, tie: str, n: int, rank: str = "rank_no") -> DataFrame:
    """Of the rows that :func:`top_timers` fired for all salts of a bucket, which happens in one micro-batch, the first
    ``n``. For ``foreachBatch``."""
    return top_n(fired, [*keys, "ends"], [F.col(by).desc(), F.col(tie).asc()], n, rank)
