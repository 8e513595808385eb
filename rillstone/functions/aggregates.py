"""User aggregates with an accumulator, called in SQL text.

An aggregate has a state that starts at ``zero``, takes in many values at once (``add``), can be put together
from two (``merge``) and gives the result (``finish``). Spark's own user aggregates in Python see a whole group in
one task; here a view carries states in place of the values: :func:`aggregate_view` reduces the rows of each task to
one state per group, and the registered function merges what the tasks have found for a group, at most one state per
task and group (more only where a task meets more than ``HELD`` groups)::

    register_aggregate(spark, "my_avg", AVERAGE)
    aggregate_view(people, "v_users", ["gender"], {"age": AVERAGE})
    spark.sql("select gender, my_avg(age) avg_age from v_users group by gender")

The text may group by any of the view's keys, or by none, and filter on them.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: groups whose states a task holds before it hands them on
HELD = 100_000


@dataclass(frozen=True)
class UserAggregate:
    """``zero()``, ``add(state, values)`` with an Arrow array of one group's values, ``merge(a, b)``, ``finish(state)``.

    States are dicts with the fields of ``state``, a struct type in DDL; ``result`` is the type of the result.
    """

    state: str
    result: str
    zero: Callable[[], dict]
    add: Callable[[dict, pa.Array], dict]
    merge: Callable[[dict, dict], dict]
    finish: Callable[[dict], Any]


def _add_average(state: dict, values: pa.Array) -> dict:
    n = len(values) - values.null_count
    return {"total": state["total"] + (float(pc.sum(values).as_py()) if n else 0.0), "n": state["n"] + n}


#: the mean of the values that are not NULL; NULL for none
AVERAGE = UserAggregate(
    "total double, n bigint",
    "double",
    lambda: {"total": 0.0, "n": 0},
    _add_average,
    lambda a, b: {"total": a["total"] + b["total"], "n": a["n"] + b["n"]},
    lambda s: s["total"] / s["n"] if s["n"] else None,
)


def aggregate_view(df: DataFrame, name: str, keys: Sequence[str], values: Mapping[str, UserAggregate]) -> DataFrame:
    """Register a view of the keys and, under each value's name, the states of that value."""
    keys = list(keys)
    fields = [df.select(*keys).schema[k] for k in keys] + [T.StructField(v, T.StructType.fromDDL(a.state)) for v, a in values.items()]
    schema = T.StructType(fields)
    shape = to_arrow_schema(schema)

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, dict[str, dict]] = {}
        for batch in batches:
            # rows of one group next to each other, so that each takes its values in at once
            table = pa.Table.from_batches([batch]).append_column("_i", pa.array(range(batch.num_rows)))
            if keys:
                groups = table.group_by(keys).aggregate([("_i", "list")])
                found = zip(zip(*[groups.column(k).to_pylist() for k in keys], strict=True), groups.column("_i_list").combine_chunks(), strict=True)
            else:
                found = [((), None)]
            for key, places in found:
                rows = table if places is None else table.take(places.values)
                own = held.setdefault(key, {v: a.zero() for v, a in values.items()})
                for v, a in values.items():
                    own[v] = a.add(own[v], rows.column(v).combine_chunks())
            if len(held) > HELD:
                yield handed(held)
                held = {}
        if held:
            yield handed(held)

    def handed(held: dict) -> pa.RecordBatch:
        columns = [[key[i] for key in held] for i in range(len(keys))] + [[own[v] for own in held.values()] for v in values]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, shape, strict=True)], schema=shape)

    view = df.select(*keys, *values).mapInArrow(states, schema)
    view.createOrReplaceTempView(name)
    return view


def register_aggregate(spark: SparkSession, name: str, aggregate: UserAggregate) -> None:
    """Make the aggregate a SQL function of this name, over states of an :func:`aggregate_view`."""

    @F.arrow_udf(aggregate.result)
    def merged(states: pa.Array) -> Any:
        return aggregate.finish(reduce(aggregate.merge, (s for s in states.to_pylist() if s is not None), aggregate.zero()))

    spark.udf.register(name, merged)
