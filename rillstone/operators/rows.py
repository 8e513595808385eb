"""Row-wise work: mapping, filtering, splitting, parsing, routing, unions and bounded iteration.

Everything here is a narrow projection or filter of built-in expressions; nothing shuffles.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rillstone.functions.text import literal_pattern, words
from rillstone.session import written


def upper_case(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(col, F.upper(col))


def with_one(df: DataFrame, col: str, one: str = "one") -> DataFrame:
    return df.select(col, F.lit(1).alias(one))


def starting_with(df: DataFrame, col: str, prefix: str) -> DataFrame:
    return df.where(F.startswith(F.col(col), F.lit(prefix)))


def not_starting_with(df: DataFrame, col: str, prefix: str) -> DataFrame:
    return df.where(~F.startswith(F.col(col), F.lit(prefix)))


def split_lines(df: DataFrame, col: str, out: str = "line") -> DataFrame:
    """One row per line of a text column."""
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.explode(F.split(F.col(col), "\n", -1)).alias(out))


def split_words(df: DataFrame, col: str, out: str = "word") -> DataFrame:
    """One row per word of a line: inner empty words stay, trailing ones do not."""
    rest = [c for c in df.columns if c != col]
    return df.select(*rest, F.explode(words(F.col(col))).alias(out))


def project(df: DataFrame, *positions: int) -> DataFrame:
    """Pick and reorder columns by position."""
    return df.select(*[df.columns[i] for i in positions])


def parse_delimited(
    df: DataFrame, col: str, schema: T.StructType, sep: str = ",", strict: bool = True
) -> DataFrame:
    """Split one text column into typed fields. A bad field fails the job, or is NULL if lenient."""
    rest = [c for c in df.columns if c != col]
    parted = df.select(*rest, F.split(F.col(col), literal_pattern(sep), -1).alias("_parts"))

    def field(i: int, f: T.StructField) -> Column:
        raw = F.get("_parts", F.lit(i))
        if not strict:
            return raw.try_cast(f.dataType).alias(f.name)
        typed = raw.try_cast(f.dataType)
        bad = F.raise_error(F.concat(F.lit(f"bad {f.name}: "), F.coalesce(raw, F.lit("missing"))))
        return F.when(typed.isNotNull(), typed).otherwise(bad.cast(f.dataType)).alias(f.name)

    return parted.select(*rest, *[field(i, f) for i, f in enumerate(schema.fields)])


def parse_json(df: DataFrame, col: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``: typed records, and the rows whose text is not such a record."""
    checked = T.StructType([*schema.fields, T.StructField("_broken", T.StringType())])
    parsed = F.from_json(col, checked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    # as an array of none or one, so that a text is parsed once and not again for the filter
    whole = F.filter(F.array(parsed), lambda r: r.isNotNull() & r["_broken"].isNull())
    rest = [c for c in df.columns if c != col]
    good = df.select(*rest, F.explode(whole).alias("_record"))
    return good.select(*rest, *[f"_record.{f.name}" for f in schema.fields]), df.where(F.size(whole) == 0)


def tagged(df: DataFrame, rules: Mapping[str, Column], tag: str = "tag") -> DataFrame:
    """First matching rule per row, as a column; rows no rule matches get NULL."""
    rule = reduce(
        lambda built, item: built.when(item[1], F.lit(item[0])), rules.items(), F
    )
    return df.withColumn(tag, rule)


def route(df: DataFrame, rules: Mapping[str, Column]) -> dict[str, DataFrame]:
    """Named side outputs by first matching rule; ``main`` still has every row.

    On a stream call this inside ``foreachBatch``, where the one tagged micro-batch is shared.
    """
    marked = tagged(df, rules, "_tag")
    outputs = {name: marked.where(F.col("_tag") == name).drop("_tag") for name in rules}
    return {"main": df, **outputs}


def routed(df: DataFrame, rules: Mapping[str, Column], output: str = "output") -> DataFrame:
    """All outputs of :func:`route` in one pass: each row once for ``main`` and once for its side
    output, named in a column. ``write.partitionBy(output)`` then makes one folder per output."""
    marked = tagged(df, rules, "_tag")
    names = F.array_compact(F.array(F.lit("main"), F.col("_tag")))
    return marked.select(F.explode(names).alias(output), *df.columns)


def quarantine(
    df: DataFrame, bad: Column, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``(good, bad)``; with ``strict`` a bad row fails the job instead."""
    is_bad = F.coalesce(bad, F.lit(False))
    if strict:
        fine = F.when(is_bad, F.raise_error(F.lit("bad record"))).otherwise(F.lit(True))
        return df.where(fine.cast("boolean")), df.where(F.lit(False))
    return df.where(~is_bad), df.where(is_bad)


def union_all(*dfs: DataFrame) -> DataFrame:
    """Merge inputs of the same columns; duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def co_map(
    left: DataFrame,
    right: DataFrame,
    map_left: Callable[[DataFrame], DataFrame],
    map_right: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Two inputs of different types, each mapped to one common type."""
    return union_all(map_left(left), map_right(right))


def iterate(
    df: DataFrame,
    col: str,
    step: Callable[[Column], Column],
    again: Callable[[Column], Column],
    steps_per_pass: int = 64,
    max_passes: int = 1000,
) -> DataFrame:
    """Apply ``step`` to a value, and once more as long as ``again`` holds for the result.

    A pass takes up to ``steps_per_pass`` steps inside the row and is written once to a table in the shared folder,
    each row marked whether it goes on; those that do take another pass. The passes run when this is called. A value
    that still goes on after ``max_passes`` of them is an error.
    """
    def one_pass(rows: DataFrame) -> DataFrame:
        start = F.struct(F.col(col).alias("v"), F.lit(True).alias("on"))

        def advance(acc: Column, _: Column) -> Column:
            moved = step(acc["v"]).cast(df.schema[col].dataType)
            went = F.struct(moved.alias("v"), F.coalesce(again(moved), F.lit(False)).alias("on"))
            return F.when(acc["on"], went).otherwise(acc)

        turns = F.sequence(F.lit(1), F.lit(steps_per_pass))
        return rows.withColumn("_state", F.aggregate(turns, start, advance))

    def finished(rows: DataFrame) -> DataFrame:
        return rows.where(~F.col("_state.on")).withColumn(col, F.col("_state.v")).drop("_state")

    outputs, rows = [], df
    for _ in range(max_passes):
        moved = written(one_pass(rows), "pass")
        outputs.append(finished(moved))
        rows = moved.where("_state.on").withColumn(col, F.col("_state.v")).drop("_state")
        if rows.isEmpty():
            return union_all(*outputs)
    raise RuntimeError(f"values still go on after {max_passes} passes of {steps_per_pass} steps")


def iterate_recursive(df: DataFrame, key: str, col: str, step: str, again: str, max_steps: int = 100) -> DataFrame:
    """Key and final value by a recursive query, for values that need few steps: ``step`` and ``again`` are deterministic SQL
    expressions of ``col``. The first step is always taken.

    The recursion runs over the different values, each once, and every row then looks up the end of its value: the rows of the
    steps grow with the values there are and not with the table. With many steps or many different values :func:`iterate` is
    the way. A value that still goes on after ``max_steps`` is an error, and so are more rows in all steps than
    ``spark.sql.cteRecursionRowLimit`` (a million unless set).
    """
    name = f"turns_of_{uuid.uuid4().hex}"
    rows = df.select(key, col)
    rows.select(col).distinct().createOrReplaceTempView(name)
    kind = df.schema[col].dataType.simpleString()
    ends = df.sparkSession.sql(
        f"WITH RECURSIVE turns(_from, {col}, _on) MAX RECURSION LEVEL {max_steps} AS ("
        f"SELECT {col}, {col}, true FROM {name} UNION ALL SELECT _from, {col}, coalesce({again}, false) FROM "
        f"(SELECT _from, CAST({step} AS {kind}) AS {col} FROM turns WHERE _on)) "
        f"SELECT _from, {col} AS _end FROM turns WHERE NOT _on"
    )
    return rows.join(ends, rows[col].eqNullSafe(ends["_from"])).select(key, F.col("_end").alias(col))
