"""Views over DataFrames and scripts of SQL statements."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_QUOTED_OR_END = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"|`[^`]*`|--[^\n]*|/\*.*?\*/|;", re.S)
_INSERT = re.compile(r"insert\s+into\s+(?:table\s+)?`?(\w+)`?\s+(.*)", re.I | re.S)


def register(df: DataFrame, name: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Make a view, with columns renamed by position if names are given."""
    named = df.toDF(*cols) if cols else df
    named.createOrReplaceTempView(name)
    return named


def describe(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE {name}")


def with_schema(df: DataFrame, columns: Mapping[str, str | Column]) -> DataFrame:
    """Declared columns: each a SQL expression or a Column over the input."""
    return df.select(
        *[(F.expr(c) if isinstance(c, str) else c).alias(name) for name, c in columns.items()]
    )


def statements(text: str) -> list[str]:
    """The statements of a script: cut at semicolons outside quotes and comments, blanks left out."""
    cuts, kept, at = [], "", 0
    for found in _QUOTED_OR_END.finditer(text):
        token = found.group()
        kept += text[at : found.start()]
        at = found.end()
        if token == ";":
            cuts.append(kept)
            kept = ""
        elif not token.startswith(("--", "/*")):
            kept += token
    cuts.append(kept + text[at:])
    return [s.strip() for s in cuts if s.strip()]


def run_script(
    spark: SparkSession, text: str, sinks: Mapping[str, Callable[[DataFrame], None]] | None = None
) -> DataFrame | None:
    """Run every statement in turn and return the last one's result.

    ``INSERT INTO name SELECT ...`` goes to the writer registered for the name, if there is one.
    """
    result = None
    for statement in statements(text):
        insert = _INSERT.match(statement)
        if insert and insert.group(1) in (sinks or {}):
            result = spark.sql(insert.group(2))
            sinks[insert.group(1)](result)
        else:
            result = spark.sql(statement)
    return result
