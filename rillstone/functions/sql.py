"""Functions for SQL text. All but one are SQL expressions, so they run inside Spark's own code."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, SparkSession, functions as F


def register_functions(spark: SparkSession) -> None:
    """``my_concat_ws(sep, a, b)``, ``rand_int(n)``, ``ip_number(ip)``
    and the table function ``split_words(line, sep)``, which leaves out empty words at the end, for this session."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION my_concat_ws(sep STRING, a STRING, b STRING) "
        "RETURNS STRING RETURN a || sep || b"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION rand_int(n INT) "
        "RETURNS INT NOT DETERMINISTIC RETURN CAST(floor(rand() * n) AS INT)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION ip_number(ip STRING) RETURNS BIGINT RETURN "
        "((CAST(split_part(ip, '.', 1) AS BIGINT) * 256 + CAST(split_part(ip, '.', 2) AS BIGINT))"
        " * 256 + CAST(split_part(ip, '.', 3) AS BIGINT)) * 256 + CAST(split_part(ip, '.', 4) AS BIGINT)"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION split_words(line STRING, sep STRING) "
        "RETURNS TABLE(word STRING) RETURN SELECT w FROM (SELECT explode(CASE WHEN line = '' THEN array('') ELSE "
        "transform(array(split(line, concat('\\\\Q', sep, '\\\\E'), -1)), words -> slice(words, 1, "
        "array_max(transform(words, (x, i) -> IF(x <> '', i + 1, 0)))))[0] END) AS w)"
    )


def random_int(n: int) -> Column:
    return F.floor(F.rand() * n).cast("int")


def register_split_udtf(spark: SparkSession, name: str = "py_split_words") -> None:
    """The same table function in Python, for rules SQL cannot state. Python gets a batch of lines as Arrow columns and gives back
    a list of words for each line, which Spark spreads into rows: no call, batch or row object of its own for a line or a word."""

    def words_of(line: str, sep: str) -> list[str]:
        words = line.split(sep)
        while len(words) > 1 and not words[-1] or line and words == [""]:
            words.pop()  # empty words at the end don't count
        return words

    @F.arrow_udf(returnType="array<string>")
    def words(lines: pa.Array, seps: pa.Array) -> pa.Array:
        pairs = zip(lines.to_pylist(), seps.to_pylist(), strict=True)
        return pa.array([None if line is None else words_of(line, sep) for line, sep in pairs], pa.list_(pa.string()))

    spark.udf.register(f"{name}_of_line", words)
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(line STRING, sep STRING) "
        f"RETURNS TABLE(word STRING) RETURN SELECT explode({name}_of_line(line, sep))"
    )
