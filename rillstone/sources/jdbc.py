"""Tables of a database, for dimensions that are joined as a whole instead of asked row by row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    split_by: str | None = None,
    lo: int | None = None,
    hi: int | None = None,
    readers: int = 8,
    fetchsize: int = 10_000,
    **properties: str,
) -> dict[str, str]:
    """Reader options. With ``split_by`` (a number column with values from ``lo`` to ``hi``) the table
    is read over ``readers`` connections; values outside are read too. Credentials come in ``properties``."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetchsize), **properties}
    if split_by is not None:
        if lo is None or hi is None:
            raise ValueError("split_by needs lo and hi")
        options |= {
            "partitionColumn": split_by,
            "lowerBound": str(lo),
            "upperBound": str(hi),
            "numPartitions": str(readers),
        }
    return options


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
