"""The given tables and the views the queries share, as DataFrames and as SQL for the checks.

The events are minutes apart, so durations that are seconds for a live stream are minutes to hours
here.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F

from rillstone.operators.rows import split_lines, split_words
from rillstone.session import fresh_path, use_utc
from rillstone.sources.files import read_rows_stream


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str, files_per_trigger: int | None = 1) -> DataFrame:
    """The table as a stream, file by file unless said otherwise. The path is a pattern so that a single file will do as well as a folder,
    which a plain stream path has to be."""
    schema = table(spark, folder, name).schema
    return read_rows_stream(spark, f"{folder}/{name}.parque[t]", schema, files_per_trigger)


def two_arrivals(spark: SparkSession, folder: str) -> Iterator[DataFrame]:
    """The events as files that arrive in two steps, earlier ones first: a stream over the same folder
    each time, to be run to its end in between."""
    events = table(spark, folder, "events")
    middle = events.agg(F.percentile_approx("event_id", 0.5)).first()[0]
    arriving = fresh_path(spark, "arriving")
    early = F.coalesce(F.col("event_id") <= middle, F.lit(False))  # a NULL id comes with the later ones
    for part in (early, ~early):
        events.where(part).write.mode("append").parquet(arriving)
        yield read_rows_stream(spark, arriving, events.schema)


def shape_events(events: DataFrame) -> DataFrame:
    """Money as whole cents, the JSON item id, and its category."""
    k = F.get_json_object("props", "$.k").cast("int")
    return events.select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        k.alias("k"),
        (k % 10).alias("category"),
    )


def ev(spark: SparkSession, folder: str) -> DataFrame:
    return shape_events(table(spark, folder, "events"))


EV = """ev AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(round(value * 100) AS BIGINT) AS cents,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         CAST(json_extract(props, '$.k') AS INTEGER) % 10 AS category
  FROM events)"""


def doc_lines(spark: SparkSession, folder: str) -> DataFrame:
    return split_lines(table(spark, folder, "documents").select("doc_id", "text"), "text")


LINES = """lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)"""


def doc_words(spark: SparkSession, folder: str) -> DataFrame:
    return split_words(doc_lines(spark, folder), "line")


WORDS = f"""{LINES}, words AS (
  SELECT doc_id, unnest(CASE WHEN line = '' THEN [''] WHEN rtrim(line, ' ') = '' THEN []
                        ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM lines)"""


def priced_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with the region and nation of their customer, money in cents."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
    )
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    place = (
        table(spark, folder, "nation")
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", "n_name", "r_name")
    )
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(place, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("o_orderkey", "o_custkey", "cents", F.col("r_name").alias("region"), F.col("n_name").alias("nation"))
    )


PRICED = """priced AS (
  SELECT o_orderkey, o_custkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
         r_name AS region, n_name AS nation
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
