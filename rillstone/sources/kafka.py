"""Kafka topics (the connector jar comes from the cluster) and their CSV payload."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def kafka_options(
    servers: str,
    topics: str | Sequence[str],
    starting: str = "earliest",
    group_prefix: str | None = None,
    max_offsets: int | None = None,
) -> dict[str, str]:
    """Reader options. ``starting`` is ``earliest``, ``latest`` or a JSON of offsets and counts only
    for a query without checkpoint; afterwards the offsets in the checkpoint do."""
    names = topics if isinstance(topics, str) else ",".join(topics)
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": names,
        "startingOffsets": starting,
        "failOnDataLoss": "true",
    }
    if group_prefix:
        options["groupIdPrefix"] = group_prefix
    if max_offsets:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options


def read_kafka(spark: SparkSession, options: Mapping[str, str], stream: bool = True) -> DataFrame:
    """Record text and time, with topic, partition and offset as the arrival order."""
    reader = spark.readStream if stream else spark.read
    return reader.format("kafka").options(**options).load().select(
        F.col("value").cast("string").alias("value"), "timestamp", "topic", "partition", "offset"
    )


def parse_csv_lenient(
    df: DataFrame,
    schema: T.StructType,
    value: str = "value",
    ts: str | None = "timestamp",
    ts_name: str = "ts",
) -> DataFrame:
    """Typed columns of a CSV payload; a field that does not fit its type is NULL, the others stay.
    ``ts`` is the record's own time, not a field."""
    parsed = df.withColumn("_csv", F.from_csv(value, schema.toDDL(), {"mode": "PERMISSIVE"}))
    columns = [F.col(f"_csv.{f.name}").alias(f.name) for f in schema.fields]
    if ts:
        columns.append(F.col(ts).alias(ts_name))
    return parsed.select(*columns)
