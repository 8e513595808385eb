"""Console, callbacks, JDBC and Kafka."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter


def to_console(df: DataFrame, label: str | None = None, mode: str = "append") -> DataStreamWriter | None:
    """Print rows, with a label column if given; a stream's writer is returned for the caller to start."""
    shown = df if label is None else df.select(F.lit(label).alias("label"), "*")
    if df.isStreaming:
        return shown.writeStream.format("console").outputMode(mode).option("truncate", "false")
    shown.show(truncate=False)
    return None


def to_callback(
    df: DataFrame,
    on_batch: Callable[[DataFrame, int], None] | None = None,
    on_row: Any = None,
    mode: str = "append",
) -> DataStreamWriter:
    """A user's sink: a function per micro-batch, or an object with ``open``, ``process`` and ``close``
    that handles single rows where they are."""
    if (on_batch is None) == (on_row is None):
        raise ValueError("give either on_batch or on_row")
    writer = df.writeStream.outputMode(mode)
    return writer.foreachBatch(on_batch) if on_batch else writer.foreach(on_row)


def jdbc_properties(batchsize: int = 100, **more: str) -> dict[str, str]:
    return {"batchsize": str(batchsize), "isolationLevel": "READ_COMMITTED", **more}


def to_jdbc(
    url: str, table: str, batchsize: int = 100, writers: int = 8, **properties: str
) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: batched inserts over at most ``writers`` connections; at least once.

    Credentials come in ``properties``. For exactly once, write with
    :func:`rillstone.sinks.tables.to_table_once`, or let the database ignore the same
    ``(batch_id, seq)``.
    """
    settings = jdbc_properties(batchsize, **properties)

    def write(df: DataFrame, batch_id: int) -> None:
        df.repartition(writers).write.jdbc(url, table, mode="append", properties=settings)

    return write


def kafka_rows(df: DataFrame, value: str, batch_id: int, seq: str, key: str | None = None) -> DataFrame:
    """Records for the Kafka writer. The header ``dedup`` is ``batch_id:seq`` and stays the same when a
    micro-batch is sent again, so a reader can drop the second copy."""
    dedup = F.concat_ws(":", F.lit(batch_id).cast("string"), F.col(seq).cast("string"))
    header = F.struct(F.lit("dedup").alias("key"), F.encode(dedup, "UTF-8").alias("value"))
    columns = [F.encode(F.col(value), "UTF-8").alias("value"), F.array(header).alias("headers")]
    if key:
        columns.insert(0, F.encode(F.col(key).cast("string"), "UTF-8").alias("key"))
    return df.select(*columns)


def kafka_sink_options(servers: str, topic: str, timeout_ms: int = 600_000) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
        "kafka.delivery.timeout.ms": str(timeout_ms),
    }


def to_kafka(
    options: Mapping[str, str], value: str, seq: str, key: str | None = None
) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: send to a topic with :func:`kafka_rows`."""
    def write(df: DataFrame, batch_id: int) -> None:
        kafka_rows(df, value, batch_id, seq, key).write.format("kafka").options(**options).save()

    return write


def insert_select(spark, sql: str, sink: Callable[[DataFrame], None]) -> None:
    """``INSERT INTO sink SELECT ...``: run the query text and hand its rows to a writer."""
    sink(spark.sql(sql))
