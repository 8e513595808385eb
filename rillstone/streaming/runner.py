"""Start, resume and finish streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from rillstone.sources.files import read_rows_stream

_PARTITIONS = "spark.sql.shuffle.partitions"

#: event time of the closing row; later than any real event
END_OF_TIME = datetime(9999, 1, 1)


def start(
    df: DataFrame,
    checkpoint: str,
    path: str | None = None,
    each: Callable[[DataFrame, int], None] | None = None,
    mode: str = "append",
    every: str | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Start a query into parquet files at ``path`` or a function per micro-batch.

    Offsets and state live in ``checkpoint``: the same call after a stop or a failure goes on where
    the query was. Without ``every`` it takes what is there now, in as many micro-batches as the
    sources ask for, and ends.

    The number of state partitions is fixed when a query first starts: ``spark.sql.shuffle.partitions`` unless
    given, and on a single machine not more than its cores. (On a cluster the cores of the moment say nothing.)
    """
    if (path is None) == (each is None):
        raise ValueError("give either path or each")
    spark = df.sparkSession
    configured = spark.conf.get(_PARTITIONS)
    local = spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"
    wanted = state_partitions or (min(int(configured), spark.sparkContext.defaultParallelism) if local else int(configured))
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    writer = writer.foreachBatch(each) if each else writer.format("parquet").option("path", path)
    if str(wanted) == configured:
        return writer.start()
    spark.conf.set(_PARTITIONS, str(wanted))
    try:  # the query keeps its own copy of the settings from here on
        return writer.start()
    finally:
        spark.conf.set(_PARTITIONS, configured)


def run(df: DataFrame, checkpoint: str, **options: object) -> None:
    """:func:`start` and wait until all that is there now has been processed."""
    start(df, checkpoint, **options).awaitTermination()


def closing_rows(spark: SparkSession, schema: T.StructType, folder: str) -> DataFrame:
    """A stream of the closing row, empty until :func:`write_closing_row` is called on the folder."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(folder)
    return read_rows_stream(spark, folder, schema)


def write_closing_row(
    spark: SparkSession, schema: T.StructType, folder: str, ts: str, values: Mapping[str, object] | None = None
) -> None:
    """One row at the end of time. Append mode holds back windows that later rows could still change;
    this row moves the watermark past all of them. Its key must be one of its own."""
    at = F.lit(END_OF_TIME).cast(schema[ts].dataType)
    row = spark.range(1).select(
        *[
            (at if f.name == ts else F.lit((values or {}).get(f.name)).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )
    row.coalesce(1).write.mode("append").parquet(folder)


def run_to_end(
    df: Callable[[], DataFrame],
    checkpoint: str,
    close: Callable[[], None],
    **options: object,
) -> None:
    """Process what is there, then let ``close`` write the closing row and process that, so that
    every window of a finished input comes out."""
    run(df(), checkpoint, **options)
    close()
    run(df(), checkpoint, **options)


def forget_commit(spark: SparkSession, checkpoint: str) -> None:
    """Take back the note that the newest micro-batch of an ended query is done, as if the driver had been lost just before
    writing it: the next start delivers it again. For trying out sinks."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/commits")
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    notes = [s.getPath() for s in store.listStatus(folder) if s.getPath().getName().isdigit()]
    store.delete(max(notes, key=lambda p: int(p.getName())), False)
