"""Readers, over files that Spark first writes from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from rillstone.plans.registry import query
from rillstone.plans.tables import LINES, ev, table
from rillstone.session import fresh_path
from rillstone.sources.files import read_lines
from rillstone.sources.generated import sequence
from rillstone.sources.kafka import parse_csv_lenient
from rillstone.sources.tail import opened, tail_lines
from rillstone.streaming.runner import run, start

_LINES_ONLY = f"WITH {LINES} SELECT line FROM lines"


def _text(spark, sf, part=None):
    """Documents as text files; with ``part`` one half of them."""
    docs = table(spark, sf, "documents")
    if part is not None:
        docs = docs.where(F.col("doc_id") % 2 == part)
    return docs.select("text")


@query("src_text_lines", _LINES_ONLY)
def src_text_lines(spark, sf):
    """A line stream, drained into a table."""
    folder, out = fresh_path(spark, "text"), fresh_path(spark, "lines")
    _text(spark, sf).write.text(folder)
    run(read_lines(spark, folder, stream=True), fresh_path(spark, "progress"), path=out)
    return spark.read.parquet(out)


@query("src_file_once", _LINES_ONLY)
def src_file_once(spark, sf):
    folder = fresh_path(spark, "text")
    _text(spark, sf).write.text(folder)
    return read_lines(spark, folder)


@query("src_file_watch", _LINES_ONLY)
def src_file_watch(spark, sf):
    """Files that come while the folder is watched every second are read too."""
    folder, out = fresh_path(spark, "text"), fresh_path(spark, "lines")
    _text(spark, sf, 0).write.text(folder)
    watching = start(
        read_lines(spark, folder, stream=True), fresh_path(spark, "progress"), path=out, every="1 second"
    )
    try:
        watching.processAllAvailable()
        _text(spark, sf, 1).write.mode("append").text(folder)
        watching.processAllAvailable()
    finally:
        watching.stop()
    return spark.read.parquet(out)


#: characters of a growing file, about
_FILE_CHARS = 128 * 1024 * 1024


def _grow(docs, folder, files, whole):
    """Text files of the documents' lines in order; without ``whole`` the last line has been written by half only."""

    def write(batches):
        from pyspark import TaskContext

        store, root = opened(folder)
        store.create_dir(root, recursive=True)
        with store.open_output_stream(f"{root}/{TaskContext.get().partitionId()}.txt") as out:
            last = None
            for text in (v.as_py().encode() for batch in batches for v in batch.column(0)):
                if last is not None:
                    out.write(last + b"\n")
                last = text
            if last is not None:
                before, _, line = (b"\n" + last).rpartition(b"\n")
                out.write(last + b"\n" if whole else (before + b"\n" + line[: len(line) // 2])[1:])
        return iter(())

    docs.repartition(files, "doc_id").sortWithinPartitions("doc_id").select("text").mapInArrow(write, "text string").count()


def _whole_lines(spark, sf):
    """Documents without their lines that have a carriage return."""
    lines = F.filter(F.split("text", "\n"), lambda line: ~F.contains(line, F.lit("\r")))
    docs = table(spark, sf, "documents").select("doc_id", lines.alias("lines")).where(F.size("lines") > 0)
    return docs.select("doc_id", F.array_join("lines", "\n").alias("text"))


@query("src_tailed_files", f"WITH {LINES} SELECT line FROM lines WHERE NOT contains(line, chr(13))")
def src_tailed_files(spark, sf):
    """Files that grow between two runs are read on from the byte that was reached, in ranges of 64 KiB. There are four files,
    or more for large tables, so that none grows with the table."""
    folder, out, progress = (fresh_path(spark, n) for n in ("growing", "lines", "progress"))
    docs = table(spark, sf, "documents")
    middle, chars = docs.agg(F.percentile_approx("doc_id", 0.4), F.sum(F.length("text"))).first()
    files = max(4, -(-(chars or 0) // _FILE_CHARS))
    for upto, whole in ((F.col("doc_id") <= middle, False), (F.lit(True), True)):
        _grow(_whole_lines(spark, sf).where(upto), folder, files, whole)
        run(tail_lines(spark, folder, range_bytes=65536).select("line"), progress, path=out)
    return spark.read.parquet(out)


@query("src_resumable_files", _LINES_ONLY)
def src_resumable_files(spark, sf):
    """A stopped query goes on with the files it has not read."""
    folder, out, progress = (fresh_path(spark, n) for n in ("text", "lines", "progress"))
    for part in (0, 1):
        _text(spark, sf, part).write.mode("append").text(folder)
        run(read_lines(spark, folder, stream=True, files_per_trigger=64), progress, path=out)
    return spark.read.parquet(out)


@query("src_sequence", "SELECT CAST(i AS BIGINT) AS n FROM range(1, (SELECT count(*) FROM lineitem) + 1) AS r(i)")
def src_sequence(spark, sf):
    """Numbers 1 to as many as there are order lines."""
    return sequence(spark, 1, table(spark, sf, "lineitem").count())


@query(
    "src_kafka_csv_table",
    """SELECT CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id, event_id AS item_id, event_type AS behavior, ts FROM events""",
)
def src_kafka_csv_table(spark, sf):
    """CSV payloads as a topic would hold them; every seventh has a user id that is no number."""
    user = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("u"), F.col("user_id").cast("string"))).otherwise(
        F.col("user_id").cast("string")
    )
    records = ev(spark, sf).select(
        F.concat_ws(",", user, F.col("event_id").cast("string"), "event_type").alias("value"),
        F.col("ts").alias("timestamp"),
    )
    schema = T.StructType(
        [
            T.StructField("user_id", T.LongType()),
            T.StructField("item_id", T.LongType()),
            T.StructField("behavior", T.StringType()),
        ]
    )
    return parse_csv_lenient(records, schema)
