"""Sinks and delivery: upserts, exactly-once tables, restart and replay."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.operators.scan import total
from rillstone.plans import rolling_queries  # noqa: F401  (its checks are used here)
from rillstone.plans.registry import CHECKS, query
from rillstone.plans.tables import (
    WORDS,
    doc_words,
    shape_events,
    table,
    table_stream,
    two_arrivals,
)
from rillstone.session import fresh_path
from rillstone.sinks.external import kafka_rows, to_callback
from rillstone.sinks.tables import (
    compact,
    read_latest,
    read_once,
    to_kv_latest,
    to_table_once,
    to_upsert,
    write_once,
)
from rillstone.sinks.two_phase import read_committed, register_two_phase
from rillstone.streaming.batches import rolling_batches
from rillstone.streaming.runner import forget_commit, run

_PLAIN = "SELECT event_id, user_id, event_type FROM events"
_LATEST = """SELECT user_id, arg_max(event_type, event_id) AS event_type, max(event_id) AS event_id
    FROM events GROUP BY user_id"""


@query("sink_custom", _PLAIN)
def sink_custom(spark, sf):
    """A user's function per micro-batch."""
    out = fresh_path(spark, "out")
    rows = table_stream(spark, sf, "events").select("event_id", "user_id", "event_type")
    writer = to_callback(rows, on_batch=lambda df, batch_id: write_once(df, out, batch_id))
    writer.option("checkpointLocation", fresh_path(spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    return read_once(spark, out)


@query(
    "sink_kafka_rows",
    "SELECT event_type AS payload, '7:' || event_id AS dedup FROM events WHERE NOT starts_with(event_type, 'error')",
)
def sink_kafka_rows(spark, sf):
    """The records an exactly-once reader of the topic sees for micro-batch 7."""
    kept = table(spark, sf, "events").where(~F.startswith(F.col("event_type"), F.lit("error")))
    records = kafka_rows(kept, "event_type", 7, "event_id")
    return records.select(
        F.decode("value", "UTF-8").alias("payload"), F.decode(F.col("headers")[0]["value"], "UTF-8").alias("dedup")
    )


@query("sink_upsert", _LATEST)
def sink_upsert(spark, sf):
    """Last row per user, arriving in two steps, with the table compacted in the end."""
    out, packed, progress = (fresh_path(spark, n) for n in ("users", "packed", "progress"))
    for stream in two_arrivals(spark, sf):
        rows = stream.select("user_id", "event_type", "event_id")
        run(rows, progress, each=to_upsert(out, ["user_id"], "event_id"))
    compact(spark, out, ["user_id"], packed)
    return read_latest(spark, packed, ["user_id"])


@query(
    "sink_kv_latest",
    f"WITH {WORDS} SELECT 'WORD_COUNT' AS hash, word AS field, CAST(count(*) AS VARCHAR) AS value FROM words GROUP BY word",
)
def sink_kv_latest(spark, sf):
    """Newest count per word under one hash name."""
    out = fresh_path(spark, "kv")
    counts = doc_words(spark, sf).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    to_kv_latest(out, "WORD_COUNT", "word", "n", "n")(counts, 0)
    return read_latest(spark, out, ["hash", "field"]).select("hash", "field", "value")


@query("sink_jdbc_eo", _PLAIN)
def sink_jdbc_eo(spark, sf):
    """Every row once, although the newest micro-batch is delivered again after the note that it was done is lost."""
    out, progress = fresh_path(spark, "once"), fresh_path(spark, "progress")
    for stream in two_arrivals(spark, sf):
        rows = stream.select("event_id", "user_id", "event_type")
        run(rows, progress, each=to_table_once(out))
        forget_commit(spark, progress)
        run(rows.repartition(3), progress, each=to_table_once(out))
    return read_once(spark, out)


@query("sink_two_phase", _PLAIN)
def sink_two_phase(spark, sf):
    """Two arrivals through a two-phase commit. After the first, the note that its micro-batch is done is lost, so it
    is delivered again, cut differently."""
    register_two_phase(spark)
    out, progress = fresh_path(spark, "published"), fresh_path(spark, "progress")

    def deliver(rows):
        writer = rows.writeStream.format("two_phase").option("path", out).option("checkpointLocation", progress)
        writer.trigger(availableNow=True).start().awaitTermination()

    for stream in two_arrivals(spark, sf):
        rows = stream.select("event_id", "user_id", "event_type")
        deliver(rows)
        forget_commit(spark, progress)
        deliver(rows.repartition(3))
    return read_committed(spark, out, rows.schema)


@query("resume_from_checkpoint", CHECKS["rolling_sum"])
def resume_from_checkpoint(spark, sf):
    """Running sums over a stop and a start: state and offsets go on from the checkpoint."""
    out, held, progress = (fresh_path(spark, n) for n in ("out", "held", "progress"))
    each = rolling_batches(out, held, ["event_type"], "event_id", {"cents_so_far": total("cents")})
    for stream in two_arrivals(spark, sf):
        run(shape_events(stream).select("event_id", "event_type", "cents"), progress, each=each)
    return read_once(spark, out).drop("cents")


@query("replay_idempotent", _LATEST)
def replay_idempotent(spark, sf):
    """A micro-batch delivered again after a failure, and then the whole stream once more, to an upsert table."""
    out, progress = fresh_path(spark, "users"), fresh_path(spark, "progress")
    for stream in two_arrivals(spark, sf):
        rows = stream.select("user_id", "event_type", "event_id")
        run(rows, progress, each=to_upsert(out, ["user_id"], "event_id"))
        forget_commit(spark, progress)
        run(rows.repartition(3), progress, each=to_upsert(out, ["user_id"], "event_id"))
    run(rows, fresh_path(spark, "progress"), each=to_upsert(out, ["user_id"], "event_id"))
    return read_latest(spark, out, ["user_id"])
