"""Streams against batch results, restart, replay, and sinks."""

from __future__ import annotations

import time
from datetime import datetime

import pytest
from tests.helpers import at
from pyspark.sql import functions as F

from rillstone.functions.sql import random_int
from rillstone.operators import rolling, state, windows
from rillstone.operators.scan import count, highest, scan, total
from rillstone.session import fresh_path, shared_dir
from rillstone.sinks import external, tables
from rillstone.sources import files, generated
from rillstone.streaming import batches, runner, stateful


def as_set(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def arriving(spark, skewed):
    """The skewed rows as five files in arrival order, read one file per micro-batch."""
    df, _ = skewed
    folder = fresh_path(spark, "arriving")
    for i in range(5):
        df.where(f"seq div 180 = {i}").coalesce(1).write.mode("append").parquet(folder)
        time.sleep(0.02)
    return lambda: files.read_rows_stream(spark, folder, df.schema, files_per_trigger=1)


def drained(spark, stream):
    out = fresh_path(spark, "out")
    runner.run(stream, fresh_path(spark, "progress"), path=out)
    return spark.read.parquet(out)


def test_state_over_micro_batches(spark, skewed, arriving):
    df, _ = skewed
    got = drained(spark, stateful.rolling_sum_stream(arriving(), ["key"], "seq", "v", "s"))
    assert as_set(got) == as_set(scan(df, ["key"], "seq", {"s": total("v")}).select("key", "seq", "s"))
    got = drained(spark, stateful.changelog_stream(arriving(), ["key"], "seq", "v"))
    assert as_set(got) == as_set(rolling.changelog(df, ["key"], "seq", "v"))
    got = drained(spark, stateful.last_n_stream(arriving(), ["key"], "seq", "tag", 4))
    assert as_set(got) == as_set(state.last_n(df, ["key"], "seq", "tag", 4).select("key", "seq", "last_values"))
    got = drained(spark, stateful.count_window_stream(arriving(), 7, "seq", "v", ["key"], "s"))
    assert as_set(got) == as_set(windows.count_window(df, 7, "seq", {"s": total("v")}, ["key"]))


def test_ttl_over_micro_batches(spark, skewed, arriving):
    df, _ = skewed
    timed = arriving().withColumn("at", F.unix_micros(F.col("ts").cast("timestamp")))
    got = drained(spark, stateful.rolling_ttl_stream(timed, ["key"], "seq", "at", 30_000_000, "v"))
    want = state.rolling_ttl(df, ["key"], "seq", "ts", "30 seconds", "v").select("key", "seq", "running")
    assert as_set(got) == as_set(want)


def test_dimension_over_micro_batches(spark, skewed, arriving):
    """Tag x deletes, tag y sets the value, tag z asks for it."""
    _, rows = skewed
    shaped = arriving().select(
        "key", "seq", (F.col("tag") != "z").alias("is_change"),
        F.when(F.col("tag") == "y", F.col("v").cast("string")).alias("name"),
    )
    got = {r["seq"]: r["name"] for r in drained(spark, stateful.dim_asof_stream(shaped, "key", "seq", "is_change", "name")).collect()}
    now, want = {}, {}
    for seq, key, _, v, tag in rows:
        if tag == "z":
            want[seq] = now.get(key)
        else:
            now[key] = str(v) if tag == "y" else None
    assert got == want


@pytest.mark.parametrize("block_rows", [2_000_000, 9])
def test_split_scans_over_micro_batches(spark, skewed, arriving, monkeypatch, block_rows):
    monkeypatch.setattr(batches, "SNAPSHOT_EVERY", 2)
    df, _ = skewed
    folds = {"s": total("v"), "hi": highest("v"), "n": count()}
    out, held = fresh_path(spark, "out"), fresh_path(spark, "held")
    runner.run(arriving(), fresh_path(spark, "progress"), each=batches.rolling_batches(out, held, ["key"], "seq", folds, block_rows))
    assert as_set(tables.read_once(spark, out)) == as_set(scan(df, ["key"], "seq", folds))
    out, held, pairs = (fresh_path(spark, n) for n in ("out", "held", "pairs"))
    each = batches.distinct_batches(out, held, pairs, ["key"], "seq", "v", block_rows=block_rows)
    runner.run(arriving(), fresh_path(spark, "progress"), each=each)
    want = rolling.rolling_distinct(df, ["key"], "seq", "v")
    assert as_set(tables.read_once(spark, out)) == as_set(want)
    reached = {r["key"]: r["distinct_values"] for r in tables.read_latest(spark, held, ["key"]).collect()}
    assert reached == {r["key"]: r["n"] for r in df.groupBy("key").agg(F.countDistinct("v").alias("n")).collect()}


def test_a_replayed_micro_batch_changes_nothing(spark, skewed):
    df, _ = skewed
    folds = {"s": total("v")}
    out, held = fresh_path(spark, "out"), fresh_path(spark, "held")
    write = batches.rolling_batches(out, held, ["key"], "seq", folds)
    first, second = df.where("seq < 300"), df.where("seq >= 300")
    for part, batch_id in ((first, 0), (second, 1), (second, 1), (first, 0), (second, 1)):
        write(part, batch_id)
    assert as_set(tables.read_once(spark, out)) == as_set(scan(df, ["key"], "seq", folds))


def test_late_rows_over_micro_batches(spark, skewed):
    df, rows = skewed
    mixed = df.select(((F.col("seq") * 7) % 93 + F.col("seq")).alias("a"), "seq", "ts")
    order = {r["seq"]: i for i, r in enumerate(mixed.orderBy("a", "seq").collect())}
    arrived = spark.createDataFrame([(order[r[0]], r[2]) for r in rows], "n bigint, ts timestamp_ntz")
    out, held = fresh_path(spark, "out"), fresh_path(spark, "held")
    write = batches.mark_late_batches(out, held, "ts", "5 seconds", "0 seconds", "n")
    for i in range(3):
        write(arrived.where(f"n div 100 = {i}"), i)
    whole = windows.with_lateness(arrived, "ts", "5 seconds", "0 seconds", "n").drop("ts")
    assert as_set(tables.read_once(spark, out)) == as_set(whole)
    assert whole.where("is_late").count() > 0


def test_windows_close_with_the_closing_row(spark, skewed, arriving):
    df, _ = skewed
    closing, out = fresh_path(spark, "closing"), fresh_path(spark, "out")

    def stream():
        rows = arriving().unionByName(runner.closing_rows(spark, df.schema, closing))
        timed = windows.with_event_time(rows, "ts", "0 seconds")
        return windows.session(timed, "ts", "7 seconds", {"s": total("v")}, ["key"])

    close = lambda: runner.write_closing_row(spark, df.schema, closing, "ts", {"key": "closing"})
    runner.run_to_end(stream, fresh_path(spark, "progress"), close, path=out)
    got = spark.read.parquet(out).where("key IS NULL OR key <> 'closing'")
    got = got.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).withColumn(
        "window_end", F.col("window_end").cast("timestamp_ntz")
    )
    assert as_set(got) == as_set(windows.session(df, "ts", "7 seconds", {"s": total("v")}, ["key"]))


def test_restart_reads_each_file_once(spark):
    folder, out, progress = (fresh_path(spark, n) for n in ("text", "out", "progress"))
    for lines in (["a", "b"], ["c"]):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(folder)
        runner.run(files.read_lines(spark, folder, stream=True), progress, path=out)
    assert sorted(r["line"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_upsert_and_compaction(spark):
    path, packed = fresh_path(spark, "t"), fresh_path(spark, "packed")
    schema = "id bigint, name string, at bigint"
    tables.upsert(spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], schema), path, ["id"], "at", 0)
    tables.upsert(spark.createDataFrame([(2, "d", 0)], schema), path, ["id"], "at", 1)
    want = ["Row(id=1, name='b', at=2)", "Row(id=2, name='d', at=0)"]
    assert as_set(tables.read_latest(spark, path, ["id"])) == want
    tables.compact(spark, path, ["id"], packed)
    assert as_set(tables.read_latest(spark, packed, ["id"])) == want
    tables.upsert(spark.createDataFrame([(3, "e", 0)], schema), packed, ["id"], "at", 2)
    assert tables.read_latest(spark, packed, ["id"]).count() == 3
    assert tables.read_latest(spark, path, ["id"], before=1).where("name = 'c'").count() == 1


def test_kv_sink(spark):
    path = fresh_path(spark, "kv")
    write = tables.to_kv_latest(path, "WORD_COUNT", "w", "n", "n")
    for i, rows in enumerate(([("a", 1), ("b", 1)], [("a", 3)])):
        write(spark.createDataFrame(rows, "w string, n bigint"), i)
    out = tables.read_latest(spark, path, ["hash", "field"])
    assert sorted((r["hash"], r["field"], r["value"]) for r in out.collect()) == [("WORD_COUNT", "a", "3"), ("WORD_COUNT", "b", "1")]


def test_clock_source_and_callbacks(spark):
    stream = generated.generate(spark, 50, 2, n=random_int(100), id=F.uuid())
    assert stream.isStreaming and stream.columns == ["ts", "seq", "n", "id"]
    seen = []
    query = external.to_callback(stream, on_batch=lambda df, i: seen.append(df.count())).trigger(processingTime="500 milliseconds").start()
    until = time.time() + 30
    while sum(seen) < 20 and time.time() < until:
        time.sleep(0.2)
    query.stop()
    assert sum(seen) >= 20
    with pytest.raises(ValueError):
        external.to_callback(stream)


def test_row_callback_has_open_and_close(spark, arriving):
    folder = shared_dir(spark)

    class Recorder:
        def open(self, partition_id, epoch_id):
            self.count = 0
            return True

        def process(self, row):
            self.count += 1

        def close(self, error):
            import uuid

            with open(f"{folder}/rec-{uuid.uuid4().hex}", "w") as f:
                f.write(str(self.count))

    import glob

    before = set(glob.glob(f"{folder}/rec-*"))
    writer = external.to_callback(arriving(), on_row=Recorder())
    writer.option("checkpointLocation", fresh_path(spark, "progress")).trigger(availableNow=True).start().awaitTermination()
    written = set(glob.glob(f"{folder}/rec-*")) - before
    assert sum(int(open(f).read()) for f in written) == 300


def test_console(spark, capsys, arriving):
    external.to_console(spark.range(1), label="here")
    assert "here" in capsys.readouterr().out
    assert external.to_console(arriving(), label="x") is not None


def test_kafka_records(spark):
    df = spark.createDataFrame([(5, "k", "text")], "seq bigint, k string, v string")
    row = external.kafka_rows(df, "v", 3, "seq", key="k").first()
    assert bytes(row["key"]) == b"k" and bytes(row["value"]) == b"text"
    assert row["headers"][0]["key"] == "dedup" and bytes(row["headers"][0]["value"]) == b"3:5"
    assert external.kafka_sink_options("h:1", "t")["kafka.delivery.timeout.ms"] == "600000"


def test_jdbc_settings(spark, monkeypatch):
    """No database is started: what would be sent to the writer is looked at."""
    calls = []
    from pyspark.sql.readwriter import DataFrameWriter

    monkeypatch.setattr(DataFrameWriter, "jdbc", lambda self, url, table, mode, properties: calls.append((url, table, mode, properties)))
    external.to_jdbc("jdbc:x", "t", user="u")(spark.range(3), 0)
    assert calls == [("jdbc:x", "t", "append", {"batchsize": "100", "isolationLevel": "READ_COMMITTED", "user": "u"})]


def test_shared_folder_is_the_session_setting(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_dir(spark) == (named or spark.sparkContext.getCheckpointDir()).rstrip("/")
    assert at(0).year == 1970


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_rows_far_in_the_future_stay(spark):
    """Only what the closing row made is left out, and it is known by its own key."""
    from rillstone.plans.stream_queries import _real, _users

    rows = [(5, datetime(2099, 5, 1)), (-1, datetime(2099, 5, 1))]
    df = spark.createDataFrame(rows, "user_id bigint, window_start timestamp_ntz")
    assert [r["user_id"] for r in _real(df, _users(), "window_start").collect()] == [5]
