"""Batch operators inside micro-batches: equal to one batch over everything, with state that stays small."""

from __future__ import annotations

import random
import time
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from rillstone.operators import rolling, rows as row_ops, state, windows
from rillstone.operators.scan import count, total
from rillstone.session import fresh_path
from rillstone.sinks.tables import folders, read_latest, read_once, to_upsert
from rillstone.sources.files import read_rows_stream
from rillstone.streaming import batches, dimensions, processors
from rillstone.streaming.runner import run, start
from tests.helpers import EPOCH, at

SCHEMA = "seq bigint, key string, ts timestamp_ntz, v bigint, tag string"


@pytest.fixture(scope="module")
def history(spark):
    """600 rows over 50 hours: a hot key, keys that fall silent, times up to 20 minutes out of order."""
    pick, rows = random.Random(3), []
    for seq in range(600):
        key = "hot" if pick.random() < 0.5 else f"k{seq // 60 * 3 + pick.randrange(3)}"
        rows.append((seq, key, at(seq * 300_000 - pick.choice([0, 0, 400_000, 1_200_000])), pick.randrange(-5, 20), pick.choice("xyz")))
    return spark.createDataFrame(rows, SCHEMA).cache(), rows


def feed(df, each, steps=12, replay=()):
    """The rows in steps by arrival, each in several partitions and no order; some steps twice."""
    for i in range(steps):
        lo, hi = 600 * i // steps, 600 * (i + 1) // steps
        for _ in range(2 if i in replay else 1):
            each(df.where(f"seq >= {lo} AND seq < {hi}").repartition(3, F.rand(i)), i)


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_operators_carry_what_they_need(spark, history):
    """With blocks so small that the hot key is split inside the micro-batches; the queries run the plain form."""
    (df, _), block_rows = history, 25
    cases = {
        "changelog": (
            lambda out, held: batches.changelog_batches(out, held, ["key"], "seq", "v", block_rows),
            rolling.changelog(df, ["key"], "seq", "v"),
        ),
        "ttl": (
            lambda out, held: batches.ttl_batches(out, held, ["key"], "seq", "ts", "1 hour", "v", "30 minutes", block_rows=block_rows),
            state.rolling_ttl(df, ["key"], "seq", "ts", "1 hour", "v"),
        ),
        "live": (
            lambda out, held: batches.live_list_batches(out, held, ["key"], "seq", "ts", "1 hour", "tag", "30 minutes", block_rows=block_rows),
            state.last_within(df, ["key"], "seq", "ts", "1 hour", "tag"),
        ),
        "last": (
            lambda out, held: batches.last_n_batches(out, held, ["key"], "seq", "tag", 4, block_rows=block_rows),
            state.last_n(df, ["key"], "seq", "tag", 4),
        ),
        "windows": (
            lambda out, held: batches.count_window_batches(out, held, 7, "seq", {"s": total("v"), "n": count()}, ["key"], block_rows),
            windows.count_window(df, 7, "seq", {"s": total("v"), "n": count()}, ["key"]),
        ),
    }
    for name, (each, want) in cases.items():
        out, held = fresh_path(spark, "out"), fresh_path(spark, "held")
        feed(df, each(out, held), steps=3, replay=(1,))
        assert bag(read_once(spark, out).select(*want.columns)) == bag(want), name


def test_expired_state_goes(spark, history):
    """Over 12 micro-batches (and 4 for the sums): what is carried on stays as small as what is alive, however many
    keys have been seen."""
    df, rows = history
    sizes = {}
    for name, make in {
        "sum": lambda o, h: batches.ttl_batches(o, h, ["key"], "seq", "ts", "1 hour", "v", "30 minutes"),
        "list": lambda o, h: batches.live_list_batches(o, h, ["key"], "seq", "ts", "1 hour", "tag", "30 minutes"),
    }.items():
        out, held = fresh_path(spark, "out"), fresh_path(spark, "held")
        each, seen = make(out, held), []

        def step(batch, i, each=each, held=held, seen=seen):
            each(batch, i)
            assert len(folders(spark, held)) <= 2
            seen.append(spark.read.parquet(f"{held}/batch_id={i}").count())

        feed(df, step, steps=12 if name == "list" else 4)
        sizes[name] = seen
    # an hour and a half has 18 rows, and up to 8 keys; the half before and the half after do not differ in kind
    assert max(sizes["sum"]) <= 8 and max(sizes["list"]) <= 26
    assert max(sizes["list"][6:]) <= max(sizes["list"][:6]) + 4
    assert len({r[1] for r in rows}) > 30


def test_upsert_log_is_folded(spark, history):
    df, rows = history
    path, seen = fresh_path(spark, "log"), []
    each = to_upsert(path, ["key"], "seq", fold_every=6)

    def step(batch, i):
        each(batch.select("key", "seq", "v"), i)
        seen.append(len(folders(spark, path)))

    feed(df, step, steps=30, replay=(12, 13, 24))
    assert max(seen) <= 12
    want = {}
    for seq, key, _, v, _ in rows:
        want[key] = (seq, v)
    assert {r.key: (r.seq, r.v) for r in read_latest(spark, path, ["key"]).collect()} == want


@pytest.mark.parametrize("kind", ["bitmap", "sketch"])
def test_distinct_states(spark, history, kind):
    df, rows = history
    held = fresh_path(spark, "held")
    numbered = df.withColumn("user", F.when(F.col("v") != 3, (F.col("seq") * 7919) % 40 * 30_000))
    feed(numbered, batches.distinct_state_batches(held, ["key"], "user", kind), steps=22 if kind == "bitmap" else 4, replay=(0, 20))
    got = {r.key: (r.hits, r.distinct_values) for r in batches.distinct_states(spark, held, ["key"], kind=kind).collect()}
    want = {}
    for seq, key, _, v, _ in rows:
        want.setdefault(key, [0, set()])[0] += 1
        if v != 3:
            want[key][1].add(seq * 7919 % 40)
    assert got == {k: (n, len(users)) for k, (n, users) in want.items()}  # so few that the sketch is exact too


def test_sketch_error(spark):
    held = fresh_path(spark, "held")
    each = batches.distinct_state_batches(held, ["k"], "u", "sketch")
    for i in range(3):
        each(spark.range(i * 20_000, i * 20_000 + 40_000).selectExpr("'a' AS k", "id AS u"), i)
    (row,) = batches.distinct_states(spark, held, ["k"], kind="sketch").collect()
    assert row.hits == 120_000 and abs(row.distinct_values - 80_000) < 0.05 * 80_000


def test_multiset_takes_values_out(spark, history):
    """Aggregates of a changelog: after each step as if only the latest value of every key were there."""
    df, rows = history
    held, latest, sums = fresh_path(spark, "held"), {}, {}
    each = batches.multiset_batches(held, ["tag"], "v", "is_insert")
    for i in range(8):
        changes = []
        for seq, key, _, v, _ in rows[i * 60 : i * 60 + 60]:
            tag = "xyz"[len(key) % 3]
            if key in sums:
                changes.append((tag, False, sums[key]))
            sums[key] = sums.get(key, 0) + v
            latest[key] = tag
            changes.append((tag, True, sums[key]))
        for _ in range(1 + (i in (3, 5))):
            each(spark.createDataFrame(changes, "tag string, is_insert boolean, v bigint"), i)
        if i in (0, 7):
            got = {r.tag: (r.n, r.total, r.least, r.most) for r in batches.multiset_totals(spark, held, ["tag"], "v").collect()}
            groups = {}
            for key, tag in latest.items():
                groups.setdefault(tag, []).append(sums[key])
            assert got == {t: (len(v), sum(v), min(v), max(v)) for t, v in groups.items()}


@pytest.mark.parametrize("block_rows", [2_000_000, 25])
def test_retracting_total(history, block_rows):
    df, rows = history
    changes = rolling.changelog(df, ["key"], "seq", "v")
    got = {r.seq: r.all for r in rolling.retracting_total(changes, [], "seq", "v", out="all", block_rows=block_rows).where("is_insert").collect()}
    sums, want = {}, {}
    for seq, key, _, v, _ in rows:
        sums[key] = sums.get(key, 0) + v
        want[seq] = sum(sums.values())
    assert got == want


def test_newest_snapshot_counts(spark):
    dim, out = fresh_path(spark, "dim"), fresh_path(spark, "out")
    each = dimensions.lookup_latest(dim, out, ["k"])
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id bigint, k string")
    with pytest.raises(ValueError, match="no snapshot"):
        each(rows, 0)
    for version in (1, 2, 10):
        dimensions.publish(spark.createDataFrame([("a", version)], "k string, name int"), dim, version)
        each(rows, version)
    spark.createDataFrame([("a", 11)], "k string, name int").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{dim}/version=11")
    each(rows, 11)  # not whole yet
    got = bag(spark.read.parquet(out).select("batch_id", "id", "name"))
    assert got == sorted([(b, i, (min(b, 10) if i == 1 else None)) for b in (1, 2, 10, 11) for i in (1, 2, 3)], key=repr)
    assert dimensions.newest(spark, dim).first().name == 10


def test_recursion(spark):
    df = spark.createDataFrame([(1, 10), (2, 1), (3, -4), (4, None)], "id int, v int")
    got = {r.id: r.v for r in row_ops.iterate_recursive(df, "id", "v", "v - 3", "v > 0").collect()}
    assert got == {1: -2, 2: -2, 3: -7, 4: None}
    with pytest.raises(Exception, match="RECURSION_LEVEL"):
        row_ops.iterate_recursive(df, "id", "v", "v + 1", "v > 0").collect()
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "6")
    try:
        with pytest.raises(Exception, match="RECURSION_ROW"):
            row_ops.iterate_recursive(df, "id", "v", "v - 1", "v > 0").collect()
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", before)


def test_recursion_grows_with_the_values_and_not_the_rows(spark):
    df = spark.range(500).select("id", F.when(F.col("id") % 10 > 0, (F.col("id") % 10).cast("int")).alias("v"))
    before = spark.conf.get("spark.sql.cteRecursionRowLimit")
    spark.conf.set("spark.sql.cteRecursionRowLimit", "200")
    try:
        got = {r.id: r.v for r in row_ops.iterate_recursive(df, "id", "v", "v - 3", "v > 0").collect()}
    finally:
        spark.conf.set("spark.sql.cteRecursionRowLimit", before)
    assert got == {i: (i % 10 - 1) % 3 - 2 if i % 10 else None for i in range(500)}

def deliver(spark, folder, rows, schema, build, out, progress, each):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    stream = read_rows_stream(spark, folder, spark.createDataFrame([], schema).schema)
    with processors.rocksdb(spark):
        run(build(stream), progress, each=each(out))


def until(spark, path, n):
    """The rows of a running query's output, once there are ``n``."""
    for _ in range(120):
        try:
            rows = spark.read.parquet(path).collect()
        except Exception:  # noqa: BLE001 - nothing has been written yet
            rows = []
        if len(rows) >= n:
            return rows
        time.sleep(0.25)
    raise AssertionError(f"{len(rows)} of {n} rows")


def test_lists_and_maps_expire_by_the_clock(spark):
    schema = "seq bigint, k string, field string, v bigint"
    folder, lists, sums = (fresh_path(spark, n) for n in ("in", "lists", "sums"))
    first = [(1, "a", "x", 5), (2, "a", "y", 1), (3, "b", "x", 7), (4, "a", "x", None)]
    second = [(5, "a", "x", 2), (6, "c", "x", 1)]
    spark.createDataFrame(first, schema).coalesce(1).write.parquet(folder)
    stream = read_rows_stream(spark, folder, spark.createDataFrame([], schema).schema)
    with processors.rocksdb(spark):
        running = [
            start(processors.expiring_list(stream, ["k"], "seq", "field", "1 second"), fresh_path(spark, "p"), path=lists, every="1 second", state_partitions=2),
            start(processors.expiring_map(stream, ["k"], "seq", "field", "v", "1 hour"), fresh_path(spark, "p"), path=sums, every="1 second", state_partitions=2),
        ]
    try:
        until(spark, lists, 4), until(spark, sums, 4)
        time.sleep(1.5)
        spark.createDataFrame(second, schema).coalesce(1).write.mode("append").parquet(folder)
        got, added = until(spark, lists, 6), until(spark, sums, 6)
    finally:
        for query in running:
            query.stop()
    assert {r.seq: r.live_values for r in got} == {
        1: ["x"], 2: ["x", "y"], 4: ["x", "y", "x"], 3: ["x"], 5: ["x"], 6: ["x"]
    }  # the second arrival finds the first one's elements expired
    assert {r.seq: r.running for r in added} == {1: 5, 2: 1, 3: 7, 4: 5, 5: 7, 6: 1}


def test_timers_fire_when_the_watermark_passes(spark):
    """A bucket's rows come in several micro-batches and salts; late rows after it has fired count no more."""
    schema = "id bigint, k string, ts timestamp, v bigint"
    folder, out, progress = (fresh_path(spark, n) for n in ("in", "out", "progress"))

    def rows(*items):
        return [(i, k, EPOCH + timedelta(seconds=s), v) for i, k, s, v in items]

    def build(stream):
        return processors.top_timers(stream.withWatermark("ts", "0 seconds"), ["k"], "ts", "30 seconds", "v", "id", 2, salts=3)

    def each(out):
        return lambda df, batch_id: batches.write_once(processors.merged_top(df, ["k"], "v", "id", 2), out, batch_id)

    for part in (
        rows((1, "a", 1, 5), (2, "a", 20, 9), (3, "b", 5, 1), (4, "a", 31, 100)),
        rows((5, "a", 29, 9), (6, "a", 40, 3), (7, "b", 33, 2)),  # 5 is late: the watermark stands at 31
        rows((8, "a", 59, 50), (9, "a", 95, 1)),
        rows((10, "c", 400, 1)),
    ):
        deliver(spark, folder, part, schema, build, out, progress, each)
    got = bag(read_once(spark, out).select("k", "ends", "id", "v", "rank_no"))
    assert got == sorted([
        ("a", 30_000, 2, 9, 1), ("a", 30_000, 1, 5, 2), ("b", 30_000, 3, 1, 1),
        ("a", 60_000, 4, 100, 1), ("a", 60_000, 8, 50, 2), ("b", 60_000, 7, 2, 1), ("a", 120_000, 9, 1, 1),
    ], key=repr)
