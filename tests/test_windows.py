"""Windows: literal edges and brute force on skewed rows."""

from __future__ import annotations

import pytest
from tests.helpers import EPOCH, at, by_key
from pyspark.sql import functions as F

from rillstone.operators import topn, windows
from rillstone.operators.scan import count, total


def timed(spark, *rows):
    return spark.createDataFrame(
        [(i, "k", at(ms), v) for i, (ms, v) in enumerate(rows)], "seq bigint, k string, ts timestamp_ntz, v bigint"
    )


def sums():
    return {"s": total("v"), "n": count()}


def test_tumble_edge(spark):
    out = windows.tumble(timed(spark, (4999, 1), (5000, 2)), "ts", "5 seconds", sums()).orderBy("window_start")
    assert [(r["window_start"], r["window_end"], r["s"]) for r in out.collect()] == [
        (at(0), at(5000), 1), (at(5000), at(10000), 2),
    ]


@pytest.mark.parametrize("step", ["2 seconds", "3 seconds"])  # one divides the size, one does not
def test_slide_bounds(spark, step):
    width = int(step[0]) * 1000
    out = windows.slide(timed(spark, (1111, 7)), "ts", "10 seconds", step, sums())
    starts = sorted(r["window_start"] for r in out.collect())
    assert starts == [at(s) for s in range(-12000, 2000) if s % width == 0 and s <= 1111 < s + 10000]


def test_session_merges_rows_exactly_one_gap_apart(spark):
    out = windows.session(timed(spark, (0, 1), (5000, 2), (11000, 4)), "ts", "5 seconds", sums())
    assert sorted((r["window_start"], r["window_end"], r["s"]) for r in out.collect()) == [
        (at(0), at(10000), 3), (at(11000), at(16000), 4),
    ]


@pytest.mark.parametrize("stretch_slots", [1_000_000, 20, 3, 1])
def test_session_brute_force(skewed, stretch_slots):
    df, rows = skewed
    out = windows.session(df, "ts", "7 seconds", sums(), ["key"], stretch_slots)
    got = sorted((str(r["key"]), r["window_start"], r["window_end"], r["s"], r["n"]) for r in out.collect())
    want = []
    for key, group in by_key(rows).items():
        spans = []
        for _, _, ts, v, _ in group:
            if spans and (ts - spans[-1][1]).total_seconds() <= 7:
                spans[-1][1], spans[-1][2], spans[-1][3] = ts, spans[-1][2] + v, spans[-1][3] + 1
            else:
                spans.append([ts, ts, v, 1])
        gap = at(7000) - EPOCH
        want += [(str(key), a, b + gap, s, n) for a, b, s, n in spans]
    assert got == sorted(want)


@pytest.mark.parametrize("block_rows", [2_000_000, 9])
def test_count_windows(skewed, block_rows):
    df, rows = skewed
    out = windows.count_window(df, 7, "seq", {"s": total("v")}, ["key"], block_rows)
    got = sorted((str(r["key"]), r["window_no"], r["s"]) for r in out.collect())
    want = []
    for key, group in by_key(rows).items():
        values = [r[3] for r in group]
        want += [(str(key), i, sum(values[7 * i : 7 * i + 7])) for i in range(len(values) // 7)]
    assert got == sorted(want)
    listed = F.aggregate("rows", F.lit(0).cast("bigint"), lambda acc, r: acc + r["v"])
    applied = windows.count_window_apply(df, 7, "seq", ["v"], listed, "s", ["key"], block_rows)
    assert sorted((str(r["key"]), r["window_no"], r["s"]) for r in applied.collect()) == got


def test_incomplete_count_window_waits(spark):
    df = spark.createDataFrame([(i, i) for i in range(1, 8)], "seq bigint, v bigint")
    out = windows.count_window(df, 5, "seq", {"s": total("v")})
    assert [(r["window_no"], r["s"]) for r in out.collect()] == [(0, 15)]


@pytest.mark.parametrize("block_rows", [2_000_000, 9])
def test_collected_windows(skewed, block_rows):
    df, rows = skewed
    want = {}
    for seq, key, ts, _, _ in rows:
        want.setdefault((key, ts.replace(second=0, microsecond=0)), []).append(seq)
    out = windows.tumble_collect(df, "ts", "1 minute", "seq", ["v"], ["key"], block_rows=block_rows).collect()
    assert {(r["key"], r["window_start"]): [x["seq"] for x in r["rows"]] for r in out} == want and len(out) == len(want)
    each = windows.tumble_rows(df, "ts", "1 minute", "seq", ["v"], ["key"], block_rows=block_rows).collect()
    assert len(each) == len(rows)
    for r in each:
        assert want[r["key"], r["window_start"]][r["position"] - 1] == r["seq"]
    with pytest.raises(Exception, match="more than 4 rows"):
        windows.tumble_collect(df, "ts", "1 minute", "seq", ["v"], ["key"], most=4, block_rows=block_rows).collect()


def test_history(spark):
    df = timed(spark, (0, 1), (1000, 2), (6000, 4))
    out = windows.window_history(df, "ts", "5 seconds", {"s": total("v")}, ["k"]).orderBy("window_start")
    assert [(r["s"], r["s_so_far"]) for r in out.collect()] == [(3, 3), (4, 7)]


def test_late_literal(spark):
    on_time, late = windows.split_late(timed(spark, (1000, 1), (5000, 2), (2000, 4)), "ts", "5 seconds", "0 seconds", "seq")
    assert [r["v"] for r in late.collect()] == [4]
    assert sorted(r["v"] for r in on_time.collect()) == [1, 2]


@pytest.mark.parametrize("block_rows", [2_000_000, 9])
def test_late_brute_force(spark, skewed, block_rows):
    _, rows = skewed
    shuffled = [(i, r[2]) for i, r in enumerate(sorted(rows, key=lambda r: (r[0] * 7) % 31 + r[0]))]
    df = spark.createDataFrame(shuffled, "seq bigint, ts timestamp_ntz")
    out = windows.with_lateness(df, "ts", "5 seconds", "3 seconds", "seq", block_rows=block_rows)
    got = {r["seq"]: r["is_late"] for r in out.collect()}
    newest = None
    for seq, ts in shuffled:
        ms = int((ts - EPOCH).total_seconds() * 1000)
        assert got[seq] == (newest is not None and ms - ms % 5000 + 5000 <= newest - 3000)
        newest = ms if newest is None else max(newest, ms)
    assert any(got.values())


def test_hot_items(spark):
    rows = [("view", i, 1, at(1000)) for i in (5, 5, 6, 6, 7, 8)] + [("click", 9, 1, at(1000))]
    df = spark.createDataFrame(rows, "event_type string, item int, category int, ts timestamp_ntz")
    out = topn.hot_items(df, "ts", "10 seconds", "2 seconds", 3).where(F.col("window_start") == at(0))
    assert sorted((r["event_type"], r["rank_no"], r["item"], r["hits"]) for r in out.collect()) == [
        ("click", 1, 9, 1), ("view", 1, 5, 2), ("view", 2, 6, 2), ("view", 3, 7, 1),
    ]


def test_top_n_is_cut_before_the_shuffle(skewed):
    out = topn.window_topn(skewed[0], "ts", "1 minute", ["key"], "v", 3, ["seq"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_slide_copies_partial_sums_not_rows(skewed):
    out = windows.slide(skewed[0], "ts", "10 seconds", "2 seconds", sums(), ["key"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Expand") :]
    assert below.count("HashAggregate") == 2  # the step sums are complete before rows are multiplied
