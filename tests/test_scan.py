"""Running aggregates against plain loops, with keys split into blocks of a few rows."""

from __future__ import annotations

from pathlib import Path

import pytest
from tests.helpers import at, by_key
from pyspark.sql import functions as F

from rillstone.operators import joins, rolling, scan as scanning, state, windows
from rillstone.operators.scan import (
    BLOCK,
    count,
    ends,
    highest,
    lowest,
    scan,
    total,
    with_blocks,
)
from rillstone.session import shared_dir

SIZES = [2_000_000, 50, 7, 1]


def test_only_large_keys_are_split_and_no_block_is_large(skewed):
    df, rows = skewed
    sizes = {
        (r["key"], r[BLOCK]): r["count"]
        for r in with_blocks(df, ["key"], "seq", 60).groupBy("key", BLOCK).count().collect()
    }
    for key, group in by_key(rows).items():
        blocks = [n for (k, _), n in sizes.items() if k == key]
        assert sum(blocks) == len(group)
        if len(group) <= 60:
            assert blocks == [len(group)] and (key, 0) in sizes
        else:
            assert len(blocks) >= len(group) / 60 and max(blocks) < 120


@pytest.mark.parametrize("block_rows", SIZES)
def test_running_aggregates(skewed, block_rows):
    df, rows = skewed
    out = scan(
        df, ["key"], "seq",
        {"s": total("v"), "n": count(), "lo": lowest("v"), "hi": highest("v")},
        block_rows=block_rows,
    )
    got = {r["seq"]: (r["s"], r["n"], r["lo"], r["hi"]) for r in out.collect()}
    want = {}
    for group in by_key(rows).values():
        for i, row in enumerate(group):
            seen = [r[3] for r in group[: i + 1]]
            want[row[0]] = (sum(seen), len(seen), min(seen), max(seen))
    assert got == want


@pytest.mark.parametrize("keys", [["key"], []])
def test_uneven_order_is_cut_evenly(spark, keys):
    """Microseconds of one second in 2024, and two stray rows: the year 1970 and the year 9999."""
    places = [0, *range(1_704_067_200_000_000, 1_704_067_201_000_000, 2000), 253_402_300_799_000_000]
    df = spark.createDataFrame([(p, "k", 1) for p in places], "seq bigint, key string, v bigint")
    blocks = with_blocks(df, keys, "seq", 20)
    assert max(r["count"] for r in blocks.groupBy(BLOCK).count().collect()) <= 40
    in_order = [r["seq"] for r in blocks.orderBy(BLOCK, "seq").collect()]
    assert in_order == places
    out = scan(df, keys, "seq", {"s": total("v")}, block_rows=20).orderBy("seq")
    assert [r["s"] for r in out.collect()] == list(range(1, 503))


def test_live_values_with_uneven_times(spark):
    times = [0, *[10**9 + 400 * i for i in range(200)], 10**12]
    df = spark.createDataFrame([(i, "k", at(ms), str(i)) for i, ms in enumerate(times)], "seq bigint, key string, ts timestamp_ntz, v string")
    out = state.last_within(df, ["key"], "seq", "ts", "3 seconds", "v", block_rows=10).orderBy("seq")
    for r, ms in zip(out.collect(), times):
        assert r["live_values"] == [str(i) for i, t in enumerate(times) if ms - 3000 < t <= ms]


def test_gaps_at_three_scales_and_many_rows_at_one_place(spark):
    places = [*range(3000), *range(10**9, 10**9 + 1500), *range(10**15, 10**15 + 500), 10**18]
    df = spark.createDataFrame([(p, "k", 1) for p in places], "seq bigint, key string, v bigint")
    sizes = [r["count"] for r in with_blocks(df, ["key"], "seq", 50).groupBy(BLOCK).count().collect()]
    assert max(sizes) <= 100 and len(sizes) >= len(places) / 100
    same = spark.createDataFrame([(i, 7, "k", 1) for i in range(3000)], "id bigint, seq bigint, key string, v bigint")
    out = scan(same, ["key"], "seq", {"s": total("v")}, tie=["id"], block_rows=50)
    assert {r["id"]: r["s"] for r in out.collect()} == {i: i + 1 for i in range(3000)}


def test_many_cuts_of_one_key(spark):
    df = spark.range(5000).select(F.col("id").alias("seq"), F.lit("k").alias("key"), F.lit(1).cast("bigint").alias("v"))
    out = scan(df, ["key"], "seq", {"s": total("v")}, block_rows=20)
    assert out.where("s != seq + 1").count() == 0


def lists_of_cuts(spark):
    return {p.name for p in Path(shared_dir(spark).removeprefix("file:")).glob("cuts-*")}


@pytest.mark.parametrize("keys", [["key"], []])
def test_blocks_are_numbered_without_a_list_of_cuts(spark, monkeypatch, keys):
    """Some 10,000 blocks, dealt to tasks that each see a range of the order."""
    monkeypatch.setattr(scanning, "_PART_ROWS", 1500)
    before = lists_of_cuts(spark)
    df = spark.range(20_000).select(
        (F.pmod(F.col("id") * 7919, F.lit(20_000)) - 5).alias("seq"), F.lit("k").alias("key"), F.lit(1).cast("bigint").alias("v")
    )
    blocks = with_blocks(df, keys, "seq", 2)
    assert blocks.columns == ["seq", "key", "v", BLOCK]
    assert {r["count"] for r in blocks.groupBy(BLOCK).count().collect()} <= {1, 2}
    assert [r["seq"] for r in blocks.orderBy(BLOCK, "seq").collect()] == list(range(-5, 19_995))
    out = scan(df, keys, "seq", {"s": total("v")}, block_rows=2)
    assert out.where("s != seq + 6").count() == 0 and out.count() == 20_000
    assert lists_of_cuts(spark) == before


def test_late_rows_of_one_arrival_are_cut_too(spark, monkeypatch):
    """2,000 rows that arrive at one time, in an order that ``tie`` settles, and 200 that follow."""
    monkeypatch.setattr(scanning, "_PART_ROWS", 300)
    before = lists_of_cuts(spark)
    rows = [(i, 5 if i < 2000 else i, at(i * 1709 % 2200 * 1000)) for i in range(2200)]
    df = spark.createDataFrame(rows, "id bigint, arrival bigint, ts timestamp_ntz")
    blocks = with_blocks(df, [], "arrival", 50, tie=["id"])
    assert max(r["count"] for r in blocks.groupBy(BLOCK).count().collect()) <= 50
    out = windows.with_lateness(df, "ts", "60 seconds", "0 seconds", "arrival", tie=["id"], block_rows=50)
    got, newest = {r["id"]: r["is_late"] for r in out.collect()}, -1
    for i, _, _ in rows:
        ms = i * 1709 % 2200 * 1000
        assert got[i] == (newest >= 0 and ms - ms % 60_000 + 60_000 <= newest)
        newest = max(newest, ms)
    assert lists_of_cuts(spark) == before


def test_running_distinct_in_blocks_of_two_rows(spark, monkeypatch):
    """A row and the mark of a first appearance have one place in the order and may lie in two blocks or tasks."""
    monkeypatch.setattr(scanning, "_PART_ROWS", 100)
    before = lists_of_cuts(spark)
    rows = [(i, "ab"[i % 3 == 0], i * 37 % 400 // (1 + i % 5)) for i in range(1500)]
    df = spark.createDataFrame(rows, "seq bigint, key string, v bigint")
    out = rolling.rolling_distinct(df, ["key"], "seq", "v", block_rows=2)
    got = {r["seq"]: (r["hits"], r["distinct_values"]) for r in out.collect()}
    for group in by_key(rows).values():
        seen = set()
        for n, (seq, _, v) in enumerate(group, 1):
            seen.add(v)
            assert got[seq] == (n, len(seen))
    assert lists_of_cuts(spark) == before


def test_dimension_changes_in_blocks_of_two_rows(spark, monkeypatch):
    monkeypatch.setattr(scanning, "_PART_ROWS", 100)
    before = lists_of_cuts(spark)
    changes = [(i, "ab"[i % 2], ("INSERT", "UPDATE", "DELETE")[i // 20 % 3], f"n{i}") for i in range(0, 1500, 20)]
    changes += [(i + 1, "b", "UPDATE", f"n{i + 1}") for i in range(0, 1500, 20)]
    facts = [(i, "ab"[i % 3 == 0]) for i in range(1500) if i % 20 > 1]
    out = joins.dim_asof_join(
        spark.createDataFrame(facts, "seq bigint, key string"),
        spark.createDataFrame(changes, "seq bigint, key string, op string, name string"),
        "key", "seq", "name", block_rows=2,
    )
    got, now, by_seq = {r["seq"]: r["name"] for r in out.collect()}, {}, {c[0]: c for c in changes}
    keys = dict(facts)
    for i in range(1500):
        if i in by_seq:
            _, key, op, name = by_seq[i]
            now[key] = None if op == "DELETE" else name
        if i in keys:
            assert got[i] == now.get(keys[i])
    assert len(got) == len(facts) and lists_of_cuts(spark) == before


@pytest.mark.parametrize("block_rows", [3, 10, 25])
def test_live_values_reach_over_several_blocks(spark, block_rows):
    """A crowd of rows at one time, and rows within the expiry behind it."""
    times = [*range(0, 40_000, 1000), *[40_000] * 60, *[40_000 + 7 * i for i in range(60)], *range(41_000, 80_000, 500)]
    df = spark.createDataFrame([(i, "k", at(ms)) for i, ms in enumerate(times)], "seq bigint, key string, ts timestamp_ntz")
    out = state.last_within(df, ["key"], "seq", "ts", "3 seconds", "seq", block_rows=block_rows).orderBy("seq")
    for i, (r, ms) in enumerate(zip(out.collect(), times, strict=True)):
        assert r["live_values"] == [j for j, t in enumerate(times[: i + 1]) if ms - 3000 < t]


def test_arg_extreme_leaves_null_out_and_takes_times(spark):
    df = spark.createDataFrame(
        [(at(i), "p", c, m) for i, (c, m) in enumerate([("v", None), ("x", 5), ("y", None), ("z", 3)])],
        "ts timestamp_ntz, p string, city string, money int",
    )
    for block_rows in (100, 1):
        out = rolling.rolling_by(df, ["p"], "ts", "money", largest=False, block_rows=block_rows).orderBy("ts")
        assert [r["city"] for r in out.collect()] == [None, "x", "x", "z"]


@pytest.mark.parametrize("block_rows", SIZES)
def test_no_key_and_rows_before_only(skewed, block_rows):
    df, rows = skewed
    out = scan(df, [], "seq", {"s": total("v")}, inclusive=False, block_rows=block_rows)
    got = {r["seq"]: r["s"] for r in out.collect()}
    sums = 0
    for row in rows:
        assert got[row[0]] == (sums or None)
        sums += row[3]


@pytest.mark.parametrize("block_rows", [2_000_000, 7])
def test_scan_goes_on_from_initial_values(skewed, block_rows):
    df, rows = skewed
    folds = {"s": total("v"), "hi": highest("v")}
    first, second = df.where("seq < 400"), df.where("seq >= 400")
    reached = ends(first, ["key"], folds)
    tail = scan(second, ["key"], "seq", folds, block_rows=block_rows, initial=reached)
    whole = scan(df, ["key"], "seq", folds, block_rows=block_rows).where("seq >= 400")
    assert sorted(map(str, tail.collect())) == sorted(map(str, whole.collect()))
    assert {r["key"]: r["s"] for r in ends(second, ["key"], folds, reached).collect()} == {
        k: sum(r[3] for r in g) for k, g in by_key(rows).items()
    }


def test_time_can_be_the_order(skewed):
    df, _ = skewed
    whole = scan(df, ["key"], "ts", {"n": count()}, tie=["seq"])
    split = scan(df, ["key"], "ts", {"n": count()}, tie=["seq"], block_rows=9)
    assert sorted(map(str, whole.collect())) == sorted(map(str, split.collect()))


def test_order_must_be_a_number_or_time(skewed):
    with pytest.raises(TypeError):
        scan(skewed[0], ["key"], "tag", {"n": count()})


@pytest.mark.parametrize("block_rows", [2_000_000, 3])
def test_extreme_keeps_other_columns_of_the_first_row(spark, block_rows):
    df = spark.createDataFrame(
        [(1, "p", "x", 3), (2, "p", "y", 9), (3, "p", "z", 5), (4, "p", "w", 9)],
        "seq bigint, p string, city string, money int",
    )
    out = rolling.rolling_extreme(df, ["p"], "seq", "money", block_rows=block_rows).orderBy("seq")
    assert [(r["money"], r["city"]) for r in out.collect()] == [(3, "x"), (9, "x"), (9, "x"), (9, "x")]
    out = rolling.rolling_extreme(df, ["p"], "seq", "money", largest=False, block_rows=block_rows)
    assert [r["money"] for r in out.orderBy("seq").collect()] == [3, 3, 3, 3]


@pytest.mark.parametrize("block_rows", [2_000_000, 1])
@pytest.mark.parametrize(
    ("largest", "first_on_tie", "want"),
    [(True, False, "xyyw"), (True, True, "xyyy"), (False, False, "xxzz"), (False, True, "xxxx")],
)
def test_arg_extreme_ties(spark, block_rows, largest, first_on_tie, want):
    low = [("x", 5), ("y", 9), ("z", 5), ("w", 9)]
    df = spark.createDataFrame(
        [(i, "p", c, m) for i, (c, m) in enumerate(low)], "seq bigint, p string, city string, money int"
    )
    out = rolling.rolling_by(
        df, ["p"], "seq", "money", largest=largest, first_on_tie=first_on_tie, block_rows=block_rows
    )
    assert "".join(r["city"] for r in out.orderBy("seq").collect()) == want


@pytest.mark.parametrize("block_rows", SIZES)
def test_running_distinct(skewed, block_rows):
    df, rows = skewed
    out = rolling.rolling_distinct(df, ["key"], "seq", "v", block_rows=block_rows)
    got = {r["seq"]: (r["hits"], r["distinct_values"]) for r in out.collect()}
    for group in by_key(rows).values():
        for i, row in enumerate(group):
            assert got[row[0]] == (i + 1, len({r[3] for r in group[: i + 1]}))


@pytest.mark.parametrize("block_rows", [2_000_000, 1])
def test_changelog(spark, block_rows):
    df = spark.createDataFrame([(1, "w", 1), (2, "w", 2), (3, "u", None)], "seq bigint, w string, v bigint")
    out = rolling.changelog(df, ["w"], "seq", "v", block_rows=block_rows).orderBy("seq", "is_insert")
    assert [tuple(r) for r in out.collect()] == [
        ("w", 1, True, 1), ("w", 2, False, 1), ("w", 2, True, 3), ("u", 3, True, 0),
    ]


def test_ttl_literal(spark):
    df = spark.createDataFrame(
        [(i, "k", at(s * 1000), 1) for i, s in enumerate((0, 29, 59, 60))],
        "seq bigint, k string, ts timestamp_ntz, v bigint",
    )
    out = state.rolling_ttl(df, ["k"], "seq", "ts", "30 seconds", "v").orderBy("seq")
    assert [r["running"] for r in out.collect()] == [1, 2, 1, 2]


@pytest.mark.parametrize("block_rows", SIZES)
def test_ttl(skewed, block_rows):
    df, rows = skewed
    out = state.rolling_ttl(df, ["key"], "seq", "ts", "30 seconds", "v", block_rows=block_rows)
    got = {r["seq"]: r["running"] for r in out.collect()}
    for group in by_key(rows).values():
        alive, last = 0, None
        for seq, _, ts, v, _ in group:
            alive = v if last is None or (ts - last).total_seconds() >= 30 else alive + v
            last = ts
            assert got[seq] == alive


@pytest.mark.parametrize("n", [2, 10])
@pytest.mark.parametrize("block_rows", SIZES)
def test_last_n(skewed, block_rows, n):
    df, rows = skewed
    out = state.last_n(df, ["key"], "seq", "tag", n, block_rows=block_rows)
    got = {r["seq"]: r["last_values"] for r in out.collect()}
    for group in by_key(rows).values():
        for i, row in enumerate(group):
            assert got[row[0]] == [r[4] for r in group[max(0, i + 1 - n) : i + 1]]


@pytest.mark.parametrize("block_rows", SIZES)
def test_last_within(skewed, block_rows):
    df, rows = skewed
    out = state.last_within(df, ["key"], "seq", "ts", "30 seconds", "tag", block_rows=block_rows)
    got = {r["seq"]: r["live_values"] for r in out.collect()}
    for group in by_key(rows).values():
        for i, row in enumerate(group):
            live = [r[4] for r in group[: i + 1] if (row[2] - r[2]).total_seconds() < 30]
            assert got[row[0]] == live


def test_timers_fire_once_per_key_and_time(spark):
    df = spark.createDataFrame([("k", at(0)), ("k", at(0)), ("j", at(0))], "k string, ts timestamp_ntz")
    out = state.delayed(df, ["k"], "ts", "20 seconds")
    assert sorted((r["k"], r["fires_at"]) for r in out.collect()) == [("j", at(20000)), ("k", at(20000))]


def test_plan_moves_full_rows_once(skewed):
    df, _ = skewed
    def exchanges(block_rows):
        plan = scan(df.withColumn("wide", F.lit("w")), ["key"], "seq", {"s": total("v")}, block_rows=block_rows)
        text = plan._jdf.queryExecution().executedPlan().toString()
        return text, [line for line in text.splitlines() if "Exchange" in line]

    text, all_exchanges = exchanges(2_000_000)
    assert len(all_exchanges) == 1 and "Union" not in text  # no large key: the plain window
    text, all_exchanges = exchanges(50)
    wide = [line for line in all_exchanges if "hashpartitioning(key" in line and "_block" in line]
    assert len(wide) == 2 and "CartesianProduct" not in text and "BroadcastNestedLoop" not in text
