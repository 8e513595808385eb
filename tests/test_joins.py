"""Joins: literal edges, brute force, and the shuffled path beyond the broadcast limit."""

from __future__ import annotations

import pytest
from tests.helpers import EPOCH, at

from rillstone.operators import joins, skew
from rillstone.operators.scan import count, total


def orders(spark, *rows):
    return spark.createDataFrame([(o, at(ms)) for ms, o in rows], "oid string, ts timestamp_ntz")


@pytest.mark.parametrize("salts", [1, 4])
def test_window_join_left(spark, salts):
    left = orders(spark, (1000, "o1"), (5000, "o2")).withColumnRenamed("ts", "l_ts")
    right = orders(spark, (1500, "o1"), (2000, "o2")).withColumnRenamed("ts", "r_ts")
    out = joins.window_join(left, right, ["oid"], "5 seconds", "left", "l_ts", "r_ts", salts)
    assert sorted((r["oid"], r["r_ts"]) for r in out.collect()) == [("o1", at(1500)), ("o2", None)]
    inner = joins.window_join(left, right, ["oid"], "5 seconds", "inner", "l_ts", "r_ts", salts)
    assert [r["oid"] for r in inner.collect()] == ["o1"]


def test_cogroup_has_groups_of_one_side(spark):
    left, right = orders(spark, (1000, "o1"), (1100, "o1")), orders(spark, (1500, "o1"), (9000, "o3"))
    out = joins.window_cogroup(left, right, ["oid"], "5 seconds", {"l": count()}, {"r": count()})
    assert sorted((r["oid"], r["l"], r["r"]) for r in out.collect()) == [("o1", 2, 1), ("o3", None, 1)]


def test_interval_edges(spark):
    left = orders(spark, (1000, "o"))
    right = orders(spark, (0, "o"), (1999, "o"), (2000, "o"), (1000, "x")).withColumnRenamed("ts", "right_ts")
    second = 1_000_000
    open_end = joins.interval_join(left, right, ["oid"], -second, second)
    assert sorted(r["right_ts"] for r in open_end.collect()) == [at(0), at(1999)]
    closed = joins.interval_join(left, right, ["oid"], -second, second, hi_open=False)
    assert sorted(r["right_ts"] for r in closed.collect()) == [at(0), at(1999), at(2000)]


@pytest.mark.parametrize(
    ("lo", "hi", "salts"), [(-3000, 2000, 1), (-3000, 2000, 5), (1000, 5000, 1), (-5000, -1000, 1), (0, 1, 1)]
)
def test_interval_brute_force(skewed, lo, hi, salts):
    df, rows = skewed
    left = df.select("key", "seq", "ts")
    right = df.selectExpr("key", "seq AS r_seq", "ts AS right_ts")
    out = joins.interval_join(left, right, ["key"], lo * 1000, hi * 1000, salts=salts)
    ms = {r[0]: (r[1], (r[2] - EPOCH).total_seconds() * 1000) for r in rows}
    want = sorted(
        (a, b)
        for a, (ka, ta) in ms.items()
        for b, (kb, tb) in ms.items()
        if ka is not None and ka == kb and ta + lo <= tb < ta + hi
    )
    assert sorted((r["seq"], r["r_seq"]) for r in out.collect()) == want


@pytest.mark.parametrize("block_rows", [2_000_000, 2])
def test_dimension_changes(spark, block_rows):
    changes = spark.createDataFrame(
        [(1, "c1", "A", "INSERT"), (3, "c1", "B", "UPDATE"), (5, "c1", "B", "DELETE")],
        "seq bigint, cid string, name string, op string",
    )
    facts = spark.createDataFrame([(2, "c1"), (4, "c1"), (6, "c1"), (7, "c9")], "seq bigint, cid string")
    out = joins.dim_asof_join(facts, changes, "cid", "seq", "name", block_rows=block_rows).orderBy("seq")
    assert [r["name"] for r in out.collect()] == ["A", "B", None, None]


@pytest.mark.parametrize("limit", [skew.BROADCAST_BYTES, -1])
def test_lookup(spark, limit):
    df = spark.createDataFrame([(i, i % 4) for i in range(40)], "seq bigint, cid int")
    dim = spark.createDataFrame([(0, "zero"), (1, "one"), (2, "two")], "cid int, name string")
    out = joins.lookup_join(df, dim, ["cid"], {"name": "unknown"}, broadcast_bytes=limit).orderBy("seq")
    names = ["zero", "one", "two", "unknown"]
    assert [(r["seq"], r["name"]) for r in out.collect()] == [(i, names[i % 4]) for i in range(40)]
    plain = joins.lookup_join(df, dim, ["cid"], broadcast_bytes=limit)
    assert plain.where("name IS NULL").count() == 10


@pytest.mark.parametrize("limit", [skew.BROADCAST_BYTES, -1])
def test_ip_ranges(spark, limit):
    rules = spark.createDataFrame(
        [(0, 257, "low"), (258, 258, "one"), (1 << 21, (1 << 23) + 5, "wide")],
        "range_start bigint, range_end bigint, province string",
    )
    ips = spark.createDataFrame(
        [("0.0.1.2",), ("0.0.0.0",), ("0.0.1.3",), ("0.32.0.0",), ("0.128.0.5",), ("0.128.0.6",), ("x",)], "ip string"
    )
    out = joins.ip_lookup(ips, rules, "ip", broadcast_bytes=limit)
    assert {r["ip"]: r["province"] for r in out.collect()} == {
        "0.0.1.2": "one", "0.0.0.0": "low", "0.0.1.3": None, "0.32.0.0": "wide",
        "0.128.0.5": "wide", "0.128.0.6": None, "x": None,
    }


@pytest.mark.parametrize("limit", [skew.BROADCAST_BYTES, -1])
def test_geo(spark, limit):
    grid = spark.createDataFrame([(11, 3, "north"), (-1, -1, "south")], "cell_x bigint, cell_y bigint, province string")
    df = spark.createDataFrame([(1, 116.3, 39.9), (2, -0.1, -0.1), (3, 0.1, 0.1)], "seq bigint, lon double, lat double")
    out = joins.geo_enrich(df, grid, 10.0, broadcast_bytes=limit).orderBy("seq")
    assert [r["province"] for r in out.collect()] == ["north", "south", None]


def test_salted_sum_is_the_sum(skewed):
    df, _ = skewed
    salted = skew.salted_sum(df, ["key"], "v", ["seq"])
    plain = df.groupBy("key").agg({"v": "sum"})
    assert sorted(map(tuple, salted.collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)


def test_a_large_dimension_is_not_broadcast(spark):
    df, dim = spark.range(100).withColumnRenamed("id", "k"), spark.range(10).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = skew.lookup(df, dim, ["k"])._jdf.queryExecution().executedPlan().toString()
        large = skew.lookup(df, dim, ["k"], broadcast_bytes=8)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in small and "BroadcastHashJoin" not in large


def test_ranges_of_any_width(spark):
    rules = [(0, 2**62, "huge"), (2**62 + 1, 2**62 + 1, "one"), (-500, -300, "below"), (-10, -1, "near"), (2**62 + 5, 2**62 + 900, "more")]
    df = spark.createDataFrame([(v,) for v in (0, 17, 2**62, 2**62 + 1, 2**62 + 2, 2**62 + 900, -1, -11, -400, None)], "v bigint")
    ranges = spark.createDataFrame(rules, "range_start bigint, range_end bigint, name string")
    for limit in (skew.BROADCAST_BYTES, -1):
        got = {r["v"]: r["name"] for r in joins.range_lookup(df, ranges, "v", broadcast_bytes=limit).collect()}
        assert got == {
            0: "huge", 17: "huge", 2**62: "huge", 2**62 + 1: "one", 2**62 + 2: None, 2**62 + 900: "more",
            -1: "near", -11: None, -400: "below", None: None,
        }
    assert joins.range_lookup(df, ranges.limit(0), "v").where("name IS NOT NULL").count() == 0
