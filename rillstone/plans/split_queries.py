"""Operators over ordered keys with a small block size, so that the split form runs, and is checked, on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.operators import joins, rolling, state, windows
from rillstone.operators.scan import count, total
from rillstone.plans import (  # noqa: F401
    join_queries,
    rolling_queries,
    state_queries,
    window_queries,
)
from rillstone.plans.registry import CHECKS, query
from rillstone.plans.tables import ev, priced_orders

#: rows of a block: far below what the keys of the smallest table have
_MANY, _FEW = 200, 20


@query("rolling_sum_split", CHECKS["rolling_sum"])
def rolling_sum_split(spark, sf):
    events = ev(spark, sf).select("event_id", "event_type", "cents")
    return rolling.rolling(events, ["event_type"], "event_id", {"cents_so_far": total("cents")}, _MANY).drop("cents")


@query("rolling_max_split", CHECKS["rolling_max"])
def rolling_max_split(spark, sf):
    rows = rolling_queries._slim(spark, sf)
    return rolling.rolling_extreme(rows, ["event_type"], "event_id", "cents", block_rows=_MANY)


@query("grand_total_income_split", CHECKS["grand_total_income"])
def grand_total_income_split(spark, sf):
    orders = priced_orders(spark, sf).select("o_orderkey", "region", "cents")
    folds = {"income": total("cents"), "orders_so_far": count()}
    return rolling.rolling(orders, [], "o_orderkey", folds, _MANY).drop("cents")


@query("ad_counts_running_split", CHECKS["ad_counts_running"])
def ad_counts_running_split(spark, sf):
    events = ev(spark, sf).select("event_id", F.col("k").alias("aid"), "event_type", "user_id")
    return rolling.rolling_distinct(
        events, ["aid", "event_type"], "event_id", "user_id", distinct="users", block_rows=2
    )


@query("retract_changelog_split", CHECKS["retract_changelog"])
def retract_changelog_split(spark, sf):
    events = ev(spark, sf).select("event_id", "event_type", "cents")
    return rolling.changelog(events, ["event_type"], "event_id", "cents", _MANY)


@query("count_window_keyed_split", CHECKS["count_window_keyed"])
def count_window_keyed_split(spark, sf):
    events = ev(spark, sf).select("event_id", "event_type", "cents")
    return windows.count_window(events, 5, "event_id", {"cents": total("cents")}, ["event_type"], _MANY)


@query("state_value_ttl_split", CHECKS["state_value_ttl"])
def state_value_ttl_split(spark, sf):
    events = ev(spark, sf).select("event_id", "ts", "user_id", "cents")
    return state.rolling_ttl(events, ["user_id"], "event_id", "ts", "6 hours", "cents", block_rows=_FEW).drop("ts", "cents")


@query("state_list_last10_split", CHECKS["state_list_last10"])
def state_list_last10_split(spark, sf):
    events = ev(spark, sf).select("event_id", "user_id", "event_type")
    lists = state.last_n(events, ["user_id"], "event_id", "event_type", 10, block_rows=_FEW)
    return lists.select("event_id", "user_id", F.array_join("last_values", ",").alias("actions"))


@query("state_list_ttl_split", CHECKS["state_list_ttl"])
def state_list_ttl_split(spark, sf):
    events = ev(spark, sf).select("event_id", "ts", "user_id", "event_type")
    lists = state.last_within(events, ["user_id"], "event_id", "ts", "6 hours", "event_type", block_rows=_FEW)
    return lists.select("event_id", "user_id", F.array_join("live_values", ",").alias("actions"))


@query("broadcast_dim_join_split", CHECKS["broadcast_dim_join"])
def broadcast_dim_join_split(spark, sf):
    facts, changes = join_queries.facts_and_changes(spark, sf)
    return joins.dim_asof_join(facts, changes, "cid", "event_id", "name", block_rows=_FEW)


@query("late_data_split_blocks", CHECKS["late_data_split"])
def late_data_split_blocks(spark, sf):
    arriving = window_queries._arriving(spark, sf)
    marked = windows.with_lateness(
        arriving, "ts", "1 hour", "0 seconds", "arrival", tie=["event_id"], block_rows=_MANY
    )
    return marked.drop("ts")
