"""Keyed state, expiry, timers, top-n."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.operators import rolling, state, topn
from rillstone.operators.scan import total
from rillstone.operators.windows import tumble
from rillstone.plans.registry import query
from rillstone.plans.tables import EV, PRICED, ev, priced_orders


@query(
    "state_value_sum",
    f"""WITH {EV} SELECT event_id, user_id,
    CAST(sum(cents) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS cents_so_far FROM ev""",
)
def state_value_sum(spark, sf):
    events = ev(spark, sf).select("event_id", "user_id", "cents")
    return rolling.rolling(events, ["user_id"], "event_id", {"cents_so_far": total("cents")}).drop("cents")


@query(
    "state_map_sum",
    f"""WITH {PRICED} SELECT o_orderkey, region, nation,
    CAST(sum(cents) OVER (PARTITION BY region, nation ORDER BY o_orderkey) AS BIGINT) AS income FROM priced""",
)
def state_map_sum(spark, sf):
    orders = priced_orders(spark, sf).select("o_orderkey", "region", "nation", "cents")
    return rolling.rolling(
        orders, ["region", "nation"], "o_orderkey", {"income": total("cents")}
    ).drop("cents")


def _ttl_check(keys: str) -> str:
    return f"""WITH {EV}, gaps AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY {keys} ORDER BY event_id)
        >= INTERVAL '6 hours' THEN 1 ELSE 0 END AS fresh FROM ev),
    runs AS (SELECT *, sum(fresh) OVER (PARTITION BY {keys} ORDER BY event_id) AS run FROM gaps)
    SELECT event_id, {keys}, CAST(sum(cents) OVER (PARTITION BY {keys}, run ORDER BY event_id) AS BIGINT) AS running FROM runs"""


@query("state_value_ttl", _ttl_check("user_id"))
def state_value_ttl(spark, sf):
    events = ev(spark, sf).select("event_id", "ts", "user_id", "cents")
    return state.rolling_ttl(events, ["user_id"], "event_id", "ts", "6 hours", "cents").drop("ts", "cents")


@query("state_map_ttl", _ttl_check("user_id, event_type"))
def state_map_ttl(spark, sf):
    events = ev(spark, sf).select("event_id", "ts", "user_id", "event_type", "cents")
    return state.rolling_ttl(
        events, ["user_id", "event_type"], "event_id", "ts", "6 hours", "cents"
    ).drop("ts", "cents")


@query(
    "state_list_last10",
    f"""WITH {EV} SELECT event_id, user_id, array_to_string(list(event_type) OVER
    (PARTITION BY user_id ORDER BY event_id ROWS 9 PRECEDING), ',') AS actions FROM ev""",
)
def state_list_last10(spark, sf):
    events = ev(spark, sf).select("event_id", "user_id", "event_type")
    lists = state.last_n(events, ["user_id"], "event_id", "event_type", 10)
    return lists.select("event_id", "user_id", F.array_join("last_values", ",").alias("actions"))


@query(
    "state_list_ttl",
    f"""WITH {EV}, live AS (SELECT event_id, user_id, list({{'id': event_id, 'e': event_type}}) OVER
      (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN 21599999999 PRECEDING AND CURRENT ROW) AS l FROM ev)
    SELECT event_id, user_id, array_to_string(list_transform(list_filter(list_sort(l), lambda x: x.id <= event_id),
      lambda x: x.e), ',') AS actions FROM live""",
)
def state_list_ttl(spark, sf):
    events = ev(spark, sf).select("event_id", "ts", "user_id", "event_type")
    lists = state.last_within(events, ["user_id"], "event_id", "ts", "6 hours", "event_type")
    return lists.select("event_id", "user_id", F.array_join("live_values", ",").alias("actions"))


@query("timer_delay", f"WITH {EV} SELECT DISTINCT event_type, k, ts + INTERVAL '20 minutes' AS fires_at FROM ev")
def timer_delay(spark, sf):
    return state.delayed(ev(spark, sf), ["event_type", "k"], "ts", "20 minutes")


@query(
    "timer_bucket_sum",
    f"""WITH {EV} SELECT time_bucket(INTERVAL '30 minutes', ts, TIMESTAMP '1970-01-01') + INTERVAL '30 minutes' AS fires_at,
    event_type, CAST(sum(cents) AS BIGINT) AS cents FROM ev GROUP BY ALL""",
)
def timer_bucket_sum(spark, sf):
    sums = tumble(ev(spark, sf), "ts", "30 minutes", {"cents": total("cents")}, ["event_type"])
    return sums.select(F.col("window_end").alias("fires_at"), "event_type", "cents")


@query(
    "timer_topn_per_key",
    f"""WITH {EV}, placed AS (SELECT event_id, event_type, cents,
      time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01') AS window_start FROM ev),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY event_type, window_start ORDER BY cents DESC, event_id) AS rank_no FROM placed)
    SELECT window_start, window_start + INTERVAL '1 day' AS window_end, event_type, event_id, cents, rank_no
    FROM ranked WHERE rank_no <= 3""",
)
def timer_topn_per_key(spark, sf):
    top = topn.window_topn(
        ev(spark, sf).select("event_id", "ts", "event_type", "cents"),
        "ts", "1 day", ["event_type"], "cents", 3, tie=["event_id"],
    )
    return top.drop("ts")


@query(
    "hot_items_topn",
    f"""WITH {EV}, panes AS (SELECT *, time_bucket(INTERVAL '2 hours', ts, TIMESTAMP '1970-01-01') AS pane FROM ev),
    counted AS (SELECT pane - i * INTERVAL '2 hours' AS window_start, category, event_type, k AS item, count(*) AS hits
      FROM panes, range(5) AS r(i) GROUP BY ALL),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY category, event_type, window_start ORDER BY hits DESC, item) AS rank_no
      FROM counted)
    SELECT window_start, window_start + INTERVAL '10 hours' AS window_end, category, event_type, item, hits, rank_no
    FROM ranked WHERE rank_no <= 3""",
)
def hot_items_topn(spark, sf):
    events = ev(spark, sf).select("ts", "event_type", F.col("k").alias("item"), "category")
    return topn.hot_items(events, "ts", "10 hours", "2 hours", 3)
