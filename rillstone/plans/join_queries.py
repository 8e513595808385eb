"""Window and interval joins, changing dimensions, lookups, ranges."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.functions.text import number_ip
from rillstone.operators import joins as ops
from rillstone.operators.scan import count, total
from rillstone.plans.registry import query
from rillstone.plans.tables import EV, ev, table

_SIDES = f"""{EV}, views AS (SELECT event_id AS view_id, user_id, ts, cents AS view_cents,
    time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS window_start FROM ev WHERE event_type = 'view'),
  clicks AS (SELECT event_id AS click_id, user_id, ts, cents AS click_cents,
    time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS window_start FROM ev WHERE event_type = 'click')"""


def _views(spark, sf):
    return ev(spark, sf).where(F.col("event_type") == "view").select(
        F.col("event_id").alias("view_id"), "user_id", "ts", F.col("cents").alias("view_cents")
    )


def _clicks(spark, sf):
    return ev(spark, sf).where(F.col("event_type") == "click").select(
        F.col("event_id").alias("click_id"), "user_id", "ts", F.col("cents").alias("click_cents")
    )


def _window_join_check(how: str) -> str:
    return f"""WITH {_SIDES} SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, user_id,
    view_id, view_cents, click_id, click_cents FROM views {how} JOIN clicks USING (user_id, window_start)"""


_PAIR = ["window_start", "window_end", "user_id", "view_id", "view_cents", "click_id", "click_cents"]


@query("window_join_inner", _window_join_check("INNER"))
def window_join_inner(spark, sf):
    return ops.window_join(_views(spark, sf), _clicks(spark, sf), ["user_id"], "1 hour").select(*_PAIR)


@query("window_join_left", _window_join_check("LEFT"))
def window_join_left(spark, sf):
    joined = ops.window_join(_views(spark, sf), _clicks(spark, sf), ["user_id"], "1 hour", "left")
    return joined.select(*_PAIR)


@query(
    "window_cogroup",
    f"""WITH {_SIDES}, l AS (SELECT user_id, window_start, count(*) AS views, sum(view_cents) AS view_cents FROM views GROUP BY ALL),
    r AS (SELECT user_id, window_start, count(*) AS clicks, sum(click_cents) AS click_cents FROM clicks GROUP BY ALL)
    SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, user_id, views,
      CAST(view_cents AS BIGINT) AS view_cents, clicks, CAST(click_cents AS BIGINT) AS click_cents
    FROM l FULL JOIN r USING (user_id, window_start)""",
)
def window_cogroup(spark, sf):
    return ops.window_cogroup(
        _views(spark, sf),
        _clicks(spark, sf),
        ["user_id"],
        "1 hour",
        {"views": count(), "view_cents": total("view_cents")},
        {"clicks": count(), "click_cents": total("click_cents")},
    )


@query(
    "interval_join",
    f"""WITH {_SIDES} SELECT views.user_id, view_id, click_id, view_cents, click_cents
    FROM views JOIN clicks ON views.user_id = clicks.user_id
    AND clicks.ts >= views.ts - INTERVAL '6 hours' AND clicks.ts < views.ts + INTERVAL '6 hours'""",
)
def interval_join(spark, sf):
    clicks = _clicks(spark, sf).withColumnRenamed("ts", "right_ts")
    six_hours = 6 * 3_600_000_000
    joined = ops.interval_join(_views(spark, sf), clicks, ["user_id"], -six_hours, six_hours)
    return joined.select("user_id", "view_id", "click_id", "view_cents", "click_cents")


_OPS = "CASE event_type WHEN 'signup' THEN 'INSERT' WHEN 'view' THEN 'UPDATE' ELSE 'DELETE' END"


@query(
    "broadcast_dim_join",
    f"""WITH {EV}, changes AS (SELECT event_id AS at, user_id % 10 AS cid,
      CASE WHEN event_type <> 'error' THEN 'name-' || k END AS name FROM ev WHERE event_type IN ('signup', 'view', 'error')),
    facts AS (SELECT event_id, user_id % 10 AS cid, cents FROM ev WHERE event_type = 'purchase')
    SELECT event_id, facts.cid, cents, name FROM facts ASOF LEFT JOIN changes
    ON facts.cid = changes.cid AND facts.event_id >= changes.at""",
)
def broadcast_dim_join(spark, sf):
    return ops.dim_asof_join(*facts_and_changes(spark, sf), "cid", "event_id", "name")


def facts_and_changes(spark, sf):
    """Purchases, and a dimension whose entries come, change and go with other events."""
    events = ev(spark, sf).withColumn("cid", F.col("user_id") % 10)
    changes = events.where(F.col("event_type").isin("signup", "view", "error")).select(
        "cid",
        "event_id",
        F.expr(_OPS).alias("op"),
        F.concat(F.lit("name-"), F.col("k").cast("string")).alias("name"),
    )
    return events.where(F.col("event_type") == "purchase").select("event_id", "cid", "cents"), changes


def _lines(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_partkey").alias("p_partkey"))


def _small_parts(spark, sf):
    return table(spark, sf, "part").where(F.col("p_size") <= 25).select("p_partkey", "p_name")


@query(
    "lookup_join_default",
    """SELECT l_orderkey, l_linenumber, l_partkey AS p_partkey, coalesce(p_name, 'unknown') AS p_name FROM lineitem
    LEFT JOIN (SELECT p_partkey, p_name FROM part WHERE p_size <= 25) ON l_partkey = p_partkey""",
)
def lookup_join_default(spark, sf):
    return ops.lookup_join(_lines(spark, sf), _small_parts(spark, sf), ["p_partkey"], {"p_name": "unknown"})


@query(
    "lookup_join_ordered",
    """SELECT l_orderkey * 8 + l_linenumber AS seq, l_partkey AS p_partkey, p_name FROM lineitem
    LEFT JOIN (SELECT p_partkey, p_name FROM part WHERE p_size <= 25) ON l_partkey = p_partkey""",
)
def lookup_join_ordered(spark, sf):
    lines = _lines(spark, sf).select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"), "p_partkey"
    )
    return ops.lookup_join(lines, _small_parts(spark, sf), ["p_partkey"])


#: a made position of each user, and one named grid cell per nation
_LON, _LAT = "(user_id * 37 % 360) - 180", "(user_id * 53 % 180) - 90"


@query(
    "geo_enrich",
    f"""WITH {EV}, grid AS (SELECT (n_nationkey % 6) - 3 AS cell_x, (n_nationkey // 6) - 2 AS cell_y, n_name AS province FROM nation),
    placed AS (SELECT event_id, {_LON} AS lon, {_LAT} AS lat FROM ev)
    SELECT event_id, lon, lat, province FROM placed LEFT JOIN grid
    ON floor(lon / 60.0) = cell_x AND floor(lat / 60.0) = cell_y""",
)
def geo_enrich(spark, sf):
    return with_province(spark, sf, ev(spark, sf))


def with_province(spark, sf, events):
    grid = table(spark, sf, "nation").select(
        (F.col("n_nationkey") % 6 - 3).cast("bigint").alias("cell_x"),
        (F.floor(F.col("n_nationkey") / 6) - 2).alias("cell_y"),
        F.col("n_name").alias("province"),
    )
    placed = events.select("event_id", F.expr(_LON).alias("lon"), F.expr(_LAT).alias("lat"))
    return ops.geo_enrich(placed, grid, 60.0)


#: an address per user, and one address range per nation with a gap after each
_IP = "(user_id * 2654435761) % 4294967296"


@query(
    "range_lookup",
    f"""WITH {EV}, rules AS (SELECT n_nationkey::BIGINT * 171798691 AS a, n_nationkey::BIGINT * 171798691 + 120000000 AS b,
      n_name AS province FROM nation),
    hits AS (SELECT event_id, {_IP} AS ip FROM ev)
    SELECT event_id, (ip >> 24) || '.' || ((ip >> 16) & 255) || '.' || ((ip >> 8) & 255) || '.' || (ip & 255) AS ip, province
    FROM hits LEFT JOIN rules ON ip BETWEEN a AND b""",
)
def range_lookup(spark, sf):
    start = F.col("n_nationkey").cast("bigint") * 171798691
    rules = table(spark, sf, "nation").select(
        start.alias("range_start"), (start + 120000000).alias("range_end"), F.col("n_name").alias("province")
    )
    hits = ev(spark, sf).select("event_id", number_ip(F.expr(_IP)).alias("ip"))
    return ops.ip_lookup(hits, rules, "ip")
