"""Count, tumbling, sliding and session windows, history and late rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.functions.aggregates import AVERAGE, aggregate_view, register_aggregate
from rillstone.operators import windows as ops
from rillstone.operators.scan import count, highest, lowest, total
from rillstone.plans.registry import query
from rillstone.plans.tables import EV, ev


def cents_and_rows():
    return {"cents": total("cents"), "n": count()}


_SUMS = "CAST(sum(cents) AS BIGINT) AS cents, count(*) AS n"


def _count_check(keys: str = "", measure: str = "CAST(sum(cents) AS BIGINT) AS cents") -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    cols = f"{keys}, " if keys else ""
    return f"""WITH {EV}, numbered AS (SELECT *, (row_number() OVER ({part} ORDER BY event_id) - 1) // 5 AS window_no FROM ev)
    SELECT {cols}window_no, {measure} FROM numbered GROUP BY {cols}window_no HAVING count(*) = 5"""


@query("count_window_all_sum", _count_check())
def count_window_all_sum(spark, sf):
    events = ev(spark, sf).select("event_id", "cents")
    return ops.count_window(events, 5, "event_id", {"cents": total("cents")})


@query("count_window_all_apply", _count_check())
def count_window_all_apply(spark, sf):
    events = ev(spark, sf).select("event_id", "cents")
    summed = F.aggregate("rows", F.lit(0).cast("bigint"), lambda acc, row: acc + row["cents"])
    return ops.count_window_apply(events, 5, "event_id", ["cents"], summed, "cents")


@query("count_window_keyed", _count_check("event_type"))
def count_window_keyed(spark, sf):
    events = ev(spark, sf).select("event_id", "event_type", "cents")
    return ops.count_window(events, 5, "event_id", {"cents": total("cents")}, ["event_type"])


def _tumble_check(keys: str = "", size: str = "1 hour", measures: str = _SUMS) -> str:
    cols = f"{keys}, " if keys else ""
    return f"""WITH {EV}, placed AS (SELECT *, time_bucket(INTERVAL '{size}', ts, TIMESTAMP '1970-01-01') AS window_start FROM ev)
    SELECT window_start, window_start + INTERVAL '{size}' AS window_end, {cols}{measures}
    FROM placed GROUP BY {cols}window_start"""


@query("tumble_all", _tumble_check())
def tumble_all(spark, sf):
    return ops.tumble(ev(spark, sf), "ts", "1 hour", cents_and_rows())


@query("tumble_keyed", _tumble_check("user_id"))
def tumble_keyed(spark, sf):
    return ops.tumble(ev(spark, sf), "ts", "1 hour", cents_and_rows(), ["user_id"])


@query(
    "tumble_reduce",
    _tumble_check(
        "event_type",
        measures="min(cents) AS least, max(cents) AS most, count(*) AS n, "
        "CAST(max(CASE WHEN k >= 50 THEN cents END) AS BIGINT) AS most_upper",
    ),
)
def tumble_reduce(spark, sf):
    folds = {
        "least": lowest("cents"),
        "most": highest("cents"),
        "n": count(),
        "most_upper": highest(F.when(F.col("k") >= 50, F.col("cents"))),
    }
    return ops.tumble(ev(spark, sf), "ts", "1 hour", folds, ["event_type"])


@query(
    "tumble_collect",
    _tumble_check(
        "event_type",
        measures="count(*) AS n, "
        "string_agg(CAST(cents AS VARCHAR), ',' ORDER BY event_id) AS listed",
    ),
)
def tumble_collect(spark, sf):
    lists = ops.tumble_collect(ev(spark, sf), "ts", "1 hour", "event_id", ["cents"], ["event_type"])
    return lists.select(
        "window_start",
        "window_end",
        "event_type",
        F.size("rows").cast("bigint").alias("n"),
        F.array_join(F.transform("rows", lambda r: r["cents"].cast("string")), ",").alias("listed"),
    )


def _slide_check(keys: str, size_h: int, step_h: int, measures: str = _SUMS) -> str:
    cols = f"{keys}, " if keys else ""
    return f"""WITH {EV}, panes AS (
      SELECT *, time_bucket(INTERVAL '{step_h} hours', ts, TIMESTAMP '1970-01-01') AS pane FROM ev),
    placed AS (SELECT panes.*, pane - i * INTERVAL '{step_h} hours' AS window_start
      FROM panes, range({size_h // step_h}) AS r(i))
    SELECT window_start, window_start + INTERVAL '{size_h} hours' AS window_end, {cols}{measures}
    FROM placed GROUP BY {cols}window_start"""


@query("slide_all", _slide_check("", 2, 1))
def slide_all(spark, sf):
    return ops.slide(ev(spark, sf), "ts", "2 hours", "1 hour", cents_and_rows())


@query("slide_keyed", _slide_check("user_id", 2, 1))
def slide_keyed(spark, sf):
    return ops.slide(ev(spark, sf), "ts", "2 hours", "1 hour", cents_and_rows(), ["user_id"])


@query("slide_keyed_five", _slide_check("event_type", 10, 2))
def slide_keyed_five(spark, sf):
    return ops.slide(ev(spark, sf), "ts", "10 hours", "2 hours", cents_and_rows(), ["event_type"])


def _session_check(keys: str, gap: str) -> str:
    part = f"PARTITION BY {keys}" if keys else ""
    cols = f"{keys}, " if keys else ""
    return f"""WITH {EV}, gaps AS (SELECT *, CASE WHEN ts - lag(ts) OVER ({part} ORDER BY ts, event_id) <= INTERVAL '{gap}'
        THEN 0 ELSE 1 END AS is_new FROM ev),
    numbered AS (SELECT *, sum(is_new) OVER ({part} ORDER BY ts, event_id) AS session_no FROM gaps)
    SELECT min(ts) AS window_start, max(ts) + INTERVAL '{gap}' AS window_end, {cols}{_SUMS}
    FROM numbered GROUP BY {cols}session_no"""


@query("session_all", _session_check("", "20 minutes"))
def session_all(spark, sf):
    return ops.session(ev(spark, sf), "ts", "20 minutes", cents_and_rows())


@query("session_keyed", _session_check("user_id", "6 hours"))
def session_keyed(spark, sf):
    return ops.session(ev(spark, sf), "ts", "6 hours", cents_and_rows(), ["user_id"])


@query("sql_tumble", _tumble_check("user_id", "10 hours"))
def sql_tumble(spark, sf):
    ev(spark, sf).createOrReplaceTempView("timed_orders")
    return spark.sql(
        "SELECT window.start AS window_start, window.end AS window_end, user_id, "
        "sum(cents) AS cents, count(*) AS n FROM timed_orders "
        "GROUP BY window(ts, '10 hours'), user_id"
    )


@query("sql_hop", _slide_check("user_id", 10, 2))
def sql_hop(spark, sf):
    ev(spark, sf).createOrReplaceTempView("timed_orders")
    return spark.sql(
        "SELECT window.start AS window_start, window.end AS window_end, user_id, "
        "sum(cents) AS cents, count(*) AS n FROM timed_orders "
        "GROUP BY window(ts, '10 hours', '2 hours'), user_id"
    )


@query(
    "window_reduce_history",
    f"""WITH {EV}, w AS (SELECT time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS window_start, user_id,
      sum(cents) AS cents FROM ev GROUP BY ALL)
    SELECT user_id, CAST(cents AS BIGINT) AS cents,
      CAST(sum(cents) OVER (PARTITION BY user_id ORDER BY window_start) AS BIGINT) AS cents_so_far FROM w""",
)
def window_reduce_history(spark, sf):
    return ops.window_history(
        ev(spark, sf), "ts", "1 hour", {"cents": total("cents")}, ["user_id"], with_bounds=False
    )


@query(
    "window_aggregate_history",
    f"""WITH {EV}, w AS (SELECT time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS window_start, user_id,
      sum(cents) AS cents, count(*) AS n FROM ev GROUP BY ALL)
    SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, user_id, CAST(cents AS BIGINT) AS cents, n,
      CAST(sum(cents) OVER h AS BIGINT) AS cents_so_far, CAST(sum(n) OVER h AS BIGINT) AS n_so_far
    FROM w WINDOW h AS (PARTITION BY user_id ORDER BY window_start)""",
)
def window_aggregate_history(spark, sf):
    return ops.window_history(ev(spark, sf), "ts", "1 hour", cents_and_rows(), ["user_id"])


#: an arrival order that brings some events up to 100 minutes late; event_id settles equal arrivals
_ARRIVAL = "+ ((event_id * 37) % 11) * 600000000"


def _arriving(spark, sf):
    events = ev(spark, sf).select("event_id", "ts", "event_type", "cents")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    return events.withColumn("arrival", at + F.expr("((event_id * 37) % 11) * 600000000"))


def _late_check(delay: str) -> str:
    return f"""WITH {EV}, arriving AS (SELECT *, epoch_us(ts) {_ARRIVAL} AS arrival FROM ev),
    seen AS (SELECT *, max(epoch_us(ts)) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
      FROM arriving)
    SELECT event_id, event_type, cents, arrival, coalesce(epoch_us(time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01'))
      + 3600000000 <= newest - {delay}, false) AS is_late FROM seen"""


@query("late_data_split", _late_check("0"))
def late_data_split(spark, sf):
    marked = ops.with_lateness(_arriving(spark, sf), "ts", "1 hour", "0 seconds", "arrival", tie=["event_id"])
    return marked.drop("ts")


@query("late_data_delayed", _late_check("3600000000"))
def late_data_delayed(spark, sf):
    return ops.with_lateness(_arriving(spark, sf), "ts", "1 hour", "1 hour", "arrival", tie=["event_id"]).drop("ts")


@query(
    "late_window_totals",
    f"""SELECT time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') AS window_start,
    time_bucket(INTERVAL '1 hour', ts, TIMESTAMP '1970-01-01') + INTERVAL '1 hour' AS window_end, event_type,
    CAST(sum(cents) AS BIGINT) AS cents, count(*) AS n
    FROM ({_late_check("0")}) JOIN (SELECT event_id, ts FROM events) USING (event_id)
    WHERE NOT is_late GROUP BY ALL""",
)
def late_window_totals(spark, sf):
    """The main output next to the late side output: window sums of the rows that came in time."""
    on_time, _ = ops.split_late(_arriving(spark, sf), "ts", "1 hour", "0 seconds", "arrival")
    return ops.tumble(on_time, "ts", "1 hour", cents_and_rows(), ["event_type"])


@query(
    "udaf_avg",
    "SELECT n_regionkey AS region, sum(c_acctbal) / count(c_acctbal) AS mean_balance "
    "FROM (SELECT n_regionkey, round(c_acctbal * 100) AS c_acctbal FROM customer "
    "JOIN nation ON c_nationkey = n_nationkey) GROUP BY n_regionkey",
)
def udaf_avg(spark, sf):
    """A user aggregate in the text of a grouped query."""
    from rillstone.plans.tables import table

    customer = table(spark, sf, "customer").select(
        "c_nationkey", F.round(F.col("c_acctbal") * 100).alias("c_acctbal")
    )
    nation = table(spark, sf, "nation").select("n_nationkey", F.col("n_regionkey").alias("region"))
    placed = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    register_aggregate(spark, "my_avg", AVERAGE)
    aggregate_view(placed, "v_customers", ["region"], {"c_acctbal": AVERAGE})
    return spark.sql("SELECT region, my_avg(c_acctbal) mean_balance FROM v_customers GROUP BY region")
