"""Rolling and grouped keyed aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.functions.sql import random_int
from rillstone.operators import rolling as ops
from rillstone.operators.folding import rolling_combine
from rillstone.operators.scan import count, highest, lowest, total
from rillstone.operators.skew import salted_sum as salted
from rillstone.plans.registry import query
from rillstone.plans.tables import EV, PRICED, WORDS, doc_words, ev, priced_orders, table


@query("word_count", f"WITH {WORDS} SELECT word, count(*) AS n FROM words GROUP BY word")
def word_count(spark, sf):
    return doc_words(spark, sf).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


_BY_TYPE = "OVER (PARTITION BY event_type ORDER BY event_id)"


@query(
    "rolling_sum",
    f"WITH {EV} SELECT event_id, event_type, CAST(sum(cents) {_BY_TYPE} AS BIGINT) AS cents_so_far FROM ev",
)
def rolling_sum(spark, sf):
    events = ev(spark, sf).select("event_id", "event_type", "cents")
    out = ops.rolling(events, ["event_type"], "event_id", {"cents_so_far": total("cents")})
    return out.drop("cents")


@query(
    "rolling_reduce",
    f"""WITH {EV} SELECT event_id, event_type, CAST(sum(cents) {_BY_TYPE} AS BIGINT) AS total_cents,
    count(*) {_BY_TYPE} AS n, min(k) {_BY_TYPE} AS least_k, max(k) {_BY_TYPE} AS most_k FROM ev""",
)
def rolling_reduce(spark, sf):
    events = ev(spark, sf).select("event_id", "event_type", "cents", "k")
    folds = {"total_cents": total("cents"), "n": count(), "least_k": lowest("k"), "most_k": highest("k")}
    return ops.rolling(events, ["event_type"], "event_id", folds).drop("cents", "k")


@query(
    "rolling_reduce_user",
    f"""WITH {EV}, marked AS (SELECT *, category IS DISTINCT FROM lag(category) {_BY_TYPE} AND lag(event_id) {_BY_TYPE} IS NOT NULL AS changed FROM ev)
    SELECT event_id, event_type, first_value(category) {_BY_TYPE} AS first, category AS last,
      CAST(count(*) FILTER (changed) {_BY_TYPE} AS BIGINT) AS changes FROM marked""",
)
def rolling_reduce_user(spark, sf):
    """A user's combine that does not commute, with blocks far below what the keys have."""
    def joined(a: dict, b: dict) -> dict:
        """Two stretches of a key's rows put together; it matters which comes first."""
        return {"first": a["first"], "last": b["last"], "changes": a["changes"] + b["changes"] + (a["last"] != b["first"])}

    events = ev(spark, sf).select("event_id", "event_type", "category")
    own = F.struct(F.col("category").alias("first"), F.col("category").alias("last"), F.lit(0).cast("bigint").alias("changes"))
    out = rolling_combine(events, ["event_type"], "event_id", own, joined, "all", block_rows=200)
    return out.select("event_id", "event_type", "all.first", "all.last", "all.changes")


def _extreme_check(fn: str) -> str:
    return f"""WITH {EV} SELECT event_id, event_type, {fn}(cents) {_BY_TYPE} AS cents,
    first_value(user_id) {_BY_TYPE} AS user_id, first_value(k) {_BY_TYPE} AS k FROM ev"""


def _slim(spark, sf):
    return ev(spark, sf).select("event_id", "event_type", "cents", "user_id", "k")


@query("rolling_max", _extreme_check("max"))
def rolling_max(spark, sf):
    return ops.rolling_extreme(_slim(spark, sf), ["event_type"], "event_id", "cents")


@query("rolling_min", _extreme_check("min"))
def rolling_min(spark, sf):
    return ops.rolling_extreme(_slim(spark, sf), ["event_type"], "event_id", "cents", largest=False)


def _by_check(largest: bool, first_on_tie: bool) -> str:
    rank = "-event_id" if first_on_tie == largest else "event_id"
    pick = "max" if largest else "min"
    return f"""WITH {EV}, best AS (
      SELECT event_id, event_type,
        {pick}({{'by': cents, 'rank': {rank}, 'at': event_id, 'user_id': user_id, 'k': k}}) {_BY_TYPE} AS b
      FROM ev)
    SELECT event_id, event_type, b.at AS event_id_at, b.by AS cents, b.user_id AS user_id, b.k AS k FROM best"""


@query("rolling_max_by", _by_check(True, False))
def rolling_max_by(spark, sf):
    return ops.rolling_by(_slim(spark, sf), ["event_type"], "event_id", "cents", first_on_tie=False)


@query("rolling_max_by_first", _by_check(True, True))
def rolling_max_by_first(spark, sf):
    return ops.rolling_by(_slim(spark, sf), ["event_type"], "event_id", "cents", first_on_tie=True)


@query("rolling_min_by", _by_check(False, False))
def rolling_min_by(spark, sf):
    return ops.rolling_by(
        _slim(spark, sf), ["event_type"], "event_id", "cents", largest=False, first_on_tie=False
    )


@query("rolling_min_by_first", _by_check(False, True))
def rolling_min_by_first(spark, sf):
    return ops.rolling_by(
        _slim(spark, sf), ["event_type"], "event_id", "cents", largest=False, first_on_tie=True
    )


@query(
    "keyed_multi",
    f"""WITH {EV} SELECT event_id, user_id, event_type,
    CAST(sum(cents) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS BIGINT) AS cents_so_far FROM ev""",
)
def keyed_multi(spark, sf):
    events = ev(spark, sf).select("event_id", "user_id", "event_type", "cents")
    return ops.rolling(
        events, ["user_id", "event_type"], "event_id", {"cents_so_far": total("cents")}
    ).drop("cents")


@query(
    "province_income",
    f"""WITH {PRICED} SELECT o_orderkey, region,
    CAST(sum(cents) OVER w AS BIGINT) AS income, count(*) OVER w AS orders_so_far FROM priced
    WINDOW w AS (PARTITION BY region ORDER BY o_orderkey)""",
)
def province_income(spark, sf):
    orders = priced_orders(spark, sf).select("o_orderkey", "region", "cents")
    return ops.rolling(
        orders, ["region"], "o_orderkey", {"income": total("cents"), "orders_so_far": count()}
    ).drop("cents")


@query(
    "grand_total_income",
    f"""WITH {PRICED} SELECT o_orderkey, region,
    CAST(sum(cents) OVER w AS BIGINT) AS income, count(*) OVER w AS orders_so_far FROM priced
    WINDOW w AS (ORDER BY o_orderkey)""",
)
def grand_total_income(spark, sf):
    orders = priced_orders(spark, sf).select("o_orderkey", "region", "cents")
    return ops.rolling(
        orders, [], "o_orderkey", {"income": total("cents"), "orders_so_far": count()}
    ).drop("cents")


@query(
    "grand_total_final",
    f"WITH {PRICED} SELECT CAST(sum(cents) AS BIGINT) AS income, count(*) AS orders_so_far FROM priced",
)
def grand_total_final(spark, sf):
    regions = (
        priced_orders(spark, sf)
        .groupBy("region")
        .agg(F.sum("cents").alias("income"), F.count(F.lit(1)).alias("orders_so_far"))
    )
    return regions.agg(F.sum("income").alias("income"), F.sum("orders_so_far").alias("orders_so_far"))


@query(
    "grand_total_retract",
    f"WITH {PRICED} SELECT o_orderkey, CAST(sum(cents) OVER (ORDER BY o_orderkey) AS BIGINT) AS income FROM priced",
)
def grand_total_retract(spark, sf):
    """The total over regions of each region's latest sum: the changelog of the sums is consumed, an old sum goes out
    of the total before the new one comes in."""
    orders = priced_orders(spark, sf).select("o_orderkey", "region", "cents")
    changes = ops.changelog(orders, ["region"], "o_orderkey", "cents")
    totals = ops.retracting_total(changes, [], "o_orderkey", "cents", out="income")
    return totals.where("is_insert").select("o_orderkey", "income")


@query(
    "ad_counts_running",
    f"""WITH {EV}, marked AS (SELECT *, CASE WHEN row_number() OVER
      (PARTITION BY k, event_type, user_id ORDER BY event_id) = 1 THEN 1 ELSE 0 END AS is_first FROM ev)
    SELECT event_id, k AS aid, event_type, user_id, count(*) OVER w AS hits,
      CAST(sum(is_first) OVER w AS BIGINT) AS users FROM marked
    WINDOW w AS (PARTITION BY k, event_type ORDER BY event_id)""",
)
def ad_counts_running(spark, sf):
    events = ev(spark, sf).select("event_id", F.col("k").alias("aid"), "event_type", "user_id")
    return ops.rolling_distinct(
        events, ["aid", "event_type"], "event_id", "user_id", distinct="users"
    )


@query(
    "ad_counts_sql",
    f"""WITH {EV} SELECT k AS aid, event_type, count(*) AS hits, count(DISTINCT user_id) AS users
    FROM ev GROUP BY k, event_type""",
)
def ad_counts_sql(spark, sf):
    ev(spark, sf).createOrReplaceTempView("ad_events")
    return spark.sql(
        "SELECT k AS aid, event_type, count(*) AS hits, count(DISTINCT user_id) AS users "
        "FROM ad_events GROUP BY k, event_type"
    )


_SUPPLIER_SUM = """SELECT l_suppkey AS supplier, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
    FROM lineitem GROUP BY l_suppkey"""


@query("sql_group_sum", _SUPPLIER_SUM)
def sql_group_sum(spark, sf):
    table(spark, sf, "lineitem").createOrReplaceTempView("supplied_lines")
    return spark.sql(
        "SELECT l_suppkey AS supplier, sum(CAST(l_quantity AS BIGINT)) AS quantity "
        "FROM supplied_lines GROUP BY l_suppkey"
    )


@query("salted_sum", _SUPPLIER_SUM)
def salted_sum(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").alias("supplier"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        "l_orderkey",
    )
    return salted(lines, ["supplier"], "quantity", spread=["l_orderkey"], buckets=10)


@query(
    "retract_changelog",
    f"""WITH {EV}, sums AS (SELECT event_id, event_type, sum(cents) {_BY_TYPE} AS s FROM ev),
    steps AS (SELECT *, lag(s) {_BY_TYPE} AS old FROM sums)
    SELECT event_id, event_type, false AS is_insert, CAST(old AS BIGINT) AS cents FROM steps WHERE old IS NOT NULL
    UNION ALL SELECT event_id, event_type, true, CAST(s AS BIGINT) FROM steps""",
)
def retract_changelog(spark, sf):
    return ops.changelog(ev(spark, sf), ["event_type"], "event_id", "cents")


@query("append_stream", "SELECT event_id, event_type, true AS drawn_in_range FROM events")
def append_stream(spark, sf):
    """Insert-only rows with a random number 0 to 4; the number itself differs from run to run."""
    drawn = ev(spark, sf).select("event_id", "event_type", random_int(5).alias("drawn"))
    return drawn.select("event_id", "event_type", F.col("drawn").between(0, 4).alias("drawn_in_range"))
