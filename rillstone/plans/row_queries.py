"""Projections, filters, parsing, routing, unions, iteration."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from rillstone.operators import rows
from rillstone.plans.registry import CHECKS, query
from rillstone.plans.tables import EV, LINES, WORDS, doc_lines, doc_words, ev, table


# the upper case of the sharp s is two letters, as Java and Spark have it
@query("map_upper", f"WITH {LINES} SELECT doc_id, upper(replace(line, 'ß', 'ss')) AS line FROM lines")
def map_upper(spark, sf):
    return rows.upper_case(doc_lines(spark, sf), "line")


@query("map_pair", f"WITH {WORDS} SELECT word, 1 AS one FROM words")
def map_pair(spark, sf):
    return rows.with_one(doc_words(spark, sf), "word")


@query(
    "parse_delimited",
    "SELECT l_orderkey AS order_no, l_linenumber AS line_no, l_quantity AS quantity, "
    "l_returnflag AS flag FROM lineitem",
)
def parse_delimited(spark, sf):
    text = table(spark, sf, "lineitem").select(
        F.concat_ws(",", "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag").alias("csv")
    )
    schema = T.StructType.fromDDL("order_no BIGINT, line_no INT, quantity DOUBLE, flag STRING")
    return rows.parse_delimited(text, "csv", schema)


@query("filter_prefix", f"WITH {WORDS} SELECT doc_id, word FROM words WHERE starts_with(word, 'h')")
def filter_prefix(spark, sf):
    return rows.starting_with(doc_words(spark, sf), "word", "h")


@query(
    "filter_drop_prefix",
    "SELECT event_id, event_type FROM events WHERE NOT starts_with(event_type, 'error')",
)
def filter_drop_prefix(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    return rows.not_starting_with(events, "event_type", "error")


@query("flatmap_split", f"WITH {WORDS} SELECT doc_id, word FROM words")
def flatmap_split(spark, sf):
    return doc_words(spark, sf)


@query("project_cols", "SELECT l_suppkey, l_orderkey FROM lineitem")
def project_cols(spark, sf):
    return rows.project(table(spark, sf, "lineitem"), 2, 0)


#: the events' JSON with the braces of every eleventh value's text lost, as a broken sender would
_BROKEN = "CASE WHEN event_id % 11 = 0 THEN substr(props, 2) ELSE props END"
_PROPS = T.StructType([T.StructField("k", T.IntegerType())])


def with_broken(events):
    return events.select("event_id", F.expr(_BROKEN).alias("j"))


@query(
    "parse_json_drop_bad",
    f"SELECT event_id, CAST(json_extract(j, '$.k') AS INTEGER) AS k FROM "
    f"(SELECT event_id, {_BROKEN} AS j FROM events) WHERE json_valid(j)",
)
def parse_json_drop_bad(spark, sf):
    return rows.parse_json(with_broken(table(spark, sf, "events")), "j", _PROPS)[0]


@query(
    "parse_json_bad_rows",
    f"SELECT event_id, j FROM (SELECT event_id, {_BROKEN} AS j FROM events) WHERE NOT json_valid(j)",
)
def parse_json_bad_rows(spark, sf):
    return rows.parse_json(with_broken(table(spark, sf, "events")), "j", _PROPS)[1]


#: numbers and words mixed: the item id, or for errors the event's name
_MIXED = "CASE WHEN event_type = 'error' THEN event_type ELSE CAST(k AS VARCHAR) END"


@query(
    "side_output_route",
    f"""WITH {EV}, mixed AS (SELECT event_id, {_MIXED} AS v FROM ev),
    tagged AS (SELECT event_id, v, CASE WHEN TRY_CAST(v AS INTEGER) IS NULL THEN 'text'
        WHEN TRY_CAST(v AS INTEGER) % 2 = 0 THEN 'even' ELSE 'odd' END AS tag FROM mixed)
    SELECT 'main' AS output, event_id, v FROM tagged
    UNION ALL SELECT tag AS output, event_id, v FROM tagged""",
)
def side_output_route(spark, sf):
    return mixed_outputs(ev(spark, sf))


def mixed_outputs(events):
    mixed = events.select("event_id", F.expr(_MIXED.replace("VARCHAR", "STRING")).alias("v"))
    number = F.col("v").try_cast("int")
    rules = {"text": number.isNull(), "even": number % 2 == 0, "odd": number % 2 != 0}
    return rows.routed(mixed, rules)


@query(
    "quarantine_bad",
    "SELECT event_id, event_type, contains(event_type, 'error') AS is_bad FROM events",
)
def quarantine_bad(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    good, bad = rows.quarantine(events, F.contains(F.col("event_type"), F.lit("error")))
    return good.withColumn("is_bad", F.lit(False)).unionByName(bad.withColumn("is_bad", F.lit(True)))


_PARTIES = """SELECT 'customer-' || c_custkey AS party, c_nationkey AS nation FROM customer
    UNION ALL SELECT upper(s_name) AS party, s_nationkey AS nation FROM supplier"""


@query("co_map", _PARTIES)
def co_map(spark, sf):
    return rows.co_map(
        table(spark, sf, "customer"),
        table(spark, sf, "supplier"),
        lambda c: c.select(
            F.concat(F.lit("customer-"), F.col("c_custkey").cast("string")).alias("party"),
            F.col("c_nationkey").alias("nation"),
        ),
        lambda s: s.select(F.upper("s_name").alias("party"), F.col("s_nationkey").alias("nation")),
    )


@query(
    "union_all",
    "SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer "
    "UNION ALL SELECT s_nationkey, s_acctbal FROM supplier",
)
def union_all(spark, sf):
    return rows.union_all(
        table(spark, sf, "customer").select(
            F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")
        ),
        table(spark, sf, "supplier").select(
            F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance")
        ),
    )


@query(
    "iterate_until",
    """WITH RECURSIVE turns AS (
      SELECT p_partkey, p_size - 3 AS v FROM part
      UNION ALL SELECT p_partkey, v - 3 FROM turns WHERE v > 0)
    SELECT p_partkey, v FROM turns WHERE v <= 0""",
)
def iterate_until(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_size").alias("v"))
    return rows.iterate(parts, "v", lambda v: v - 3, lambda v: v > 0)


@query("iterate_recursive", CHECKS["iterate_until"])
def iterate_recursive(spark, sf):
    """The same by a recursive query: sizes up to 50 take few steps."""
    parts = table(spark, sf, "part").select("p_partkey", F.col("p_size").alias("v"))
    return rows.iterate_recursive(parts, "p_partkey", "v", "v - 3", "v > 0")
