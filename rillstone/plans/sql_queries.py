"""SQL text, views, scripts and SQL functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.functions.script import register, run_script, with_schema
from rillstone.functions.sql import register_functions, register_split_udtf
from rillstone.functions.text import concat_with
from rillstone.plans.registry import query
from rillstone.plans.tables import WORDS, doc_lines, table
from rillstone.session import fresh_path
from rillstone.sinks.external import insert_select


@query("view_schema", "SELECT event_type AS word, user_id AS counts FROM events")
def view_schema(spark, sf):
    """A view with column names given by position."""
    register(table(spark, sf, "events").select("event_type", "user_id"), "named_view", ["word", "counts"])
    return spark.sql("SELECT word, counts FROM named_view")


@query(
    "computed_columns",
    """SELECT upper(event_type) AS name, CAST(user_id AS BIGINT) AS amount, ts AS row_time, true AS has_read_time
    FROM events""",
)
def computed_columns(spark, sf):
    shaped = with_schema(
        table(spark, sf, "events"),
        {
            "name": "upper(event_type)",
            "amount": "CAST(user_id AS BIGINT)",
            "row_time": "ts",
            "read_time": F.current_timestamp(),
        },
    )
    return shaped.select("name", "amount", "row_time", F.col("read_time").isNotNull().alias("has_read_time"))


_FILTERED = """SELECT user_id, event_id, event_type AS behavior FROM events
    WHERE user_id IS NOT NULL AND event_type <> 'purchase'"""


@query("sql_filter", _FILTERED)
def sql_filter(spark, sf):
    register(table(spark, sf, "events"), "behaviors")
    return spark.sql(
        "SELECT user_id, event_id, event_type AS behavior FROM behaviors "
        "WHERE user_id IS NOT NULL AND event_type <> 'purchase'"
    )


@query("sql_insert_select", _FILTERED)
def sql_insert_select(spark, sf):
    register(table(spark, sf, "events"), "behaviors")
    out = fresh_path(spark, "inserted")
    insert_select(
        spark,
        "SELECT user_id, event_id, event_type AS behavior FROM behaviors "
        "WHERE user_id IS NOT NULL AND event_type <> 'purchase'",
        lambda df: df.write.parquet(out),
    )
    return spark.read.parquet(out)


@query("sql_script", _FILTERED.replace("SELECT", "SELECT 'a;b' AS mark,", 1))
def sql_script(spark, sf):
    out = fresh_path(spark, "scripted")
    run_script(
        spark,
        f"""
        -- the source; a semicolon in a comment; or in quotes is no end
        CREATE OR REPLACE TEMPORARY VIEW script_events USING parquet OPTIONS (path '{sf}/events.parquet');
        ;
        INSERT INTO kept SELECT 'a;b' AS mark, user_id, event_id, event_type AS behavior FROM script_events
        WHERE user_id IS NOT NULL AND event_type <> 'purchase'
        """,
        {"kept": lambda df: df.write.parquet(out)},
    )
    return spark.read.parquet(out)


@query(
    "udf_concat_ws",
    "SELECT c_custkey, c_mktsegment || '-' || c_name AS label, c_mktsegment || '-' || c_name AS sql_label FROM customer",
)
def udf_concat_ws(spark, sf):
    register_functions(spark)
    both = table(spark, sf, "customer").select(
        "c_custkey",
        "c_mktsegment",
        "c_name",
        concat_with("-", F.col("c_mktsegment"), F.col("c_name")).alias("label"),
    )
    register(both, "labelled")
    return spark.sql("SELECT c_custkey, label, my_concat_ws('-', c_mktsegment, c_name) AS sql_label FROM labelled")


_SPLIT = f"WITH {WORDS} SELECT doc_id, word FROM words"


@query("udtf_split", _SPLIT)
def udtf_split(spark, sf):
    register_functions(spark)
    register(doc_lines(spark, sf), "text_lines")
    return spark.sql("SELECT doc_id, word FROM text_lines, LATERAL split_words(line, ' ')")


@query("udtf_split_python", _SPLIT)
def udtf_split_python(spark, sf):
    register_split_udtf(spark)
    register(doc_lines(spark, sf), "text_lines")
    return spark.sql("SELECT doc_id, word FROM text_lines, LATERAL py_split_words(line, ' ')")
