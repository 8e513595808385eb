"""Explicit data placement. The rows stay the same; where it can be told, so is the partition."""

from __future__ import annotations

from pyspark.sql import functions as F

from rillstone.operators import placement as ops
from rillstone.plans.registry import query
from rillstone.plans.tables import table

_ROWS = "SELECT event_id, event_type, user_id FROM events"


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "event_type", "user_id")


@query("part_round_robin", _ROWS)
def part_round_robin(spark, sf):
    return ops.round_robin(_events(spark, sf), 8)


@query("part_random", _ROWS)
def part_random(spark, sf):
    return ops.random_spread(_events(spark, sf), 8)


@query(
    "part_hash",
    "SELECT user_id, CAST(1 AS BIGINT) AS partitions_used, count(*) AS n FROM events GROUP BY user_id",
)
def part_hash(spark, sf):
    """Same key, same partition."""
    placed = ops.by_key(_events(spark, sf), 8, "user_id").withColumn("p", F.spark_partition_id())
    per_task = placed.groupBy("user_id", "p").agg(F.count(F.lit(1)).alias("n"))
    return per_task.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("partitions_used"), F.sum("n").alias("n")
    )


@query(
    "part_custom",
    """SELECT event_id, event_type, CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2
    WHEN 'purchase' THEN 3 ELSE 0 END AS partition_no FROM events""",
)
def part_custom(spark, sf):
    kind = F.col("event_type")
    rule = F.when(kind == "view", 1).when(kind == "click", 2).when(kind == "purchase", 3).otherwise(0)
    placed = ops.by_rule(_events(spark, sf).select("event_id", "event_type"), rule, 4)
    return placed.withColumn("partition_no", F.spark_partition_id())


@query(
    "part_broadcast",
    "SELECT event_id, event_type, CAST(i AS INTEGER) AS copy_no, CAST(i AS INTEGER) AS partition_no "
    "FROM events, range(4) AS r(i)",
)
def part_broadcast(spark, sf):
    copies = ops.replicate(_events(spark, sf).select("event_id", "event_type"), 4)
    return copies.withColumn("partition_no", F.spark_partition_id())


@query("part_coalesce", _ROWS)
def part_coalesce(spark, sf):
    return ops.fewer(_events(spark, sf), 2)


def _sizes(placed):
    """How many partitions have rows, how many rows there are, and the shares of the smallest and largest in percent of
    an even one."""
    sizes = placed.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"))
    even = F.sum("n") / F.count(F.lit(1))
    return sizes.agg(
        F.count(F.lit(1)).alias("partitions"), F.sum("n").alias("n"), (100 * F.min("n") / even).alias("least"), (100 * F.max("n") / even).alias("most")
    )


def _even(placed, percent):
    return _sizes(placed).select("partitions", "n", ((F.col("least") >= 100 - percent) & (F.col("most") <= 100 + percent)).alias("even"))


@query("part_round_robin_sizes", "SELECT CAST(8 AS BIGINT) AS partitions, count(*) AS n, true AS even FROM events")
def part_round_robin_sizes(spark, sf):
    """Rows dealt out in turn: all partitions within 5 % of an even share."""
    return _even(ops.round_robin(_events(spark, sf), 8), 5)


@query("part_random_sizes", "SELECT CAST(8 AS BIGINT) AS partitions, count(*) AS n, true AS even FROM events")
def part_random_sizes(spark, sf):
    """Rows spread by chance: within 40 % of an even share, also where few rows are spread."""
    return _even(ops.random_spread(_events(spark, sf), 8), 40)


@query("part_coalesce_sizes", "SELECT CAST(2 AS BIGINT) AS partitions, count(*) AS n, true AS even FROM events")
def part_coalesce_sizes(spark, sf):
    """Eight even partitions merged to two without a shuffle: even still."""
    return _even(ops.fewer(ops.round_robin(_events(spark, sf), 8), 2), 5)
