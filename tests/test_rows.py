"""Row functions, placement, SQL functions and scripts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F, types as T

from rillstone.functions import script
from rillstone.functions.sql import random_int, register_functions, register_split_udtf
from rillstone.functions.text import concat_with, ip_number, number_ip
from rillstone.operators import placement, rows
from rillstone.sources import generated, jdbc, kafka


def column(df, name):
    return [r[name] for r in df.collect()]


def test_split_words(spark):
    df = spark.createDataFrame([(0, "a  b "), (1, " c"), (2, "   "), (3, ""), (4, None)], "i int, line string")
    out = rows.split_words(df, "line")
    found = {}
    for r in out.collect():
        found.setdefault(r["i"], []).append(r["word"])
    assert found == {0: ["a", "", "b"], 1: ["", "c"], 3: [""]}


def test_parse_delimited_strict_and_lenient(spark):
    schema = T.StructType.fromDDL("a BIGINT, b STRING, c DOUBLE")
    df = spark.createDataFrame([("1,x,2.5",), ("u1,y",)], "csv string")
    lenient = rows.parse_delimited(df, "csv", schema, strict=False)
    assert [tuple(r) for r in lenient.collect()] == [(1, "x", 2.5), (None, "y", None)]
    with pytest.raises(Exception, match="bad a: u1"):
        rows.parse_delimited(df, "csv", schema).collect()
    piped = spark.createDataFrame([("1|x|2.5",)], "csv string")
    assert [tuple(r) for r in rows.parse_delimited(piped, "csv", schema, sep="|").collect()] == [(1, "x", 2.5)]


def test_json_good_and_bad(spark):
    df = spark.createDataFrame([(1, '{"name":"n","age":3}'), (2, "{oops"), (3, None)], "i int, j string")
    good, bad = rows.parse_json(df, "j", T.StructType.fromDDL("name STRING, age INT"))
    assert [tuple(r) for r in good.collect()] == [(1, "n", 3)]
    assert column(bad, "i") == [2, 3]


def test_route(spark):
    df = spark.createDataFrame([("1",), ("2",), ("abc",)], "v string")
    n = F.col("v").try_cast("int")
    rules = {"text": n.isNull(), "odd": n % 2 == 1, "even": n % 2 == 0}
    out = rows.route(df, rules)
    one_pass = sorted(map(tuple, rows.routed(df, rules).collect()))
    assert one_pass == sorted((k, v) for k, d in out.items() for v in column(d, "v"))
    assert {k: column(d, "v") for k, d in out.items()} == {
        "main": ["1", "2", "abc"], "text": ["abc"], "odd": ["1"], "even": ["2"],
    }


def test_quarantine(spark):
    df = spark.createDataFrame([("fine",), ("an error",), (None,)], "v string")
    good, bad = rows.quarantine(df, F.col("v").contains("error"))
    assert column(good, "v") == ["fine", None] and column(bad, "v") == ["an error"]
    with pytest.raises(Exception, match="bad record"):
        rows.quarantine(df, F.col("v").contains("error"), strict=True)[0].collect()


@pytest.mark.parametrize("steps", [1, 3, 64])
def test_iterate_takes_any_number_of_steps(spark, steps):
    df = spark.createDataFrame([(0, 10), (1, 4), (2, -5)], "i int, v bigint")
    out = rows.iterate(df, "v", lambda v: v - 3, lambda v: v > 0, steps_per_pass=steps)
    assert sorted(map(tuple, out.collect())) == [(0, -2), (1, -2), (2, -8)]


def test_small_row_functions(spark):
    df = spark.createDataFrame([("hello", 1), ("error x", 2)], "w string, n int")
    assert column(rows.upper_case(df, "w"), "w") == ["HELLO", "ERROR X"]
    assert rows.with_one(df, "w").columns == ["w", "one"]
    assert column(rows.starting_with(df, "w", "h"), "w") == ["hello"]
    assert column(rows.not_starting_with(df, "w", "error"), "w") == ["hello"]
    assert rows.project(df, 1, 0).columns == ["n", "w"]
    assert rows.union_all(df, df).count() == 4


def test_addresses(spark):
    df = spark.createDataFrame([("0.0.1.2",), ("255.255.255.255",), ("bad",)], "ip string")
    numbers = df.select("ip", ip_number(F.col("ip")).alias("n"))
    assert column(numbers, "n") == [258, 2**32 - 1, None]
    assert column(numbers.where("n IS NOT NULL").select(number_ip(F.col("n")).alias("b")), "b") == ["0.0.1.2", "255.255.255.255"]


def test_concat(spark):
    df = spark.createDataFrame([("a", "b", 1.0), ("a", None, None), ("c", "d", 2.0)], "a string, b string, x double")
    assert column(df.select(concat_with("-", F.col("a"), F.col("b")).alias("c")), "c") == ["a-b", None, "c-d"]
    drawn = column(spark.range(200).select(random_int(5).alias("r")), "r")
    assert set(drawn) <= {0, 1, 2, 3, 4}


def test_sql_functions(spark):
    register_functions(spark)
    assert spark.sql("SELECT my_concat_ws('-', 'a', 'b') c, ip_number('0.0.1.2') n").first().asDict() == {"c": "a-b", "n": 258}
    assert spark.sql("SELECT rand_int(3) r").first()["r"] in (0, 1, 2)
    register_split_udtf(spark)
    for name in ("split_words", "py_split_words"):
        words = spark.sql(f"SELECT word FROM VALUES ('a|b'), ('c') AS t(line), LATERAL {name}(line, '|')")
        assert sorted(column(words, "word")) == ["a", "b", "c"]


def test_python_table_function_takes_lines_in_batches(spark):
    """The words of odd lines, by a plan that has one Python call for many lines."""
    register_functions(spark)
    register_split_udtf(spark)
    lines = ["a b", "a  b ", " c", "   ", "", None, "x" * 100_000 + " y", " "]
    spark.createDataFrame(list(enumerate(lines)) + [(100 + i, f"{i} w") for i in range(12_000)], "id bigint, line string").createOrReplaceTempView("odd_lines")
    got = {}
    for name in ("split_words", "py_split_words"):
        words = spark.sql(f"SELECT id, word FROM odd_lines, LATERAL {name}(line, ' ')")
        got[name] = sorted((r.id, r.word) for r in words.collect())
    assert got["py_split_words"] == got["split_words"] and len(got["split_words"]) == 24_010
    assert "PythonUDTF" not in words._jdf.queryExecution().executedPlan().toString()


def test_script(spark):
    text = "-- one; two\nSELECT 'a;b' AS x; ; /* ; */ SELECT \"c;d\" AS y;\n"
    assert script.statements(text) == ["SELECT 'a;b' AS x", 'SELECT "c;d" AS y']
    kept = []
    script.run_script(
        spark,
        "CREATE OR REPLACE TEMP VIEW nums AS SELECT id FROM range(4); INSERT INTO sink SELECT id FROM nums WHERE id > 1",
        {"sink": lambda df: kept.extend(column(df, "id"))},
    )
    assert sorted(kept) == [2, 3]


def test_views(spark):
    named = script.register(spark.range(2).selectExpr("id", "id + 1"), "v", ["a", "b"])
    assert named.columns == ["a", "b"]
    assert column(script.describe(spark, "v"), "col_name") == ["a", "b"]
    shaped = script.with_schema(named, {"c": "a * 2", "d": F.current_timestamp()})
    assert shaped.dtypes == [("c", "bigint"), ("d", "timestamp")]


def test_placement(spark):
    df = spark.range(40).repartition(3)
    where = lambda d: d.select("*", F.spark_partition_id().alias("p"))
    even = [r["count"] for r in where(placement.round_robin(df, 4)).groupBy("p").count().collect()]
    assert len(even) == 4 and max(even) - min(even) <= 3
    assert placement.random_spread(df, 5).rdd.getNumPartitions() == 5
    keyed = where(placement.by_key(df.withColumn("k", F.col("id") % 5), 4, "k"))
    assert keyed.select("k", "p").distinct().count() == 5
    ruled = where(placement.by_rule(df, F.col("id") % 3, 3))
    assert ruled.where(F.col("p") != F.col("id") % 3).count() == 0
    copies = where(placement.replicate(df, 3))
    assert copies.count() == 120 and copies.where("p <> copy_no").count() == 0
    assert placement.fewer(df, 2).rdd.getNumPartitions() == 2


def test_bounded_sources(spark):
    out = generated.from_rows(spark, [(1,), (2,)], "n int").select((F.col("n") * 10).alias("n"))
    assert column(out, "n") == [10, 20]
    numbers = generated.sequence(spark, 1, 10, 3)
    assert column(numbers, "n") == list(range(1, 11)) and numbers.rdd.getNumPartitions() == 3


def test_kafka_reader_options():
    assert kafka.kafka_options("h:9092", ["a", "b"], "earliest", group_prefix="g", max_offsets=5) == {
        "kafka.bootstrap.servers": "h:9092", "subscribe": "a,b", "startingOffsets": "earliest",
        "failOnDataLoss": "true", "groupIdPrefix": "g", "maxOffsetsPerTrigger": "5",
    }


def test_jdbc_reader_options():
    assert jdbc.jdbc_options("jdbc:x", "t", "id", 1, 9, readers=2, user="u") == {
        "url": "jdbc:x", "dbtable": "t", "fetchsize": "10000", "user": "u", "partitionColumn": "id",
        "lowerBound": "1", "upperBound": "9", "numPartitions": "2",
    }
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x", "t", "id")


def test_lenient_csv(spark):
    schema = T.StructType.fromDDL("user_id BIGINT, item_id BIGINT, behavior STRING")
    df = spark.createDataFrame([("u01,5,view",), ("7,6,pay",), ("8",)], "value string")
    out = kafka.parse_csv_lenient(df, schema, ts=None)
    assert [tuple(r) for r in out.collect()] == [(None, 5, "view"), (7, 6, "pay"), (8, None, None)]
