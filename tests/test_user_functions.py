"""A user's combine in running aggregates and user aggregates in SQL text."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rillstone.functions import aggregates
from rillstone.functions.aggregates import AVERAGE, UserAggregate, aggregate_view, register_aggregate
from rillstone.operators.folding import rolling_combine
from tests.helpers import by_key


@pytest.mark.parametrize("block_rows", [2_000_000, 40, 7])
def test_combine_that_does_not_commute(skewed, block_rows):
    """Texts put behind one another, cut to their ends: the order shows."""
    df, rows = skewed

    def joined(a, b):
        return {"head": (a["head"] + b["head"])[:5], "tail": (a["tail"] + b["tail"])[-5:], "n": a["n"] + b["n"]}

    own = F.struct(F.col("tag").alias("head"), F.col("tag").alias("tail"), F.lit(1).cast("bigint").alias("n"))
    got = {r.seq: (r.all.head, r.all.tail, r.all.n) for r in rolling_combine(df, ["key"], "seq", own, joined, "all", block_rows).collect()}
    want = {}
    for group in by_key(rows).values():
        text = ""
        for seq, _, _, _, tag in sorted(group):
            text += tag
            want[seq] = (text[:5], text[-5:], len(text))
    assert got == want


@pytest.mark.parametrize("block_rows", [2_000_000, 30])
def test_combine_without_keys_and_with_nulls(spark, skewed, block_rows):
    df, rows = skewed
    value = F.when(F.col("v") % 3 != 0, F.col("v").cast("bigint"))
    got = {r.seq: r.m for r in rolling_combine(df, [], "seq", value, max, "m", block_rows).collect()}
    best, want = None, {}
    for seq, _, _, v, _ in sorted(rows):
        if v % 3:
            best = v if best is None else max(best, v)
        want[seq] = best
    assert got == want
    assert rolling_combine(df.where("false"), [], "seq", value, max, "m").collect() == []


def test_average_in_text(spark, skewed, monkeypatch):
    df, rows = skewed
    monkeypatch.setattr(aggregates, "HELD", 1)
    register_aggregate(spark, "my_avg", AVERAGE)
    aggregate_view(df.repartition(6), "v_rows", ["key", "tag"], {"v": AVERAGE})
    want = {key: sum(r[3] for r in group) / len(group) for key, group in by_key(rows).items()}
    got = {r.key: r.m for r in spark.sql("SELECT key, my_avg(v) m FROM v_rows GROUP BY key").collect()}
    assert got == pytest.approx(want)
    by_tag = spark.sql("SELECT tag, my_avg(v) AS m FROM v_rows WHERE key = 'hot' GROUP BY tag HAVING my_avg(v) > 0").collect()
    assert {r.tag: r.m for r in by_tag} == pytest.approx(
        {t: sum(v) / len(v) for t in "xyz" if (v := [r[3] for r in rows if r[4] == t and r[1] == "hot"])}
    )
    assert spark.sql("SELECT my_avg(v) AS m FROM v_rows").first().m == pytest.approx(sum(r[3] for r in rows) / len(rows))


def test_states_are_few(spark):
    """However many rows a group has, what meets for it in one task is a state per task."""
    view = aggregate_view(spark.range(0, 50_000, 1, 8).selectExpr("'one' AS k", "id AS v"), "v_big", ["k"], {"v": AVERAGE})
    assert view.count() == 8
    register_aggregate(spark, "my_avg", AVERAGE)
    assert spark.sql("SELECT my_avg(v) AS m FROM v_big GROUP BY k").first().m == 24999.5


def test_nulls_and_none(spark):
    rows = spark.createDataFrame([("a", None), ("b", 1), ("b", None), (None, 5)], "k string, v int")
    register_aggregate(spark, "my_avg", AVERAGE)
    aggregate_view(rows, "v_few", ["k"], {"v": AVERAGE})
    assert {r.k: r.m for r in spark.sql("SELECT k, my_avg(v) AS m FROM v_few GROUP BY k").collect()} == {"a": None, "b": 1.0, None: 5.0}
    aggregate_view(rows.where("false"), "v_few", ["k"], {"v": AVERAGE})
    assert spark.sql("SELECT k, my_avg(v) AS m FROM v_few GROUP BY k").collect() == []


def test_own_aggregate(spark, skewed):
    """Another state and two values in one view: the longest value and the mean."""
    df, rows = skewed
    longest = UserAggregate(
        "word string", "string", lambda: {"word": ""},
        lambda s, values: {"word": max([s["word"], *(v for v in values.to_pylist() if v)], key=lambda w: (len(w), w))},
        lambda a, b: max(a, b, key=lambda s: (len(s["word"]), s["word"])),
        lambda s: s["word"],
    )
    named = df.withColumn("word", F.concat_ws("-", "tag", "v"))
    register_aggregate(spark, "longest", longest)
    register_aggregate(spark, "my_avg", AVERAGE)
    aggregate_view(named, "v_words", ["key"], {"word": longest, "v": AVERAGE})
    got = {r.key: (r.w, r.m) for r in spark.sql("SELECT key, longest(word) AS w, my_avg(v) AS m FROM v_words GROUP BY key").collect()}
    for key, group in by_key(rows).items():
        words = [f"{r[4]}-{r[3]}" for r in group]
        assert got[key] == (max(words, key=lambda w: (len(w), w)), pytest.approx(sum(r[3] for r in group) / len(group)))
