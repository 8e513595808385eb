"""Suffix, line and n-gram deduplication against plain loops."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rillstone.llm import graph, jaccard, line_dedup, suffix_dedup
from rillstone.llm.common import row_key
from tests.llm import plain


def distinct(rows):
    """One (id, text) per document; the NULL id first, as the operators order it."""
    return plain.in_order({(d, t) for d, t, *_ in rows})


def pieces(seed, n):
    pick = random.Random(seed)

    def some(n):
        return "".join(pick.choice("abcd hé") for _ in range(n))

    shared, out = [some(pick.choice([80, 99, 100, 101, 150, 300])) for _ in range(15)], []
    for i in range(n):
        text = "".join(pick.choice([some(pick.randrange(90)), pick.choice(shared), shared[0]]) for _ in range(pick.randrange(7)))
        text = pick.choice(out)[1] if out and pick.random() < 0.2 else "ab" * pick.randrange(200) if pick.random() < 0.1 else text
        out.append((i, text))
    return out


@pytest.mark.parametrize(("crowd", "bucket", "piece"), [(2000, 4 << 20, 1 << 20), (3, 2000, 333)])
def test_suffix_dedup(spark, docs, monkeypatch, crowd, bucket, piece):
    for name, value in (("CROWD", crowd), ("BUCKET", bucket), ("PIECE", piece)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rows = pieces(crowd, 150) + [(901, None), (902, ""), (None, "z" * 250)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    got = {(r.doc, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == set(plain.suffix_dedup(rows))


def test_suffix_dedup_of_messy_rows(docs):
    df, rows = docs
    got = suffix_dedup.remove_repeats(df).collect()
    assert len(got) == len(rows)
    assert {(r.doc, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got} == set(plain.suffix_dedup(distinct(rows)))


def test_merged_transforms_need_no_spark():
    contents = [t.encode() for _, t in pieces(4, 40) if len(t) >= 20]
    long = 20
    seen, want = set(), set()
    for i, c in enumerate(contents):
        for a in range(len(c) - long + 1):
            if c[a : a + long] in seen:
                want.add((i, a))
            seen.add(c[a : a + long])
    import numpy as np

    docs, byte = suffix_dedup.later_windows(contents, np.arange(len(contents)), np.zeros(len(contents), int), long, shard_bytes=500)
    assert set(zip(docs.tolist(), byte.tolist(), strict=True)) == want


def test_line_dedup(spark, docs):
    pick = random.Random(3)

    def line():
        return " ".join(pick.choice(["a", "bb", "ccc"]) for _ in range(pick.choice([0, 1, 2, 3, 7])))

    shared = ["\n".join(line() for _ in range(pick.choice([1, 2, 3, 6]))) for _ in range(20)]
    rows = [(i, "\n".join(pick.choice([line(), pick.choice(shared), shared[0]]) for _ in range(pick.randrange(7)))) for i in range(150)]
    rows += [(901, None), (902, ""), (None, "a a a a a a a a\nb"), (903, rows[5][1])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {(r.doc_id, r.n, r.text or "") for r in line_dedup.drop_repeated_lines(df, least=8, count="n").collect()}
    assert got == set(plain.line_dedup(rows, 8))


def test_line_dedup_short_boilerplate(spark):
    """A short line that many otherwise different documents have stays once, by the operator's own bound."""
    pick = random.Random(11)

    def own():
        return " ".join(f"w{pick.randrange(10**6)}" for _ in range(pick.choice([2, 9, 40])))

    common, few = "All rights reserved by the owners of this page.", "Read more"
    menu = "Home page\nAbout us\nOur contact"
    rows = [(i, "\n".join([own(), common, own(), few, own(), menu, own()])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = {(r.doc_id, r.n, r.text) for r in line_dedup.drop_repeated_lines(df, count="n").collect()}
    assert got == set(plain.line_dedup(rows, 5))
    assert sum(common in text for _, _, text in got) == sum(menu in text for _, _, text in got) == 1
    assert all(few in text for _, _, text in got)


def test_line_dedup_keeps_columns(docs):
    df, rows = docs
    done = line_dedup.drop_repeated_lines(df, least=12)
    assert done.columns == df.columns
    got = done.collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.text or "") for r in got} == {(d, t) for d, _, t in plain.line_dedup(distinct(rows), 12)}
    left = line_dedup.drop_repeated_lines(df, least=12, emptied=False).collect()
    assert all(r.text is None or r.text.split() or r.doc_id % 1000 >= 0 for r in left) and len(left) < len(got)


def test_jaccard_components(spark):
    pick = random.Random(5)
    words, rows = [f"w{i}" for i in range(900)], []
    for _ in range(25):
        n = pick.choice([3, 4, 5, 8, 10, 12, 20, 40, 80, 150, 400])
        base = [pick.choice(words) for _ in range(n)]
        for _ in range(pick.choice([1, 3, 12])):
            text = list(base)
            for _ in range(pick.randrange(1 + max(1, n // 25))):
                text[pick.randrange(len(text))] = pick.choice(words)
            rows.append(" ".join(text))
    common = " ".join(pick.choice(words) for _ in range(60))
    rows += [" ".join(pick.choice(words) for _ in range(pick.choice([10, 30]))) + " " + common for _ in range(60)]
    rows += ["", None, "a", "A", "a b", "a b c d", "a b c d e"]
    pick.shuffle(rows)
    docs = list(enumerate(rows))
    got = {r.doc: (r.n, r.component) for r in jaccard.join_components(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == dict(enumerate(plain.components(docs)))


def test_jaccard_crowded_block(spark, monkeypatch):
    """Texts of which very many share a phrase: the same components, and no task with all the copies of a block."""
    monkeypatch.setattr(jaccard, "CROWD", 40)
    monkeypatch.setattr(jaccard, "PIECE", 8)
    monkeypatch.setattr(jaccard, "TOGETHER", 100)
    seen, real = [], jaccard.dealt_out
    monkeypatch.setattr(jaccard, "dealt_out", lambda members: seen.append((members, real(members))) or seen[-1][1])
    pick = random.Random(23)
    words, rows = [f"w{i}" for i in range(5000)], []
    phrase = " ".join(pick.choice(words) for _ in range(12))
    for _ in range(160):
        own = [pick.choice(words) for _ in range(30)]
        rows.append(" ".join(own) + " " + phrase)
        if pick.random() < 0.3:  # near copies, some within reach and some not
            rows.append(" ".join([*own[: pick.choice([27, 29])], "x", phrase]))
    pick.shuffle(rows)
    docs = list(enumerate(rows))
    got = {r.doc: (r.n, r.component) for r in jaccard.join_components(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == dict(enumerate(plain.components(docs)))
    ((members, dealt),) = seen
    assert dealt.count() < 10 * len(rows)  # a member is not copied to every piece of the phrase's blocks

    # one block that nothing makes smaller: 1,000 members, 125 pieces
    block = spark.range(1000).selectExpr("0L AS block", "id AS sig", "id AS comp")
    sizes = [r["count"] for r in real(block).groupBy("group").count().collect()]
    assert sum(sizes) == 125 * 1000 and max(sizes) < 5 * 100


def test_jaccard_takes_sets_of_pairs_that_sketches_pass(spark, monkeypatch):
    """Texts that only share a passage meet in blocks, but their sets are not written."""
    wanted, real = [], jaccard.sets_of
    monkeypatch.setattr(jaccard, "sets_of", lambda docs, which, size: wanted.append(which.count()) or real(docs, which, size))
    pick = random.Random(31)
    words = [f"w{i}" for i in range(5000)]
    passage = " ".join(pick.choice(words) for _ in range(120))
    rows = [" ".join([*[pick.choice(words) for _ in range(60)], passage]) for _ in range(80)]
    rows.append(rows[3] + " x")
    docs = list(enumerate(rows))
    got = {r.doc: (r.n, r.component) for r in jaccard.join_components(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert got == dict(enumerate(plain.components(docs))) and got[80][1] == 3
    assert 2 <= sum(wanted) < 10


def rows_shuffled(plan):
    """Rows written by the exchanges of an executed plan without adaptive execution."""
    below = plan.children()
    own = plan.metrics().apply("shuffleRecordsWritten").value() if plan.nodeName() == "Exchange" else 0
    return own + sum(rows_shuffled(below.apply(i)) for i in range(below.size()))


def test_jaccard_leaves_unwanted_texts_in_place(spark):
    """Where the list of wanted documents is too long to go to every text, the other texts are not moved either."""
    docs = spark.range(5000).selectExpr("nullif(id, 7) AS doc", "concat('a b c d ', id) AS text").select("doc", row_key("doc", "text").alias("key"), "text")
    wanted = docs.where("doc IS NULL OR doc % 100 = 0").select("doc", "key", F.coalesce("doc", F.lit(7)).alias("sig"))
    before = {name: spark.conf.get(name) for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        found = jaccard.sets_of(docs, wanted, 4)
        got = found.collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    memo = jaccard.WordHashes()
    assert {r.sig: r.hashes for r in got} == {i: jaccard.shingles(f"a b c d {i}", 4, memo).view("int64").tolist() for i in [7, *range(0, 5000, 100)]}
    assert len(got) == 51
    assert 102 <= rows_shuffled(found._jdf.queryExecution().executedPlan()) < 102 + 250  # the list, its texts and few others


def test_jaccard_keeps_one(spark, docs):
    df, rows = docs
    each = distinct(rows)
    found = plain.components(each, 5, 80)
    # of each component the smallest id, a NULL one only if alone
    groups = {}
    for (doc, text), (n, root) in zip(each, found, strict=True):
        groups.setdefault((root, n == 0), []).append((doc is None, doc or 0, text))
    stays = {(None if least[0] else least[1], least[2]) for least in (min(g, key=lambda x: x[:2]) for g in groups.values())}
    kept = jaccard.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(((d, t) for d, t, _ in rows if (d, t) in stays), key=repr)


def test_parity_bounds():
    """Blocks and sketches differ at most as the sets do, and similar sets share a block."""
    import numpy as np

    pick, bands = np.random.default_rng(2), jaccard.Bands(85, 100)
    for _ in range(300):
        size = int(pick.integers(7, 400))
        a = np.unique(pick.integers(0, 1 << 63, size).astype(np.uint64))
        b = a.copy()
        for _ in range(int(pick.integers(0, max(2, len(a) // 10)))):
            b = np.delete(b, pick.integers(len(b))) if pick.random() < 0.5 else np.append(b, np.uint64(pick.integers(1 << 62)))
        b = np.unique(b)
        shared = len(np.intersect1d(a, b))
        if 100 * shared >= 85 * (len(a) + len(b) - shared) and not np.array_equal(a, b):
            assert np.intersect1d(jaccard.block_keys(a, bands), jaccard.block_keys(b, bands)).size
            assert jaccard.sketches_allow(len(a), jaccard.bit_sketch(a), len(b), jaccard.bit_sketch(b), 85, 100)


def test_graph_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 200), (200, 300)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, **{i: 100 for i in range(100, 160)}, 300: 200, 200: 200}


def test_empty_tables(empty):
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert line_dedup.drop_repeated_lines(empty).count() == 0
    assert jaccard.join_components(empty).count() == 0


def test_row_key_tells_texts_apart(docs):
    df, rows = docs
    assert df.select(row_key("doc_id", "text")).distinct().count() == len(distinct(rows))


def test_a_block_compared_as_it_is_moves_each_member_twice_at_most(spark):
    members = spark.range(jaccard.CROWD).select(F.lit(7).cast("bigint").alias("block"), F.col("id").alias("sig"), F.col("id").alias("comp"))
    dealt = jaccard.dealt_out(members)
    assert dealt.count() <= 2 * jaccard.CROWD
    met = dealt.groupBy("group", "low", "high").agg(F.collect_set("sig").alias("s")).collect()
    assert len({(a, b) for r in met for a in r.s for b in r.s if a < b}) == jaccard.CROWD * (jaccard.CROWD - 1) // 2
