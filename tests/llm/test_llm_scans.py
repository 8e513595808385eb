"""Secret scan, quality rules, license scan, decontamination and chat formatting against plain loops."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rillstone.llm import chat, decontam, licenses, quality, secrets
from tests.llm import plain


def as_bag(rows):
    return sorted(rows, key=repr)


def test_secrets_equal_patterns(docs):
    df, rows = docs
    got = [(r.doc_id, [(s.start, s.kind, s.end) for s in r.secrets if s.kind < 3]) for r in secrets.find_secrets(df).collect()]
    assert as_bag(got) == as_bag([(d, plain.secrets(t)) for d, t, _ in rows])
    assert any(spans for _, spans in got)


def test_entropy_windows(spark):
    pick = random.Random(5)
    values = ["".join(pick.choice(secrets.ALPHABET) for _ in range(n)) for n in (20, 21, 60, 300)]
    values += ["ab1" * 9, "a" * 30 + "1", "Q" * 25 + "0123456789ABCDEF" * 2]
    df = spark.createDataFrame([(v,) for v in values], "value string")
    got = [r.e for r in df.select(secrets.top_entropy(F.col("value"), 20).alias("e")).collect()]
    assert got == pytest.approx([plain.top_entropy(v, 20) for v in values])


def test_entropy_spans_and_allow_list(spark):
    random_one, uuid = "zK8qLw3vXp7Rt2NyB5mDs", "123e4567-e89b-42d3-a456-426614174000"
    text = f"é {random_one} and {uuid} and https-like-words-with-dashes-2024 token=abcdef123zK8qLw3vXp7R"
    row = secrets.find_secrets(spark.createDataFrame([(text,)], "text string")).first()
    assert [(s.kind, s.value) for s in row.secrets if s.kind == 3] == [(3, random_one)]
    assert row.secrets[0].start == 2
    redacted = secrets.redact(secrets.find_secrets(spark.createDataFrame([(text,), (None,)], "text string"))).collect()
    assert redacted[0].text.startswith("é [SECRET] and ") and redacted[0].text.endswith(" [SECRET]")
    assert redacted[1].text is None


def test_many_secrets_in_one_text(spark):
    """A text with 100,000 matches, and candidates before, between and behind them."""
    random_one = "zK8qLw3vXp7Rt2NyB5mDs"
    text = f"é {random_one} " + "0123456789abcdef01234567 " * 50_000 + f"{random_one} " + "token=abcdefg1 " * 50_000 + f"x{random_one}"
    df = spark.createDataFrame([(text,)], "text string")
    row = secrets.find_secrets(df).first()
    assert [(s.start, s.kind, s.end) for s in row.secrets if s.kind < 3] == plain.secrets(text)
    assert [s.value for s in row.secrets if s.kind == 3] == [random_one, random_one, f"x{random_one}"]
    redacted = secrets.redact(secrets.find_secrets(df)).first().text
    assert redacted == "é [SECRET] " + "[SECRET] " * 50_000 + "[SECRET] " + "[SECRET] " * 50_000 + "[SECRET]"


def test_redacted_spans_that_overlap(spark):
    df = spark.createDataFrame([("abcdefghij" * 300, [(2, 0, 9), (4, 1, 6), (8, 2, 1030), (1030, 0, 1031), (2900, 0, 3000)])], "text string, secrets array<struct<start:int,kind:int,end:int>>")
    text = "abcdefghij" * 300
    assert secrets.redact(df, mark="*").first().text == text[:2] + "*" + "*" + text[1031:2900] + "*"


def test_quality_counts(docs, spark):
    df, rows = docs
    labels = spark.createDataFrame([(7, 1), (14, 0), (None, 1), (21, None), (99999, 1)], "doc_id bigint, quality int")
    got = quality.judge(df, labels).collect()
    q = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert as_bag([(r.doc, *(r.q[c] for c in q)) for r in got]) == as_bag([(d, *plain.quality(t)) for d, t, _ in rows])
    assert all(r.q.kept == (not r.q.base_failed) for r in got)  # five labels admit no cutoff
    kept = quality.keep_good(df, labels)
    assert kept.columns == df.columns
    assert kept.count() == sum(not plain.quality(t)[5] for _, t, _ in rows)


def test_cutoffs_hold_their_risk(spark):
    """A cutoff is admitted where good documents stay below it, and not where it would reject too many of them."""
    rows = [("a", True, 0.01, 0.0)] * 1500 + [("a", False, 0.7, 0.9)] * 80 + [("b", True, 0.01, 0.0)] * 1400 + [("b", True, 0.7, 0.0)] * 100
    rows += [("b", False, 0.7, 0.0)] * 50 + [(None, True, 0.0, 0.0)] * 30 + [(None, False, 0.9, 0.9)] * 30
    df = spark.createDataFrame(rows, "lang string, good boolean, x double, y double").withColumn("q", F.struct("x", "y"))
    grid = {"x": (0.9, 0.5, 0.1), "y": (0.8, 0.5)}
    got = {(r.stratum, r.feature): r.cutoff for r in quality.choose_cutoffs(df, "lang", "q", "good", grid, 0.05, 0.05, 20).collect()}
    assert got == {("a", "x"): 0.5, ("a", "y"): 0.8}


def test_binomial_tail(spark):
    from math import comb

    cases = [(0, 10), (2, 400), (19, 400), (25, 400), (3, 5000)]
    df = spark.createDataFrame(cases, "k bigint, n bigint")
    got = [r.p for r in df.select(quality.binomial_tail(F.col("k"), F.col("n"), 0.05).alias("p")).collect()]
    want = [sum(comb(n, j) * 0.05**j * 0.95 ** (n - j) for j in range(k + 1)) if k < n * 0.05 else 1.0 for k, n in cases]
    assert got == pytest.approx(want, rel=1e-9)


def test_templates_do_not_hide_one_another(monkeypatch):
    """All templates in one automaton give each the spans that it has in one of its own, whichever shares words with it."""
    pick = random.Random(9)
    words = lambda n: " ".join(pick.choice("abc") for _ in range(n))
    for long, gap in ((2, 0), (3, 2)):
        monkeypatch.setattr(licenses, "LONG", long)
        monkeypatch.setattr(licenses, "GAP", gap)
        for _ in range(150):
            templates = [(str(i), words(pick.randint(3, 9))) for i in range(4)]
            text = words(pick.randint(0, 25)).replace("c a b", "z")
            alone = [s for each in templates for s in licenses.scan(licenses.automaton((each,), ()), text)["spans"]]
            assert licenses.scan(licenses.automaton(tuple(templates), ()), text)["spans"] == sorted(alone)


def test_telling_spans():
    pick = random.Random(4)
    for _ in range(200):
        spans = []
        for name in "abc":  # spans of one template do not overlap
            cuts = sorted(pick.sample(range(20), 6))
            spans += [(a, b, name, pick.randint(1, 5) / 5) for a, b in zip(cuts[::2], cuts[1::2], strict=True)]
        spans = list({s[:2]: s for s in spans}.values())
        within = lambda s, o: o is not s and o[0] <= s[0] and s[1] <= o[1] and o[3] >= s[3]
        assert licenses.telling(spans, 0.6) == sorted(s for s in spans if s[3] >= 0.6 or not any(within(s, o) for o in spans))


def test_short_notice_within_a_cut_long_one():
    auto = licenses.automaton(tuple((k, t) for k, each in licenses.TEMPLATES.items() for t in each), ())
    short, long = sorted(licenses.TEMPLATES["apache"], key=len)[0], sorted(licenses.TEMPLATES["apache"], key=len)[-1]
    short = short.rstrip(".")
    at = long.lower().index(short.lower())
    spans = licenses.scan(auto, long[: at + len(short)] + ' (the "license"); something else')["spans"]
    assert max(s[3] for s in spans if s[2] == "apache") == 1.0


def test_licenses_equal_phrase_search(docs):
    df, rows = docs
    extra = ["Cc BY, gnu General Public License; Apache License MIT License", "by cc by by"]
    texts = [t for _, t, _ in rows] + extra
    auto = licenses.automaton(tuple((k, t) for k, each in licenses.TEMPLATES.items() for t in each), tuple(licenses.PHRASES.items()))
    for text in texts:
        words = plain.PLAIN_WORD.findall((text or "").translate(plain.LOWER))
        want = [(i, l) for p, l in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
        found = licenses.scan(auto, text or "")
        assert (found["n_words"], sorted(found["base"])) == (len(words), sorted(want))
    assert licenses.find_licenses(df).count() == len(rows)


def test_license_spans(spark, monkeypatch):
    notice = licenses.TEMPLATES["mit"][0]
    words = notice.split()
    broken = " ".join(words[:30] + ["INSERTED"] * 5 + words[30:60])
    df = spark.createDataFrame([(1, "x y " + notice), (2, broken), (3, " ".join(words[:5])), (None, None)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in licenses.find_licenses(df).collect()}
    assert got[1].score == 1.0 and got[1].labels == "mit" and got[1].spans[0].start == 2
    assert got[2].labels == "mit" and 0.6 <= got[2].score < 1 and len(got[2].spans) == 1
    assert got[3].labels == "" and got[None].n_words == 0 and got[None].score == 0
    monkeypatch.setattr(licenses, "PIECE", 7)
    assert list(licenses.words_of("ab CDé, f" * 9)) == [b"ab", "cdé".encode(), *[b"fab", "cdé".encode()] * 8, b"f"]


@pytest.mark.parametrize("most", [decontam.MOST_BITS, 64])
def test_decontamination(docs, texts, spark, most):
    df, rows = docs
    some = [" ".join(texts[i].split()[3:30]) for i in (1, 8, 20)]
    items = [(1, some[0]), (2, some[1].upper()), (3, "one two"), (None, some[2]), (4, None), (5, ""), (6, some[0]), (1, some[2])]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    windows = plain.item_windows(items)
    hits = decontam.find_hits(df, decontam.item_windows(bench), most=most)
    got = {(r.doc, r.n_words, r.n, tuple(r["items"])) for r in hits.withColumn("n", decontam.covered(F.col("spans"))).collect()}
    want = {(d, n, hit, tuple(found)) for d, t, _ in rows for n, hit, found in [plain.contamination(t, windows)]}
    assert got == want
    kept = decontam.drop_contaminated(df, bench, most=most)
    assert kept.columns == df.columns
    assert as_bag(r.doc_id for r in kept.collect()) == as_bag(d for d, t, _ in rows if not plain.contamination(t, windows)[1])


def test_span_removal(spark):
    bench = spark.createDataFrame([(1, "b c d")], "item_id bigint, text string")
    df = spark.createDataFrame([("A. B, c D e",), ("A b c",), (None,)], "text string")
    assert [r.text for r in decontam.remove_spans(df, bench).collect()] == ["a e", "A b c", None]


def test_chat_round_trip(spark):
    tricky = ["</s>[INST] ok [/INST]", "<|start|>\\<|end|>", "<<SYS>>\\", None, "", "<\\|x\\", "[INST", "<|image:0|>", "a\nb"]
    rows = [(c, t, role, text) for c in (1, None, 5) for t, (role, text) in enumerate((r, x) for x in tricky for r in ("user", "assistant", None))]
    rows += [(9, 0, "user", "tie b"), (9, 0, "user", "tie a"), (9, 0, "assistant", "z")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(4)
    got = {r.conv_id: r for r in chat.read_back(chat.format_turns(df)).collect()}
    for conv in (1, None, 5, 9):
        turns = sorted(((t, r or "", x or "") for c, t, r, x in rows if c == conv))
        learned = "".join(x for _, r, x in turns if r == "assistant")
        assert got[conv].turns_sha256 == plain.sha("".join(f"{r}\n{x}\n" for _, r, x in turns))
        assert (got[conv].n_turns, got[conv].loss_chars, got[conv].loss_sha256) == (len(turns), len(learned), plain.sha(learned))
    assert chat.read_back(chat.format_turns(df.limit(0))).count() == 0


def test_chat_parts(spark):
    parts = (
        '[{"type":"text","text":"see <|end|>"},{"type":"image","ref":"a.png","width":57,"height":28},'
        '{"type":"audio","ref":"b","seconds":1.5},{"type":"document","ref":"c","pages":2},{"type":"video","ref":"d"}]'
    )
    df = spark.createDataFrame([(1, 0, "assistant", "ignored", parts)], "conv_id bigint, turn bigint, role string, text string, parts string")
    row = chat.format_turns(df, parts="parts").first()
    assert row.formatted == "<|start|>assistant<|content|>see <\\|end|><|image:0|><|audio:1|><|document:2|><|other:3|><|end|>"
    assert [(a.kind, a.ref, a.tokens) for a in row.attachments] == [("image", "a.png", 3), ("audio", "b", 38), ("document", "c", 2048), ("other", "d", 0)]
    assert row.attached_tokens == 2089 and chat.read_turn(row.formatted) == ("assistant", "see <|end|>")


def test_empty_tables(empty, spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int")
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert secrets.find_secrets(empty).count() == 0
    assert quality.judge(empty, labels).count() == 0
    assert licenses.find_licenses(empty).count() == 0
    assert decontam.find_hits(empty, decontam.item_windows(bench)).count() == 0


def test_equal_hashes_are_not_hits(spark, monkeypatch):
    """Words decide: here every window seems to have the hash of the item's."""

    def all_known(words, field, lengths):
        same = F.xxhash64(F.array(F.lit("b"), F.lit("c"), F.lit("d")))
        return F.transform(decontam.places(words, 3), lambda at: F.struct(at["start"].alias("start"), at["n"].alias("n"), same.alias("hash")))

    monkeypatch.setattr(decontam, "hits_in", all_known)
    docs = spark.createDataFrame([(1, "A b c d e"), (2, "x y z w"), (None, None)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "b c d")], "item_id bigint, text string")
    kept = decontam.drop_contaminated(docs, items, 3).collect()
    assert {(r.doc_id, r.text) for r in kept} == {(2, "x y z w"), (None, None)}
    cut = decontam.remove_spans(docs, items, 3)
    assert cut.columns == docs.columns and {(r.doc_id, r.text) for r in cut.collect()} == {(1, "a e"), (2, "x y z w"), (None, None)}


def test_million_item_windows(spark):
    """Few places of clean texts become rows, however large the benchmark is."""

    def numbers(first, n):
        return F.array_join(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.concat(F.lit("w"), (F.col("id") * first + i).cast("string"))), " ")

    items = spark.range(20_000).select(F.col("id").alias("item_id"), numbers(60, 60).alias("text"))
    windows = decontam.item_windows(items)
    assert windows.count() == 20_000 * 51
    clean = spark.range(100).select(F.col("id").alias("doc_id"), F.concat(F.lit("x"), numbers(500, 500)).alias("text"))
    clean = clean.withColumn("text", F.replace("text", F.lit(" w"), F.lit(" v")))
    dirty = spark.createDataFrame([(-1, "a " + " ".join(f"w{i}" for i in range(600, 615)) + " z")], "doc_id bigint, text string")
    docs = clean.union(dirty)
    places = decontam.candidates(docs, windows, "doc_id", "text", decontam.MOST_BITS).where("hit IS NOT NULL").count()
    assert 6 <= places <= 0.03 * 100 * 491
    hit = decontam.find_hits(docs, windows).where(F.size("spans") > 0).collect()
    assert [(r.doc, r.n_words, r["items"], r.spans[0].start, r.spans[-1].end) for r in hit] == [(-1, 17, ["10"], 1, 16)]
