"""Language model, mixing and the pipeline."""

from __future__ import annotations

from itertools import product

import numpy as np
import pytest

import corpus_pipeline
from rillstone.llm import hmm, line_dedup, mixing
from tests.llm import plain


def test_counts_and_base_scores(docs):
    df, rows = docs
    got = sorted(
        ((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in hmm.language_model(df, passes=1).collect()),
        key=repr,
    )
    assert got == sorted(((*r[:5], round(r[5], 6)) for r in plain.base_scores([(d, t) for d, t, _ in rows])), key=repr)


def test_rare_words_are_joined(docs, monkeypatch):
    """With room for a few counts only, the rest comes from the join; the results stay."""
    df, rows = docs
    monkeypatch.setattr(hmm, "OWN", 5)
    monkeypatch.setattr(hmm.learn_vocabulary, "__defaults__", (5, 40))
    got = {(r.doc_id, r.n_known, round(r.base_score, 6)) for r in hmm.language_model(df, passes=1).collect()}
    assert got == {(r[0], r[3], round(r[5], 6)) for r in plain.base_scores([(d, t) for d, t, _ in rows])}


def small_model():
    pick = np.random.default_rng(1)
    share = lambda *shape: (x := pick.random(shape)) / x.sum(-1, keepdims=True)
    return hmm.Model(share(3), share(3, 3), share(3, 4).T.copy())


def paths(model, seq):
    """(probability, path) of every way through the states."""
    for path in product(range(3), repeat=len(seq)):
        p = model.start[path[0]] * model.emit[seq[0], path[0]]
        for a, b, s in zip(path, path[1:], seq[1:], strict=False):
            p *= model.move[a, b] * model.emit[s, b]
        yield p, path


def test_forward_and_expected_counts_equal_all_paths():
    model, sequences = small_model(), [np.array(s) for s in ([0, 1, 2, 3, 0], [3], [1, 1, 2], [2, 0])]
    totals = [sum(p for p, _ in paths(model, s)) for s in sequences]
    assert hmm.log10_likelihood(model, sequences) == pytest.approx(np.log10(totals))
    emitted, moved, started = (np.zeros(x) for x in ((4, 3), (3, 3), 3))
    for seq, total in zip(sequences, totals, strict=True):
        for p, path in paths(model, seq):
            started[path[0]] += p / total
            for s, k in zip(seq, path, strict=True):
                emitted[s, k] += p / total
            for a, b in zip(path, path[1:], strict=False):
                moved[a, b] += p / total
    for stretch, at_once in product((1, 2, 3, 10), (1, 4, 100)):  # stretches and groups leave the results as they are
        assert hmm.log10_likelihood(model, sequences, stretch, at_once) == pytest.approx(np.log10(totals))
        for got, want in zip(hmm.expected_counts(model, sequences, stretch, at_once), (emitted, moved, started), strict=True):
            assert got == pytest.approx(want)


def test_long_text_counts_one_start():
    model, text = small_model(), np.random.default_rng(2).integers(0, 4, 20_000)
    whole = hmm.expected_counts(model, [text], 20_000)
    for got, want in zip(hmm.expected_counts(model, [text], 512), whole, strict=True):
        assert got == pytest.approx(want, rel=1e-9)
    assert whole[2].sum() == pytest.approx(1) and whole[1].sum() == pytest.approx(19_999) and whole[0].sum() == pytest.approx(20_000)
    assert hmm.log10_likelihood(model, [text], 512) == pytest.approx(hmm.log10_likelihood(model, [text], 20_000), rel=1e-12)


def test_training_beats_counts(spark):
    """Texts that switch between two word stocks: states predict held-out ones better than plain shares do."""
    pick = np.random.default_rng(3)
    rows = []
    for i in range(300):
        text, stock = [], int(pick.integers(2))
        for _ in range(60):
            stock = 1 - stock if pick.random() < 0.05 else stock
            text.append(f"{'ab'[stock]}{int(pick.integers(12))}")
        rows.append((i, " ".join(text)))
    scores = [r for r in hmm.language_model(spark.createDataFrame(rows, "doc_id bigint, text string"), passes=12).collect() if r.held_out]
    assert sum(r.score for r in scores) > sum(r.base_score for r in scores) + 0.1 * sum(r.n_tokens for r in scores)


def check_mix(rows, got, block):
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len(plain.WORD.findall(text or ""))
    want = plain.targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
    for source in sizes:
        assert abs(taken[source] - want[source]) <= 4 * block


def test_mix_meets_targets(docs):
    df, rows = docs
    got = mixing.mix(df, block_words=8).collect()
    assert len(got) == len(rows)
    check_mix(rows, got, 8)
    again = mixing.mix(df.repartition(5), block_words=8).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))
    in_mix = mixing.mix_documents(df)
    assert in_mix.columns == [*[c for c in df.columns if c != "size"], "size", "source_size", "target", "taken"]
    assert in_mix.where("taken > 0").count() == in_mix.count() > 0


def test_mix_in_slot_order(docs):
    """Slots hold the words that ``taken`` counts, without gaps or overlaps, and name their source in the schedule."""
    df, rows = docs
    rows = mixing.mix_blocks(df, block_words=8).collect()
    taken, filled = {}, {}
    for r in rows:
        assert r.at == filled.get(r.slot, (0,))[0] and 0 <= r.first < r["last"]
        filled[r.slot] = (r.at + r["last"] - r.first, r.source)
        key = r.doc, r["_text_key"], r.source
        taken[key] = taken.get(key, 0) + r["last"] - r.first
    assert [r.slot for r in rows] == sorted(r.slot for r in rows) and all(n <= 8 for n, _ in filled.values())
    want = {}
    for r in mixing.mix(df, block_words=8).collect():
        key = r.doc, r["_text_key"], r.source
        want[key] = want.get(key, 0) + r.taken
    assert taken == {k: n for k, n in want.items() if n}
    # a stretch of the mix has the shares of the whole
    half = sorted(filled)[: len(filled) // 2]
    for source in {s for _, s in filled.values()}:
        whole = sum(n for n, s in filled.values() if s == source) / sum(n for n, _ in filled.values())
        part = sum(filled[i][0] for i in half if filled[i][1] == source) / sum(filled[i][0] for i in half)
        assert abs(part - whole) < 0.02


def test_mix_with_a_fraction_at_most(spark):
    df = spark.createDataFrame([(i, "w " * 20, "ab"[i % 4 == 0]) for i in range(80)], "doc_id bigint, text string, source string")
    for most, small in ((1.5, 600), (2.0, 800)):
        got = mixing.mix(df, weights=(1, 50), most=most, block_words=8).where("source = 'a'").collect()
        assert {r.target for r in got} == {2400.0 - small} and sum(r.taken for r in got) > 1200
        got = mixing.mix(df, weights=(1, 50), most=most, block_words=8).where("source = 'b'").collect()
        assert abs(sum(r.taken for r in got) - small) <= 16 and all(r.taken <= 40 for r in got)


def test_schedule_is_even_in_every_stretch(spark):
    targets = spark.createDataFrame([("a", 8000.0), ("b", 4000.0), (None, 2000.0), ("d", 2000.0)], "source string, target double")
    slots = sorted(mixing.schedule(targets, 4).collect(), key=lambda r: r.slot)
    assert [r.slot for r in slots] == list(range(4000))
    seen = {}
    for r in slots:
        assert r["rank"] == seen.get(r.source, 0)
        seen[r.source] = r["rank"] + 1
    for start in range(0, 4000, 100):
        assert abs(sum(r.source == "a" for r in slots[start : start + 100]) - 50) <= 3


def test_empty_tables(empty):
    assert mixing.mix(empty).count() == 0
    assert mixing.mix_documents(empty).count() == 0
    assert hmm.language_model(empty).count() == 0


def test_pipeline_stages(spark, docs, texts, tmp_path):
    """Each stage on what its predecessor kept, against the plain versions of all of them."""
    df, rows = docs
    folder = str(tmp_path)
    df.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(7, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, " ".join(texts[8].split()[3:30])), (2, " ".join(texts[20].split()[:12]))]
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")

    good = {(d, t, s) for d, t, s in rows if not plain.quality(t)[5]}
    source = {(d, t): s for d, t, s in good}
    cut = plain.line_dedup(distinct := plain.in_order({(d, t) for d, t, _ in good}), line_dedup.LEAST_WORDS)
    lined = [(d, new, source[d, old]) for (d, old), (_, _, new) in zip(distinct, cut, strict=True) if new.split()]
    groups = {}
    for row, (_, root) in zip(lined, plain.components([r[:2] for r in lined], 5, 80), strict=True):
        groups.setdefault(root, []).append(row)
    single = [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in groups.values()]
    windows = plain.item_windows(items)
    clean = [r for r in single if not plain.contamination(r[1], windows)[1]]

    got = corpus_pipeline.run(spark, folder).collect()
    kept = {(d, t) for d, t, _ in clean}
    assert {(r.doc_id, r.text) for r in got} <= kept
    twice = [r for r in rows if rows.count(r) > 1]
    times = {(d, t): 2 if any((d == x[0] and source.get((x[0], x[1])) == x[2]) for x in twice) else 1 for d, t in kept}
    sizes = {}
    for d, t, s in clean:
        sizes[s] = sizes.get(s, 0) + len(plain.WORD.findall(t)) * times[d, t]
    want = plain.targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 < r.taken <= 2 * r.size
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "mixing sources to target weights"
    ]
