"""Quality rules whose cutoffs are chosen on labelled documents so that few good ones are rejected.

A text gets features; a rule rejects a document whose feature is above a cutoff. The cutoffs of each stratum
come from labelled rows: a cutoff is admitted only if the exact binomial test says that it rejects less than a
set share of the stratum's good documents, at an error probability that is split over all tests. All
labelled rows take part, and the features cover the whole text; both steps are expressions and joins.

NULL or empty texts have no words; they fail the base rule. A NULL stratum is a stratum of its own. Labels that
repeat a document count once per row; labels without a document, and NULL labels, are left out. With no labels, or
too few for a stratum, no cutoff is admitted there and only the base rule rejects. Other columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rillstone.llm.common import SPACE, cut, let, marked, row_key, split_words, whole_text

#: share of a stratum's good documents that the chosen cutoffs may reject, and the probability of being wrong
RISK, DOUBT = 0.05, 0.05
#: a cutoff must reject this many times more bad labelled documents than good ones
GAIN = 20

# Candidate cutoffs per feature, loosest first. A higher value is worse.
CUTOFFS = {
    "symbol_share": (1.0, 0.5, 0.3, 0.2, 0.1, 0.05),
    "dup_line_share": (0.8, 0.6, 0.4, 0.3, 0.2),
    "repeat_share": (0.5, 0.4, 0.3, 0.2, 0.1),
    "upper_share": (0.9, 0.7, 0.5, 0.3, 0.2),
    "word_length": (20.0, 15.0, 12.0, 10.0, 8.0),
    "short_words": (-2.0, -2.5, -3.0, -3.5),
}


def repeat_words(words: Column) -> Column:
    """How many words stand in windows of three words that the text has twice or more. Windows are compared by
    64-bit hashes: sorted, equal ones are neighbours."""

    def marked(sorted_windows: Column) -> Column:
        def twice(w: Column, i: Column) -> Column:
            before, after = F.get(sorted_windows, i - 1), F.get(sorted_windows, i + 1)
            return F.coalesce(before["h"] == w["h"], F.lit(False)) | F.coalesce(after["h"] == w["h"], F.lit(False))

        starts = F.sort_array(F.transform(F.filter(sorted_windows, twice), lambda w: w["i"]))
        return let(
            starts,
            lambda s: F.aggregate(
                F.transform(s, lambda at, i: F.least(F.coalesce(F.get(s, i + 1) - at, F.lit(3)), F.lit(3))),
                F.lit(0),
                lambda n, x: n + x,
            ),
        )

    windows = F.transform(
        F.sequence(F.lit(1), F.size(words) - 2),
        lambda i: F.struct(F.xxhash64(F.slice(words, i, 3)).alias("h"), i.alias("i")),
    )
    return F.when(F.size(words) >= 3, let(F.sort_array(windows), marked)).otherwise(F.lit(0))


def text_features(text: str = "text") -> Column:
    """A struct of counts over the whole text, and the shares that the rules look at."""
    body = whole_text(text)
    lines = F.filter(F.split(body, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def left(pattern: str) -> Column:
        return F.length(F.regexp_replace(body, pattern, ""))

    def counts(words: Column) -> Column:
        return F.struct(
            F.size(words).alias("n_words"),
            left(SPACE).alias("word_chars"),
            left(r"[^#*$%&|<>]+").alias("n_symbols"),
            left(r"[^A-Z]+").alias("n_upper"),
            let(lines, lambda ls: F.struct(F.size(ls).alias("n"), (F.size(ls) - F.size(F.array_distinct(ls))).alias("dup"))).alias("lines"),
            repeat_words(words).alias("n_repeat_words"),
        )

    def features(c: Column) -> Column:
        n = F.greatest(c["n_words"], F.lit(1)).cast("double")
        return F.struct(
            c["n_words"].cast("bigint").alias("n_words"),
            c["word_chars"].cast("bigint").alias("word_chars"),
            c["n_symbols"].cast("bigint").alias("n_symbols"),
            c["lines"]["dup"].cast("bigint").alias("n_dup_lines"),
            c["n_repeat_words"].cast("bigint").alias("n_repeat_words"),
            ((c["n_words"] < 50) | (100 * c["n_repeat_words"] > 50 * c["n_words"])).alias("base_failed"),
            (c["n_symbols"] / n).alias("symbol_share"),
            (c["lines"]["dup"] / F.greatest(c["lines"]["n"], F.lit(1))).alias("dup_line_share"),
            (c["n_repeat_words"] / n).alias("repeat_share"),
            (c["n_upper"] / F.greatest(c["word_chars"], F.lit(1))).alias("upper_share"),
            (c["word_chars"] / n).alias("word_length"),
            (-(c["word_chars"] / n)).alias("short_words"),
        )

    return let(let(split_words(body), counts), features)


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Bin(n, p), the exact sum; 1 where k is not below the mean, as it is no evidence there."""
    step = F.log(F.lit(p / (1 - p)))

    def add(state: Column, j: Column) -> Column:
        term = state["term"] + F.when(j > 0, F.log((n - j + 1).cast("double") / F.greatest(j, F.lit(1))) + step).otherwise(F.lit(0.0))
        return F.struct(term.alias("term"), (state["sum"] + F.exp(term)).alias("sum"))

    total = F.aggregate(
        F.sequence(F.lit(0).cast("bigint"), k),
        F.struct((n * F.log(F.lit(1 - p))).alias("term"), F.lit(0.0).alias("sum")),
        add,
        lambda state: state["sum"],
    )
    return F.when(k < n * p, total).otherwise(F.lit(1.0))


def choose_cutoffs(
    holdout: DataFrame, stratum: str, features: str, good: str, cutoffs: dict[str, tuple[float, ...]],
    risk: float, doubt: float, gain: float,
) -> DataFrame:
    """One row per stratum and admitted rule: stratum, feature, cutoff, n_good, k_good, k_bad, p_value.

    Per feature the cutoffs are tested from the loosest on; each rejects whatever looser ones reject, so the
    first failure ends the sequence without a further correction. The error probability is split over
    features and strata (Bonferroni), the risk over features: all rules of a stratum together keep it.
    Of the admitted cutoffs the one with the best balance of bad against ``gain`` times good is taken.
    """
    grid = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), F.lit(c).cast("double").alias("cutoff"), (F.col(features)[f] > c).alias("hit"))
            for f, each in cutoffs.items()
            for c in each
        ]
    )
    counted = (
        holdout.select(F.col(stratum).alias("stratum"), F.col(good).alias("good"), F.explode(grid).alias("g"))
        .groupBy("stratum", "g.feature", "g.cutoff")
        .agg(
            F.count_if("good").alias("n_good"),
            F.count_if(F.col("good") & F.col("g.hit")).alias("k_good"),
            F.count_if(~F.col("good") & F.col("g.hit")).alias("k_bad"),
        )
    )
    share = risk / len(cutoffs)
    tested = counted.withColumn("p_value", binomial_tail(F.col("k_good"), F.col("n_good"), share))
    n_strata = holdout.select(stratum).distinct().count() or 1
    level = doubt / (len(cutoffs) * n_strata)
    return (
        tested.where((F.col("p_value") <= level) & (F.col("k_bad") > gain * F.col("k_good")))
        .groupBy("stratum", "feature")
        .agg(
            F.max_by(
                F.struct("cutoff", "n_good", "k_good", "k_bad", "p_value"),
                F.struct((F.col("k_bad") - gain * F.col("k_good")).alias("gain"), F.col("cutoff").alias("loosest")),
            ).alias("best")
        )
        .select("stratum", "feature", "best.*")
    )


def judge(
    docs: DataFrame,
    labels: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    risk: float = RISK,
    doubt: float = DOUBT,
    gain: float = GAIN,
    cutoffs: dict[str, tuple[float, ...]] | None = None,
) -> DataFrame:
    """doc, key, stratum, q per row: q has the features, ``failed`` (names of the rules that reject) and ``kept``.

    The texts are read once; what is joined and counted afterwards are their features.
    """
    cutoffs = cutoffs or CUTOFFS
    rows = cut(
        docs.select(F.col(doc).cast("bigint").alias("doc"), row_key(doc, text).alias("key"), F.col(stratum).alias("stratum"), text_features(text).alias("q")),
        "features",
    )
    known = labels.where("quality IS NOT NULL").select(F.col(doc).alias("_doc"), (F.col("quality") == 1).alias("good"))
    holdout = rows.join(known, F.col("doc") == F.col("_doc")).select("stratum", "good", "q")
    rules = choose_cutoffs(holdout, "stratum", "q", "good", cutoffs, risk, doubt, gain)
    # a row per stratum: its cutoffs by feature
    per_stratum = rules.groupBy(F.col("stratum").alias("_stratum")).agg(
        F.struct(*[F.min(F.when(F.col("feature") == f, F.col("cutoff"))).alias(f) for f in cutoffs]).alias("_rules")
    )
    failed = F.filter(
        F.array(*[F.when(F.col("q")[f] > F.col("_rules")[f], F.lit(f)) for f in cutoffs]), lambda f: f.isNotNull()
    )
    return (
        rows.join(per_stratum, F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
        .withColumn("_failed", failed)
        .withColumn("q", F.col("q").withField("failed", F.col("_failed")).withField("kept", ~F.col("q.base_failed") & (F.size("_failed") == 0)))
        .select("doc", "key", "stratum", "q")
    )


def keep_good(docs: DataFrame, labels: DataFrame, doc: str = "doc_id", text: str = "text", **how: object) -> DataFrame:
    """The documents that no rule rejects, with their columns."""
    kept = judge(docs, labels, doc, text, **how).where("q.kept").select("doc", "key").distinct()
    return marked(docs, kept, doc, text, "inner")[0]
