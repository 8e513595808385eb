"""Benchmark decontamination: word windows of test items, looked up in training texts.

The windows of the items are made once. Two bits of each window's hash are set in a bit field that travels with the
plan: a hash set of fixed size, about sixteen bits a window and ``MOST_BITS`` at most. Texts are scanned in place; only
places whose bits are set become rows, which are joined to the windows by hash and words. So every benchmark size takes
the same way: windows that the field is too small for only let more places through to the join.

NULL or empty texts have no words and no hits. An item with fewer than ``n`` words is one window. Items with one
id are one item; a NULL id counts as an empty one. Rows equal in id and text give one result, rows that share an
id but not the text are told apart. Empty tables give empty or clean results; other columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rillstone.llm.common import MOST_BITS, NOT_WORD, ascii_lower, bit_field, cut, in_field, let, marked, row_key, spare, split_words, whole_text

WORDS = 10


def normal_words(text: str) -> Column:
    return split_words(ascii_lower(whole_text(text)), NOT_WORD)


def windows_of(words: Column, n: int) -> Column:
    """All windows of n words, or the one window of a shorter text."""
    long = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.slice(words, i, n))
    short = F.when(F.size(words) > 0, F.array(words)).otherwise(F.array().cast("array<array<string>>"))
    return F.when(F.size(words) >= n, long).otherwise(short)


def item_windows(items: DataFrame, n: int = WORDS, item: str = "item_id", text: str = "text") -> DataFrame:
    """One row per distinct window: its words, their number, its hash, and the items that have it. They are written,
    as several steps read them."""
    name = F.coalesce(F.col(item).cast("string"), F.lit(""))
    each = items.select(name.alias("item"), F.explode(let(normal_words(text), lambda w: windows_of(w, n))).alias("window"))
    known = each.groupBy("window").agg(F.sort_array(F.collect_set("item")).alias("items"))
    return cut(known.select("window", F.size("window").alias("n"), F.xxhash64("window").alias("hash"), "items"), "windows")


PLACES, HITS = "array<struct<start:int,n:int>>", "array<struct<start:int,n:int,hash:bigint>>"


def places(words: Column, n: int) -> Column:
    """(start, n) of every window of n words, words from 1."""
    each = F.transform(
        F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.struct(i.cast("int").alias("start"), F.lit(n).alias("n"))
    )
    return F.when(F.size(words) >= n, each).otherwise(F.array().cast(PLACES))


def hits_in(words: Column, field: tuple[Column, int], lengths: list[int]) -> Column:
    """The places of the words whose window has its bits in the field: (start, n, hash)."""

    def known(at: Column) -> Column:
        return in_field(at["hash"], field)

    def hashed(at: Column) -> Column:
        return F.struct(at["start"].alias("start"), at["n"].alias("n"), F.xxhash64(F.slice(words, at["start"], at["n"])).alias("hash"))

    return F.concat(F.array().cast(HITS), *[F.filter(F.transform(places(words, n), hashed), known) for n in lengths])


def candidates(docs: DataFrame, windows: DataFrame, doc: str, text: str, most: int) -> DataFrame:
    """A row per place that may be a hit, and one with a NULL place for a document without: doc, key, n_words, hit
    (start from 1, n, hash, window)."""
    field = bit_field(windows, most)
    lengths = sorted(r[0] for r in windows.select("n").distinct().collect())  # at most WORDS of them

    def scanned(words: Column) -> Column:
        found = hits_in(words, field, lengths) if field else F.array().cast(HITS)
        with_words = F.transform(
            found,
            lambda h: F.struct(h["start"].alias("start"), h["n"].alias("n"), h["hash"].alias("hash"), F.slice(words, h["start"], h["n"]).alias("window")),
        )
        return F.struct(F.size(words).cast("bigint").alias("n_words"), with_words.alias("hits"))

    return docs.select(
        F.col(doc).alias("doc"), row_key(doc, text).alias("key"), let(normal_words(text), scanned).alias("s")
    ).select("doc", "key", F.col("s.n_words").alias("n_words"), F.explode_outer("s.hits").alias("hit"))


def find_hits(docs: DataFrame, windows: DataFrame, doc: str = "doc_id", text: str = "text", most: int = MOST_BITS) -> DataFrame:
    """One row per document: doc, key, n_words, spans (start and end of each hit window, words from 0, end
    exclusive, in order), items (sorted). ``most`` bounds the bit field (a power of two, 64 or more)."""
    read = candidates(docs, windows, doc, text, most)
    # rows without a place get a hash of their own, so that a shuffled join stays even, and a window that no item has
    asked = read.select(
        "doc", "key", "n_words", "hit.start", "hit.n",
        F.coalesce("hit.hash", "key").alias("hash"), F.coalesce("hit.window", F.array().cast("array<string>")).alias("window"),
    )
    checked = asked.join(windows.select("hash", "window", "items"), ["hash", "window"], "left")
    return (
        checked.groupBy("doc", "key", "n_words")
        .agg(
            F.sort_array(
                F.collect_set(
                    F.when(F.col("items").isNotNull(), F.struct((F.col("start") - 1).alias("start"), (F.col("start") - 1 + F.col("n")).alias("end")))
                )
            ).alias("spans"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        )
    )


def covered(spans: Column) -> Column:
    """How many words the spans, sorted by start, cover."""
    start = F.struct(F.lit(0).alias("to"), F.lit(0).alias("n"))

    def step(state: Column, span: Column) -> Column:
        fresh = F.greatest(span["end"] - F.greatest(span["start"], state["to"]), F.lit(0))
        return F.struct(F.greatest(state["to"], span["end"]).alias("to"), (state["n"] + fresh).alias("n"))

    return F.aggregate(spans, start, step, lambda state: state["n"].cast("bigint"))


def drop_contaminated(
    docs: DataFrame, items: DataFrame, n: int = WORDS, doc: str = "doc_id", text: str = "text", item: str = "item_id", most: int = MOST_BITS
) -> DataFrame:
    """The documents in which no window of an item occurs, with their columns. Only places whose bits are set are
    looked up, and the list of documents to drop is written: Spark broadcasts it or not by its size."""
    windows = item_windows(items, n, item, text)
    asked = candidates(docs, windows, doc, text, most).where("hit IS NOT NULL").select("doc", "key", "hit.hash", "hit.window")
    hit = asked.join(windows.select("hash", "window"), ["hash", "window"], "left_semi").select("doc", "key").distinct()
    return marked(docs, cut(hit, "contaminated"), doc, text, "left_anti")[0]


def remove_spans(
    docs: DataFrame, items: DataFrame, n: int = WORDS, text: str = "text", item: str = "item_id", most: int = MOST_BITS
) -> DataFrame:
    """The documents with every word of a hit window taken out; a touched text becomes its remaining words, in
    lower case and with single spaces."""
    doc = spare(docs, "_doc")[0]  # the text alone says what goes
    known = docs.withColumn(doc, F.lit(0).cast("bigint"))
    hit = find_hits(known, item_windows(items, n, item, text), doc, text, most).where(F.size("spans") > 0)
    joined, spans = marked(known, hit, doc, text, "left", "spans")

    def outside(words: Column) -> Column:
        rest = F.filter(words, lambda w, i: ~F.exists(F.col(spans), lambda s: (i >= s["start"]) & (i < s["end"])))
        return F.array_join(rest, " ")

    left = F.when(F.col(spans).isNotNull(), let(normal_words(text), outside)).otherwise(F.col(text))
    return joined.withColumn(text, left).drop(spans, doc)
