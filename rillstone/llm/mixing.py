"""Mixing sources to target weights with a low-discrepancy schedule.

Each source's documents are laid out in a hashed order and cut into blocks of equally many words. The mix is a
row of slots of that many words. Slot i takes a golden-ratio point, whose place among the cumulative shares
names its source; the slot's rank among the source's slots names the block, going round. So every stretch of the
mix, not only the whole, has the target shares, and what a source gives differs from its target by a few blocks.

A NULL text has no words; a NULL source is a source of its own, the last one. Rows equal in id and text share what
is taken evenly up to a block. Empty tables, or tables without words, give an empty mix. Other columns are kept.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from rillstone.llm.common import columns_of, cut, spare, split_words, whole_text

WEIGHTS = (5, 2, 1)
SHARE, MOST = 1.5, 2.0
BLOCK_WORDS = 32
#: the golden-ratio step on a circle of 2^30 points; it is odd, so the points of a lap are all different
LAP, STEP = 1 << 30, 663608941
GOLDEN = (math.sqrt(5) - 1) / 2


def n_words(text: str) -> Column:
    return F.size(split_words(whole_text(text))).cast("bigint")


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Adds a global row number from 0: numbers within range partitions, plus the rows of the partitions before."""
    ranged = cut(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "numbered")
    parts = ranged.groupBy("_part").count()
    before = parts.select(
        F.col("_part"),
        (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_before"),  # a row per partition
    )
    within = Window.partitionBy("_part").orderBy(*order)
    return (
        ranged.join(before, "_part")
        .withColumn(name, F.col("_before") + F.row_number().over(within) - 1)
        .drop("_part", "_before")
    )


def set_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """source, source_size -> also weight and target. A target stops at ``most`` times the size; the excess is
    shared out again by weight among the others until none is above."""
    order = [F.col("source").isNull().asc(), F.col("source").asc()]
    ranked = numbered(sizes, order, "_rank")
    weighted = cut(
        ranked.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))),
        "sources",
    )
    limit = most * F.col("source_size")
    total = weighted.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while total:  # each turn stops at least one source more, and mostly all that have to stop
        open_ = limit > level * F.col("weight")
        left, weight = weighted.agg(
            F.lit(share * total) - F.coalesce(F.sum(F.when(~open_, limit)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(open_, F.col("weight"))), F.lit(0.0)),
        ).first()
        if not weight or left / weight <= level:
            break
        level = left / weight
    return weighted.withColumn("target", F.least(limit.cast("double"), F.lit(level) * F.col("weight"))).drop("_rank")


def schedule(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """slot, source, rank: which source fills a slot of the mix, and its how-manieth slot that is."""
    spark = targets.sparkSession
    total = targets.agg(F.sum("target")).first()[0] or 0.0
    n_slots = int(round(total / block_words))
    points = max(1, min(1 << 20, 4 * targets.count()))
    by_target = numbered(targets.where("target > 0").select("source", "target"), [F.col("source").isNull().asc(), F.col("source").asc()], "_rank")
    per_part = Window.partitionBy("_group").orderBy("_rank")
    grouped = by_target.withColumn("_group", F.expr("_rank div 4096"))
    groups = grouped.groupBy("_group").agg(F.sum("target").alias("_sum"))
    offsets = groups.select(
        "_group", (F.sum("_sum").over(Window.orderBy("_group")) - F.col("_sum")).alias("_offset")  # a row per 4096 sources
    )
    high = F.col("_offset") + F.sum("target").over(per_part)
    shares = grouped.join(offsets, "_group").select(
        "source", ((high - F.col("target")) / F.lit(total or 1.0)).alias("low"), (high / F.lit(total or 1.0)).alias("high")
    )
    cells = cut(
        shares.withColumn(
            "cell",
            F.explode(
                F.sequence(F.floor(F.col("low") * points).cast("bigint"), F.least(F.floor(F.col("high") * points), F.lit(points - 1)).cast("bigint"))
            ),
        ),
        "cells",
    )
    lap = F.floor(F.col("slot") / LAP)
    place = (F.pmod(F.pmod(F.col("slot"), F.lit(LAP)) * STEP, F.lit(LAP)) + F.pmod((lap + 0.5) * GOLDEN, F.lit(1.0))) / float(LAP)
    slots = spark.range(n_slots).select(F.col("id").alias("slot")).withColumn("point", place)
    filled = slots.withColumn("cell", F.floor(F.col("point") * points).cast("bigint")).join(cells, "cell").where(
        (F.col("point") >= F.col("low")) & ((F.col("point") < F.col("high")) | ((F.col("high") >= 1.0 - 1e-12) & (F.col("point") >= F.col("high"))))
    )
    return ranked_within(filled.select("slot", "source"), "source", "slot", n_slots, "rank")


def ranked_within(rows: DataFrame, key: str, at: str, n: int, name: str) -> DataFrame:
    """Rank from 0 per key by a number below n: counts of stretches first, so that no task orders a whole key."""
    stretch = max(1, math.isqrt(max(n, 1)))
    cut_rows = rows.withColumn("_stretch", F.floor(F.col(at) / stretch).cast("bigint"))
    counts = cut_rows.groupBy(key, "_stretch").count()
    before = counts.select(
        F.col(key).alias("_key"),
        F.col("_stretch").alias("_at"),
        (F.sum("count").over(Window.partitionBy(key).orderBy("_stretch")) - F.col("count")).alias("_before"),
    )
    within = Window.partitionBy(key, "_stretch").orderBy(at)
    return (
        cut_rows.withColumn("_within", F.row_number().over(within) - 1)
        .join(before, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_stretch") == F.col("_at")))
        .withColumn(name, F.col("_before") + F.col("_within"))
        .drop("_stretch", "_within", "_key", "_at", "_before")
    )


def laid_out(sized: DataFrame, doc: str, n_docs: int) -> DataFrame:
    """Adds start: the words that precede a document in its source, the documents being in hashed order."""
    buckets = max(1, math.isqrt(max(n_docs, 1)))
    placed = sized.withColumn("_order", F.xxhash64(F.lit(7), doc, "_text_key")).withColumn(
        "_bucket", F.pmod("_order", F.lit(buckets))
    )
    sums = placed.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    before = sums.select(
        F.col("source").alias("_source"),
        F.col("_bucket").alias("_at"),
        (F.sum("_sum").over(Window.partitionBy("source").orderBy("_bucket")) - F.col("_sum")).alias("_before"),
    )
    within = Window.partitionBy("source", "_bucket").orderBy("_order", doc, "_text_key").rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumn("_upto", F.sum("size").over(within))
        .join(before, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_bucket") == F.col("_at")))
        .withColumn("start", F.col("_before") + F.col("_upto") - F.col("size"))
        .drop("_order", "_bucket", "_upto", "_source", "_at", "_before")
    )


def sized_rows(docs: DataFrame, doc: str, text: str, source: str) -> DataFrame:
    """doc, _text_key, source, size: written, as several steps read it."""
    return cut(
        docs.select(
            F.col(doc).alias("doc"), F.xxhash64(text).alias("_text_key"), F.col(source).cast("string").alias("source"), n_words(text).alias("size")
        ),
        "sized",
    )


def source_targets(sized: DataFrame, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    return cut(set_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "targets")


def slot_pieces(sized: DataFrame, targets: DataFrame, most: float, block_words: int) -> DataFrame:
    """slot, source, rank, block, at, doc, _text_key, first, last: the words [first, last) of a document that stand at
    word ``at`` of a slot. Every slot takes the block that its rank comes round to; of blocks taken ``most`` times the
    slots stay empty."""
    n_blocks = F.ceil(F.col("source_size") / block_words)
    blocks = targets.select(F.col("source").alias("_source"), n_blocks.alias("n_blocks"))
    slots = (
        schedule(targets, block_words)
        .join(blocks, F.col("source").eqNullSafe(F.col("_source")))
        .where(F.col("rank") < F.lit(most) * F.col("n_blocks"))
        .select("slot", "rank", F.col("source").alias("_source"), (F.col("rank") % F.col("n_blocks")).alias("_block"))
    )
    placed = laid_out(sized, "doc", sized.count())
    begin = F.greatest(F.col("start"), F.col("block") * block_words)
    pieces = (
        placed.where("size > 0")
        .withColumn("block", F.explode(F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))))
        .select(
            "doc", "_text_key", "source", "block",
            (begin - F.col("block") * block_words).alias("at"),
            (begin - F.col("start")).alias("first"),
            (F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words) - F.col("start")).alias("last"),
        )
    )
    same = F.col("source").eqNullSafe(F.col("_source")) & (F.col("block") == F.col("_block"))
    return pieces.join(slots, same).select("slot", "source", "rank", "block", "at", "doc", "_text_key", "first", "last")


def mix_blocks(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The mix itself, in order: slot, source, rank, block, at, doc, _text_key, first, last (see ``slot_pieces``)."""
    sized = sized_rows(docs, doc, text, source)
    return slot_pieces(sized, source_targets(sized, weights, share, most), most, block_words).orderBy("slot", "at")


def mix(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: doc, _text_key, source, size, source_size, target, taken.

    ``taken`` is how many words the slots of the mix take of the document, repeats counted. It is at most ``most`` times
    the size, a fraction rounded up: a block that the schedule would take more often is not taken again.
    """
    sized = sized_rows(docs, doc, text, source)
    targets = source_targets(sized, weights, share, most)
    blocks = targets.select(F.col("source").alias("_source"), "source_size", "target")
    taken = (
        slot_pieces(sized, targets, most, block_words)
        .groupBy("doc", "_text_key", "source")
        .agg(F.sum(F.col("last") - F.col("first")).alias("_taken"))
    )
    rows = sized.withColumnRenamed("doc", "_doc").withColumnRenamed("source", "_of").withColumnRenamed("_text_key", "_key")
    copies = rows.groupBy("_doc", "_key", "_of").agg(F.first("size").alias("size"), F.count("*").alias("_copies"))
    return (
        copies.join(taken, F.col("_doc").eqNullSafe(F.col("doc")) & F.col("_key").eqNullSafe(F.col("_text_key")) & F.col("_of").eqNullSafe(F.col("source")), "left")
        .join(blocks, F.col("_of").eqNullSafe(F.col("_source")))
        .select(
            F.col("_doc").alias("doc"), F.col("_key").alias("_text_key"), F.col("_of").alias("source"), "size", "source_size", "target",
            F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))).alias("_copy"),
            F.coalesce("_taken", F.lit(0)).alias("_all"), "_copies",
        )
        .withColumn("taken", F.expr("_all div _copies + IF(_copy <= _all % _copies, 1, 0)"))
        .drop("_all", "_copies", "_copy")
    )


def mix_documents(docs: DataFrame, doc: str = "doc_id", text: str = "text", source: str = "source", **how: object) -> DataFrame:
    """The documents that the mix takes words of, with their columns and size, source_size, target and taken."""
    mixed = mix(docs, doc, text, source, **how).where("taken > 0")
    taken = mixed.select(
        F.col("doc").alias("_doc"), F.col("_text_key").alias("_mixed_key"), F.col("source").alias("_source"),
        "size", "source_size", "target", "taken",
    ).groupBy("_doc", "_mixed_key", "_source").agg(
        *[F.max(c).alias(c) for c in ("size", "source_size", "target")], F.sort_array(F.collect_list("taken"), asc=False).alias("_each")
    )
    # rows equal in id, text and source each say what the mix takes of the first of them
    new = ("size", "source_size", "target", "taken")
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in new])
    mine, doc_, key_, of_, size_, source_size_, target_, each_ = spare(kept, "_mine", "_d", "_k", "_s", "_size", "_source_size", "_target", "_each")
    renamed = taken.toDF(doc_, key_, of_, size_, source_size_, target_, each_)
    same = F.col(doc).eqNullSafe(F.col(doc_)) & (F.col(mine) == F.col(key_)) & F.col(source).cast("string").eqNullSafe(F.col(of_))
    return kept.withColumn(mine, F.xxhash64(text)).join(renamed, same).select(
        *columns_of(kept), F.col(size_).alias("size"), F.col(source_size_).alias("source_size"), F.col(target_).alias("target"),
        F.get(each_, F.lit(0)).alias("taken"),
    )
