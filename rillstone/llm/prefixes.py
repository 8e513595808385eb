"""The tree of conversation beginnings, by collapsing whole sequences.

Every conversation starts with turns of its donor and goes on with its own. A sequence of turns is known by its length
and two 64-bit hashes, each the exclusive or of one hash per turn that depends on the turn's place; so the hashes of all
beginnings of a conversation are a running aggregate, and the parent of a beginning is had by taking the last turn's hash
out again. Then:

1. conversations with equal whole sequences become one sequence with a weight, its smallest member and the list of
   those that end there; only that member's beginnings are followed further, so copies cost nothing;
2. sequences that are a proper beginning of another one go by an anti-join: the others are the leaves;
3. beginnings of all sequences are grouped with their weights into nodes;
4. sums over subtrees: each node belongs to the smallest leaf below it, so a leaf owns the lower end of its path. A
   running sum along that end gives what lies below a node on it, and each other leaf below adds all it owns.

A long conversation or a hot first turn is never one group in memory: running aggregates are cut into blocks
(:mod:`rillstone.operators.scan`), everything else is a grouped sum that is combined before the shuffle or a plain
join that adaptive execution can split. The digest of an end list needs its ids in order: they are joined in blocks of
1,024 numbers first, and a task streams over the blocks.

Defined cases: turns are ordered by turn (NULL first), then role and text; a NULL role or text is empty; rows without
a conversation id take no part; equal rows are turns of their own; an empty table gives no nodes; other columns are
neither needed nor touched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rillstone.llm.common import cut, split_words, whole_text
from rillstone.operators.scan import BLOCK_ROWS, Fold, count, scan, total

#: conversations share the beginning of the first of so many ids in a row, of up to three turns
FAMILY, SHARED = 20, 4

KEY = ["depth", "k1", "k2"]


def turns_in_order(rows: DataFrame, conv: str, turn: str, role: str, text: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """conv, pos (from 1), words, and two hashes of role and text."""
    at = F.col(f"`{turn}`").cast("bigint")
    who, said = whole_text(f"`{role}`"), whole_text(f"`{text}`")
    slim = rows.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("bigint").alias("conv"),
        F.coalesce(at, F.lit(-(2**63))).alias("seq"),
        at.isNotNull().alias("known"),
        who.alias("role"),
        said.alias("text"),
        F.size(split_words(said)).cast("bigint").alias("words"),
        F.xxhash64(who, said).alias("t1"),
        F.xxhash64(F.lit("turn"), said, who).alias("t2"),
    )
    numbered = scan(slim, ["conv"], "seq", {"pos": count()}, tie=["known", "role", "text"], block_rows=block_rows)
    return numbered.select("conv", "pos", "words", "t1", "t2")


def shared_turns(conv: Column) -> Column:
    return F.crc32(conv.cast("string")) % SHARED


def donor_of(conv: Column) -> Column:
    return conv - conv % FAMILY


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of every rebuilt conversation with their new places, and (conv, len) of every conversation."""
    sizes = cut(turns.groupBy("conv").agg(F.count("*").alias("n")), "conversation-sizes")
    donors = sizes.where(F.col("conv") % FAMILY == 0).select(F.col("conv").alias("donor"), F.col("n").alias("has"))
    asks = sizes.select("conv", "n", donor_of(F.col("conv")).alias("donor"), shared_turns(F.col("conv")).alias("h"))
    given = F.least("h", F.coalesce("has", F.lit(0)))
    plan = asks.join(donors, "donor", "left").select(
        "conv", "donor", "h", given.alias("given"), (given + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")
    )
    plan = cut(plan, "rebuilt-plan")
    heads = turns.where((F.col("conv") % FAMILY == 0) & (F.col("pos") < SHARED)).withColumnRenamed("conv", "donor")
    lent = heads.join(plan, "donor").where(F.col("pos") <= F.col("given"))
    own = turns.join(plan, "conv").where(F.col("pos") > F.col("h")).withColumn("pos", F.col("pos") - F.col("h") + F.col("given"))
    columns = ["conv", "len", F.col("pos").alias("depth"), "words", F.xxhash64("t1", "t2", "pos").alias("a"), F.xxhash64("pos", "t2", "t1").alias("b")]
    return lent.select(*columns).unionByName(own.select(*columns)), plan.select("conv", "len")


def xor(value: str) -> Fold:
    return Fold(F.col(value), F.bit_xor)


def digests(ends: DataFrame) -> DataFrame:
    """KEY, ends_sha256: of the comma-joined conv of each key in rising order."""
    block = F.shiftright("conv", 10)
    joined = F.array_join(F.transform(F.array_sort(F.collect_set("conv")), lambda c: c.cast("string")), ",")
    lists = ends.groupBy(*KEY, block.alias("block")).agg(joined.alias("ids"))
    placed = lists.repartition(*KEY).sortWithinPartitions(*KEY, "block")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None
        for batch in batches:
            done = []
            for *key, _, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if key != at:
                    if at is not None:
                        done.append((*at, held.hexdigest()))
                    at, held = key, hashlib.sha256(ids.encode())
                else:
                    held.update(b"," + ids.encode())
            yield rows_of(done)
        if at is not None:
            yield rows_of([(*at, held.hexdigest())])

    def rows_of(done: list[tuple]) -> pa.RecordBatch:
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = [pa.array([row[i] for row in done], t) for i, t in enumerate(types)]
        return pa.RecordBatch.from_arrays(columns, names=[*KEY, "ends_sha256"])

    return placed.mapInArrow(digest, "depth bigint, k1 bigint, k2 bigint, ends_sha256 string")


def prefix_tree(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, convs = rebuilt(cut(turns_in_order(rows, conv, turn, role, text, block_rows), "turns"))
    begun = cut(scan(turns, ["conv"], "depth", {"k1": xor("a"), "k2": xor("b")}, block_rows=block_rows), "beginnings")

    zero = F.lit(0).cast("bigint")
    ends = begun.where("depth = len").select("conv", *KEY).union(
        convs.where("len = 0").select("conv", zero, zero, zero)
    )
    sequences = cut(ends.groupBy(*KEY).agg(F.count("*").alias("weight"), F.min("conv").alias("conv")), "sequences")

    # beginnings of one conversation per sequence; the root is the empty one
    paths = begun.join(sequences.select("conv", "weight"), "conv").select(
        "conv", "weight", *KEY, "words", (F.col("depth") < F.col("len")).alias("proper"),
        F.col("k1").bitwiseXOR(F.col("a")).alias("p1"), F.col("k2").bitwiseXOR(F.col("b")).alias("p2"),
    )
    none = F.lit(None).cast("bigint")
    roots = sequences.select("conv", "weight", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("words"),
                             (F.col("depth") > 0).alias("proper"), none.alias("p1"), none.alias("p2"))
    paths = cut(paths.unionByName(roots), "paths")
    leaves = cut(sequences.join(paths.where("proper").select(*KEY).distinct(), KEY, "left_anti").select("conv"), "leaves")

    leaf_paths = paths.join(leaves, "conv", "left_semi").select(*KEY, F.col("conv").alias("leaf"))
    owners = leaf_paths.groupBy(*KEY).agg(F.count("*").alias("n_leaves"), F.min("leaf").alias("owner"))
    nodes = paths.groupBy(*KEY).agg(
        F.min("conv").alias("conv_id"), F.sum("weight").alias("n_convs"), F.max("words").alias("words"), F.max("p1").alias("p1"), F.max("p2").alias("p2")
    )
    nodes = nodes.join(owners, KEY).withColumn("gain", (F.col("n_convs") - 1) * F.col("words")).withColumn("up", -F.col("depth"))
    nodes = cut(scan(nodes, ["owner"], "up", {"below": total("gain")}, block_rows=block_rows), "nodes")

    owned = nodes.groupBy(F.col("owner").alias("leaf")).agg(F.sum("gain").alias("owned"))
    under = leaf_paths.join(owned, "leaf").groupBy(*KEY).agg(F.sum("owned").alias("under"))
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(
        F.count("*").alias("n_children")
    )
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    told = nodes.join(under, KEY).join(children, KEY, "left").join(digests(ends), KEY, "left")
    told = told.join(owned.withColumnRenamed("leaf", "owner"), "owner").join(parents, ["depth", "p1", "p2"], "left")
    return told.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", zero).alias("n_children"),
        "n_leaves",
        (F.col("below") + F.col("under") - F.col("owned")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
