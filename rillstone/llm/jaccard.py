"""Similarity join on word shingles with parity sketches.

A set's shingles are hashed into the blocks of a sketch, and each block keeps the XOR of their hashes. A shingle that
only one of two sets has changes one block, so the number of differing blocks is at most the symmetric difference.
Within a band of sizes that difference has a bound D for any pair that is similar enough; with more than D blocks some
block is equal, and the join is on equal blocks. A finer sketch of single bits, whose Hamming distance is bounded by the
symmetric difference too, sorts out chance pairs, and the sets themselves decide.

Equal sets are one class from the start. Sets that share a block are compared with one of them first; what is linked
by then needs no further comparing, and only members of different components are compared with each other. These
comparisons are made inside tasks, on pieces of bounded size; only pairs that the sketches let pass are rows.
Members of a block with very many, such as texts that share a phrase, meet on their rarest shingles instead.

NULL and empty texts, and texts without words, have an empty set and no links. Rows with one id but different texts
are documents of their own; NULL ids don't name a component unless there is no other id in it. Empty tables give
empty results, other columns are dropped. Sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rillstone.llm.common import bit_field, cut, in_field, marked, mix64, row_key
from rillstone.llm.graph import components

#: the ratio of the sizes within a band
BAND = 1.9
#: bits of the fine sketch per shingle, and members of a piece: a member is moved once for each piece of its block, so a
#: block that is compared as it is has two
BITS, PIECE = 1, 512
#: sets that have a shingle which counts as frequent
OFTEN = 128
#: rows, with a sketch each, that a task compares in one call
TOGETHER = 4_000
#: members up to which a block is compared as it is
CROWD = 1_024


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) >= 300_000:
            self.clear()
        self[word] = value
        return value


def shingles(text: str | None, size: int, memo: WordHashes) -> np.ndarray:
    """The distinct shingle hashes, sorted; a text with fewer words is one shingle."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    span = min(size, len(words))
    rolled = np.full(len(words) - span + 1, span, np.uint64)
    for i in range(span):
        rolled = mix64(rolled + hashes[i : len(words) - span + 1 + i])
    return np.unique(rolled)


def signature(hashes: np.ndarray) -> int:
    """A number for the set; equal for equal sets."""
    both = np.array([np.bitwise_xor.reduce(hashes), mix64(hashes).sum(dtype=np.uint64), len(hashes)], np.uint64)
    return int(xxhash.xxh64_intdigest(both.tobytes())) - (1 << 63)


def bit_sketch(hashes: np.ndarray) -> bytes:
    """One parity bit per hash value; the number of bits, a power of two, depends on the band of the size only in that
    it grows with it, and a larger sketch folds into a smaller one by XOR of its halves."""
    size = 64
    while size < BITS * len(hashes):
        size *= 2
    counts = np.bincount((hashes >> np.uint64(40)).astype(np.int64) % size, minlength=size)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(sketch: bytes, size: int) -> np.ndarray:
    parity = np.frombuffer(sketch, np.uint64)
    while len(parity) > size:
        half = len(parity) // 2
        parity = parity[:half] ^ parity[half:]
    return parity


class Bands:
    """Size bands for a similarity of ``part`` in ``whole``: each set belongs to its band, and to the strip around a
    boundary between bands if a partner may lie on the other side."""

    def __init__(self, part: int, whole: int) -> None:
        self.part, self.whole = part, whole

    def edge(self, band: int) -> int:
        return math.ceil(BAND**band)

    def most_apart(self, a: int, b: int) -> int:
        """The largest symmetric difference of similar sets of these sizes."""
        return (a + b) * (self.whole - self.part) // (self.whole + self.part)

    def of(self, size: int) -> list[tuple[int, int]]:
        """(number of the band or strip, largest symmetric difference in it)."""
        band = max(0, int(math.log(size, BAND)) - 1)
        while self.edge(band + 1) <= size:
            band += 1
        low, high = self.edge(band), self.edge(band + 1)
        out = [(2 * band, self.most_apart(high - 1, high - 1))]
        if size * self.whole >= (high) * self.part:  # a partner may have the next band's first size
            out.append((2 * band + 1, self.across(high)))
        if (low - 1) * self.whole >= size * self.part:
            out.append((2 * band - 1, self.across(low)))
        return [(number, apart) for number, apart in out if apart > 0]

    def across(self, edge: int) -> int:
        return self.most_apart(edge - 1, (edge - 1) * self.whole // self.part)


def block_keys(hashes: np.ndarray, bands: Bands) -> np.ndarray:
    """A number per band, block and XOR of the block's hashes. Blocks without a shingle are left out as long as more
    blocks are left than may differ."""
    keys = []
    for number, apart in bands.of(len(hashes)):
        blocks = apart + 2 + apart // 16
        seed = np.uint64((number + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        mixed = mix64(hashes ^ seed)
        block = ((mixed >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
        order = np.argsort(block.astype(np.int32), kind="stable")
        sorted_blocks = block[order]
        starts = np.flatnonzero(np.concatenate(([True], sorted_blocks[1:] != sorted_blocks[:-1])))
        parity, used = np.bitwise_xor.reduceat(mixed[order], starts), sorted_blocks[starts]
        if len(used) <= apart:
            empty = np.setdiff1d(np.arange(blocks, dtype=np.uint64), used)
            used, parity = np.concatenate((used, empty)), np.concatenate((parity, np.zeros(len(empty), np.uint64)))
        keys.append(mix64(parity ^ mix64(used + seed)))
    return np.concatenate(keys) if keys else np.empty(0, np.uint64)


def per_text(docs: DataFrame, schema: str, make, size: int) -> DataFrame:
    """``make(doc ids, keys, hash sets)`` on every few texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                yield make(part.column(0), part.column(1), [shingles(t, size, memo) for t in part.column(2).to_pylist()])

    return docs.mapInArrow(run, schema)


def describe(rows: DataFrame, size: int) -> DataFrame:
    """doc, key, n, sig, sketch per document."""

    def make(doc: pa.Array, key: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                doc, key,
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([signature(s) if len(s) else None for s in sets], pa.int64()),
                pa.array([bit_sketch(s) if len(s) else None for s in sets], pa.binary()),
            ],
            names=["doc", "key", "n", "sig", "sketch"],
        )

    return per_text(rows, "doc bigint, key bigint, n bigint, sig bigint, sketch binary", make, size)


def block_rows(rows: DataFrame, size: int, part: int, whole: int) -> DataFrame:
    """block, sig: the keys of every set's blocks; equal sets of a few neighbouring texts are given once."""

    def make(doc: pa.Array, key: pa.Array, sets: list[np.ndarray]) -> pa.RecordBatch:
        bands = Bands(part, whole)
        distinct = {signature(s): s for s in sets if len(s)}
        each = [block_keys(s, bands) for s in distinct.values()]
        blocks = np.concatenate(each) if each else np.empty(0, np.uint64)
        sigs = np.repeat(np.array(list(distinct), np.int64), [len(k) for k in each]) if each else np.empty(0, np.int64)
        return pa.RecordBatch.from_arrays([pa.array(blocks.view(np.int64)), pa.array(sigs)], names=["block", "sig"])

    return per_text(rows, "block bigint, sig bigint", make, size)


def sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """sig, hashes of the wanted documents (doc, key, sig). A bit field of the wanted keys sorts out the other texts
    where they are read, so that none but the wanted and a few more are moved to the join, which decides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                sets = [shingles(t, size, memo).view(np.int64) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["sig", "hashes"])

    field = bit_field(wanted.select(F.col("key").alias("hash")))
    likely = docs.where(in_field(F.col("key"), field)) if field else docs
    texts = likely.join(
        wanted.select(F.col("doc").alias("_doc"), F.col("key").alias("_key"), "sig"),
        (F.col("key") == F.col("_key")) & F.col("doc").eqNullSafe(F.col("_doc")),
    )
    return texts.select("sig", "text").mapInArrow(run, "sig bigint, hashes array<bigint>")


def sets_for(docs: DataFrame, known: DataFrame, sigs: DataFrame, size: int) -> DataFrame:
    """The sets of the classes named in ``sigs`` and of no others. The list of them is written first: it is counted, made
    a bit field of and joined, and while it is short it goes to the texts instead of the likely texts to it."""
    wanted = cut(known.join(sigs, "sig").select("first.doc", "first.key", "sig"), "wanted")
    return cut(sets_of(docs, wanted, size), "hashes")


def ends_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("sig")).union(pairs.select(F.col("b").alias("sig"))).distinct()


def near_by_sketch(pairs: DataFrame, facts: DataFrame, part: int, whole: int) -> DataFrame:
    """The pairs (a, b) whose sizes and bit sketches allow the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            keep = [
                sketches_allow(na, x, nb, y, part, whole)
                for na, x, nb, y in zip(rows["na"], rows["xa"], rows["nb"], rows["xb"], strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_a = pairs.join(facts.select(F.col("sig").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("xa")), "a")
    both = with_a.join(facts.select(F.col("sig").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("xb")), "b")
    fits = (F.least("na", "nb") * whole >= F.greatest("na", "nb") * part)
    return both.where(fits).select("a", "b", "na", "xa", "nb", "xb").mapInArrow(run, "a bigint, b bigint")


def sketches_allow(na: int, xa: bytes, nb: int, xb: bytes, part: int, whole: int) -> bool:
    size = min(len(xa), len(xb)) // 8
    differ = int(np.bitwise_count(folded(xa, size) ^ folded(xb, size)).sum())
    return differ <= Bands(part, whole).most_apart(na, nb)


def similar(pairs: DataFrame, sets: DataFrame, part: int, whole: int) -> DataFrame:
    """The pairs whose sets are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                x, y = (np.asarray(batch.column(c)[i].values) for c in (2, 3))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(whole * shared >= part * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_a = pairs.join(sets.select(F.col("sig").alias("a"), F.col("hashes").alias("x")), "a")
    both = with_a.join(sets.select(F.col("sig").alias("b"), F.col("hashes").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def narrowed(members: DataFrame, sets_named: Callable[[DataFrame], DataFrame], part: int, whole: int) -> DataFrame:
    """The members (block, sig, comp), those of blocks with more than ``CROWD`` by their rarest shingles as blocks.
    ``sets_named`` gives the sets of named classes.

    Of two similar sets each has ``part / whole`` of its shingles in common with the other. In any one order of all
    shingles, the first that they share is thus in both among the first ``n - ceil(n * part / whole) + 1``. The order
    goes by how many of the sets have a shingle, so what very many share comes last.
    """
    crowded = cut(
        members.groupBy("block").agg(F.count("*").alias("_n")).where(F.col("_n") > CROWD).select(F.col("block").alias("_block")), "crowded"
    )
    if crowded.isEmpty():
        return members
    same = F.col("block") == F.col("_block")
    wanted = members.join(crowded, same, "leftsemi").select("sig", "comp").distinct()
    each = sets_named(wanted.select("sig").distinct()).join(wanted, "sig").select("sig", "comp", F.size("hashes").alias("n"), F.explode("hashes").alias("hash"))
    often = each.groupBy("hash").agg(F.count("*").alias("_n")).where(F.col("_n") >= OFTEN).select(F.col("hash").alias("_hash"), "_n")
    order = F.sort_array(F.collect_set(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), "hash")))
    first = F.expr(f"n - (n * {part} + {whole - 1}) div {whole} + 1").cast("int")
    rare = cut(
        each.join(cut(often, "often"), F.col("hash") == F.col("_hash"), "left")
        .groupBy("sig", "comp", "n")
        .agg(order.alias("order"))
        .select("sig", "comp", F.explode(F.slice("order", F.lit(1), first)).alias("at"))
        .select(F.col("at.hash").alias("block"), "sig", "comp"),
        "rare",
    )
    open_ = rare.groupBy("block").agg(F.min("comp").alias("_x"), F.max("comp").alias("_y")).where("_x < _y").select("block")
    others = members.join(crowded, same, "leftanti").select("block", "sig", "comp")
    return cut(others.union(rare.join(open_, "block").select("block", "sig", "comp")), "narrowed")


def dealt_out(members: DataFrame) -> DataFrame:
    """group, block, low, high, piece, sig, comp: a row per member (block, sig, comp) and pair of pieces that it is in.

    The members of a block are dealt into pieces of about ``PIECE``. A group gets about ``TOGETHER`` rows, be they of
    many small blocks or of a few pairs of pieces.
    """
    sizes = members.groupBy("block").agg(F.count("*").alias("_n")).withColumn("pieces", F.ceil(F.col("_n") / PIECE).cast("int"))
    n_rows = sizes.agg(F.sum(F.col("_n") * F.col("pieces"))).first()[0] or 0
    groups = max(1, n_rows // TOGETHER)
    return (
        members.join(sizes.drop("_n"), "block")
        .withColumn("piece", F.pmod(F.xxhash64("sig", F.lit(3)), F.col("pieces")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .withColumn("low", F.least("piece", "other"))
        .withColumn("high", F.greatest("piece", "other"))
        .withColumn("group", F.pmod(F.xxhash64("block", "low", "high"), F.lit(groups)))
        .select("group", "block", "low", "high", "piece", "sig", "comp")
    )


def across_components(members: DataFrame, facts: DataFrame, part: int, whole: int) -> DataFrame:
    """Pairs (a, b) of members (block, sig, comp) of one block but different components that the sketches allow. Each
    pair of pieces of a block is compared in one go."""
    dealt = dealt_out(members).join(facts.select("sig", "n", "sketch"), "sig")  # last, so that sketches are moved once

    def run(frame):
        import pandas as pd

        frame = frame.sort_values(["block", "low", "high", "n", "sig"])
        block, low, high, piece, n, sig, comp = (frame[c].to_numpy() for c in ("block", "low", "high", "piece", "n", "sig", "comp"))
        raw, out = frame["sketch"].tolist(), []
        opens = (block[1:] != block[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        starts = np.concatenate(([0], np.flatnonzero(opens) + 1))
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(n)], strict=True):
            if end - start < 2 or (comp[start:end] == comp[start]).all():
                continue
            size = min(map(len, raw[start:end])) // 8
            sketch = np.stack([folded(x, size) for x in raw[start:end]])
            for i in range(start, end - 1):
                to = np.arange(i + 1, start + np.searchsorted(n[start:end], n[i] * whole // part, side="right"))
                to = to[(comp[to] != comp[i]) & ((low[i] == high[i]) | (piece[to] != piece[i]))]
                differ = np.bitwise_count(sketch[to - start] ^ sketch[i - start]).sum(1, dtype=np.int64)
                to = to[differ <= (n[to] + n[i]) * (whole - part) // (whole + part)]
                out += [(min(sig[i], sig[j]), max(sig[i], sig[j])) for j in to]
        return pd.DataFrame(out, columns=["a", "b"]).drop_duplicates().astype("int64")

    return dealt.groupBy("group").applyInPandas(run, "a bigint, b bigint").distinct()


def join_components(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", size: int = 4, part: int = 85, whole: int = 100
) -> DataFrame:
    """doc, key, n, root, component per document: sets of ``size``-word shingles link when ``whole`` times their
    intersection is at least ``part`` times their union; root numbers what is linked
    (NULL without words), component is the smallest id in it."""
    rows = docs.select(F.col(doc).cast("bigint").alias("doc"), row_key(doc, text).alias("key"), F.col(text).cast("string").alias("text"))
    facts = cut(describe(rows, size), "sets")
    classes = facts.where("sig IS NOT NULL").groupBy("sig").agg(
        F.min(F.struct("doc", "key")).alias("first"), F.first("n").alias("n"), F.first("sketch").alias("sketch")
    )
    # blocks that more than one class has; the rows are shuffled once, for the count and for the join back
    blocks = block_rows(rows, size, part, whole).repartition("block")
    shared = blocks.groupBy("block").agg(F.min("sig").alias("_first"), F.max("sig").alias("_last")).where("_first < _last")
    common = cut(blocks.join(shared.select(F.col("block").alias("_block")), F.col("block") == F.col("_block")).select("block", "sig").distinct(), "common")
    # a block's center is the class that meets most others in all its blocks: of a group of near copies, one close to all
    sizes = common.groupBy("block").agg(F.count("*").alias("_n"))
    weights = common.join(sizes, "block").groupBy("sig").agg(F.sum("_n").alias("_w"))
    centers = common.join(weights, "sig").groupBy("block").agg(F.max(F.struct("_w", "sig")).alias("_c")).select(F.col("block").alias("_block"), F.col("_c.sig").alias("center"))
    members = cut(common.join(centers, F.col("block") == F.col("_block")).select("block", "sig", "center"), "members")
    known = cut(classes.join(members.select("sig").distinct(), "sig"), "classes")
    stars = members.where("sig != center").select(F.least("center", "sig").alias("a"), F.greatest("center", "sig").alias("b")).distinct()
    close = cut(near_by_sketch(stars, known, part, whole), "close")

    def sets_named(sigs: DataFrame) -> DataFrame:
        return sets_for(rows, known, sigs, size)

    linked = cut(similar(close, sets_named(ends_of(close)), part, whole), "linked")
    found = cut(components(linked), "found")

    root = F.coalesce("component", F.col("sig"))
    placed = members.where("sig != center").join(found.withColumnRenamed("node", "sig"), "sig", "left").select("block", "sig", root.alias("comp"))
    open_ = placed.groupBy("block").agg(F.min("comp").alias("_x"), F.max("comp").alias("_y")).where("_x < _y").select("block")
    rest = cut(placed.join(open_, "block"), "open")
    near = cut(across_components(narrowed(rest, sets_named, part, whole), known, part, whole), "near")
    more = cut(similar(near, sets_named(ends_of(near)), part, whole), "more")
    final = cut(components(linked.union(more)), "components")

    placed_docs = facts.join(final.withColumnRenamed("node", "sig"), "sig", "left").select("doc", "key", "n", root.alias("root"))
    least = placed_docs.where("root IS NOT NULL").groupBy("root").agg(F.min("doc").alias("component"))
    return placed_docs.join(least.withColumnRenamed("root", "_root"), F.col("root") == F.col("_root"), "left").select(
        "doc", "key", "n", "root", F.coalesce("component", "doc").alias("component")
    )


def keep_one(docs: DataFrame, doc: str = "doc_id", text: str = "text", size: int = 5, part: int = 80, whole: int = 100) -> DataFrame:
    """The documents, with their columns, less all but one of each component of near duplicates: five words and a
    similarity of 0.8, unless given. The smallest id stays; of rows that share it, the least text hash. Documents
    without words are linked with nothing and stay."""
    joined = join_components(docs, doc, text, size, part, whole)
    least = F.min(F.struct(F.col("doc").isNull().alias("unnamed"), "doc", "key"))
    stays = joined.where("n > 0").groupBy("root").agg(least.alias("first")).select("first.doc", "first.key")
    kept = stays.union(joined.where("n = 0").select("doc", "key")).distinct()
    return marked(docs, kept, doc, text, "inner")[0]
