"""Removal of long repeated substrings with merged Burrows-Wheeler transforms.

Every byte that is covered by a ``LONG``-byte string which also starts earlier goes. All windows of that length are
dealt out by a value that only their content decides: the least hash of their ``GRAM``-byte substrings. Windows in a
row that have the same least hash stay together as one stretch of text, so equal windows always meet, and a
window's text is stored a few times instead of ``LONG`` times. Stretches that are equal as a whole need no search: all but the
first go. What is left, different stretches with one
least hash and stretches that repeat their own least hash, is searched in buckets of bounded size: the
stretches of a bucket are shards with a Burrows-Wheeler transform each, and their interleave is refined step by step,
two bytes at a time, until strings that still share a block agree in ``LONG`` bytes.

Places are ordered by id, then by the text's hash where an id repeats, then by byte. Rows equal in id and text are one
document. NULL texts count as empty, NULL ids as the smallest. Texts shorter than ``LONG`` are left as they are.
Texts of any length are read in pieces; empty tables give empty results; other columns are dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rillstone.llm.common import cut, mix64, row_key

LONG, GRAM = 100, 32
#: bytes of a text looked at together; stretches of one least hash up to which they stay together; bytes of a bucket
PIECE, CROWD, BUCKET = 1 << 20, 2_000, 4 << 20
#: stretches that a task remembers, to send a common one once
REMEMBERED = 200_000
NO_ID = -(1 << 63)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of each substring of ``size`` bytes, a power of two: halves are hashed first."""
    h = mix64(data.astype(np.uint64) + np.uint64(1))
    width = 1
    while width < size:
        h = mix64(h[:-width] * np.uint64(0xC2B2AE3D27D4EB4F) + h[width:])
        width *= 2
    return h


def window_least(h: np.ndarray, size: int) -> np.ndarray:
    """The least of each ``size`` neighbours."""
    width, least = 1, h
    while width * 2 <= size:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = size - width
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def stretches(data: bytes, long: int, gram: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(least hash, first byte, number of windows) of the stretches of a text, piece by piece. The number is negative
    where the least hash comes more than once in the piece: only then can windows of one stretch be equal."""
    at = 0
    while at + long <= len(data):
        piece = np.frombuffer(data[at : at + PIECE + long - 1], np.uint8)
        hashes, span = gram_hashes(piece, gram), long - gram + 1
        least = window_least(hashes, span)
        # a hash is the least of some window if it equals the greatest of the least hashes of the windows over it
        over = np.concatenate((np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)))
        chosen = np.sort(hashes[~window_least(~over, span) == hashes])
        twice = chosen[1:][chosen[1:] == chosen[:-1]]
        starts = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
        counts = np.diff(np.concatenate((starts, [len(least)])))
        if len(twice):
            counts = np.where(np.isin(least[starts], twice), -counts, counts)
        yield least[starts], starts + at, counts
        at += PIECE


STRETCH = "least bigint, content bigint, at bigint, key bigint, start bigint, n int"


def stretch_rows(docs: DataFrame, long: int, gram: int) -> DataFrame:
    """One row per stretch: least hash, hash of its content, document (at, key), first byte, number of windows
    (negative: they may be equal among themselves).

    A content that the task has already sent from an earlier place comes with no content hash: its windows are
    repeats whatever else there is. So a content that very many texts have is sent by each task only once in a while.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[tuple[int, int], tuple] = {}
        names = [c.split(" ")[0] for c in STRETCH.split(", ")]
        types = [pa.int64()] * 5 + [pa.int32()]
        for batch in batches:
            out: list[list] = [[] for _ in names]

            def flush(out=out) -> pa.RecordBatch:
                done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)
                for c in out:
                    c.clear()
                return done

            for i in range(batch.num_rows):
                doc, key, text = (batch.column(c)[i].as_py() for c in range(3))
                data = (text or "").encode()
                for least, starts, counts in stretches(data, long, gram):
                    keys, contents = [], []
                    for h, a, n in zip(least.tolist(), starts.tolist(), counts.tolist(), strict=True):
                        content = xxhash.xxh64_intdigest(data[a : a + abs(n) + long - 1]) - (1 << 63)
                        place, before = (doc, key, a), sent.get((h, content))
                        if before is not None and before < place:
                            h, content = xxhash.xxh64_intdigest(repr(place)), None  # goes anywhere, no search needs it
                        else:
                            if len(sent) >= REMEMBERED:
                                sent.clear()
                            sent[(h, content)] = place
                        keys.append(h - (1 << 63))
                        contents.append(content)
                    out[0] += keys
                    out[1] += contents
                    out[2] += [doc] * len(contents)
                    out[3] += [key] * len(contents)
                    out[4] += starts.tolist()
                    out[5] += counts.tolist()
                if len(out[0]) > 20_000:
                    yield flush()
            yield flush()

    return docs.mapInArrow(run, STRETCH)


FOUND = "least bigint, at bigint, key bigint, start bigint, n int, repeated boolean"


def repeated_stretches(rows: DataFrame) -> DataFrame:
    """Of the stretches those that are repeats as a whole (repeated), and those that share their least hash with
    different ones and have to be searched. The rows pass as a stream sorted by least hash, content and place."""

    def flagged(rows: pa.RecordBatch, repeated: np.ndarray) -> pa.RecordBatch:
        columns = [*(rows.column(c) for c in (0, 2, 3, 4)), pa.array(np.abs(rows.column(5).to_numpy()))]
        return pa.RecordBatch.from_arrays([*columns, pa.array(repeated)], names=["least", "at", "key", "start", "n", "repeated"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # of the last least hash: itself, its last content, how many contents, and its first row while that is the only one
        last_least = last_content = held = None
        n_before = 0
        for batch in batches:
            known = batch.column(1).is_valid()
            sent_before = batch.filter(batch.column(1).is_null())
            if sent_before.num_rows:
                yield flagged(sent_before, np.ones(sent_before.num_rows, bool))
            batch = batch.filter(known)
            if not batch.num_rows:
                continue
            least, content = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            same_least = np.concatenate(([last_least == least[0]], least[1:] == least[:-1]))
            repeated = same_least & np.concatenate(([last_content == content[0]], content[1:] == content[:-1]))
            group = np.cumsum(~same_least)  # 0 goes on from the batch before
            n_contents = np.bincount(group, ~repeated).astype(int)
            if group[0] == 0:
                n_contents[0] += n_before
                if held is not None and n_contents[0] >= 2:
                    yield held
                    held = None
            if group[-1] > 0:
                held = None
            alike = batch.column(5).to_numpy() < 0
            search = ~repeated & ((n_contents[group] >= 2) | alike)
            rows = flagged(batch, repeated)
            only = np.flatnonzero(~repeated & ~alike & (group == group[-1])) if n_contents[group[-1]] == 1 else []
            if len(only):
                held = rows.slice(int(only[0]), 1)
            yield rows.filter(pa.array(repeated | search))
            last_least, last_content, n_before = int(least[-1]), int(content[-1]), int(n_contents[group[-1]])

    sorted_rows = rows.repartition("least").sortWithinPartitions("least", "content", "at", "key", "start")
    return sorted_rows.mapInArrow(run, FOUND)


PART = "part bigint, at bigint, key bigint, start bigint, content binary, again boolean"


def stretch_texts(docs: DataFrame, wanted: DataFrame, long: int) -> DataFrame:
    """The bytes of stretches, (part, at, key, start, content). Of a crowded least hash single windows are given, and
    parted by their own hash; one that the task has already given from an earlier place only comes as ``again``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[int, tuple] = {}
        names, types = [c.split(" ")[0] for c in PART.split(", ")], [pa.int64()] * 4 + [pa.binary(), pa.bool_()]
        for batch in batches:
            for i in range(batch.num_rows):
                at, key, text, pieces = (batch.column(c)[i].as_py() for c in range(4))
                data, out = (text or "").encode(), []
                for piece in pieces:
                    start, n = piece["start"], piece["n"]
                    if not piece["crowded"]:
                        out.append((piece["least"], at, key, start, data[start : start + n + long - 1], False))
                        continue
                    for a in range(start, start + n):
                        window = data[a : a + long]
                        part, place = xxhash.xxh64_intdigest(window) - (1 << 63), (at, key, a)
                        again = part in sent and sent[part] < place
                        if not again:
                            if len(sent) >= REMEMBERED:
                                sent.clear()
                            sent[part] = place
                        out.append((part, at, key, a, None if again else window, again))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    per_doc = wanted.groupBy("at", "key").agg(F.collect_list(F.struct("least", "start", "n", "crowded")).alias("pieces"))
    joined = docs.join(per_doc.withColumnRenamed("at", "_at").withColumnRenamed("key", "_key"), (F.col("at") == F.col("_at")) & (F.col("key") == F.col("_key")))
    return joined.select("at", "key", "text", "pieces").mapInArrow(run, PART)


class Shard:
    """A shard's transform: its suffixes ordered by their first eight bytes, and for each the two bytes before it. Only
    suffixes with room for the rest of ``long`` bytes to their left take part: no other can become a whole window."""

    def __init__(self, contents: list[bytes], base: int, long: int) -> None:
        text = np.frombuffer(b"".join(contents), np.uint8)
        lengths = np.array([len(c) for c in contents])
        left = np.arange(len(text)) - np.repeat(np.cumsum(lengths) - lengths, lengths)  # bytes before, in its content
        right = np.repeat(lengths, lengths) - left  # bytes from here on
        wide = text.astype(np.uint64)
        prefix = np.zeros(len(text), np.uint64)
        for i in range(8):
            prefix = (prefix << np.uint64(8)) | np.concatenate((wide[i:], np.zeros(min(i, len(wide)), np.uint64)))
        before = np.zeros(len(text), np.uint16)
        before[2:] = (text[:-2].astype(np.uint16) << 8) | text[1:-1]
        rows = np.flatnonzero((right >= 8) & (left >= long - 8))
        rows = rows[np.argsort(prefix[rows], kind="stable")]
        self.order, self.prefix, self.before, self.base = rows + base, prefix[rows], before, base


def merge_shards(shards: list[Shard], long: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (bytes of all shards laid end to end) whose ``long`` bytes occur twice or more, and the number of the
    repeated interval that each belongs to.

    The interleave of the shards starts from their eight-byte prefixes. A step orders it by the two bytes before each
    suffix and keeps the order among equal ones, which is the order of the suffixes two bytes to the left, with two bytes
    more in common inside a block. A suffix alone in its block has no equal, and none to its left has: it drops out.
    """
    order = np.concatenate([s.order for s in shards])
    prefix = np.concatenate([s.prefix for s in shards])
    before = np.concatenate([s.before for s in shards])
    merged = np.argsort(prefix, kind="stable")  # runs that are sorted already are merged
    order, block = order[merged], np.cumsum(np.concatenate(([True], prefix[merged][1:] != prefix[merged][:-1])))
    order, block = repeated_only(order, block)
    for _ in range(8, long, 2):
        symbol = before[order]
        step = np.argsort(symbol, kind="stable")
        order, block, symbol = order[step] - 2, block[step], symbol[step]
        if not len(order):
            break
        block = np.cumsum(np.concatenate(([True], (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1]))))
        order, block = repeated_only(order, block)
    return order, block


def repeated_only(order: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keep = np.bincount(block)[block] >= 2 if len(block) else np.zeros(0, bool)
    return order[keep], block[keep]


def later_windows(contents: list[bytes], docs: np.ndarray, starts: np.ndarray, long: int, shard_bytes: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """(document, first byte) of the windows that also start earlier in the same contents; documents in order."""
    shards, part, size, base = [], [], 0, 0
    for content in contents:
        part.append(content)
        size += len(content)
        if size >= shard_bytes:
            shards.append(Shard(part, base, long))
            base, part, size = base + size, [], 0
    if part:
        shards.append(Shard(part, base, long))
    order, block = merge_shards(shards, long)
    if not len(order):
        return order, order
    lengths = np.array([len(c) for c in contents])
    ends = np.cumsum(lengths)
    owner = np.searchsorted(ends, order, side="right")
    byte = starts[owner] + order - (ends - lengths)[owner]
    by_place = np.lexsort((byte, docs[owner], block))
    block, doc, byte = block[by_place], docs[owner][by_place], byte[by_place]
    first = np.concatenate(([True], block[1:] != block[:-1]))
    # the first place may be there twice, by stretches that overlap: that is no repeat
    lead = np.maximum.accumulate(np.where(first, np.arange(len(block)), 0))
    later = (doc != doc[lead]) | (byte != byte[lead])
    return doc[later], byte[later]


def search_buckets(parts: DataFrame, long: int) -> DataFrame:
    """at, key, start, end of the windows of stretches that also start earlier in another."""
    total = parts.where("NOT again").agg(F.sum(F.octet_length("content"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET))

    def run(frame):
        import pandas as pd

        frame = frame.sort_values(["at", "key", "start"])
        ids = frame.groupby(["at", "key"], sort=True).ngroup().to_numpy()
        doc, byte = later_windows(frame["content"].tolist(), ids, frame["start"].to_numpy(), long)
        firsts = np.unique(ids, return_index=True)[1]
        order = np.lexsort((byte, doc))
        doc, byte = doc[order], byte[order]
        opens = np.concatenate(([True], (doc[1:] != doc[:-1]) | (byte[1:] > byte[:-1] + long))) if len(doc) else np.zeros(0, bool)
        starts = np.flatnonzero(opens)
        ends = np.concatenate((starts[1:], [len(doc)]))[: len(starts)] - 1
        rows = firsts[doc[starts]]
        return pd.DataFrame(
            {"at": frame["at"].to_numpy()[rows], "key": frame["key"].to_numpy()[rows], "start": byte[starts], "end": byte[ends] + long}
        ).astype("int64")

    return (
        parts.where("NOT again")
        .withColumn("bucket", F.pmod(F.xxhash64("part"), F.lit(buckets)))
        .groupBy("bucket")
        .applyInPandas(run, "at bigint, key bigint, start bigint, end bigint")
    )


def repeated_ranges(docs: DataFrame, doc: str = "doc_id", text: str = "text", long: int = LONG, gram: int = GRAM) -> tuple[DataFrame, DataFrame]:
    """The documents as (doc, at, key, text), and (at, key, start, end) of bytes that repeat earlier ones."""
    at = F.coalesce(F.col(doc).cast("bigint"), F.lit(NO_ID))
    ids = docs.groupBy(at.alias("at")).count().agg(F.max("count")).first()[0] or 1
    # where no id repeats, none needs the text's hash beside it
    key = row_key(doc, text) if ids > 1 else F.lit(0).cast("bigint")
    rows = docs.select(F.col(doc).alias("doc"), at.alias("at"), key.alias("key"), F.col(text).cast("string").alias("text"))
    once = rows.select("at", "key", "text")
    if ids > 1:
        once = once.dropDuplicates(["at", "key"])
    found = cut(repeated_stretches(stretch_rows(once, long, gram)), "stretches")
    search = found.where("NOT repeated")
    crowds = search.groupBy("least").agg(F.count("*").alias("_n")).where(F.col("_n") > CROWD)
    wanted = search.join(crowds.select(F.col("least").alias("_least")), F.col("least") == F.col("_least"), "left").withColumn(
        "crowded", F.col("_least").isNotNull()
    )
    parts = cut(stretch_texts(once, wanted, long), "parts")
    whole = found.where("repeated").select("at", "key", "start", (F.col("start") + F.col("n") + (long - 1)).alias("end"))
    again = parts.where("again").select("at", "key", "start", (F.col("start") + long).alias("end"))
    return rows, whole.union(again).union(search_buckets(parts, long))


def union_of(ranges: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs: sorted, overlapping and touching ones joined."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((r["start"], r["end"]) for r in ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


KEPT = "doc bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"


def remove_repeats(docs: DataFrame, doc: str = "doc_id", text: str = "text", long: int = LONG, gram: int = GRAM, digest: bool = False) -> DataFrame:
    """One row per document: doc, n_bytes, n_removed, n_spans, kept (the remaining bytes, or their SHA-256)."""
    rows, ranges = repeated_ranges(docs, doc, text, long, gram)
    per_doc = ranges.groupBy("at", "key").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = [c.split(" ")[0] for c in KEPT.split(", ")], [pa.int64()] * 4 + [pa.binary()]
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part, out = batch.slice(at, 64), []
                for name, body, spans in zip(*[part.column(i).to_pylist() for i in range(3)], strict=True):
                    data, cursor, kept = (body or "").encode(), 0, []
                    runs = union_of(spans or [])
                    for start, end in runs:
                        kept.append(data[cursor:start])
                        cursor = end
                    left = b"".join([*kept, data[cursor:]])
                    out.append((name, len(data), len(data) - len(left), len(runs), hashlib.sha256(left).digest() if digest else left))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

    joined = rows.join(
        per_doc.withColumnRenamed("at", "_at").withColumnRenamed("key", "_key"), (F.col("at") == F.col("_at")) & (F.col("key") == F.col("_key")), "left"
    )
    return joined.select(F.col("doc").cast("bigint"), "text", "ranges").mapInArrow(run, KEPT)
