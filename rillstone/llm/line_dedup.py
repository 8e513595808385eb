"""Removal of repeated runs of lines, found by winnowing over line hashes.

Lines with a word are a text's units. From each line on, and up to each line, the shortest run with at least
``LEAST_WORDS`` words is a window. The line with the least hash in a window is its fingerprint, so equal windows have
equal fingerprints, and neighbouring windows mostly share one. Fingerprints that occur at one place only are dropped;
at the others the windows around them extend the match both ways, and all but the first place of a window are repeats.
A line with ``LEAST_WORDS`` words is a window of its own, so a line of boilerplate goes wherever it stands; shorter
lines go as part of a run only.

So a line goes exactly if it is part of a run of lines, with ``LEAST_WORDS`` words or more, that also starts earlier:
in a document with a smaller id, or in the same one before. Rows equal in id and text are one document; where an id
repeats, the text's hash orders its texts. NULL ids come first, NULL texts have no lines and stay. Lines without a
word stay. Empty tables give empty results, other columns are kept. Runs are compared by 64-bit hashes of their lines.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from rillstone.llm.common import columns_of, cut, marked, row_key, spare

LEAST_WORDS = 5

POINT = "print bigint, doc bigint, key bigint, windows array<struct<run:bigint,start:int,end:int>>"
WINDOWS = pa.list_(pa.struct([("run", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))


def windows_of(words: list[int], least: int) -> list[tuple[int, int]]:
    """(first unit, last unit) of the shortest runs with ``least`` words that start, or end, at each unit."""
    found, end, total = set(), 0, 0
    for start in range(len(words)):
        while end < len(words) and total < least:
            total += words[end]
            end += 1
        if total < least:
            break
        found.add((start, end - 1))
        total -= words[start]
    start, total = 0, 0
    for end in range(len(words)):
        total += words[end]
        while total - words[start] >= least:
            total -= words[start]
            start += 1
        if total >= least:
            found.add((start, end))
    return sorted(found)


def fingerprints(text: str | None, least: int) -> dict[int, list[dict]]:
    """Fingerprint hash -> its windows: hash of the run, first line, line after the last."""
    places, words, hashes = [], [], []
    for at, line in enumerate((text or "").encode().split(b"\n")):
        n = len(line.split())
        if n:
            places.append(at)
            words.append(n)
            hashes.append(xxhash.xxh64_intdigest(line))
    out: dict[int, list[dict]] = {}
    for first, last in windows_of(words, least):
        run = hashes[first : last + 1]
        digest = xxhash.xxh64_intdigest(b"".join(h.to_bytes(8, "little") for h in run))
        out.setdefault(min(run), []).append(
            {"run": digest - (1 << 63), "start": places[first], "end": places[last] + 1}
        )
    return out


def points(docs: DataFrame, least: int) -> DataFrame:
    """A row per fingerprint of a document (doc, key, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = [
                    (value - (1 << 63), doc, key, windows)
                    for doc, key, text in zip(*[part.column(i).to_pylist() for i in range(3)], strict=True)
                    for value, windows in fingerprints(text, least).items()
                ]
                columns = zip(*rows, strict=True) if rows else [()] * 4
                types = [pa.int64()] * 3 + [WINDOWS]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["print", "doc", "key", "windows"])

    return docs.mapInArrow(run, POINT)


def repeated_lines(docs: DataFrame, doc: str = "doc_id", text: str = "text", least: int = LEAST_WORDS) -> DataFrame:
    """doc, key, runs: per document the (start, end) line numbers of its runs that occur earlier."""
    rows = docs.select(F.col(doc).cast("bigint").alias("doc"), row_key(doc, text).alias("key"), F.col(text).cast("string").alias("text"))
    found = cut(points(rows, least), "fingerprints")
    # a fingerprint of one place may still be that of two equal windows there, if its line repeats
    shared = found.groupBy("print").agg(F.sum(F.size("windows")).alias("_n")).where("_n > 1").select(F.col("print").alias("_print"))
    # written, so that both sides of the join are shuffled as they are and the key of a very common line can be split
    shared = cut(shared, "shared")
    extended = found.join(shared, F.col("print") == F.col("_print")).select("doc", "key", F.explode("windows").alias("w"))
    places = extended.select(F.col("w.run").alias("run"), "doc", "key", F.col("w.start").alias("start"), F.col("w.end").alias("end"))
    first = places.groupBy("run").agg(F.min(F.struct("doc", "key", "start")).alias("first"), F.count("*").alias("_n")).where("_n > 1")
    later = places.join(cut(first, "first").withColumnRenamed("run", "_run"), F.col("run") == F.col("_run")).where(F.struct("doc", "key", "start") > F.col("first"))
    return later.groupBy("doc", "key").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("runs"))


def line_mask(n_lines: int, runs: list[dict]) -> bytearray:
    """1 for each line that goes."""
    gone = bytearray(n_lines)
    done = 0
    for run in runs:  # by start
        gone[max(run["start"], done) : run["end"]] = b"\1" * max(0, run["end"] - max(run["start"], done))
        done = max(done, run["end"])
    return gone


def drop_repeated_lines(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", least: int = LEAST_WORDS, emptied: bool = True, count: str | None = None
) -> DataFrame:
    """The documents with their columns and without repeated runs. ``emptied``: whether texts stay of which no word is
    left. ``count`` names a new column for the number of removed lines."""
    runs = repeated_lines(docs, doc, text, least)
    names = docs.columns
    place = names.index(text)
    joined, more = marked(docs.withColumn(text, F.col(text).cast("string")), runs, doc, text, "left", "runs")
    gone_name = spare(joined, "_gone")[0]
    kept = joined.withColumn(gone_name, F.lit(0).cast("bigint"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, removed, keep = batch.column(place).to_pylist(), [0] * batch.num_rows, [True] * batch.num_rows
            touched = batch.column(len(names)).is_valid().to_pylist()
            for i in range(batch.num_rows):
                if not touched[i]:
                    continue
                lines = texts[i].split("\n")
                mask = line_mask(len(lines), batch.column(len(names))[i].as_py())
                left = [line for line, g in zip(lines, mask, strict=True) if not g or not line.encode().split()]
                texts[i], removed[i] = "\n".join(left), len(lines) - len(left)
                keep[i] = emptied or bool(texts[i].encode().split())
            columns = [batch.column(j) for j in range(len(names))]
            columns[place] = pa.array(texts, pa.string())
            out = pa.RecordBatch.from_arrays([*columns, batch.column(len(names)), pa.array(removed, pa.int64())], names=batch.schema.names)
            yield out.filter(pa.array(keep))

    done = kept.mapInArrow(run, kept.schema)
    return done.select(*columns_of(docs), *([F.col(gone_name).alias(count)] if count else []))
