"""Pack documents into training sequences by vector best-fit.

A document is its token ids and an end id. Only one longer than a sequence is cut; the rest are placed whole. Every
piece is a vector: its tokens, one document, and its attention cost, the square of its length. A sequence has a
capacity in each. Pieces are placed from the longest down; of the open sequences that have room in every component
the one is taken whose residual, as shares of the capacities, lies nearest to the piece (``select="norm"``: the
weighted norm of what would be left, so the tightest fit), or whose residual has the largest weighted dot-product with
it (``select="dot"``: the roomiest where the piece needs most). If none has room, a new sequence is opened.

All components of a piece follow from its length, so pieces of one length are interchangeable and so are sequences
filled alike. The choice is therefore made once per (length, kind of filling) and not per piece: what it needs is the
number of pieces of each length, at most ``length`` rows however large the corpus is. Spark tokenizes, counts, ranks
the pieces of each length, and gives every piece its place by a join on the length.

Defined cases: a NULL text is an empty one and has the end id alone; a NULL id stays NULL; repeated rows are packed
once each; an empty table gives no rows; other columns are neither needed nor touched.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from rillstone.llm.common import cut, whole_text

LENGTH = 2048
END = 0

#: pieces of one length that are ranked in one group
RANKED = 50_000

PIECES = "doc bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def tokenized(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    special: Mapping[str, int] | None = None,
    *,
    length: int = LENGTH,
    end: int = END,
    doc: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: doc, piece, start, length, ids_crc32, and with ``with_ids`` the ids.

    ``vocabulary`` is a file of byte-pair ranks (a base64 token and its id per line) on the driver, ``pattern`` how a
    text is parted before merging, ``special`` the tokens with ids of their own. The file is sent to the tasks once;
    its size does not depend on the data. The first piece of a cut document has what full pieces leave over.
    """
    spark = docs.sparkSession
    ranks, special = spark.sparkContext.broadcast(Path(vocabulary).read_bytes()), dict(special or {})

    def tokenize(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks.value, pattern, special)
        for batch in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for key, value in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.array([*encode(value.as_py()), end], dtype="<u4")
                for number, (start, stop) in enumerate(pieces(len(ids), length)):
                    mine = ids[start:stop]
                    row = (key.as_py(), number, start, stop - start, zlib.crc32(mine.tobytes()), mine.astype("int64") if with_ids else None)
                    for column, v in zip(rows, row, strict=True):
                        column.append(v)
            arrays = [pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())), strict=True)]
            names = ["doc", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(arrays[: 6 if with_ids else 5], names[: 6 if with_ids else 5])

    slim = docs.select(F.col(f"`{doc}`").cast("bigint"), whole_text(f"`{text}`"))
    return slim.mapInArrow(tokenize, PIECES + (", ids array<bigint>" if with_ids else ""))


def encoder(ranks: bytes, pattern: str, special: Mapping[str, int]):
    import base64

    import tiktoken

    pairs = (line.split() for line in ranks.splitlines() if line)
    table = {base64.b64decode(token): int(number) for token, number in pairs}
    own = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens=dict(special))
    if special:
        return lambda value: own.encode(value, allowed_special="all")
    return own.encode_ordinary


def pieces(n: int, length: int) -> list[tuple[int, int]]:
    """(start, stop) of the pieces of ``n`` ids: whole ones of ``length``, before them what is left over."""
    first = n % length
    starts = ([0] if first else []) + list(range(first, n, length))
    return [(s, t) for s, t in zip(starts, [*starts[1:], n], strict=True)]


@dataclass
class Filling:
    """Sequences that are filled alike: what is in them as (length, count), and how many there are."""

    many: int
    held: tuple[tuple[int, int], ...] = field(default_factory=tuple)


def fill(counts: Mapping[int, int], capacity: tuple[float, float, float], weights=(1.0, 1.0, 1.0), select: str = "norm") -> list[Filling]:
    """Place ``counts`` pieces of each length, the longest first.

    Pieces of one length go on filling the sequences of the kind chosen for the first of them: with "norm" each is
    filled as far as it goes before the next (it is nearest still), with "dot" they take one in turn (one that has taken
    a piece has less room than the others). The number of kinds grows by two per length at most.
    """
    cap, weight = np.array(capacity, float), np.array(weights, float)
    room, kinds, done = np.zeros((0, 3)), [], []
    for length in sorted(counts, reverse=True):
        need, left = np.array([length, 1, length * length], float), counts[length]
        if (need > cap).any():
            raise ValueError(f"a piece of {length} tokens is beyond the capacities {capacity}")
        while left:
            fits = np.flatnonzero((room >= need).all(axis=1)) if len(kinds) else []
            if len(fits):
                shares, piece = room[fits] / cap, need / cap
                if select == "norm":
                    best = fits[np.argmin((weight * (shares - piece) ** 2).sum(axis=1))]
                else:
                    best = fits[np.argmax((weight * shares * piece).sum(axis=1))]
                kind, space = kinds[best], room[best].copy()
                room = np.delete(room, best, axis=0)
                del kinds[best]
            else:
                kind, space = Filling(left), cap
            each = int((space // need).min()) if select == "norm" or not kind.held else 1
            whole = min(kind.many, left // each)
            rest = min(left - whole * each, each) if kind.many > whole else 0
            for many, taken in ((whole, each), (1 if rest else 0, rest), (kind.many - whole - (1 if rest else 0), 0)):
                if not many or not (taken or kind.held):
                    continue  # sequences that were never opened
                after, filled = space - taken * need, Filling(many, (*kind.held, (length, taken)) if taken else kind.held)
                if after[0] < 1 or after[1] < 1 or after[2] < 1:
                    done.append(filled)
                else:
                    room, kinds = np.vstack([room, after]), [*kinds, filled]
            left -= whole * each + rest
    return done + kinds


def places(fillings: list[Filling]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, number of sequences, first sequence, first offset) for each run of equal pieces: the
    pieces of that length, from that rank on, take the sequences in turn, and the next round starts behind them."""
    out, next_rank, sequence = [], {}, 0
    for kind in fillings:
        offset = 0
        for length, each in kind.held:
            rank = next_rank.get(length, 0)
            out.append((length, rank, kind.many, sequence, offset))
            next_rank[length] = rank + each * kind.many
            offset += each * length
        sequence += kind.many
    return out


def pack(
    parts: DataFrame,
    *,
    length: int = LENGTH,
    max_docs: int | None = None,
    max_cost: int | None = None,
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
    select: str = "norm",
) -> DataFrame:
    """The pieces (see :func:`tokenized`) with sequence_id and offset.

    ``max_docs`` bounds the pieces of a sequence and ``max_cost`` its attention cost, the sum of squared lengths;
    without them they are what ``length`` allows anyway. Sequences are numbered from 0.
    """
    if select not in ("norm", "dot"):
        raise ValueError(f"select is norm or dot, not {select}")
    spark = parts.sparkSession
    parts = cut(parts, "pieces")
    sizes = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``length`` rows
    planned = places(fill(sizes, (length, max_docs or length, max_cost or length * length), weights, select))
    schema = "length bigint, runs array<struct<rank:bigint,many:bigint,sequence:bigint,offset:bigint>>"
    runs: dict[int, list] = {}
    for size, *run in planned:
        runs.setdefault(size, []).append(tuple(run))
    # as many runs as kinds of filling have lengths: bounded by the capacities, not by the corpus
    plan = spark.createDataFrame(list(runs.items()), schema)

    # rank within the length, in two steps: a length that very many pieces have is dealt out to groups
    groups = max(1, -(-sum(sizes.values()) // RANKED))
    dealt = parts.withColumn("_g", F.pmod(F.xxhash64("doc", "piece"), F.lit(groups)))
    before = dealt.groupBy("length", "_g").agg(F.count("*").alias("_n")).withColumn(
        "_before", F.sum("_n").over(Window.partitionBy("length").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1))
    )
    inside = Window.partitionBy("length", "_g").orderBy("doc", "piece", "ids_crc32")
    ranked = (
        dealt.withColumn("_r", F.row_number().over(inside) - 1)
        .join(before.select("length", "_g", "_before"), ["length", "_g"])
        .withColumn("_rank", F.col("_r") + F.coalesce("_before", F.lit(0)))
    )
    found = F.element_at(F.filter("runs", lambda run: run["rank"] <= F.col("_rank")), -1)
    placed = ranked.join(F.broadcast(plan), "length").withColumn("_run", found).withColumn("_i", F.col("_rank") - F.col("_run.rank"))
    turn = F.floor(F.col("_i") / F.col("_run.many"))
    return placed.select(
        *[F.col(c) for c in parts.columns],
        (F.col("_run.sequence") + F.col("_i") % F.col("_run.many")).cast("bigint").alias("sequence_id"),
        (F.col("_run.offset") + turn * F.col("length")).cast("bigint").alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves, from pieces packed with their ids: sequence_id, ids, and per piece its doc, piece,
    offset and length, so that attention and positions can start anew at each. A sequence has at most ``length`` ids,
    so a group is small."""
    part = F.struct("offset", "length", "doc", "piece", "ids")
    grouped = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(part)).alias("_parts"))
    return grouped.select(
        "sequence_id",
        F.flatten("_parts.ids").alias("ids"),
        F.transform("_parts", lambda p: F.struct(p["doc"].alias("doc"), p["piece"].alias("piece"), p["offset"].alias("offset"), p["length"].alias("length"))).alias("parts"),
    )
