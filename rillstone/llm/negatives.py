"""Hard negatives by maximum inner product search with coordinate pruning.

Vectors are whole numbers (components times 256, rounded down), so every score is exact. Anchors are a stated part of
the rows (ids divisible by 100) and meet all rows, chunk by chunk: rows are dealt to chunks by a hash of their id,
every anchor goes to every chunk, and a task streams the anchors past one chunk at a time.

Within a chunk vectors stand by decreasing length, cut into buckets, and a bucket keeps one list of its members per
coordinate, sorted by the value of the normalised vectors there. An anchor with threshold t needs from a bucket whose
longest vector has length l a cosine of c = t / (|anchor| l). Buckets with c > 1 can't hold a result, nor can later,
shorter ones. Else, for the coordinates on which the anchor weighs most (its focus), a unit vector at an angle of at
most arccos(c) to the anchor has its value there within cos(arccos(a) -+ arccos(c)), a being the anchor's. These
ranges are found by binary search in the sorted lists; members in the ranges of all focus coordinates are scored
exactly. The threshold rises with the results of the buckets before.

Two passes: the best rows with the anchor's label (positives), then, for each positive, the best rows with other labels
whose scores lie in a window below it (negatives), for which the low end of the lowest window is the first threshold.
Each chunk gives its few best, and a rank over all chunks chooses among those.

Defined cases: rows with a NULL id, label or vector, or with a NULL or non-finite component, take no part. Vectors of
different sizes count as filled up with zeros. Rows equal in id, label and vector are one row; other rows with one id
are rows of their own, but never each other's positives. Ties go to the smaller id. An anchor without positives or negatives
gives no rows. Columns with other names are neither needed nor touched. Components beyond what whole numbers of 64 bits
hold in a score raise an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rillstone.llm.common import cut

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: the window of negative scores, in hundredths of the positive score
LOW, HIGH = 30, 90
ANCHOR_EVERY, RELABEL_EVERY, LABELS = 100, 7, 10

#: rows of a chunk, and rows of a chunk at least where there are fewer chunks than shuffle partitions
CHUNK, LEAST_CHUNK = 32_768, 512
#: vectors of a bucket and coordinates of the focus
BUCKET, FOCUS = 1024, 3

ROWS = "id bigint, label bigint, v array<bigint>"


def quantised(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """id, label, v: the rows that take part, labels noised and components as whole numbers."""
    values = F.col(f"`{vector}`").cast("array<double>")
    usable = ~F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    id_, own = F.col(f"`{vec_id}`").cast("bigint"), F.col(f"`{label}`").cast("bigint")
    noised = F.when(id_ % RELABEL_EVERY == 0, (own + 1) % LABELS).otherwise(own)
    whole = F.transform(values, lambda x: F.floor(x * SCALE))
    return rows.where(id_.isNotNull() & own.isNotNull() & values.isNotNull() & usable).select(id_.alias("id"), noised.alias("label"), whole.alias("v"))


class Bucket:
    """Vectors of similar length, longest first, with sorted coordinate lists that are made when first needed."""

    def __init__(self, vectors: np.ndarray, lengths: np.ndarray):
        self.vectors, self.longest = vectors, lengths[0]
        self.unit = vectors / np.maximum(lengths, 1e-300)[:, None]
        self.lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def coordinate(self, f: int) -> tuple[np.ndarray, np.ndarray]:
        if f not in self.lists:
            order = np.argsort(self.unit[:, f])
            self.lists[f] = order, self.unit[order, f]
        return self.lists[f]

    def candidates(self, anchor: np.ndarray, focus: np.ndarray, cosine: float) -> np.ndarray | slice:
        """Members that can have this cosine with the unit vector ``anchor``."""
        if cosine <= 0:
            return slice(None)
        reach, ranges = np.arccos(min(cosine, 1.0)) + 1e-7, []
        for f in focus:
            angle = np.arccos(np.clip(anchor[f], -1, 1))
            low, high = np.cos(min(angle + reach, np.pi)), np.cos(max(angle - reach, 0.0))
            order, values = self.coordinate(f)
            ranges.append((np.searchsorted(values, low - 1e-9), np.searchsorted(values, high + 1e-9, "right"), order, f, low, high))
        ranges.sort(key=lambda r: r[1] - r[0])
        start, stop, order = ranges[0][:3]
        if stop - start == len(order):
            return slice(None)
        found = order[start:stop]
        for _, _, _, f, low, high in ranges[1:]:
            values = self.unit[found, f]
            found = found[(values >= low - 1e-9) & (values <= high + 1e-9)]
        return found


class Chunk:
    """The rows of a chunk in buckets, either per label or all labels together."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.vectors, self.ids, self.labels = vectors, ids, labels
        self.lengths = np.sqrt((vectors.astype(np.float64) ** 2).sum(axis=1))
        self.made: dict[int | None, list[tuple[np.ndarray, Bucket]]] = {}

    def buckets(self, label: int | None) -> list[tuple[np.ndarray, Bucket]]:
        if label not in self.made:
            rows = np.arange(len(self.ids)) if label is None else np.flatnonzero(self.labels == label)
            rows = rows[np.argsort(-self.lengths[rows], kind="stable")]
            parts = [rows[i : i + BUCKET] for i in range(0, len(rows), BUCKET)]
            self.made[label] = [(p, Bucket(self.vectors[p], self.lengths[p])) for p in parts]
        return self.made[label]


def best(scores: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` different (score, id), by falling score and rising id."""
    if len(scores) > 64 * n and len(np.unique(ids)) == len(ids):
        keep = scores >= np.partition(scores, len(scores) - n)[len(scores) - n]
        scores, ids = scores[keep], ids[keep]
    order = np.lexsort((ids, -scores))
    scores, ids = scores[order], ids[order]
    new = np.ones(len(ids), bool)
    new[1:] = (scores[1:] != scores[:-1]) | (ids[1:] != ids[:-1])
    return scores[new][:n], ids[new][:n]


def search(chunk: Chunk, anchor: np.ndarray, label: int | None, usable, windows: list[tuple[int, int]], n: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each window (low, high) of scores the best ``n`` of the chunk's usable rows in it."""
    length = float(np.sqrt((anchor.astype(np.float64) ** 2).sum()))
    unit = anchor / max(length, 1e-300)
    focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
    none = np.zeros(0, np.int64)
    tops, least = [(none, none)] * len(windows), [low for low, _ in windows]
    for rows, bucket in chunk.buckets(label):
        threshold, reach = min(least), length * bucket.longest
        if threshold > reach * (1 + 1e-9):
            break  # and so in all shorter buckets
        inside = bucket.candidates(unit, focus, threshold / reach * (1 - 1e-9) if reach > 0 else 0.0)
        scores, found = bucket.vectors[inside] @ anchor, rows[inside]
        keep = (scores >= threshold) & usable(found)
        scores, found = scores[keep].astype(np.int64), chunk.ids[found[keep]]
        for w, (_, high) in enumerate(windows):
            fit = (scores >= least[w]) & (scores <= high)
            if fit.any():
                tops[w] = best(np.concatenate([tops[w][0], scores[fit]]), np.concatenate([tops[w][1], found[fit]]), n)
                if len(tops[w][0]) == n:
                    least[w] = int(tops[w][0][-1])
    return tops


def padded(values: pa.ListArray | pa.Array) -> np.ndarray:
    """The vectors as rows of a matrix of doubles where these hold every score exactly, else of 64-bit numbers."""
    sizes = values.value_lengths().to_numpy(zero_copy_only=False)
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def exact(*matrices: np.ndarray) -> list[np.ndarray]:
    """As doubles if no score can leave the whole numbers that these hold, an error if none can be held at all."""
    most = [int(max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))) for m in matrices]
    bound = max(most) ** 2 * max(m.shape[-1] for m in matrices)
    if bound >= 2**63:
        raise ValueError("components too large: a score may not fit a 64-bit number")
    return [m.astype(np.float64 if bound < 2**52 else np.int64) for m in matrices]


def widen(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, max(0, width - matrix.shape[1]))))


def over_chunks(rows: DataFrame, anchors: DataFrame, chunks: int, out: str, visit) -> DataFrame:
    """``visit(chunk, anchor, label, extra)`` for every anchor and chunk, as rows of ``out``.

    Rows and anchors of a chunk come sorted, rows first: a task holds one chunk and streams the anchors past it.
    """
    extra = anchors.schema["extra"].dataType.simpleString()
    here = rows.select(F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int").alias("chunk"), F.lit(0).alias("part"), F.lit(None).cast("bigint").alias("key"), *rows.columns)
    here = here.withColumn("extra", F.lit(None).cast(extra))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk")
    dealt = here.unionByName(anchors.select(everywhere, F.lit(1).alias("part"), "key", "id", "label", "v", "extra"))
    placed = dealt.repartition("chunk").sortWithinPartitions("chunk", "part")
    schema = dealt.sparkSession.createDataFrame([], out).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, chunk = None, [], None
        for batch in batches:
            numbers, parts = batch.column("chunk").to_numpy(), batch.column("part").to_numpy()
            change = np.flatnonzero(np.diff(numbers) | np.diff(parts)) + 1
            for start, stop in zip([0, *change], [*change, len(numbers)], strict=True):
                if start == stop:
                    continue
                piece = batch.slice(start, stop - start)
                if numbers[start] != at:
                    at, held, chunk = numbers[start], [], None
                if parts[start] == 0:
                    held.append(piece)
                    continue
                if chunk is None and held:
                    table = pa.Table.from_batches(held).combine_chunks()
                    chunk, held = (table["id"].to_numpy(), table["label"].to_numpy(), padded(table["v"].combine_chunks())), []
                    built = None
                if chunk is None:
                    continue  # no row fell into this chunk
                asked = padded(piece.column("v"))
                width = max(asked.shape[1], chunk[2].shape[1])
                asked, vectors = exact(widen(asked, width), widen(chunk[2], width))
                if built is None or built.vectors.shape != vectors.shape or built.vectors.dtype != vectors.dtype:
                    built = Chunk(chunk[0], chunk[1], vectors)
                keys, labels, extras = piece.column("key").to_pylist(), piece.column("label").to_pylist(), piece.column("extra").to_pylist()
                ids = piece.column("id").to_pylist()
                results = [visit(built, asked[i], ids[i], labels[i], keys[i], extras[i]) for i in range(len(keys))]
                columns = [np.concatenate(c) for c in zip(*results, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=schema.names)

    return placed.mapInArrow(run, out)


def best_positives(chunk: Chunk, anchor, own_id: int, label: int, key: int, extra) -> list[np.ndarray]:
    never = np.iinfo(np.int64).min
    ((scores, ids),) = search(chunk, anchor, label, lambda rows: chunk.ids[rows] != own_id, [(never, -never - 1)], POSITIVES)
    return [np.full(len(ids), key), ids, scores]


def best_negatives(chunk: Chunk, anchor, own_id: int, label: int, key: int, positives: list[dict]) -> list[np.ndarray]:
    windows = [(-(-LOW * p["score"] // 100), HIGH * p["score"] // 100) for p in positives]
    open_ = [w for w, (low, high) in enumerate(windows) if low <= high]
    if not open_:
        return [np.zeros(0, np.int64)] * 4
    tops = search(chunk, anchor, None, lambda rows: chunk.labels[rows] != label, [windows[w] for w in open_], NEGATIVES)
    many = [len(ids) for _, ids in tops]
    return [
        np.full(sum(many), key),
        np.repeat(np.array(open_, np.int64), many),
        np.concatenate([ids for _, ids in tops]),
        np.concatenate([scores for scores, _ in tops]),
    ]


def first(rows: DataFrame, n: int, group: list[str], rank: str) -> DataFrame:
    """The best ``n`` per group, ranked from 1; all but ``n`` rows a group go in each task before the shuffle."""
    by = Window.partitionBy(*group).orderBy(F.desc("score"), "found")
    return rows.withColumn(rank, F.row_number().over(by)).where(F.col(rank) <= n)


def hard_negatives(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    spark = rows.sparkSession
    stored = cut(quantised(rows, vec_id, vector, label), "vectors")
    n = stored.count()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(1, -(-n // CHUNK), min(partitions, n // LEAST_CHUNK))
    one: Column = F.xxhash64("id", "label", "v").alias("key")
    # the stated query set: rows whose id is divisible by 100, equal ones once
    anchors = stored.where(F.col("id") % ANCHOR_EVERY == 0).distinct().select(one, "id", "label", "v")
    asked = anchors.withColumn("extra", F.lit(None).cast("int"))
    near = over_chunks(stored, asked, chunks, "key bigint, found bigint, score bigint", best_positives)
    chosen = first(near, POSITIVES, ["key"], "place")
    # at most five per anchor, in order of their places
    lists = chosen.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("place", "score", "found"))).alias("extra"))
    paired = cut(anchors.join(lists, "key"), "anchors")
    far = over_chunks(stored, paired, chunks, "key bigint, nth bigint, found bigint, score bigint", best_negatives)
    ranked = first(far, NEGATIVES, ["key", "nth"], "rank")
    named = paired.select(F.col("key").alias("_key"), F.col("id").alias("anchor_id"), F.posexplode("extra").alias("_nth", "_positive"))
    return ranked.join(named, (F.col("key") == F.col("_key")) & (F.col("nth") == F.col("_nth"))).select(
        "anchor_id",
        F.col("_positive.found").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("found").alias("negative_id"),
        F.col("_positive.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
