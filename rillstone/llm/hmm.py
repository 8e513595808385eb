"""A hidden Markov language model, trained by Baum-Welch on all training texts and scored by the forward recursion.

Words are counted over the whole training part. The ``OWN`` most frequent words are symbols of the model, the others
are read as one of a few classes (length and kind of the last character), and a word's share within its class comes
from its count. So the model has a bounded size while its counts follow the corpus. Texts become symbols once, in a
written table. Each pass of Baum-Welch is one job: tasks run forward and backward over their texts and return expected
counts, which are summed by symbol. A long text is worked on in stretches that know, by one matrix per stretch, what the
rest of the text says about their ends, so its counts are those of the whole text.

NULL texts count as empty: one end token. A NULL id hashes like an empty one. Rows equal in id and text are scored
alike, each on its own row. Empty tables give an empty result; with no training text every word is unseen.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from rillstone.llm.common import cut, row_key

STATES, PASSES = 6, 3
#: how likely a state goes on before training
GO_ON = 0.95
#: words that are symbols of the model, and words whose count travels with the tasks; both bounds on what is sent
OWN, KNOWN = 8_192, 262_144
#: the words of a task that are counted at once, the tokens that wait to be worked on together, those that are worked on
#: together, and the stretches that long texts are worked on in; none of them changes a result
COUNT_AT_ONCE, WAITING, TRAIN_AT_ONCE, STRETCH = 200_000, 4_000_000, 400_000, 2_048
#: the part that is held out
FOLDS, HELD_OUT = 7, 2
END = b""
N_CLASSES = 24
#: a symbol, as it is written
SYMBOL = np.dtype("<u2")


def tokens(text: str | None) -> list[bytes]:
    return [*(text or "").encode().lower().split(), END]


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS == HELD_OUT


def word_class(word: bytes) -> int:
    size, last = len(word), word[-1]
    length = 0 if size <= 3 else 1 if size <= 5 else 2 if size <= 7 else 3 if size <= 9 else 4 if size <= 12 else 5
    kind = 0 if 97 <= last <= 122 else 1 if 48 <= last <= 57 else 2 if last >= 128 else 3
    return length * 4 + kind


@dataclass
class Vocabulary:
    """Counts of the frequent words, symbol numbers of the most frequent, totals of the rest by class."""

    known: dict[bytes, int]
    n_tokens: int
    n_words: int
    class_tokens: np.ndarray
    class_words: np.ndarray
    own: dict[bytes, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.own:
            return
        ranked = sorted(self.known, key=lambda w: (-self.known[w], w))
        self.own = {w: i for i, w in enumerate([END, *[w for w in ranked if w != END][: OWN - 1]])}

    @property
    def n_symbols(self) -> int:
        return len(self.own) + N_CLASSES

    def symbol(self, word: bytes) -> int:
        own = self.own.get(word)
        return len(self.own) + word_class(word) if own is None else own

    def in_class(self, count: int, of: int) -> float:
        """log10 of a word's share of its class, one being kept for words that were never seen."""
        return float(np.log10(count + 1) - np.log10(self.class_tokens[of] + self.class_words[of] + 1))


class Symbols(dict):
    """Words to symbols, filled as words turn up; emptied when it grows, so it stays bounded."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        super().__init__(vocabulary.own)
        self.vocabulary = vocabulary

    def __missing__(self, word: bytes) -> int:
        symbol = len(self.vocabulary.own) + word_class(word)
        if len(self) < 500_000:
            self[word] = symbol
        return symbol

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), SYMBOL, len(words))


def count_words(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """word (binary; empty: end), c: counts over the training texts, summed in the tasks before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def rows() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays(
                [pa.array(list(seen.keys()), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "c"]
            )
            seen.clear()
            return batch

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for doc_id, body in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if not held_out(doc_id):
                        seen.update(tokens(body))
                if len(seen) > COUNT_AT_ONCE:
                    yield rows()
        yield rows()

    counted = docs.select(F.col(doc).cast("bigint"), F.col(text).cast("string")).mapInArrow(run, "word binary, c bigint")
    return counted.groupBy("word").agg(F.sum("c").alias("c"))


def learn_vocabulary(counts: DataFrame, own: int = OWN, known: int = KNOWN) -> Vocabulary:
    """What the tasks need of the counts. At most ``known`` words are brought to the driver: those above a count
    that a histogram of counts gives."""
    n, v = counts.agg(F.sum("c"), F.count("*")).first()
    bins = counts.groupBy(F.floor(8 * F.log2("c")).alias("bin")).count().collect()  # at most 8 * 64 rows
    least, total = None, 0
    for bin_, many in sorted(bins, reverse=True):
        total += many
        if total > known:
            break
        least = bin_
    frequent = counts.where(F.floor(8 * F.log2("c")) >= least) if least is not None else counts.limit(0)
    vocabulary = Vocabulary({bytes(w): c for w, c in frequent.collect()}, n or 0, v, np.zeros(N_CLASSES), np.zeros(N_CLASSES))
    mine = vocabulary.own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(word_class(w), c) for w, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if w not in mine]
            cls = np.array([x[0] for x in got], np.int64)
            sums = np.bincount(cls, [x[1] for x in got], N_CLASSES) if got else np.zeros(N_CLASSES)
            words = np.bincount(cls, minlength=N_CLASSES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(N_CLASSES)), pa.array(sums.astype(np.int64)), pa.array(words.astype(np.int64))], names=["cls", "c", "words"]
            )

    for cls, c, words in (
        counts.mapInArrow(run, "cls bigint, c bigint, words bigint").groupBy("cls").agg(F.sum("c"), F.sum("words")).collect()
    ):
        vocabulary.class_tokens[cls], vocabulary.class_words[cls] = c, words
    return vocabulary


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # symbols x states


def first_model(vocabulary: Vocabulary, states: int) -> Model:
    """Shares of the symbols, made unequal between the states by fixed pseudo-random numbers. A state mostly goes on:
    if it did not, the states would start so alike that training leaves them so."""
    noise = np.random.default_rng(11)
    share = np.zeros(vocabulary.n_symbols)
    for word, symbol in vocabulary.own.items():
        share[symbol] = vocabulary.known.get(word, 0)
    share[len(vocabulary.own) :] = vocabulary.class_tokens
    emit = (share + 0.1)[:, None] * np.exp(noise.standard_normal((len(share), states)))
    move = (1 - GO_ON) / states + GO_ON * np.eye(states)
    return Model(np.full(states, 1 / states), move, emit / emit.sum(0))


def by_time(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For sequences sorted by falling length and laid end to end: the order that takes first all first tokens, then
    all second ones and so on; and how many sequences have a token at each time."""
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    active = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(lengths[0]), "right")
    rows = np.arange(active.sum()) - np.repeat(np.cumsum(active) - active, active)
    return starts[rows] + np.repeat(np.arange(lengths[0]), active), active


@dataclass
class Stretches:
    """Texts cut into stretches, with what a stretch must know of the rest of its text: how likely the states are at
    its first token given all before it, and how likely all behind it is given the state there. Texts of one
    stretch know that anyway; for the others a stretch is summed up by one matrix, and the matrices are chained."""

    parts: list[np.ndarray]
    owner: np.ndarray
    first: np.ndarray
    before: np.ndarray
    behind: np.ndarray

    @classmethod
    def of(cls, model: Model, sequences: list[np.ndarray], stretch: int) -> Stretches:
        counts = np.array([-(-len(s) // stretch) for s in sequences])
        parts = [s[i : i + stretch] for s in sequences for i in range(0, len(s), stretch)]
        owner, at = np.repeat(np.arange(len(sequences)), counts), np.cumsum(counts) - counts
        first = np.zeros(len(parts), bool)
        first[at] = True
        before = np.tile(model.start, (len(parts), 1))
        behind = np.ones_like(before)
        long = np.flatnonzero(counts[owner] > 1)
        if len(long):
            through = dict(zip(long.tolist(), transfers(model, [parts[i] for i in long]), strict=True))
            for i, n in zip(at[counts > 1].tolist(), counts[counts > 1].tolist(), strict=True):
                for j in range(i, i + n - 1):
                    to = before[j] @ through[j]
                    before[j + 1] = to / to.sum()
                for j in range(i + n - 1, i, -1):
                    back = through[j] @ behind[j]
                    behind[j - 1] = back / back.max()
        return cls(parts, owner, first, before, behind)


def transfers(model: Model, parts: list[np.ndarray]) -> np.ndarray:
    """A matrix for each stretch, up to a factor: from the state at its first token to the state at the token behind it."""
    rank = np.argsort([-len(s) for s in parts], kind="stable")
    order, active = by_time(np.array([len(parts[r]) for r in rank]))
    symbols = np.concatenate([parts[r] for r in rank])[order]
    k = len(model.move)
    through, at = np.tile(np.eye(k), (len(parts), 1, 1)), 0
    for n in active:
        now = (through[:n] * model.emit[symbols[at : at + n], None]).reshape(-1, k) @ model.move
        through[:n] = now.reshape(n, k, k) / now.reshape(n, -1).sum(1)[:, None, None]
        at += n
    out = np.empty_like(through)
    out[rank] = through
    return out


def expected_counts(
    model: Model, sequences: list[np.ndarray], stretch: int = STRETCH, at_once: int = TRAIN_AT_ONCE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Expected symbol, transition and start counts of whole texts: scaled forward and backward, many stretches at once."""
    cut_up, k = Stretches.of(model, sequences, stretch), len(model.move)
    emitted, moved, started = np.zeros_like(model.emit), np.zeros_like(model.move), np.zeros(k)
    one = np.ones(k)
    for chosen in chunks(cut_up.parts, at_once):
        lengths = np.array([len(cut_up.parts[i]) for i in chosen])
        order, active = by_time(lengths)
        symbols = np.concatenate([cut_up.parts[i] for i in chosen])[order]
        emit, move = model.emit[symbols], model.move
        offsets = np.concatenate(([0], np.cumsum(active))).tolist()
        alpha, scale = np.empty_like(emit), np.empty((len(symbols), 1))
        before, behind = cut_up.before[chosen], cut_up.behind[chosen]
        for a, b in zip(offsets, offsets[1:], strict=False):
            now = emit[a:b] * before[: b - a]
            scale[a:b, 0] = now @ one
            now /= scale[a:b]
            alpha[a:b] = now
            before = now @ move
        # a last token's look ahead, and the step across to the next stretch of the same text, if there is one
        last = np.searchsorted(-active, -np.arange(1, len(chosen) + 1), "right") - 1
        at_end = alpha[np.array(offsets)[last] + np.arange(len(chosen))]
        ends = behind @ move.T
        weight = (at_end * ends) @ one
        ends /= weight[:, None]
        goes_on = np.array([i + 1 < len(cut_up.first) and not cut_up.first[i + 1] for i in chosen])
        across = at_end[goes_on].T @ (behind[goes_on] / weight[goes_on, None])
        emit /= scale
        beta, gamma = ends[: active[-1]], np.empty_like(alpha)
        ahead = np.empty_like(alpha)
        gamma[offsets[-2] :] = alpha[offsets[-2] :] * beta
        for t in range(len(active) - 2, -1, -1):
            a, b, c = offsets[t : t + 3]
            now = np.multiply(emit[b:c], beta, out=ahead[b:c])
            beta = now @ move.T
            if c - b < b - a:
                beta = np.concatenate((beta, ends[c - b : b - a]))
            np.multiply(alpha[a:b], beta, out=gamma[a:b])
        # the token before one is as many rows back as there were sequences at the time before
        later = np.arange(active[0], len(symbols))
        within = alpha[later - np.repeat(active[:-1], active[1:])].T @ ahead[active[0] :]
        for state in range(k):
            emitted[:, state] += np.bincount(symbols, gamma[:, state], len(model.emit))
        moved += (within + across) * move
        started += gamma[: active[0]][cut_up.first[chosen]].sum(0)
    return emitted, moved, started


def log10_likelihood(model: Model, sequences: list[np.ndarray], stretch: int = STRETCH, at_once: int = TRAIN_AT_ONCE) -> np.ndarray:
    """log10 of each text's probability: the scaled forward recursion, kept for one time only."""
    cut_up, one, total = Stretches.of(model, sequences, stretch), np.ones(len(model.move)), np.zeros(len(sequences))
    for chosen in chunks(cut_up.parts, at_once):
        lengths = np.array([len(cut_up.parts[i]) for i in chosen])
        order, active = by_time(lengths)
        symbols = np.concatenate([cut_up.parts[i] for i in chosen])[order]
        emit, scale, before, at = model.emit[symbols], np.empty(len(symbols)), cut_up.before[chosen], 0
        for n in active.tolist():
            now = emit[at : at + n] * before[:n]
            scale[at : at + n] = now @ one
            now /= scale[at : at + n, None]
            before, at = now @ model.move, at + n
        by_stretch = np.arange(len(symbols)) - np.repeat(np.cumsum(active) - active, active)
        found = np.bincount(by_stretch, np.log10(scale), len(chosen))
        total += np.bincount(cut_up.owner[chosen], found, len(sequences))
    return total


def chunks(parts: list[np.ndarray], most: int) -> Iterator[np.ndarray]:
    """The numbers of the parts, longest first, in groups of about ``most`` tokens."""
    sizes = np.array([len(p) for p in parts])
    order = np.argsort(-sizes, kind="stable")
    group = (np.cumsum(sizes[order]) - sizes[order]) // most
    yield from np.split(order, np.flatnonzero(np.diff(group)) + 1)


ENCODED = (
    "doc_id bigint, key bigint, held_out boolean, sequence binary, n_known bigint, base double, rest double, word binary, n bigint"
)


def encode_texts(docs: DataFrame, vocabulary: Vocabulary, doc: str, text: str) -> DataFrame:
    """Every text as the numbers of its symbols (two bytes each), read by all passes and by the scoring.

    A text's row has what the words whose count the tasks have add to its scores: base, and rest for those within a
    class. Words beyond those have a row (key, word, n) of their own, for a join to the counts.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vars(vocabulary))  # bounded by OWN and KNOWN

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(**sent.value)
        symbols, known, n_own = Symbols(vocabulary), vocabulary.known, len(vocabulary.own)
        log_all = math.log10(vocabulary.n_tokens + vocabulary.n_words + 1)
        log_class = np.log10(vocabulary.class_tokens + vocabulary.class_words + 1).tolist()
        own_counts = np.array([known.get(word, 0) for word in vocabulary.own])
        own_logs, own_known = np.log10(own_counts + 1), own_counts > 0
        fields = [pa.field(*f.split(" ")) for f in ENCODED.replace("bigint", "int64").replace("boolean", "bool").split(", ")]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                out: list[tuple] = []
                for doc_id, key, body in zip(*[c.to_pylist() for c in batch.slice(at, 256).columns], strict=True):
                    words = tokens(body)
                    sequence = symbols.of(words)
                    mine = sequence[sequence < n_own]
                    n_known, rest = int(own_known[mine].sum()), 0.0
                    base = float(own_logs[mine].sum()) - log_all * len(sequence)
                    for word, n in Counter(words[i] for i in np.flatnonzero(sequence >= n_own).tolist()).items():
                        rest -= n * log_class[symbols[word] - n_own]
                        c = known.get(word)
                        if c is None:
                            out.append((None, key, None, None, None, None, None, word, n))
                        else:
                            n_known, log_c = n_known + n, n * math.log10(c + 1)
                            base, rest = base + log_c, rest + log_c
                    out.append((doc_id, key, held_out(doc_id), sequence.tobytes(), n_known, base, rest, None, None))
                columns = [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), fields, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    rows = docs.select(F.col(doc).cast("bigint").alias("doc"), row_key(doc, text).alias("key"), F.col(text).cast("string").alias("text"))
    return cut(rows.mapInArrow(run, ENCODED), "encoded")


def waiting(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[list[tuple], list[np.ndarray]]]:
    """Rows and their sequences, the last column, in lists of about ``most`` tokens: a step of the recursion serves all of them."""
    rows: list[tuple] = []
    sequences: list[np.ndarray] = []
    total = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for *row, sequence in zip(*[c.to_pylist() for c in batch.slice(at, 256).columns], strict=True):
                rows.append(tuple(row))
                sequences.append(np.frombuffer(sequence, SYMBOL))
                total += len(sequences[-1])
            if total >= most:
                yield rows, sequences
                rows, sequences, total = [], [], 0
    if rows:
        yield rows, sequences


def train(encoded: DataFrame, vocabulary: Vocabulary, states: int = STATES, passes: int = PASSES) -> Model:
    """Baum-Welch over all training texts, each a sequence from its first token to its end, however long."""
    model = first_model(vocabulary, states)
    spark: SparkSession = encoded.sparkSession
    rows = encoded.where("word IS NULL AND NOT held_out").select("sequence")
    for _ in range(passes):
        sent = spark.sparkContext.broadcast(vars(model))  # bounded by OWN and the states

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            model, total = Model(**sent.value), None
            for _, sequences in waiting(batches, WAITING):
                got = expected_counts(model, sequences)
                total = got if total is None else tuple(a + b for a, b in zip(total, got, strict=True))
            if total is not None:
                emitted, moved, started = total
                used = np.flatnonzero(emitted.sum(1) > 0)
                index = [*used.tolist(), *range(-1, -1 - len(moved), -1), -1 - len(moved)]
                values = [*emitted[used].tolist(), *moved.tolist(), started.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(index, pa.int64()), pa.array(values, pa.list_(pa.float64()))], names=["at", "v"])

        summed = (
            rows.mapInArrow(run, "at bigint, v array<double>")
            .groupBy("at")
            .agg(F.array(*[F.sum(F.get("v", F.lit(k))) for k in range(states)]).alias("v"))
            .collect()  # a row per symbol and state
        )
        emit, move, start = np.zeros_like(model.emit), np.zeros_like(model.move), np.zeros(states)
        for at, v in summed:
            if at >= 0:
                emit[at] = v
            elif at >= -states:
                move[-1 - at] = v
            else:
                start[:] = v
        emit += 0.01 * model.emit.mean(1, keepdims=True) * max(1.0, emit.sum() / 1e4) + 1e-9  # nothing gets probability 0
        model = Model((start + 1) / (start + 1).sum(), (move + 1) / (move + 1).sum(1, keepdims=True), emit / emit.sum(0))
        sent.unpersist()
    return model


SCORED = "doc_id bigint, key bigint, n_tokens bigint, n_known bigint, base double, score double"


def score_texts(encoded: DataFrame, counts: DataFrame, vocabulary: Vocabulary, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Words whose count the tasks had are scored with the text; the others are summed up per text and joined to the counts.
    """
    sent = encoded.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**sent.value)
        for rows, sequences in waiting(batches, WAITING):
            doc_id, key, n_known, base, rest = (list(c) for c in zip(*rows, strict=True))
            columns = [
                pa.array(doc_id, pa.int64()),
                pa.array(key, pa.int64()),
                pa.array([len(s) for s in sequences], pa.int64()),
                pa.array(n_known, pa.int64()),
                pa.array(base, pa.float64()),
                pa.array(log10_likelihood(model, sequences) + np.array(rest), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split(" ")[0] for c in SCORED.split(", ")])

    texts = cut(
        encoded.where("word IS NULL").select("doc_id", "key", "n_known", "base", "rest", "sequence").mapInArrow(run, SCORED), "scored"
    )
    rare = (
        encoded.where("word IS NOT NULL")
        .select("key", "word", "n")
        .join(counts, "word")
        .groupBy("key")
        .agg(F.sum("n").alias("rare_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("rare_log"))
    )
    copies = texts.groupBy("key").agg(F.count("*").alias("copies"))  # copies have added up in the sums of their key
    extra = rare.join(copies, "key").select(
        "key", (F.col("rare_known") / F.col("copies")).cast("bigint").alias("rare_known"), (F.col("rare_log") / F.col("copies")).alias("rare_log")
    )
    zero = F.lit(0.0)
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % FOLDS
    return texts.join(extra, "key", "left").select(
        "doc_id",
        (fold == HELD_OUT).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.n_tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_log", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("rare_log", zero)).alias("score"),
    )


def language_model(docs: DataFrame, doc: str = "doc_id", text: str = "text", states: int = STATES, passes: int = PASSES) -> DataFrame:
    """Count, encode, train and score; texts are read twice, their symbols by every pass."""
    counts = cut(count_words(docs, doc, text), "counts")
    vocabulary = learn_vocabulary(counts)
    encoded = encode_texts(docs, vocabulary, doc, text)
    model = train(encoded, vocabulary, states, passes)
    return score_texts(encoded, counts, vocabulary, model)
