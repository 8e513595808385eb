"""Chat formatting: typed content parts become one template text with placeholders and a loss mask.

A turn is formatted on its own row, wherever it lies; only reading a conversation in order needs its rows in one
place, and there they pass as a sorted stream, so that a conversation of any length takes constant memory.

NULL texts and roles count as empty. Turns with one number are ordered by role, then text; repeated rows are turns
of their own. A NULL conversation id is a conversation. Empty tables give empty results; extra columns are dropped.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

START, CONTENT, END = "<|start|>", "<|content|>", "<|end|>"
# Strings that other chat templates give a meaning; none may come out of a text unescaped.
CONTROL = re.compile(r"\\|<(?=\||/?s>|<?/?SYS>>)|\[(?=/?INST\])")
PLACEHOLDER = re.compile(r"<\|(?:image|audio|document|other):\d+\|>")
TURN = re.compile(r"<\|start\|>(.*?)<\|content\|>(.*?)<\|end\|>", re.S)
LEARNED = "assistant"


def escape(text: str) -> str:
    """Backslashes are doubled, and one is put behind the first character of a control string."""
    return CONTROL.sub(lambda m: "\\\\" if m[0] == "\\" else m[0] + "\\", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


class PartVisitor:
    """Flattens typed parts in order. Texts are escaped, attachments become numbered placeholders; what they refer
    to and how many tokens they will stand for is noted."""

    patch, audio_rate, page_tokens = 28, 25, 1024

    def __init__(self) -> None:
        self.pieces: list[str] = []
        self.attachments: list[dict] = []

    def visit(self, part: dict) -> None:
        kind = str(part.get("type") or "text")
        getattr(self, f"visit_{kind}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        self.pieces.append(escape(str(part.get("text") or "")))

    def visit_image(self, part: dict) -> None:
        wide, high = (math.ceil((part.get(side) or self.patch) / self.patch) for side in ("width", "height"))
        self.attach("image", part, wide * high)

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, math.ceil((part.get("seconds") or 0) * self.audio_rate))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, int(part.get("pages") or 1) * self.page_tokens)

    def visit_other(self, part: dict) -> None:
        self.attach("other", part, 0)

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        self.pieces.append(f"<|{kind}:{len(self.attachments)}|>")
        self.attachments.append({"kind": kind, "ref": str(part.get("ref") or ""), "tokens": tokens})


def format_turn(role: str, parts: list[dict]) -> tuple[str, int, int, list[dict]]:
    """The turn's text, where its loss mask starts and ends in it (equal: not learned), its attachments."""
    visitor = PartVisitor()
    for part in parts:
        visitor.visit(part)
    head, body = f"{START}{escape(role)}{CONTENT}", "".join(visitor.pieces)
    learned = len(body) if role == LEARNED else 0
    return head + body + END, len(head), len(head) + learned, visitor.attachments


FORMATTED = (
    "conv bigint, turn bigint, role string, text string, formatted string, loss_start int, loss_end int, "
    "attachments array<struct<kind:string,ref:string,tokens:bigint>>, attached_tokens bigint"
)
ATTACHMENT = pa.list_(pa.struct([("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())]))


def format_turns(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", parts: str | None = None
) -> DataFrame:
    """One row per turn. ``parts`` names a column with a JSON list of typed parts, used where it is not NULL; else
    the text is the turn's only part. ``role`` and ``text`` (or the parts' JSON) settle the order of equal turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            out = [
                format_turn(r or "", json.loads(p) if p is not None else [{"type": "text", "text": t or ""}])
                for r, t, p in zip(rows["role"], rows["text"], rows["parts"], strict=True)
            ]
            attached = [x[3] for x in out]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), batch.column(2), batch.column(3),
                    pa.array([x[0] for x in out], pa.string()),
                    pa.array([x[1] for x in out], pa.int32()),
                    pa.array([x[2] for x in out], pa.int32()),
                    pa.array(attached, ATTACHMENT),
                    pa.array([sum(a["tokens"] for a in each) for each in attached], pa.int64()),
                ],
                names=["conv", "turn", "role", "text", "formatted", "loss_start", "loss_end", "attachments", "attached_tokens"],
            )

    return turns.select(
        F.col(conv).cast("bigint").alias("conv"), F.col(turn).cast("bigint").alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"),
        (F.col(parts) if parts else F.lit(None)).cast("string").alias("parts"),
    ).mapInArrow(run, FORMATTED)


def read_turn(piece: str) -> tuple[str, str]:
    """Role and text of a formatted turn, placeholders left out."""
    role, body = TURN.fullmatch(piece).groups()
    return unescape(role), unescape(PLACEHOLDER.sub("", body))


class Digest:
    """What a conversation's formatted turns, read back in order, add up to."""

    def __init__(self) -> None:
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0

    def add(self, piece: str, loss_start: int, loss_end: int) -> None:
        role, text = read_turn(piece)
        learned = unescape(PLACEHOLDER.sub("", piece[loss_start:loss_end]))
        self.turns.update(f"{role}\n{text}\n".encode())
        self.loss.update(learned.encode())
        self.n_turns += 1
        self.loss_chars += len(learned)
        self.chars += len(piece)


DIGEST = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def read_back(formatted: DataFrame) -> DataFrame:
    """One row per conversation from its formatted turns: their number, digests of turns and of learned text, lengths.

    A digest takes its text in order, so a conversation is read by one task, as a sorted stream.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        digest = Digest()
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

        def rows(done: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*done, strict=True)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

        def closed() -> tuple:
            return (
                now[0], digest.n_turns, digest.turns.hexdigest(), digest.loss_chars, digest.loss.hexdigest(), digest.chars,
            )

        for batch in batches:
            done = []
            got = batch.to_pydict()
            for conv, piece, a, b in zip(got["conv"], got["formatted"], got["loss_start"], got["loss_end"], strict=True):
                if now != (conv,):
                    if now is not None:
                        done.append(closed())
                    now, digest = (conv,), Digest()
                digest.add(piece, a, b)
            yield rows(done)
        if now is not None:
            yield rows([closed()])

    return (
        formatted.repartition("conv")
        .sortWithinPartitions("conv", "turn", "role", "text")
        .select("conv", "formatted", "loss_start", "loss_end")
        .mapInArrow(run, DIGEST)
    )
