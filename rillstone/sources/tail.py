"""A source that follows growing text files from byte to byte: ``format("tail_lines")``.

The offset of a stream is the byte reached in every file, so a file is not read again when it grows, and a query that
starts anew goes on in the middle of it. Only whole lines are read: a line whose end has not been written yet waits for
the next micro-batch. A file's new bytes are cut into ranges; a line belongs to the range it starts in. A task reads one range
after another, of one or several files: as many as make up its share of the micro-batch, but not more than 64 MiB (or one
range, if ranges are larger). Small ranges and small files do not make more tasks.

Lines end with a line feed, a carriage return before it does not count. Options: ``path``, a folder that driver and
tasks reach; ``rangeBytes``, the size of a range (64 MiB); ``bytesPerTrigger``, about how many new bytes a micro-batch
takes (no bound; the first one after a restart takes what has come meanwhile, because Spark does not tell a source where
it is then). A file that has shrunk is an error: its offset no longer means anything.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "file string, start bigint, line string"

RANGE_BYTES = 64 * 1024 * 1024
#: shares of a micro-batch, as long as a share is within ``RANGE_BYTES``
_TASKS = 64
#: a file counts for so many bytes more
_FILE_BYTES = 256 * 1024
_LOOK = 64 * 1024
_LINES = 10_000


@dataclass
class Span:
    """Bytes of a file: lines that start in [start, stop) are read; ``begin`` is the start of a line before it."""

    file: str
    begin: int
    start: int
    stop: int
    end: int


class Share(InputPartition):
    """What one task reads."""

    def __init__(self, spans: list[Span]):
        super().__init__((spans[0].file, spans[0].start))
        self.spans = spans


def opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def whole_lines(store: fs.FileSystem, file: str, start: int, size: int) -> int:
    """The end of the last whole line in [start, size), or ``start``."""
    with store.open_input_file(file) as data:
        stop = size
        while stop > start:
            begin = max(start, stop - _LOOK)
            data.seek(begin)
            found = data.read(stop - begin).rfind(b"\n")
            if found >= 0:
                return begin + found + 1
            stop = begin
    return start


def first_line_end(data: pa.NativeFile, start: int, size: int) -> int:
    """The end of the line that ``start`` lies in, or ``size``."""
    data.seek(start)
    while start < size:
        piece = data.read(min(_LOOK, size - start))
        found = piece.find(b"\n")
        if found >= 0:
            return start + found + 1
        start += len(piece)
    return size


class TailReader(DataSourceStreamReader):
    def __init__(self, path: str, range_bytes: int, per_trigger: int | None):
        self.path, self.range_bytes, self.per_trigger = path, range_bytes, per_trigger
        self.reached: dict[str, int] = {}
        self.located = False

    def initialOffset(self) -> dict:
        self.located = True  # only a query without a checkpoint asks
        return {}

    def latestOffset(self) -> dict:
        store, root = opened(self.path)
        files = [i for i in store.get_file_info(fs.FileSelector(root, recursive=True)) if i.type == fs.FileType.File and not i.base_name.startswith((".", "_"))]
        offset, left = dict(self.reached), self.per_trigger if self.located else None
        for info in sorted(files, key=lambda i: i.path):
            name = info.path[len(root.rstrip("/")) + 1 :]
            start = self.reached.get(name, 0)
            if info.size < start:
                raise ValueError(f"{name} has {info.size} bytes, {start} were read")
            size = info.size
            if left is not None and size - start > left:
                # up to a line's end, and a line at least, however long it is
                with store.open_input_file(info.path) as data:
                    size = first_line_end(data, start + left - 1, info.size) if left > 0 else start
            stop = whole_lines(store, info.path, start, size)
            offset[name] = stop
            left = None if left is None else max(0, left - (stop - start))
        return offset

    def partitions(self, start: dict, end: dict) -> list[Share]:
        spans = []
        for name, stop in sorted(end.items()):
            begin = start.get(name, 0)
            for at in range(begin, stop, self.range_bytes):
                spans.append(Span(name, begin, at, min(at + self.range_bytes, stop), stop))
        self.reached, self.located = {**self.reached, **end}, True
        most = min(RANGE_BYTES, -(-sum(s.stop - s.start + _FILE_BYTES * (s.start == s.begin) for s in spans) // _TASKS))
        shares, held = [], 0
        for span in spans:
            weight = span.stop - span.start + _FILE_BYTES * (span.start == span.begin)
            if not shares or held + weight > most:
                shares.append([])
                held = 0
            shares[-1].append(span)
            held += weight
        return [Share(share) for share in shares]

    def read(self, partition: Share) -> Iterator[pa.RecordBatch]:
        store, root = opened(self.path)
        for file, spans in groupby(partition.spans, lambda span: span.file):
            lines, starts = [], []
            with store.open_input_file(f"{root}/{file}") as data:
                for span in spans:
                    for at, line in self._lines(data, span):
                        lines.append(line.removesuffix(b"\r").decode("utf-8", "replace"))
                        starts.append(at)
                        if len(lines) == _LINES:
                            yield self._batch(file, starts, lines)
                            lines, starts = [], []
            if lines:
                yield self._batch(file, starts, lines)

    @staticmethod
    def _lines(data: pa.NativeFile, span: Span) -> Iterator[tuple[int, bytes]]:
        at = span.start
        if at > span.begin:  # a line that began before belongs to the range before
            at = first_line_end(data, at - 1, span.end)
        data.seek(at)
        read_to, rest = at, []
        while at < span.stop:
            # what is left of the range, and beyond it as much as its last line takes
            piece = data.read(min(_LOOK * 16, max(span.stop - read_to, _LOOK), span.end - read_to))
            if not piece:
                raise ValueError(f"{span.file} ends before byte {span.end}, which was there before")
            read_to += len(piece)
            *whole, last = piece.split(b"\n")
            if whole:
                whole[0] = b"".join([*rest, whole[0]])
                rest = []
            rest.append(last)
            for line in whole:
                if at >= span.stop:
                    break
                yield at, line
                at += len(line) + 1

    @staticmethod
    def _batch(file: str, starts: list[int], lines: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([file] * len(lines)), pa.array(starts, pa.int64()), pa.array(lines, pa.string())], names=["file", "start", "line"]
        )


class Tail(DataSource):
    @classmethod
    def name(cls) -> str:
        return "tail_lines"

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema: StructType) -> TailReader:
        per_trigger = self.options.get("bytesPerTrigger")
        return TailReader(self.options["path"], int(self.options.get("rangeBytes", RANGE_BYTES)), int(per_trigger) if per_trigger else None)


def tail_lines(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES, bytes_per_trigger: int | None = None) -> DataFrame:
    """A stream of (file, start, line) from the text files of a folder, as they grow."""
    spark.dataSource.register(Tail)
    reader = spark.readStream.format("tail_lines").option("path", path).option("rangeBytes", str(range_bytes))
    if bytes_per_trigger:
        reader = reader.option("bytesPerTrigger", str(bytes_per_trigger))
    return reader.load()
