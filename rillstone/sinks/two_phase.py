"""A sink with two-phase commit, as a data source of Spark: ``format("two_phase")``.

Every task of a micro-batch (or of a batch write) stages its rows in files of its own and reports them. When all
have reported, the driver publishes the list of files as the micro-batch's manifest, in one atomic step: the
manifest is there or it is not, and rows count from then on. If a task fails, what the others staged is removed. If
the driver is lost after publishing, Spark delivers the micro-batch again, perhaps cut differently; its manifest is
found and the second set of files is removed. So every row is there exactly once, without overwriting anything that
a reader may be reading.

Where the rows go is a :class:`Target`: :class:`FileTarget` keeps parquet files in a shared folder; a target for a
database stages into a side table and publishes with one transaction that moves them and notes the micro-batch.
"""

from __future__ import annotations

import itertools
import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: rows that a task holds before it writes them out
STAGED_ROWS = 20_000


@dataclass
class Staged(WriterCommitMessage):
    """What one task has staged: names that mean something to the target."""

    names: list[str]
    rows: int


class Target(Protocol):
    def stage(self, rows: Iterator[Row]) -> Staged:
        """In a task: put the rows where no reader sees them yet."""

    def publish(self, staged: list[Staged], batch: str) -> bool:
        """On the driver, once all tasks are done: make them visible in one atomic step. False, and nothing
        changed, if this batch was published before."""

    def discard(self, staged: list[Staged]) -> None:
        """On the driver: remove what was staged in vain."""


@dataclass
class FileTarget:
    """Parquet files below ``path``/data, listed in ``path``/manifests; ``path`` is reachable from all machines."""

    path: str
    schema: T.StructType

    def _open(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)

    def stage(self, rows: Iterator[Row]) -> Staged:
        store, root = self._open()
        shape, names, count = to_arrow_schema(self.schema), [], 0
        writer = None
        while chunk := list(itertools.islice(rows, STAGED_ROWS)):
            if writer is None:  # a task without rows leaves no file
                names.append(f"{uuid.uuid4().hex}.parquet")
                store.create_dir(f"{root}/data", recursive=True)
                writer = pq.ParquetWriter(f"{root}/data/{names[0]}", shape, filesystem=store)
            writer.write_batch(pa.RecordBatch.from_arrays([pa.array([r[i] for r in chunk], f.type) for i, f in enumerate(shape)], schema=shape))
            count += len(chunk)
        if writer is not None:
            writer.close()
        return Staged(names, count)

    def publish(self, staged: list[Staged], batch: str) -> bool:
        store, root = self._open()
        store.create_dir(f"{root}/manifests", recursive=True)
        final = f"{root}/manifests/{batch}.json"
        if store.get_file_info(final).type != fs.FileType.NotFound:
            return False
        # readers take only names that end in .json; a rename within a folder is atomic
        started = f"{root}/manifests/.{batch}.{uuid.uuid4().hex}"
        with store.open_output_stream(started) as out:
            out.write(json.dumps({"batch": batch, "files": [n for s in staged for n in s.names], "rows": sum(s.rows for s in staged)}).encode())
        store.move(started, final)
        return True

    def discard(self, staged: list[Staged]) -> None:
        store, root = self._open()
        for name in (n for s in staged for n in s.names):
            if store.get_file_info(f"{root}/data/{name}").type != fs.FileType.NotFound:
                store.delete_file(f"{root}/data/{name}")


def committed(target: Target, messages: list[Staged | None], batch: str) -> None:
    staged = [m for m in messages if m is not None]
    if not target.publish(staged, batch):
        target.discard(staged)


class StreamSide(DataSourceStreamWriter):
    def __init__(self, target: Target):
        self.target = target

    def write(self, iterator: Iterator[Row]) -> Staged:
        return self.target.stage(iterator)

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        committed(self.target, messages, str(batchId))

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        self.target.discard([m for m in messages if m is not None])


class BatchSide(DataSourceWriter):
    """A batch write is one commit under the name given by the option ``batch``."""

    def __init__(self, target: Target, batch: str):
        self.target, self.batch = target, batch

    def write(self, iterator: Iterator[Row]) -> Staged:
        return self.target.stage(iterator)

    def commit(self, messages: list[Staged | None]) -> None:
        committed(self.target, messages, self.batch)

    def abort(self, messages: list[Staged | None]) -> None:
        self.target.discard([m for m in messages if m is not None])


class TwoPhase(DataSource):
    """Option ``path``: the folder. Option ``batch``, for batch writes: the name of the commit (a new one if absent)."""

    @classmethod
    def name(cls) -> str:
        return "two_phase"

    def _target(self, schema: T.StructType) -> Target:
        return FileTarget(self.options["path"], schema)

    def streamWriter(self, schema: T.StructType, overwrite: bool) -> StreamSide:
        return StreamSide(self._target(schema))

    def writer(self, schema: T.StructType, overwrite: bool) -> BatchSide:
        return BatchSide(self._target(schema), self.options.get("batch") or uuid.uuid4().hex)


def register_two_phase(spark: SparkSession) -> None:
    spark.dataSource.register(TwoPhase)


def read_committed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all published micro-batches. Files that no manifest names are not read."""
    manifests = spark.read.schema("batch string, files array<string>, rows bigint").json(f"{path}/manifests/*.json")
    # names of files only, as many as a reader of a folder lists anyway
    files = [f"{path}/data/{name}" for row in manifests.select("files").toLocalIterator() for name in row.files]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def remove_unpublished(spark: SparkSession, path: str) -> int:
    """Remove files that no manifest names: left by a driver that was lost before it could abort. Call it while no
    query writes to the folder."""
    store, root = FileTarget(path, T.StructType())._open()
    known = {
        name
        for info in store.get_file_info(fs.FileSelector(f"{root}/manifests", allow_not_found=True))
        if info.path.endswith(".json")
        for name in json.loads(store.open_input_stream(info.path).read())["files"]
    }
    lost = [i.path for i in store.get_file_info(fs.FileSelector(f"{root}/data", allow_not_found=True)) if i.base_name not in known]
    for file in lost:
        store.delete_file(file)
    return len(lost)
