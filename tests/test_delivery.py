"""Two-phase commit and following files from byte to byte."""

from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F, types as T

from rillstone.session import fresh_path
from rillstone.sinks.two_phase import FileTarget, read_committed, register_two_phase, remove_unpublished
from rillstone.sources.files import read_rows_stream
from rillstone.sources.tail import Tail, TailReader, tail_lines
from rillstone.streaming.runner import forget_commit, run

SCHEMA = T.StructType().add("id", "long").add("name", "string")


class Delivery:
    def __init__(self, spark):
        self.spark = spark
        register_two_phase(spark)
        self.arriving, self.out, self.progress = (fresh_path(spark, n) for n in ("arriving", "published", "progress"))

    def arrive(self, first, last):
        self.spark.range(first, last).selectExpr("id", "IF(id % 5 = 0, NULL, concat('n', id)) AS name").repartition(3).write.mode("append").parquet(self.arriving)

    def deliver(self, shape=lambda df: df):
        rows = shape(read_rows_stream(self.spark, self.arriving, SCHEMA))
        writer = rows.writeStream.format("two_phase").option("path", self.out).option("checkpointLocation", self.progress)
        writer.trigger(availableNow=True).start().awaitTermination()

    def ids(self):
        return sorted(r.id for r in read_committed(self.spark, self.out, SCHEMA).collect())

    def files(self):
        data = Path(self.out, "data")
        return sorted(p.name for p in data.iterdir()) if data.exists() else []

    def named(self):
        return sorted(n for p in Path(self.out, "manifests").glob("*.json") for n in json.loads(p.read_text())["files"])


def test_a_failing_task_leaves_nothing(spark):
    d = Delivery(spark)
    d.arrive(0, 50)
    fail = F.udf(lambda i: 1 // (i - 33), "long")
    with pytest.raises(Exception, match="ZeroDivision|zero"):
        d.deliver(lambda df: df.repartition(4).withColumn("id", F.col("id") + 0 * fail("id")))
    assert not list(Path(d.out).glob("manifests/*.json"))
    d.deliver()
    assert d.ids() == list(range(50))
    remove_unpublished(spark, d.out)
    assert d.files() == d.named()


def test_a_replayed_batch_counts_once(spark):
    d = Delivery(spark)
    for first in (0, 40):
        d.arrive(first, first + 40)
        d.deliver()
        before = d.files()
        forget_commit(spark, d.progress)
        d.deliver(lambda df: df.repartition(5))  # cut differently
        assert d.files() == before == d.named()
        assert d.ids() == list(range(first + 40))
    assert {r.id for r in read_committed(spark, d.out, SCHEMA).collect() if r.name is None} == set(range(0, 80, 5))


def test_batch_writes_and_lost_files(spark):
    d = Delivery(spark)
    rows = spark.range(10).selectExpr("id", "'x' AS name")
    for _ in range(2):
        rows.write.format("two_phase").option("path", d.out).option("batch", "monday").mode("append").save()
    rows.where("id > 7").write.format("two_phase").option("path", d.out).mode("append").save()
    assert d.ids() == [0, 1, 2, 3, 4, 5, 6, 7, 8, 8, 9, 9]
    lost = FileTarget(d.out, SCHEMA).stage(iter([(1, "lost")]))
    assert d.ids() == [0, 1, 2, 3, 4, 5, 6, 7, 8, 8, 9, 9]
    assert remove_unpublished(spark, d.out) == 1 and lost.names[0] not in d.files()
    none = fresh_path(spark, "none")
    rows.where("false").write.format("two_phase").option("path", none).mode("append").save()
    assert read_committed(spark, none, SCHEMA).collect() == []


@pytest.fixture
def growing(spark, tmp_path):
    return tmp_path / "logs"


def lines_of(texts):
    """(file, start, line) of whole lines."""
    out = []
    for name, text in texts.items():
        at = 0
        for line in text.split(b"\n")[:-1]:
            out.append((name, at, line.removesuffix(b"\r").decode("utf-8", "replace")))
            at += len(line) + 1
    return sorted(out)


def test_tail_reads_every_line_once(spark, growing):
    growing.mkdir()
    out, progress = fresh_path(spark, "out"), fresh_path(spark, "progress")
    whole = {
        "a.txt": b"".join(b"line %d of a\n" % i for i in range(60)),
        "b.txt": "é\r\n\n\nlong ".encode() + b"x" * 300 + b"\nend\n",
        "sub/c.txt": b"\xff\xfe broken\nlast without end",
    }
    (growing / "sub").mkdir()
    for share in (0.0, 0.3, 0.31, 1.0, 1.0):
        for name, text in whole.items():
            (growing / name).write_bytes(text[: int(len(text) * share)])
        run(tail_lines(spark, str(growing), 64), progress, path=out)
        seen = {n: t[: int(len(t) * share)] for n, t in whole.items()}
        got = sorted((r.file, r.start, r.line) for r in spark.read.schema("file string, start bigint, line string").parquet(out).collect())
        assert got == lines_of(seen)


def test_ranges_share_lines_out(growing):
    """Every cut of a file gives its lines once, whatever the size of the ranges."""
    growing.mkdir()
    text = b"".join(b"%s\n" % (b"y" * (i * 7 % 11)) for i in range(80))
    (growing / "f").write_bytes(text + b"open")
    for size in (1, 2, 3, 5, 8, 13, 100, 10_000):
        reader = TailReader(str(growing), size, None)
        end = reader.latestOffset()
        assert end == {"f": len(text)}
        got = [
            (f, s, line)
            for span in reader.partitions({}, end)
            for batch in reader.read(span)
            for f, s, line in zip(*[c.to_pylist() for c in batch.columns], strict=True)
        ]
        assert got == lines_of({"f": text})


def test_small_ranges_and_files_do_not_make_more_tasks(growing):
    growing.mkdir()
    texts = {"a": b"".join(b"%d %s\n" % (i, b"x" * (i * 31 % 200)) for i in range(40_000)), "b": b"y" * 300_000 + b"\nend\n"}
    texts |= {f"c{i:03}": b"line %d\nmore\n" % i for i in range(300)}
    for name, text in texts.items():
        (growing / name).write_bytes(text)
    reader = TailReader(str(growing), 1024, None)
    shares = reader.partitions({}, reader.latestOffset())
    assert len(shares) <= 100
    got = [
        row
        for share in shares
        for batch in reader.read(share)
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True)
    ]
    assert got == lines_of(texts)


def test_bound_per_trigger_and_shrunk_file(growing):
    growing.mkdir()
    (growing / "f").write_bytes(b"0123456789\n" * 20)
    (growing / "g").write_bytes(b"z" * 500 + b"\n")
    reader = Tail({"path": str(growing), "bytesPerTrigger": "30"}).streamReader(None)
    start, steps = reader.initialOffset(), []
    while (end := reader.latestOffset()) != start:
        reader.partitions(start, end)
        steps.append(sum(end.values()) - sum(start.values()))
        start = end
    assert start == {"f": 220, "g": 501} and max(steps[:6]) <= 44 and len(steps) > 6
    (growing / "f").write_bytes(b"0\n")
    with pytest.raises(ValueError, match="were read"):
        reader.latestOffset()
