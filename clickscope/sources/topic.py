"""A message topic in a folder, as a batch and a streaming source.

``<path>/<partition>/<first>-<end>.txt``: numbered partitions of append-only
segments of text lines; a segment's name says which offsets it holds, so what
is there is known from a listing, and a stream's position is one offset a
partition. Spark keeps the positions of a query in its checkpoint; a restarted
query goes on there. A first start takes ``startingOffsets`` (``latest`` or
``earliest``); where it began is remembered in ``startMemory``, so that a query
that dies in its first batch begins at the same place again.

Segments appear by one rename each, so a reader never sees half of one. Paths
are opened through pyarrow's file systems (local, hdfs, object stores).
"""

from __future__ import annotations

import io
import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "partition int, offset long, value string"
LINES = 10_000  # lines of a record batch
_SEGMENT = re.compile(r"(\d{20})-(\d{20})\.txt")


def _open(path: str) -> tuple[fs.FileSystem, str]:
    system, where = fs.FileSystem.from_uri(path)
    return system, where.rstrip("/")


def segments(path: str) -> dict[int, list[tuple[int, int]]]:
    """(first, end) of the segments of each partition, in order."""
    system, where = _open(path)
    found: dict[int, list[tuple[int, int]]] = {}
    for f in system.get_file_info(fs.FileSelector(where, recursive=True, allow_not_found=True)):
        name = f.path[len(where) + 1:].split("/")
        if len(name) == 1 and name[0].isdigit() and f.type == fs.FileType.Directory:
            found.setdefault(int(name[0]), [])
        elif len(name) == 2 and name[0].isdigit() and (m := _SEGMENT.fullmatch(name[1])):
            found.setdefault(int(name[0]), []).append((int(m[1]), int(m[2])))
    return {p: sorted(s) for p, s in sorted(found.items())}


def end_offsets(path: str) -> dict[str, int]:
    """The offset after the last message of each partition (keys as JSON has them)."""
    return {str(p): (s[-1][1] if s else 0) for p, s in segments(path).items()}


@dataclass
class Stretch(InputPartition):
    """Messages [first, end) of one segment."""
    partition: int
    segment: tuple[int, int]
    first: int
    end: int


def stretches(path: str, start: dict[str, int], end: dict[str, int]) -> list[Stretch]:
    out = []
    for p, held in segments(path).items():
        a, b = start.get(str(p), 0), end.get(str(p), 0)
        out += [Stretch(p, s, max(a, s[0]), min(b, s[1])) for s in held if s[0] < b and s[1] > a]
    return out


def _messages(path: str, part: Stretch) -> Iterator[pa.RecordBatch]:
    system, where = _open(path)
    name = f"{where}/{part.partition}/{part.segment[0]:020d}-{part.segment[1]:020d}.txt"
    offsets: list[int] = []
    values: list[str] = []

    def sent() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([part.partition] * len(offsets), pa.int32()), pa.array(offsets, pa.int64()),
             pa.array(values, pa.string())], names=["partition", "offset", "value"])

    with system.open_input_stream(name) as raw, io.TextIOWrapper(raw, encoding="utf-8", newline="\n") as lines:
        for offset, line in enumerate(lines, part.segment[0]):
            if offset >= part.end:
                break
            if offset >= part.first:
                offsets.append(offset)
                values.append(line.removesuffix("\n"))
                if len(values) == LINES:
                    yield sent()
                    offsets, values = [], []
    yield sent()


class TopicReader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Stretch]:
        return stretches(self.path, {}, end_offsets(self.path))

    def read(self, partition: Stretch | None) -> Iterator[pa.RecordBatch]:
        if isinstance(partition, Stretch):  # an empty topic has no stretch
            yield from _messages(self.path, partition)


class TopicStreamReader(DataSourceStreamReader):
    def __init__(self, path: str, starting: str, memory: str | None):
        if starting not in ("latest", "earliest"):
            raise ValueError("startingOffsets is latest or earliest")
        self.path, self.starting, self.memory = path, starting, memory

    def initialOffset(self) -> dict[str, int]:
        if not self.memory:
            return self._start()
        system, where = _open(self.memory)
        if system.get_file_info(where).type == fs.FileType.File:
            with system.open_input_stream(where) as f:
                return json.loads(f.readall())
        start = self._start()
        system.create_dir(where.rsplit("/", 1)[0], recursive=True)
        fresh = f"{where}.{uuid.uuid4().hex}"
        with system.open_output_stream(fresh) as f:
            f.write(json.dumps(start).encode())
        system.move(fresh, where)
        return start

    def _start(self) -> dict[str, int]:
        ends = end_offsets(self.path)
        return ends if self.starting == "latest" else dict.fromkeys(ends, 0)

    def latestOffset(self) -> dict[str, int]:
        return end_offsets(self.path)

    def partitions(self, start: dict[str, int], end: dict[str, int]) -> list[Stretch]:
        return stretches(self.path, start, end)

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        yield from _messages(self.path, partition)


class TopicSource(DataSource):
    """Format ``topic``: options ``path``, ``startingOffsets``, ``startMemory``."""

    @classmethod
    def name(cls) -> str:
        return "topic"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TopicReader:
        return TopicReader(self.options["path"])

    def streamReader(self, schema) -> TopicStreamReader:
        # option names lose their capitals on the way through Spark
        options = {k.lower(): v for k, v in self.options.items()}
        return TopicStreamReader(options["path"], options.get("startingoffsets", "latest"), options.get("startmemory"))


def create(path: str, partitions: int) -> None:
    """An empty topic of so many partitions (no effect on one that is there)."""
    system, where = _open(path)
    for p in range(partitions):
        system.create_dir(f"{where}/{p}", recursive=True)


def append(lines: DataFrame, path: str) -> None:
    """Append ``lines`` (value) to a topic: task i writes one segment of partition
    i. A repeated task replaces its own segment. One writer at a time."""
    ends = end_offsets(path)
    if not ends:
        raise ValueError("the topic has no partitions")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = TaskContext.get().partitionId()
        system, where = _open(path)
        n, fresh = 0, f"{where}/_writing-{uuid.uuid4().hex}"
        with system.open_output_stream(fresh) as out:
            for batch in batches:
                for value in batch.column(0).to_pylist():
                    if value is not None:  # a message is one line
                        out.write(value.replace("\n", " ").encode() + b"\n")
                        n += 1
        if n:
            system.move(fresh, f"{where}/{p}/{ends[str(p)]:020d}-{ends[str(p)] + n:020d}.txt")
        else:
            system.delete_file(fresh)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    dealt = lines.select("value").repartition(len(ends))
    dealt.mapInArrow(write, "n long").write.format("noop").mode("append").save()


def topic_lines(spark: SparkSession, path: str, starting_offsets: str = "latest",
                start_memory: str | None = None) -> DataFrame:
    """Streaming frame of a topic's messages. With ``latest`` pass
    ``start_memory``, a file beside the query's checkpoint."""
    spark.dataSource.register(TopicSource)
    r = spark.readStream.format("topic").option("path", path).option("startingOffsets", starting_offsets)
    if start_memory:
        r = r.option("startMemory", start_memory)
    return r.load()


def topic_table(spark: SparkSession, path: str) -> DataFrame:
    """All messages of a topic, as a batch frame."""
    spark.dataSource.register(TopicSource)
    return spark.read.format("topic").option("path", path).load()
