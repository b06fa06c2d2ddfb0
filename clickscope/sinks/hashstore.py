"""The hash store as a data source: ``key -> {field: value}``, written by batch
and streaming queries with ``format("hash_store")``, read back with SQL.

Rows are (key, field, value). The last write of a (key, field) wins; a null
value removes the field; a row with a null field empties its key before the
other rows of its batch, so a key's whole content can be replaced.

Tasks write their rows to files of their own and report them; the commit gives
them their place, ``<path>/writer=<name>/batch=<id>``, by one rename of a
folder, so a reader sees a batch whole or not at all, and a batch that dies
before its commit leaves nothing. A batch that comes again with the same id
(a replay) is already there and is dropped. Reading is a plain Parquet scan
with one partial aggregate.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter,
                                    WriterCommitMessage)

SCHEMA = "key string, field string, value string"
STORED = SCHEMA + ", writer string, batch long"
_ARROW = pa.schema([("key", pa.string()), ("field", pa.string()), ("value", pa.string())])


def _open(path: str) -> tuple[fs.FileSystem, str]:
    system, where = fs.FileSystem.from_uri(path)
    return system, where.rstrip("/")


@dataclass
class Written(WriterCommitMessage):
    """The file a task wrote; None when it had no rows."""
    file: str | None


class _Files:
    """What batch and streaming writes share. A writer writes one batch at a
    time, in a folder of its own that goes when the batch ends either way."""

    def __init__(self, path: str, writer: str):
        self.path, self.writer = path, writer
        self.staging = f"_staging-{writer}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        system, where = _open(self.path)
        folder, name, out = f"{where}/{self.staging}", f"{uuid.uuid4().hex}.parquet", None
        try:
            for batch in batches:
                if batch.num_rows:
                    if out is None:
                        system.create_dir(folder, recursive=True)
                        out = pq.ParquetWriter(f"{folder}/{name}", _ARROW, filesystem=system)
                    out.write_batch(pa.RecordBatch.from_arrays(
                        [batch.column(c).cast(pa.string()) for c in _ARROW.names], schema=_ARROW))
        finally:
            if out is not None:
                out.close()
        return Written(name if out is not None else None)

    def place(self, messages: list[Written | None], batch: int) -> None:
        """All files the tasks reported become batch ``batch``, at once."""
        system, where = _open(self.path)
        target = f"{where}/writer={self.writer}/batch={batch}"
        if system.get_file_info(target).type == fs.FileType.NotFound:
            whole = f"{where}/{self.staging}-whole"
            if system.get_file_info(whole).type != fs.FileType.NotFound:
                system.delete_dir(whole)  # of a commit that died
            system.create_dir(whole, recursive=True)
            for m in messages:
                if m is not None and m.file:
                    system.move(f"{where}/{self.staging}/{m.file}", f"{whole}/{m.file}")
            system.create_dir(f"{where}/writer={self.writer}", recursive=True)
            system.move(whole, target)
        self.drop()

    def drop(self) -> None:
        system, where = _open(self.path)
        for folder in (f"{where}/{self.staging}", f"{where}/{self.staging}-whole"):
            if system.get_file_info(folder).type != fs.FileType.NotFound:
                system.delete_dir(folder)


class HashWriter(DataSourceArrowWriter):
    def __init__(self, files: _Files, batch: int):
        self.files, self.batch = files, batch

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.files.write(iterator)

    def commit(self, messages: list[Written | None]) -> None:
        self.files.place(messages, self.batch)

    def abort(self, messages: list[Written | None]) -> None:
        self.files.drop()


class HashStreamWriter(DataSourceStreamArrowWriter):
    def __init__(self, files: _Files):
        self.files = files

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        return self.files.write(iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        self.files.place(messages, batchId)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        self.files.drop()


class HashStore(DataSource):
    """Format ``hash_store``: options ``path``, ``writer`` (default ``main``;
    each query that writes to a store has its own) and, for batch writes,
    ``batch``, the id that a replay repeats."""

    @classmethod
    def name(cls) -> str:
        return "hash_store"

    def schema(self) -> str:
        return SCHEMA

    def _files(self) -> _Files:
        return _Files(self.options["path"], self.options.get("writer", "main"))

    def writer(self, schema, overwrite: bool) -> HashWriter:
        return HashWriter(self._files(), int(self.options["batch"]))

    def streamWriter(self, schema, overwrite: bool) -> HashStreamWriter:
        return HashStreamWriter(self._files())


def write_batch(rows: DataFrame, path: str, batch: int, writer: str = "main") -> None:
    """Write (key, field, value) rows as batch ``batch`` of ``writer``."""
    rows.sparkSession.dataSource.register(HashStore)
    (rows.select("key", "field", "value").write.format("hash_store").mode("append")
         .option("path", path).option("writer", writer).option("batch", str(batch)).save())


def start_stream(rows: DataFrame, path: str, checkpoint: str, writer: str = "main", output_mode: str = "append",
                 trigger: dict | None = None):
    """Run a streaming frame of (key, field, value) rows into the store. Spark
    gives no ``update`` mode to data sources written in Python, so changed rows
    of an aggregate go through batch writes, under the number of their batch."""
    rows = rows.select("key", "field", "value")
    if output_mode == "update":
        out = rows.writeStream.foreachBatch(lambda df, batch: write_batch(df, path, batch, writer))
    else:
        rows.sparkSession.dataSource.register(HashStore)
        out = rows.writeStream.format("hash_store").option("path", path).option("writer", writer)
    return (out.outputMode(output_mode).option("checkpointLocation", checkpoint)
               .trigger(**(trigger or {"processingTime": "5 seconds"})).start())


def replaced(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` as the whole new content of ``key``."""
    empty = rows.sparkSession.range(1).select(F.lit(key).alias("key"), F.lit(None).cast("string").alias("field"),
                                              F.lit(None).cast("string").alias("value"))
    return empty.unionByName(rows.select("key", "field", "value"))


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """(key, field, value): what the store holds now."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], SCHEMA)
    rows = spark.read.schema(STORED).parquet(path)
    emptied = rows.where("field is null").groupBy("key").agg(F.max("batch").alias("_since"))
    last = rows.where("field is not null").groupBy("key", "field").agg(
        F.max(F.struct("batch", "value")).alias("_last"))
    held = last.join(emptied, "key", "left").where("_since is null or _last.batch >= _since")
    return held.where("_last.value is not null").select("key", "field", F.col("_last.value").alias("value"))
