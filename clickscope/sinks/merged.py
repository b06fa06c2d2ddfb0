"""A partitioned table that micro-batches merge into, safely under replay.

Plain Parquet, partitioned by ``part`` (a day, an hour, a bucket) and ``slot``.
A merge rewrites only the partitions it touches, with dynamic partition
overwrite. Each partition exists in up to two slots, and a merge always writes
the slot that does not hold the latest version, so the version it reads from
is never removed while it writes. Rows carry ``as_of``, the batch that wrote
them: a partition whose latest version is already that batch's is left alone,
so a batch replayed after any crash, however far it came, has no effect twice.

The partitions a batch touches are few and become literal filters on partition
and slot, so only their latest files are listed and read; above ``MAX_PARTS``
they are joined instead.

A partition's files must appear together: the file system needs an atomic
rename of folders (hdfs, local). On an object store use a committer that gives
the same.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_PARTS = 256
_AGG = {"sum": lambda c: F.sum(c).cast("bigint"), "min": F.min, "max": F.max}


class MergedTable:
    """``keys`` identify a row within its partition; ``values`` maps each
    value column to how versions combine (sum, min, max)."""

    def __init__(self, spark: SparkSession, path: str, schema: str, part: str, keys: list[str],
                 values: dict[str, str]):
        self.spark, self.path, self.part = spark, path.rstrip("/"), part
        self.keys, self.values = list(keys), dict(values)
        self.schema = spark.createDataFrame([], schema).schema
        self.stored = T.StructType([*self.schema.fields, T.StructField("as_of", T.LongType()),
                                    T.StructField("slot", T.IntegerType())])

    def _path(self):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _all(self) -> DataFrame:
        p, fs = self._path()
        if not fs.exists(p):
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).parquet(self.path)

    def parts_of(self, rows: DataFrame) -> list | DataFrame:
        """The partitions ``rows`` fall in: their values, or, if more than
        ``MAX_PARTS``, a frame of them."""
        parts = rows.select(self.part).distinct()
        values = [r[0] for r in parts.limit(MAX_PARTS + 1).collect()]
        return values if len(values) <= MAX_PARTS else parts

    def _newest(self, rows: DataFrame) -> DataFrame:
        """(part, as_of, slot) of the latest version of each partition in ``rows``."""
        newest = rows.groupBy(self.part).agg(F.max(F.struct("as_of", "slot")).alias("_v"))
        return newest.select(self.part, F.col("_v.as_of").alias("as_of"), F.col("_v.slot").alias("slot"))

    def _versions(self, parts: list) -> dict:
        """{part: (as_of, slot)} of the listed partitions that exist."""
        rows = self._all().where(F.col(self.part).isin(parts))
        return {r[0]: (r.as_of, r.slot) for r in self._newest(rows).collect()} if parts else {}

    def _at(self, versions: dict) -> DataFrame:
        """The rows of these versions: a slot holds one version at a time."""
        where = reduce(Column.__or__, ((F.col(self.part) == F.lit(p)) & (F.col("slot") == slot)
                                       for p, (_, slot) in versions.items()), F.lit(False))
        return self._all().where(where)

    def read(self, parts: list | DataFrame | None = None) -> DataFrame:
        """The table, or its partitions listed in ``parts``."""
        if isinstance(parts, list):
            return self._at(self._versions(parts)).select(*self.schema.names)
        rows = self._all()
        if parts is not None:
            rows = rows.join(parts, self.part, "left_semi")
        return rows.join(self._newest(rows), [self.part, "as_of", "slot"], "left_semi").select(*self.schema.names)

    def merge(self, rows: DataFrame, batch_id: int, replace: bool = False,
              parts: list | None = None) -> list | DataFrame:
        """Combine ``rows`` into the partitions they fall in (with ``replace``
        they become their partitions' content); returns those partitions.
        ``parts`` names them where the caller knows them."""
        rows = rows.select(*self.schema.names)
        parts = self.parts_of(rows) if parts is None or len(parts) > MAX_PARTS else parts
        if isinstance(parts, list):
            versions = self._versions(parts)
            due = [p for p in parts if p not in versions or versions[p][0] < batch_id]
            if not due:
                return parts
            held = self._at({p: versions[p] for p in due if p in versions})
            rows = rows.where(F.col(self.part).isin(due))
            taken = [p for p in due if versions.get(p, (0, 1))[1] == 0]  # slot 1 is free there
            slot = F.when(F.col(self.part).isin(taken), 1).otherwise(0)
        else:
            held = self._all().join(parts, self.part, "left_semi")
            newest = self._newest(held)
            late = newest.where(F.col("as_of") >= int(batch_id))
            held = held.join(newest, [self.part, "as_of", "slot"], "left_semi").join(late, self.part, "left_anti")
            rows = rows.join(late, self.part, "left_anti")
            slot = None
        both = rows if replace else rows.unionByName(held.select(*self.schema.names))
        keys = [k for k in self.keys if k != self.part]
        merged = both.groupBy(self.part, *keys).agg(*(_AGG[a](c).alias(c) for c, a in self.values.items()))
        if slot is None:
            merged = merged.join(newest.select(self.part, F.col("slot").alias("_held")), self.part, "left")
            merged = merged.withColumn("slot", 1 - F.coalesce("_held", F.lit(1))).drop("_held")
        else:
            merged = merged.withColumn("slot", slot)
        (merged.withColumn("as_of", F.lit(int(batch_id)).cast("bigint"))
               .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
               .partitionBy(self.part, "slot").parquet(self.path))
        return parts

    def drop_parts(self, older_than) -> None:
        """Remove partitions whose (ordered) value is below ``older_than``."""
        p, fs = self._path()
        if fs.exists(p):
            for st in fs.listStatus(p):
                name = st.getPath().getName()
                if name.startswith(f"{self.part}=") and int(name.split("=", 1)[1]) < older_than:
                    fs.delete(st.getPath(), True)
