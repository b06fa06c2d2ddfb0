"""Helpers the training-data operators share: tables, landed intermediates,
connected components."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, shared_dir
from ..sources.tables import read_table

__all__ = ["bounded_batches", "broadcast", "buckets", "components", "landed", "read_table",
           "under_other_names"]


def landed(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back;
    ``compression`` is the codec, if not the session's.

    Cuts lineage in compact form: later uses read the files, and a lost
    executor costs a re-read, not the work that made them. The shuffles of the
    write go when it ends, not when the driver next collects its garbage.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of an Arrow batch: texts are long, so a batch of Spark's default number
#: of rows takes hundreds of MB in a Python worker.
BATCH_ROWS = 1_000


def bounded_batches(spark: SparkSession) -> None:
    """Set the session's Arrow batches to at most ``BATCH_ROWS`` rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def broadcast(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """``value`` sent to every executor, its class by value; a task calls the
    result once to get it. For values of a bounded size only."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: cloudpickle.loads(sent.value)


#: The columns of ``documents``.
DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def under_other_names(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work(docs)`` with the columns of ``docs``. Those beyond ``DOCUMENTS``
    pass through it under names that nothing else has, so that none of them
    meets a column that ``work`` makes on its way."""
    mark = uuid.uuid4().hex
    names = {c: f"own_{mark}_{i}" for i, c in enumerate(docs.columns) if c not in DOCUMENTS}
    out = work(docs.withColumnsRenamed(names))
    return out.select(*(F.col(names.get(c, c)).alias(c) for c in docs.columns))


def buckets(spark: SparkSession) -> int:
    """Hash buckets for packed shuffles: one for each shuffle partition at
    least, so that what one task holds falls as the cluster's setting grows."""
    return max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected graph: (node, root).

    ``root`` is the smallest node reachable. Nodes come only from edges;
    null ends and self loops are ignored, repeats are harmless. Rounds of
    large-star and small-star (each vertex hands its neighbours the smallest
    vertex it knows) run until the edge set is a forest of stars. A round is
    two partial-aggregated minima and two shuffled joins, so a hub with a
    third of the edges is split by the skew join. Each round is checkpointed.
    """
    ensure_checkpoint_dir(edges.sparkSession)

    def smaller_first(df: DataFrame) -> DataFrame:
        return (df.where("u is not null and v is not null and u != v")
                .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())

    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    # every pair is (u, v) with u > v
    stars = smaller_first(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))).checkpoint()
    before = mark(stars)
    while True:
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = smaller_first(both.where("v > u").join(low, "u")
                              .select(F.col("v").alias("u"), F.col("m").alias("v")))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = reduce(DataFrame.union, (
            large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")),
            low.select("u", F.col("m").alias("v"))))
        stars = smaller_first(small).checkpoint()
        after = mark(stars)
        if after == before:
            break
        before = after
    roots = stars.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select("root", "root").distinct())
