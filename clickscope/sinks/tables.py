"""Table sinks: catalog table replace, append by task, SQL-database append, preview.

Writers run on the executors; nothing is collected to the driver first.
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import DataFrame

from ..session import shared_dir


def replace_table(df: DataFrame, name: str, partition_by: list[str] | None = None,
                  fmt: str = "parquet", path: str | None = None) -> str:
    """Make ``df``'s rows the content of the catalog entry ``name``; returns the
    folder that holds them.

    The rows are written to a new folder below ``path`` (default: the shared
    folder) first; then the name, a view of one folder, is replaced in a single
    step. A reader sees the old rows or the new ones, never nothing, and a
    write that fails changes nothing. The folder before stays for queries that
    still read it, older ones go. A table of that name is dropped first.
    """
    spark = df.sparkSession
    base = path or f"{shared_dir(spark)}/tables/{name}"
    fresh = f"{base}/v-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    w = df.write.format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(fresh)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {fmt}.`{fresh}`")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    versions = sorted((st.getPath() for st in fs.listStatus(where) if st.getPath().getName().startswith("v-")),
                      key=lambda p: p.getName())
    for old in versions[:-2]:
        fs.delete(old, True)
    return fresh


def append_task(df: DataFrame, name: str, task_id: str, path: str | None = None) -> None:
    """Add a task's rows to the table ``name``, which keeps those of all tasks, in
    a partition each (column ``task_id``). A task that runs again replaces its
    own rows and no others."""
    if not re.fullmatch(r"[\w.-]+", task_id):
        raise ValueError("a task id is letters, digits, dots, dashes and underscores")
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        w = with_task_id(df, task_id).limit(0).write.partitionBy("task_id")
        (w.option("path", path) if path else w).saveAsTable(name)
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (task_id = '{task_id}') SELECT * FROM {{rows}}", rows=df)


def append_jdbc(df: DataFrame, url: str, table: str, properties: dict | None = None,
                batch_size: int = 1000, num_partitions: int | None = None) -> None:
    """Append rows to a SQL table in batched inserts, one transaction per task.

    ``num_partitions`` caps concurrent connections to the database.
    """
    props = dict(properties or {})
    props.setdefault("batchsize", str(batch_size))
    out = df.coalesce(num_partitions) if num_partitions else df
    out.write.jdbc(url=url, table=table, mode="append", properties=props)


def with_task_id(df: DataFrame, task_id: str) -> DataFrame:
    """Stamp a report with the run's task id as its first column."""
    from pyspark.sql import functions as F
    return df.select(F.lit(task_id).alias("task_id"), *df.columns)


def preview(df: DataFrame, n: int = 100) -> DataFrame:
    """The first n rows, for a console look (``preview(df).show(truncate=False)``)."""
    return df.limit(n)
