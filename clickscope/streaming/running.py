"""Running totals of the ad stream, as keyed state.

One streaming aggregate in ``update`` mode holds every running count of the
reports: clicks per (user, ad, day), per (area, city, ad, day) and, with the
city left out, per (area, ad, day). Its state lives in a RocksDB state store;
a batch reads and writes the keys its clicks touch and nothing else. The input
is the folder of surviving clicks that the filtering query (``adstream``)
writes batch by batch.

State is kept for days that still change. A click's ``event_day`` is its day,
if that is not after its arrival and at most ``keep_days`` before the latest
day; the watermark lets go of older days. Clicks outside this range (late ones,
and lines from the far future) are counted under the latest day as their
``event_day`` with their own day as ``dt``. A total is the sum over the
``event_day`` of a key, so no click is lost and no state is kept for ever.

Each batch's changed totals are appended to ``counts`` (partitioned by day),
those of clicks out of range to ``odd``. Counts only grow, so the latest total
of a key and ``event_day`` is its largest one: a batch that comes again after
a crash adds nothing. A day's earlier rows are read only if it has odd clicks.

What is done with a batch's changes reads them back from ``counts`` and ``odd``:
a plan that holds the aggregate's frame twice would run the state anew for the
second one, also when it is cached. It runs in as many tasks as there are rows
for, not in one a state partition, and with adaptive execution, which Spark
switches off for a query with state: files and tasks grow with the changes alone.

The top ads of an area and day follow by monotone maintenance: as totals only
grow, an ad enters the list only in a batch that changes it, so the new list is
the top of the old list and the changed keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import ads as ads_ops
from ..sinks import hashstore, kv
from ..sinks.merged import MergedTable

#: What the query is started with: keyed state in RocksDB, committed as a log of
#: changes; state that the watermark lets go of leaves with the next clicks.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
TOP_ADS = 3
KEEP_DAYS = 2
TASK_ROWS = 50_000  # changed rows of a task
SURVIVOR_SCHEMA = ("ts long, area string, city string, uid long, ads_id long, dt string, event_day date, "
                   "batch_id long")
KEYS = ["kind", "dt", "area", "city", "uid", "ads_id"]
COUNTS = ("kind string, area string, city string, uid long, ads_id long, event_day timestamp, clicks long, "
          "last_batch long, dt string, seen long")
USER, CITY, AREA = "user", "city", "area"


@dataclass(frozen=True)
class StreamPaths:
    base: str

    @property
    def survivors(self): return f"{self.base}/survivors"
    @property
    def checkpoint(self): return f"{self.base}/_checkpoint"
    @property
    def running_checkpoint(self): return f"{self.base}/_checkpoint_running"
    @property
    def counts(self): return f"{self.base}/counts"
    @property
    def odd(self): return f"{self.base}/odd"
    @property
    def store(self): return f"{self.base}/store"


def bans(spark: SparkSession, paths: StreamPaths) -> MergedTable:
    """Banned users in 16 buckets; a user's first ban counts."""
    return MergedTable(spark, f"{paths.base}/blacklist", "bucket int, uid long, banned_batch long",
                       "bucket", ["bucket", "uid"], {"banned_batch": "min"})


def top_lists(spark: SparkSession, paths: StreamPaths) -> MergedTable:
    """The top ads of each area and day."""
    return MergedTable(spark, f"{paths.base}/top_ads", "dt string, area string, ads_id long, clicks long",
                       "dt", ["dt", "area", "ads_id"], {"clicks": "max"})


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def totals(survivors: DataFrame, keep_days: int = KEEP_DAYS) -> DataFrame:
    """The streaming aggregate: (kind, dt, area, city, uid, ads_id, event_day,
    clicks, last_batch). Each click counts once for its user, its city and its
    area; partial counts come before the shuffle."""
    none = F.lit(None)
    shapes = F.array(*(F.struct(F.lit(kind).alias("kind"), area.cast("string").alias("area"),
                                city.cast("string").alias("city"), uid.cast("long").alias("uid"))
                       for kind, area, city, uid in ((USER, none, none, F.col("uid")),
                                                     (CITY, F.col("area"), F.col("city"), none),
                                                     (AREA, F.col("area"), none, none))))
    rows = survivors.select("dt", "ads_id", "batch_id", F.col("event_day").cast("timestamp").alias("event_day"),
                            F.explode(shapes).alias("_s")).select("dt", "ads_id", "batch_id", "event_day", "_s.*")
    # a day below the range of event_day: no click is late for the state
    return (rows.withWatermark("event_day", f"{keep_days + 1} days")
                .groupBy(*KEYS, "event_day")
                .agg(F.count(F.lit(1)).alias("clicks"), F.max("batch_id").alias("last_batch")))


def best(clicks: DataFrame, k: int = TOP_ADS) -> DataFrame:
    """The ``k`` ads with most clicks of each (dt, area); ties: ad id."""
    w = Window.partitionBy("dt", "area").orderBy(F.col("clicks").desc(), F.col("ads_id").asc())
    return clicks.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def batch_changes(spark: SparkSession, paths: StreamPaths, batch: int, days: list) -> DataFrame:
    """The changed totals of a batch, on ``days``, as they were appended."""
    frames = []
    for where in (paths.counts, paths.odd):
        held = [p for p in (f"{where}/dt={d}/seen={batch}" for d in days) if exists(spark, p)]
        if held:
            frames.append(spark.read.schema(COUNTS).option("basePath", where).parquet(*held))
    return reduce(DataFrame.unionByName, frames)


def new_top(old: DataFrame, changed: DataFrame, k: int = TOP_ADS) -> DataFrame:
    """The top lists after a batch, from the lists before it and the changed
    totals (both dt, area, ads_id, clicks). Exact while totals only grow."""
    both = old.select("dt", "area", "ads_id", "clicks").unionByName(changed.select("dt", "area", "ads_id", "clicks"))
    return best(both.groupBy("dt", "area", "ads_id").agg(F.max("clicks").alias("clicks")), k)


def stored_totals(spark: SparkSession, paths: StreamPaths, days: list | None = None) -> DataFrame:
    """(kind, dt, area, city, uid, ads_id, clicks) over all batches, of the days
    listed or of all."""
    frames = [spark.read.schema(COUNTS).parquet(p) for p in (paths.counts, paths.odd) if exists(spark, p)]
    if not frames:
        return spark.createDataFrame([], COUNTS).select(*KEYS, "clicks")
    rows = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
    if days is not None:
        rows = rows.where(F.col("dt").isin(days))
    return (rows.groupBy(*KEYS, "event_day").agg(F.max("clicks").alias("clicks"))
                .groupBy(*KEYS).agg(F.sum("clicks").cast("bigint").alias("clicks")))


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for the work on a batch's changes. The state's own
    plan is made before it and is not touched."""
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def process_changes(paths: StreamPaths, threshold: int, after: Callable[[str, int], None] = lambda step, batch: None):
    """The ``foreachBatch`` function of the aggregate's changed rows."""
    def run(changed: DataFrame, micro_batch: int) -> None:
        changed = changed.persist()
        try:
            batch, n = changed.agg(F.max("last_batch"), F.count(F.lit(1))).first()
            if batch is not None:
                with adaptive(changed.sparkSession):
                    tasks = -(-n // TASK_ROWS)
                    _apply(changed.coalesce(tasks), batch, tasks)
        finally:
            changed.unpersist()

    def _append(rows: DataFrame, where: str, batch: int) -> None:
        # one folder a day and batch: a batch that comes again writes its own anew
        rows.withColumn("seen", F.lit(batch)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("dt", "seen").parquet(where)

    def _apply(changed: DataFrame, batch: int, tasks: int) -> None:
        spark = changed.sparkSession
        in_range = F.to_date("event_day").cast("string") == F.col("dt")
        odd = changed.where(~in_range)
        has_odd = not odd.isEmpty()
        _append(changed.where(in_range), paths.counts, batch)
        if has_odd:
            _append(odd, paths.odd, batch)
        after("user counts", batch)

        days = [r[0] for r in changed.select("dt").distinct().collect()]  # the days of one batch
        changed = batch_changes(spark, paths, batch, days)
        mixed = [d for d in days if exists(spark, f"{paths.odd}/dt={d}")]
        now = changed.select(*KEYS, "clicks")
        if mixed:  # totals of these days' changed keys from all their rows
            same = [F.col(f"t.{c}").eqNullSafe(F.col(f"c.{c}")) for c in KEYS]
            keys = changed.where(F.col("dt").isin(mixed)).select(*KEYS).distinct()
            whole = stored_totals(spark, paths, mixed).alias("t").join(keys.alias("c"), same, "left_semi")
            now = now.where(~F.col("dt").isin(mixed)).unionByName(whole)
        now = now.persist()
        try:
            users, cities = now.where(F.col("kind") == USER), now.where(F.col("kind") == CITY)
            reached = users.where(F.col("clicks") >= threshold).select(
                F.pmod("uid", F.lit(16)).cast("int").alias("bucket"), "uid",
                F.lit(batch).cast("bigint").alias("banned_batch")).distinct()
            bans(spark, paths).merge(reached, batch)
            after("bans", batch)

            table = top_lists(spark, paths)
            areas = now.where(F.col("kind") == AREA)
            tops = new_top(table.read(days), areas).persist()  # a few rows for each area of the batch's days
            table.merge(tops, batch, replace=True, parts=days)
            lists = tops.join(areas.select("dt", "area").distinct(), ["dt", "area"], "left_semi")
            rows = [kv.kv_user_ads_daycount(users), kv.kv_blacklist(reached), kv.kv_area_city_ads_daycount(cities),
                    kv.kv_top3_ads_per_day(ads_ops.top_ads_per_day(lists, TOP_ADS))]
            fields = reduce(DataFrame.unionByName, rows).coalesce(tasks)
            hashstore.write_batch(fields, paths.store, batch, writer="running")
            tops.unpersist()
        finally:
            now.unpersist()
        after("area counts", batch)

    return run


def start(spark: SparkSession, paths: StreamPaths, threshold: int, name: str, keep_days: int = KEEP_DAYS,
          keep_survivors: bool = False, trigger: dict | None = None,
          after: Callable[[str, int], None] = lambda step, batch: None):
    """Run the aggregate over the surviving clicks; their files go when they
    are counted, unless ``keep_survivors``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(paths.survivors)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)
    clicks = (spark.readStream.schema(SURVIVOR_SCHEMA).option("cleanSource", "off" if keep_survivors else "delete")
                   .parquet(paths.survivors))
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():  # the query keeps the settings it was started with
        spark.conf.set(key, value)
    try:
        return (totals(clicks, keep_days).writeStream.queryName(name).outputMode("update")
                .option("checkpointLocation", paths.running_checkpoint)
                .foreachBatch(process_changes(paths, threshold, after))
                .trigger(**(trigger or {"processingTime": "500 milliseconds"})).start())
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
