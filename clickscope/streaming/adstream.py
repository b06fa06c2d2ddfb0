"""The ad-click stream: filtering, line counts and the last hour.

Each micro-batch of log lines is parsed and filtered by the blacklist as it
stood before the batch. The surviving clicks are

* handed on, as one folder a batch, to the running totals (``running``): clicks
  per user, ad and day with the users who reach the threshold by them (banned
  from the next batch on), clicks per area, city, ad and day, and the top ads;
* counted into 10-second panes of the last hour for the per-minute snapshot.

A batch waits for the totals of the batches before it, since their bans decide
what survives. The hash store is written by both: each batch's changed fields,
and the last hour as a key replaced whole.

Everything survives a crash at any point: a batch's surviving clicks appear by
one rename and are not written again, tables mark the batch that wrote them
(``sinks.merged``), the totals are absolute, and store batches are known by
number, so a batch that comes again changes nothing twice. Late clicks still
add to their own day.

The last hour follows arrival: its clock is the latest event time that is not
after the arrival of its batch, so a line from the far future counts in its
day but does not move the window.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import epoch_ms_day
from ..operators import ads as ads_ops
from ..params import SLIDE_MS, WINDOW_MS
from ..plans.joins import anti_join_ids
from ..sinks import hashstore, kv
from ..sinks.merged import MergedTable
from ..sources.adslog import parse_record
from . import running
from .running import KEEP_DAYS, SURVIVOR_SCHEMA, StreamPaths, bans

__all__ = ["StreamPaths", "bans", "start", "run_available_now", "kv_current"]

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS


def panes(spark: SparkSession, paths: StreamPaths) -> MergedTable:
    return MergedTable(spark, f"{paths.base}/last_hour_panes", "hour long, ads_id long, pane_ms long, clicks long",
                       "hour", ["hour", "ads_id", "pane_ms"], {"clicks": "sum"})


STATS = "batch_id long, lines long, rejected long, arrival_ms long, clock_ms long, block long"


def batch_stats(spark: SparkSession, paths: StreamPaths) -> DataFrame:
    """One row a batch: lines, rejected lines, arrival, and the window's clock."""
    where = f"{paths.base}/batches"
    if not running.exists(spark, where):
        return spark.createDataFrame([], STATS)
    return spark.read.schema(STATS).parquet(where)


def _last_hour(spark: SparkSession, paths: StreamPaths, clock_ms: int, length_ms: int, slide_ms: int) -> DataFrame:
    end = clock_ms - clock_ms % slide_ms + slide_ms - 1
    start = end - length_ms  # window (start, end]
    rows = panes(spark, paths).read().where(
        (F.col("hour") >= start // HOUR_MS) & (F.col("pane_ms") > start) & (F.col("pane_ms") <= end))
    minute = (F.col("pane_ms") - F.pmod(F.col("pane_ms"), F.lit(60000))).alias("minute_ms")
    minutes = rows.groupBy("ads_id", minute, F.date_format(F.timestamp_millis("pane_ms"), "HH:mm").alias(
        "hour_minute")).agg(F.sum("clicks").cast("bigint").alias("clicks"))
    return ads_ops.last_hour_ads_click(minutes)


def _event_day(clock_ms: int | None, arrived_ms: int, keep_days: int):
    """The day a click's totals are kept under (see ``running``)."""
    latest = (clock_ms if clock_ms is not None else DAY_MS) // DAY_MS  # no clock: any fixed day
    day = F.floor(F.col("ts") / DAY_MS)
    in_range = (F.col("ts") <= arrived_ms) & (day >= latest - keep_days)
    return F.date_from_unix_date(F.when(in_range, day).otherwise(F.lit(latest)).cast("int"))


def _place(rows: DataFrame, path: str) -> None:
    """Write ``rows`` as the folder ``path`` by one rename; a folder that is
    there already is complete and stays."""
    spark = rows.sparkSession
    if running.exists(spark, path):
        return
    parent, name = path.rsplit("/", 1)
    fresh = f"{parent}-writing/{name}"
    rows.write.mode("overwrite").parquet(fresh)
    as_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = as_path(fresh).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(as_path(parent))
    if not fs.rename(as_path(fresh), as_path(path)):
        raise OSError(f"could not place {path}")


def process_batch(paths: StreamPaths, length_ms: int = WINDOW_MS, slide_ms: int = SLIDE_MS,
                  keep_days: int = KEEP_DAYS, arrival_ms: Callable[[], int] = lambda: int(time.time() * 1000),
                  after: Callable[[str, int], None] = lambda step, batch_id: None,
                  settle: Callable[[], None] = lambda: None):
    """The ``foreachBatch`` function. ``settle`` waits until the running totals
    have taken in what survived so far; ``after`` is called when a step of a
    batch is done (tests stop the query there)."""
    def run(lines: DataFrame, batch_id: int) -> None:
        spark = lines.sparkSession
        settle()
        records = lines.select(parse_record(F.col("value")).alias("r")).persist()
        try:
            events = records.where("r is not null").select("r.*", epoch_ms_day(F.col("r.ts")).alias("dt"))
            barred = bans(spark, paths).read().where(F.col("banned_batch") < batch_id).select("uid")
            kept = anti_join_ids(events, barred, "uid").persist()
            try:
                arrived, clock = _count(spark, records, kept, batch_id)
                out = kept.select("ts", "area", "city", "uid", "ads_id", "dt",
                                  _event_day(clock, arrived, keep_days).alias("event_day"))
                _place(out, f"{paths.survivors}/batch_id={batch_id}")
                after("survivors", batch_id)
                if clock is not None:
                    _window(spark, kept, batch_id, clock)
                after("panes", batch_id)
            finally:
                kept.unpersist()
        finally:
            records.unpersist()
        settle()

    def _count(spark: SparkSession, records: DataFrame, kept: DataFrame, batch_id: int) -> tuple[int, int | None]:
        """Store the batch's line counts; returns its arrival and the window's
        clock. A replayed batch keeps those of its first run."""
        block, known = batch_id // 1000, {}
        # a folder a batch in blocks of a thousand: only the last ones are listed
        near = [f"{paths.base}/batches/block={b}" for b in (block - 1, block)]
        for where in [w for w in near if running.exists(spark, w)]:
            last = spark.read.schema(STATS).parquet(where).where(F.col("batch_id") <= batch_id)
            known |= {r.batch_id: r for r in last.orderBy(F.desc("batch_id")).limit(2).collect()}
        if batch_id not in known:
            arrived = arrival_ms()
            seen = records.agg(F.count("*").alias("n"), F.count_if(F.col("r").isNull()).alias("rejected")).first()
            latest = kept.agg(F.max(F.when(F.col("ts") <= arrived, F.col("ts")))).first()[0]
            clocks = [x for x in (latest, *(r.clock_ms for r in known.values())) if x is not None]
            clock = max(clocks, default=None)
            row = spark.createDataFrame([(batch_id, seen.n, seen.rejected, arrived, clock, block)], STATS)
            _place(row.drop("block").coalesce(1), f"{paths.base}/batches/block={block}/at={batch_id}")
            after("stats", batch_id)
            return arrived, clock
        return known[batch_id].arrival_ms, known[batch_id].clock_ms

    def _window(spark: SparkSession, kept: DataFrame, batch_id: int, clock: int) -> None:
        oldest = clock - length_ms - slide_ms
        pane = (F.col("ts") - F.pmod("ts", F.lit(slide_ms))).alias("pane_ms")
        recent = kept.where((F.col("ts") > oldest) & (F.col("ts") <= clock))
        counts = recent.groupBy("ads_id", pane).agg(F.count("*").alias("clicks")).withColumn(
            "hour", F.floor(F.col("pane_ms") / HOUR_MS))
        table = panes(spark, paths)
        table.merge(counts, batch_id)
        table.drop_parts(oldest // HOUR_MS)
        snapshot = kv.kv_last_hour_ads_click(_last_hour(spark, paths, clock, length_ms, slide_ms))
        hashstore.write_batch(hashstore.replaced(snapshot, kv.LAST_HOUR_ADS_CLICK), paths.store, batch_id,
                              writer="window")

    return run


class AdStream:
    """A started stream: the filtering query and, if it is its own, the query of
    the running totals behind it."""

    def __init__(self, query, totals):
        self.query, self.totals = query, totals

    @property
    def isActive(self) -> bool:
        return self.query.isActive

    def processAllAvailable(self) -> None:
        self.query.processAllAvailable()

    def awaitTermination(self, timeout: float | None = None):
        """Wait for the filtering query to end, then end the totals too."""
        try:
            ended = self.query.awaitTermination(timeout) if timeout is not None else self.query.awaitTermination()
        except BaseException:
            self.stop()
            raise
        if not self.query.isActive:
            self._stop_totals()
        return ended

    def stop(self) -> None:
        self.query.stop()
        self._stop_totals()

    def _stop_totals(self) -> None:
        if self.totals is not None:
            self.totals.stop()


def start(lines: DataFrame, paths: StreamPaths, threshold: int, trigger: dict | None = None,
          name: str = "ads_stream", keep_days: int = KEEP_DAYS, keep_survivors: bool = False, totals=None,
          **options) -> AdStream:
    """Run the stream (live: a 5-second trigger). ``keep_survivors`` keeps the
    filtered events, one folder a batch; ``totals`` is a running query of the
    totals that the caller started and stops; ``options`` go to ``process_batch``."""
    after = options.get("after", lambda step, batch: None)
    own = totals is None
    if own:
        totals = running.start(lines.sparkSession, paths, threshold, f"{name}_totals", keep_days, keep_survivors,
                               after=after)
    try:
        batch = process_batch(paths, keep_days=keep_days, settle=totals.processAllAvailable, **options)
        query = (lines.select("value").writeStream.queryName(name).option("checkpointLocation", paths.checkpoint)
                      .foreachBatch(batch).trigger(**(trigger or {"processingTime": "5 seconds"})).start())
    except BaseException:
        if own:
            totals.stop()
        raise
    return AdStream(query, totals if own else None)


def run_available_now(spark: SparkSession, lines: DataFrame, paths: StreamPaths, threshold: int,
                      **options) -> dict[str, int]:
    """Drain the line source (tests, backfills). Returns the lines and rejected
    lines of all batches of this run, as stored per batch."""
    before = batch_stats(spark, paths).agg(F.coalesce(F.max("batch_id"), F.lit(-1))).first()[0]
    start(lines, paths, threshold, {"availableNow": True}, **options).awaitTermination()
    row = batch_stats(spark, paths).where(F.col("batch_id") > before).agg(
        F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"),
        F.coalesce(F.sum("rejected"), F.lit(0)).alias("rejected")).first()
    return {"lines": row.lines, "rejected": row.rejected}


def start_raw_preview_first_rows(lines: DataFrame, trigger: dict | None = None, rows: int = 20,
                                 name: str = "ads_raw_preview"):
    """Print the first ``rows`` raw lines of each micro-batch on the driver
    console: a debugging aid that shows a sample, not every record."""
    w = (lines.writeStream.queryName(name).format("console")
              .option("truncate", "false").option("numRows", str(rows)))
    return w.trigger(**(trigger or {"processingTime": "5 seconds"})).start()


# ---- what the stream holds now ---------------------------------------------

def current_bans(spark: SparkSession, paths: StreamPaths) -> DataFrame:
    return bans(spark, paths).read().select("uid", "banned_batch")


def current_survivors(spark: SparkSession, paths: StreamPaths) -> DataFrame:
    return spark.read.schema(SURVIVOR_SCHEMA).parquet(paths.survivors)


def kv_current(spark: SparkSession, paths: StreamPaths, name: str) -> DataFrame:
    """(key, field, value): the content of one report in the hash store."""
    rows = hashstore.read_store(spark, paths.store)
    if name == kv.TOP3_ADS_PER_DAY:  # a key a day
        return rows.where(F.col("key").startswith(f"{name}:"))
    return rows.where(F.col("key") == name)
