"""Stream reports over the driver's tables: a deterministic replay.

The ad records are replayed through the stream in time blocks
(``BLOCK_DAYS`` days each, blocks in time order). Each block is appended to a
message topic (``sources.topic``) by one parallel Spark job, then the query
drains it with an ``availableNow`` trigger, from the offsets its checkpoint
holds, so micro-batch k is block k and the batch form (and its SQL oracle) can
number batches the same way. The reports are read back from the hash store.
One replay per session and input folder serves every ``stream_*`` key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import TEST_THRESHOLD
from ..session import fresh_subdir
from ..sinks import kv
from ..sources import adslog, topic
from ..sources import tables as tb
from ..streaming import adstream as pl
from ..streaming import running

BLOCK_DAYS = 10
PARTITIONS = 4
_DAY_MS = 86400 * 1000
_RUNS: dict[tuple[str, str], pl.StreamPaths] = {}


def block_of(ts_ms) -> F.Column:
    """Replay block of an event: epoch day div BLOCK_DAYS."""
    day = (ts_ms - F.pmod(ts_ms, F.lit(_DAY_MS))) / _DAY_MS
    return (F.floor(day / BLOCK_DAYS)).cast("bigint")


def replay(spark: SparkSession, sf_dir: str, threshold: int = TEST_THRESHOLD) -> pl.StreamPaths:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key in _RUNS:
        return _RUNS[key]
    base = fresh_subdir(spark, "stream-replay")
    src, paths = f"{base}/ads_log", pl.StreamPaths(f"{base}/out")
    topic.create(src, PARTITIONS)
    ads = tb.ads_log(spark, sf_dir)
    # the block numbers: one value per BLOCK_DAYS days of data
    blocks = [r[0] for r in ads.select(block_of(F.col("ts")).alias("b")).distinct().orderBy("b").collect()]
    span = BLOCK_DAYS * _DAY_MS
    totals = running.start(spark, paths, threshold, f"replay_totals_{key[0]}", BLOCK_DAYS, keep_survivors=True)
    try:
        for b in blocks:
            # the block's time range reaches the events scan as pushed filters
            part = tb.ads_log(spark, sf_dir, since_ms=b * span, until_ms=(b + 1) * span)
            topic.append(adslog.ads_lines(part), src)
            pl.run_available_now(spark, topic.topic_lines(spark, src, "earliest"), paths, threshold,
                                 keep_days=BLOCK_DAYS, totals=totals)
    finally:
        totals.stop()
    _RUNS[key] = paths
    return paths


def _un_line(df: DataFrame) -> DataFrame:
    return df.withColumn("area", adslog.area_from_line("area"))


def stream_blacklist_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.current_bans(spark, replay(spark, sf_dir)).select("uid", "banned_batch")


def stream_blacklist_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = pl.current_survivors(spark, replay(spark, sf_dir))
    return _un_line(s).select("ts", "area", "city", "uid", "ads_id", "dt")


def stream_user_ads_daycount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.kv_current(spark, replay(spark, sf_dir), kv.USER_ADS_DAYCOUNT)


def stream_area_city_ads_daycount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.kv_current(spark, replay(spark, sf_dir), kv.AREA_CITY_ADS_DAYCOUNT)


def stream_top3_ads_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.kv_current(spark, replay(spark, sf_dir), kv.TOP3_ADS_PER_DAY)


def stream_last_hour_ads_click(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.kv_current(spark, replay(spark, sf_dir), kv.LAST_HOUR_ADS_CLICK)


def registry():
    return {
        "stream_blacklist_users": stream_blacklist_users,
        "stream_blacklist_filter": stream_blacklist_filter,
        "stream_user_ads_daycount": stream_user_ads_daycount,
        "stream_area_city_ads_daycount": stream_area_city_ads_daycount,
        "stream_top3_ads_per_day": stream_top3_ads_per_day,
        "stream_last_hour_ads_click": stream_last_hour_ads_click,
    }
