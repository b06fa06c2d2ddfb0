"""Ad-click log lines: sources and the line parser.

Line format: ``<epoch ms> <area> <city> <uid> <ad id>``, fields separated by
single spaces. Fields past the fifth are ignored. A line with fewer than five
fields, a non-integer ts/uid/ad, or a ts outside the timestamp range (years
1-9999) is rejected (kept out of the parsed rows, available for counting)
instead of failing the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import epoch_ms_day

_INT = r"^[+-]?[0-9]{1,19}$"
# Epoch ms of 0001-01-01T00:00:00Z and 9999-12-31T23:59:59.999Z: the range of
# Spark timestamps. A ts outside it is rejected (the day could not be formed).
MIN_TS_MS = -62135596800000
MAX_TS_MS = 253402300799999


def _int_field(tok: Column) -> Column:
    return F.when(tok.rlike(_INT), tok.try_cast("bigint"))


def parse_record(value: Column) -> Column:
    """Line -> struct(ts, area, city, uid, ads_id), or NULL when rejected."""
    parts = F.split(value, " ")
    tok = [F.try_element_at(parts, F.lit(i + 1)) for i in range(5)]
    ts, uid, ads = _int_field(tok[0]), _int_field(tok[3]), _int_field(tok[4])
    ts = F.when(ts.between(MIN_TS_MS, MAX_TS_MS), ts)
    valid = (ts.isNotNull() & tok[1].isNotNull() & tok[2].isNotNull()
             & uid.isNotNull() & ads.isNotNull())
    rec = F.struct(ts.alias("ts"), tok[1].alias("area"), tok[2].alias("city"),
                   uid.alias("uid"), ads.alias("ads_id"))
    return F.when(valid, rec)


def parse_ads_lines(lines: DataFrame, value_col: str = "value", keep: list[str] | None = None,
                    observe_as: str | None = None) -> DataFrame:
    """Valid lines as (ts, area, city, uid, ads_id, dt) plus ``keep`` columns.

    A flatMap: each line yields its record or nothing. The record is built in
    one projection (one split per line, shared by all fields), and dropping
    rejects through ``explode`` keeps Catalyst from re-evaluating the parse
    inside a pushed-down filter.
    """
    keep = keep or []
    recs = lines.select(*keep, parse_record(F.col(value_col)).alias("_rec"))
    rec = F.col("_rec")
    if observe_as:
        # per-batch line and reject counts, reported in the query progress
        recs = recs.observe(observe_as, F.count(F.lit(1)).alias("lines"),
                            F.count_if(rec.isNull()).alias("rejected"))
    one = recs.select(*keep, F.explode(F.when(rec.isNotNull(), F.array(rec))).alias("_r"))
    return one.select(*keep, "_r.*", epoch_ms_day(F.col("_r.ts")).alias("dt"))


def rejected_ads_lines(lines: DataFrame, value_col: str = "value") -> DataFrame:
    return lines.where(parse_record(F.col(value_col)).isNull()).select(value_col)


def ads_lines(ads: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Render ad records as log lines. Spaces inside the area become ``_``
    (the line format splits on spaces); ``area_from_line`` undoes it."""
    keep = keep or []
    line = F.concat_ws(" ", F.col("ts").cast("string"), F.regexp_replace("area", " ", "_"),
                       F.col("city"), F.col("uid").cast("string"), F.col("ads_id").cast("string"))
    return ads.select(*keep, line.alias("value"))


def area_from_line(col: str = "area") -> Column:
    return F.regexp_replace(F.col(col), "_", " ")


def kafka_lines(spark: SparkSession, brokers: str, topic: str = "ads_log",
                starting_offsets: str = "latest") -> DataFrame:
    """Streaming source of ad-log lines from a message topic (needs the
    spark-sql-kafka package on the classpath)."""
    return (spark.readStream.format("kafka")
                 .option("kafka.bootstrap.servers", brokers)
                 .option("subscribe", topic)
                 .option("startingOffsets", starting_offsets)
                 .load()
                 .selectExpr("CAST(value AS STRING) AS value"))


def text_lines(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming source of ad-log lines from text files in a folder."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)
