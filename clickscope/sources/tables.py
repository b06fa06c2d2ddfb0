"""Table scans and the bindings of the click-stream model onto the driver's tables.

Every binding is a projection over a parquet scan, so Catalyst prunes columns
and pushes filters from the reports down into the scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import bounded_broadcast

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def events_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` plus ``k``, the integer stored in ``props``."""
    return read_table(spark, sf_dir, "events").withColumn("k", _k())


def _cat_list(k: Column, event_id: Column) -> Column:
    cats = F.array(k % 20 + 1, (k + 7) % 20 + 1, (k + 13) % 20 + 1)
    return F.array_join(F.slice(cats, F.lit(1), (event_id % 3 + 1).cast("int")), ",")


def _iso_day(day: str | None) -> _dt.date | None:
    """ISO day text -> ``date``, or None when absent or not an ISO day."""
    try:
        return _dt.date.fromisoformat(day) if day else None
    except ValueError:
        return None


def user_visit_action(spark: SparkSession, sf_dir: str,
                      start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """The user-visit-action table over ``events`` (one row per event).

    ``start_date``/``end_date`` (ISO days, inclusive) become a range on the
    raw ``ts`` so the bound reaches the parquet scan; the report still
    applies its own predicate on ``date``, this is only a superset prefilter.
    """
    ev = events_k(spark, sf_dir)
    lo, hi = _iso_day(start_date), _iso_day(end_date)
    if lo is not None:
        ev = ev.where(F.col("ts") >= F.to_timestamp_ntz(F.lit(f"{lo.isoformat()} 00:00:00")))
    if hi is not None:
        nxt = hi + _dt.timedelta(days=1)
        ev = ev.where(F.col("ts") < F.to_timestamp_ntz(F.lit(f"{nxt.isoformat()} 00:00:00")))
    k, eid, et = F.col("k"), F.col("event_id"), F.col("event_type")
    day = F.date_format("ts", "yyyy-MM-dd")
    is_click = et == "click"
    is_order = (et == "purchase") & (eid % 2 == 0)
    is_pay = (et == "purchase") & (eid % 2 == 1)
    return ev.select(
        eid.alias("event_id"),
        day.alias("date"),
        F.col("user_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"), day).alias("session_id"),
        (k % 10 + 1).alias("page_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("action_time"),
        F.when(et.isin("view", "signup", "error"), et).alias("search_keyword"),
        F.when(is_click, k % 20 + 1).otherwise(F.lit(-1)).cast("bigint").alias("click_category_id"),
        F.when(is_click, k + 1).otherwise(F.lit(-1)).cast("bigint").alias("click_product_id"),
        F.when(is_order, _cat_list(k, eid)).alias("order_category_ids"),
        F.when(is_order, (k + 1).cast("string")).alias("order_product_ids"),
        F.when(is_pay, _cat_list(k, eid)).alias("pay_category_ids"),
        F.when(is_pay, (k + 1).cast("string")).alias("pay_product_ids"),
        (F.col("user_id") % 25).alias("city_id"),
    )


def user_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("username"),
        F.col("c_name").alias("name"),
        (F.lit(10) + F.col("c_custkey") % 50).cast("int").alias("age"),
        F.col("c_mktsegment").alias("professional"),
        F.when(F.col("c_custkey") % 5 < 3, "M").otherwise("F").alias("gender"),
    )


def product_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("product_id"),
                    F.col("p_name").alias("product_name"),
                    F.col("p_brand").alias("extend_info"))


def city_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey)
             .select(n.n_nationkey.cast("bigint").alias("city_id"),
                     n.n_name.alias("city_name"),
                     r.r_name.alias("area")))


def _ntz(ms: int):
    """Epoch ms -> TIMESTAMP_NTZ literal (UTC wall time)."""
    t = _dt.datetime(1970, 1, 1) + _dt.timedelta(milliseconds=int(ms))
    return F.to_timestamp_ntz(F.lit(t.isoformat(sep=" ")))


def ads_log(spark: SparkSession, sf_dir: str, since_ms: int | None = None,
            until_ms: int | None = None) -> DataFrame:
    """Ad-click records: ``events`` placed in a city/area, ts in epoch ms.

    ``[since_ms, until_ms)`` restricts the raw ``ts`` so the range reaches
    the parquet scan (used to replay the table block by block)."""
    ev = events_k(spark, sf_dir)
    if since_ms is not None:
        ev = ev.where(F.col("ts") >= _ntz(since_ms))
    if until_ms is not None:
        ev = ev.where(F.col("ts") < _ntz(until_ms))
    ci = bounded_broadcast(city_info(spark, sf_dir))
    ts_ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return (ev.join(ci, (ev.user_id % 25) == ci.city_id)
              .select(ev.event_id,
                      ts_ms.alias("ts"),
                      ci.area,
                      ci.city_name.alias("city"),
                      ev.user_id.alias("uid"),
                      (F.col("k") % 6 + 1).alias("ads_id"),
                      F.date_format(F.col("ts"), "yyyy-MM-dd").alias("dt")))


def star_area_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as product clicks: (area, city_name, click_product_id).

    lineitem -> orders -> customer -> nation (city) -> region (area); the
    product is the part. Used to run the area top-3 report at lineitem scale.

    Orders are placed first (orders x customer x city, orders-sized), so the
    largest table, lineitem, is shuffled once, on the order key.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    ci = bounded_broadcast(city_info(spark, sf_dir))
    placed = (o.join(c, o.o_custkey == c.c_custkey)
               .join(ci, c.c_nationkey.cast("bigint") == ci.city_id)
               .select(o.o_orderkey, ci.area, ci.city_name))
    return (li.join(placed, li.l_orderkey == placed.o_orderkey)
              .select("area", "city_name", li.l_partkey.alias("click_product_id")))
