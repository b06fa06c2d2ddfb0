"""Registry of the reports: key -> callable(spark, sf_dir) -> DataFrame.

Each report reads the driver's tables through the bindings in
``sources.tables`` and composes operators; nothing is collected.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dataclasses import replace

from . import streams
from ..operators import ads, areas, categories, pages, visits
from ..params import FILTER_PARAMS, REPORT_PARAMS, REPORT_TASK_ID, TASKS, TEST_THRESHOLD
from ..session import fresh_subdir
from .joins import materialized
from ..sinks import kv
from ..sinks.tables import append_task, replace_table, with_task_id
from ..sources import adslog
from ..sources import tables as tb

Report = Callable[[SparkSession, str], DataFrame]


def _visit_filter(spark, d, p):
    uva = tb.user_visit_action(spark, d, p.start_date, p.end_date)
    return visits.user_visit_filter(uva, tb.user_info(spark, d), p)


def _user_visit_filter(spark, d):
    return _visit_filter(spark, d, FILTER_PARAMS).select("event_id", "user_id", "date", "age")


def _user_visit_filter_as_written(spark, d):
    p = replace(FILTER_PARAMS, as_written=True)
    return _visit_filter(spark, d, p).select("event_id", "user_id", "date", "age")


def _report_visits(spark, d):
    return _visit_filter(spark, d, REPORT_PARAMS.visits)


def _category_action_counts(spark, d):
    return categories.category_action_counts(_report_visits(spark, d))


def _category_top10(spark, d):
    return categories.category_top(_category_action_counts(spark, d), 10)


def _category_session_counts(spark, d):
    v = _report_visits(spark, d)
    top = categories.category_top(categories.category_action_counts(v), 10)
    return categories.category_session_counts(v, top)


def _top10_session(spark, d):
    return categories.top_sessions(_category_session_counts(spark, d), 10)


def _page_visit_counts(spark, d):
    return pages.page_visit_counts(_report_visits(spark, d), REPORT_PARAMS.target_page_flow)


def _session_page_pairs(spark, d):
    return pages.session_page_pairs(_report_visits(spark, d))


def _page_jump_counts(spark, d):
    return pages.page_jump_counts(_session_page_pairs(spark, d), REPORT_PARAMS.target_page_flow)


def _page_convert_ratio(spark, d):
    steps = pages.session_page_pairs(_report_visits(spark, d), keep_last=True)
    return pages.page_convert_ratio_of(steps, REPORT_PARAMS.target_page_flow)


def _area_city_clicks(spark, d):
    return areas.area_city_clicks(tb.user_visit_action(spark, d), tb.city_info(spark, d))


def _area_product_clicks(spark, d):
    return areas.area_product_clicks(_area_city_clicks(spark, d))


def _area_top3_product(spark, d):
    return areas.area_top3_product(_area_product_clicks(spark, d), tb.product_info(spark, d))


def _area_top3_product_star(spark, d):
    pc = areas.area_product_clicks(tb.star_area_clicks(spark, d))
    return areas.area_top3_product(pc, tb.product_info(spark, d))


def _ads_log_parse(spark, d):
    lines = adslog.ads_lines(tb.ads_log(spark, d), keep=["event_id"])
    parsed = adslog.parse_ads_lines(lines, keep=["event_id"])
    return parsed.select("event_id", "ts", adslog.area_from_line().alias("area"),
                         "city", "uid", "ads_id", "dt")


def _batched_ads(spark, d):
    return ads.with_batch(tb.ads_log(spark, d))


def _blacklist_users(spark, d):
    return ads.ban_batches(_batched_ads(spark, d), TEST_THRESHOLD)


def _survivors(spark, d):
    b = _batched_ads(spark, d)
    # the ban list is measured before the join, so that the ad records are
    # filtered where they are read instead of shuffled
    return ads.survivors(b, materialized(ads.ban_batches(b, TEST_THRESHOLD)))


def _blacklist_filter(spark, d):
    return _survivors(spark, d).select("event_id", "uid", "ads_id")


def _user_ads_daycount(spark, d):
    return ads.user_ads_daycount(_survivors(spark, d))


def _area_city_ads_daycount(spark, d):
    return ads.area_city_ads_daycount(_survivors(spark, d))


def _area_ads_daycount(spark, d):
    return ads.area_ads_daycount(_area_city_ads_daycount(spark, d))


def _top3_ads_per_day(spark, d):
    return ads.top_ads_per_day(_area_ads_daycount(spark, d), 3)


def _last_hour_minutes(spark, d):
    """The window is found first, by a probe backwards over what survives; then
    only its time range is scanned (the ranges reach the events scan), with the
    ban list made from all history."""
    keep = ads.blacklist(materialized(ads.ban_batches(_batched_ads(spark, d), TEST_THRESHOLD)))

    def surviving(since, until):
        return keep(ads.with_batch(tb.ads_log(spark, d, since_ms=since, until_ms=until)))

    latest = ads.latest_event_back(surviving, int(time.time() * 1000))
    start, end = ads.window(-1 if latest is None else latest)
    return ads.last_hour_ads_minutes(surviving(start + 1, end + 1), as_of_ms=end)


def _last_hour_ads_minutes(spark, d):
    return _last_hour_minutes(spark, d).select("ads_id", "hour_minute", "clicks")


def _last_hour_ads_click(spark, d):
    return ads.last_hour_ads_click(_last_hour_minutes(spark, d))


def _kv_area_city_ads_daycount(spark, d):
    return kv.kv_area_city_ads_daycount(_area_city_ads_daycount(spark, d))


def _kv_top3_ads_per_day(spark, d):
    return kv.kv_top3_ads_per_day(_top3_ads_per_day(spark, d))


def _kv_last_hour_ads_click(spark, d):
    return kv.kv_last_hour_ads_click(_last_hour_ads_click(spark, d))


def _kv_user_ads_daycount(spark, d):
    return kv.kv_user_ads_daycount(_user_ads_daycount(spark, d))


def _kv_blacklist(spark, d):
    return kv.kv_blacklist(_blacklist_users(spark, d))


def _table_replace(spark, d):
    """Catalog-table replace written twice, read back. The entry has a name of
    its own and does not stay in the catalog; its files are in shared storage."""
    where = fresh_subdir(spark, "tables") + "/city_info"
    name = f"city_info_{uuid.uuid4().hex}"
    for _ in range(2):
        held = replace_table(tb.city_info(spark, d), name, path=where)
    spark.sql(f"DROP VIEW {name}")  # the files stay
    return spark.read.parquet(held)


def _report_tasks(spark, d):
    """The category report of two tasks in one table, the second run twice."""
    where = fresh_subdir(spark, "tables") + "/category_top10"
    name = f"category_top10_{uuid.uuid4().hex}"
    for task in TASKS + TASKS[1:]:
        append_task(_category_top10(spark, d), name, task, path=where)
    columns = spark.table(name).columns
    spark.sql(f"DROP TABLE {name}")  # external: the files stay
    return spark.read.parquet(where).withColumn("task_id", F.col("task_id").cast("string")).select(*columns)


def _page_convert_ratio_task(spark, d):
    return with_task_id(_page_convert_ratio(spark, d), REPORT_TASK_ID)


def registry() -> dict[str, Report]:
    return {
        "user_visit_filter": _user_visit_filter,
        "user_visit_filter_as_written": _user_visit_filter_as_written,
        "category_action_counts": _category_action_counts,
        "category_top10": _category_top10,
        "category_session_counts": _category_session_counts,
        "top10_session": _top10_session,
        "page_visit_counts": _page_visit_counts,
        "session_page_pairs": _session_page_pairs,
        "page_jump_counts": _page_jump_counts,
        "page_convert_ratio": _page_convert_ratio,
        "page_convert_ratio_task": _page_convert_ratio_task,
        "area_city_clicks": _area_city_clicks,
        "area_product_clicks": _area_product_clicks,
        "area_top3_product": _area_top3_product,
        "area_top3_product_star": _area_top3_product_star,
        "ads_log_parse": _ads_log_parse,
        "blacklist_users": _blacklist_users,
        "blacklist_filter": _blacklist_filter,
        "user_ads_daycount": _user_ads_daycount,
        "area_city_ads_daycount": _area_city_ads_daycount,
        "area_ads_daycount": _area_ads_daycount,
        "top3_ads_per_day": _top3_ads_per_day,
        "last_hour_ads_minutes": _last_hour_ads_minutes,
        "last_hour_ads_click": _last_hour_ads_click,
        "kv_area_city_ads_daycount": _kv_area_city_ads_daycount,
        "kv_top3_ads_per_day": _kv_top3_ads_per_day,
        "kv_last_hour_ads_click": _kv_last_hour_ads_click,
        "kv_user_ads_daycount": _kv_user_ads_daycount,
        "kv_blacklist": _kv_blacklist,
        "table_replace": _table_replace,
        "report_tasks": _report_tasks,
        **streams.registry(),
    }
