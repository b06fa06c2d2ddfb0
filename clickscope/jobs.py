"""Runnable jobs: the offline reports, the area report, and the ad stream.

Inputs are the model's tables in a catalog database (``schemas.py`` has their
columns). A job reads its parameters and adds every report, stamped with the
run's task id, to the report's table, in the same database unless another is
named; a task that runs again replaces its own rows. Each returns the names of
the tables it wrote.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from .operators import areas, categories, pages, visits
from .params import BLACKLIST_THRESHOLD, ReportParams, condition_from_properties
from .session import shared_dir
from .sinks.tables import append_task
from .streaming import adstream


def _table(spark: SparkSession, database: str, name: str) -> DataFrame:
    return spark.table(f"{database}.{name}")


def _write(reports: dict[str, DataFrame], task_id: str | None, database: str) -> list[str]:
    task = task_id or uuid.uuid4().hex
    for name, df in reports.items():
        append_task(df, f"{database}.{name}", task)
    return [f"{database}.{name}" for name in reports]


def offline_reports(spark: SparkSession, database: str, params: ReportParams) -> dict[str, DataFrame]:
    """The top categories, their top sessions, and the page conversion."""
    v = visits.user_visit_filter(_table(spark, database, "user_visit_action"),
                                 _table(spark, database, "user_info"), params.visits)
    top = categories.category_top(categories.category_action_counts(v), 10)
    sessions = categories.top_sessions(categories.category_session_counts(v, top), 10)
    ratio = pages.page_convert_ratio_of(pages.session_page_pairs(v, keep_last=True), params.target_page_flow)
    return {"category_top10": top, "category_top10_session": sessions, "page_convert_ratio": ratio}


def run_offline(spark: SparkSession, database: str, properties: str, task_id: str | None = None,
                out_database: str | None = None) -> list[str]:
    """``properties`` is the text of the condition properties file."""
    reports = offline_reports(spark, database, condition_from_properties(properties))
    return _write(reports, task_id, out_database or database)


def run_area_top3(spark: SparkSession, database: str, task_id: str | None = None,
                  out_database: str | None = None) -> list[str]:
    clicks = areas.area_city_clicks(_table(spark, database, "user_visit_action"), _table(spark, database, "city_info"))
    top = areas.area_top3_product(areas.area_product_clicks(clicks), _table(spark, database, "product_info"))
    return _write({"area_top3_product": top}, task_id, out_database or database)


def run_realtime(spark: SparkSession, lines: DataFrame, name: str = "ads", threshold: int = BLACKLIST_THRESHOLD,
                 trigger: dict | None = None, **options) -> adstream.AdStream:
    """Start the ad stream over a streaming frame of log lines (``topic_lines``,
    ``kafka_lines``, ``text_lines``). Its tables and the hash store with every
    report are below the shared folder. Returns the running stream."""
    paths = adstream.StreamPaths(f"{shared_dir(spark)}/{name}")
    return adstream.start(lines, paths, threshold, trigger, **options)
