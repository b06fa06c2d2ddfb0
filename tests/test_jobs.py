"""The jobs read catalog tables and add to task-stamped report tables."""
import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from clickscope import jobs, session
from clickscope.params import REPORT_PARAMS as P
from clickscope.session import fresh_subdir, shared_dir
from clickscope.sinks import hashstore
from clickscope.sources import adslog
from clickscope.sources import tables as tb
from clickscope.streaming import adstream

from .conftest import SF_SMALL

PROPERTIES = f"""condition.params.json={{startDate:"{P.visits.start_date}", endDate:"{P.visits.end_date}", \\
 startAge:"{P.visits.start_age}", endAge:"{P.visits.end_age}", targetPageFlow:"{','.join(map(str, P.target_page_flow))}"}}"""


@pytest.fixture(scope="module")
def database(spark):
    name = f"shop_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{fresh_subdir(spark, 'db')}'")
    for t in ("user_visit_action", "user_info", "product_info", "city_info"):
        getattr(tb, t)(spark, SF_SMALL).write.saveAsTable(f"{name}.{t}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def _same(spark, table, key, task):
    got = spark.table(table).where(F.col("task_id") == task).drop("task_id")
    want = E.queries()[key](spark, SF_SMALL).select(*got.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_offline_and_area_jobs(spark, database):
    for task in ("t1", "t2", "t2"):  # a task that runs again replaces its own rows only
        names = jobs.run_offline(spark, database, PROPERTIES, task_id=task)
        names += jobs.run_area_top3(spark, database, task_id=task)
    for name, key in zip(names, ("category_top10", "top10_session", "page_convert_ratio", "area_top3_product")):
        assert {r.task_id for r in spark.table(name).select("task_id").distinct().collect()} == {"t1", "t2"}
        for task in ("t1", "t2"):
            _same(spark, name, key, task)


def test_realtime_job(spark):
    src = fresh_subdir(spark, "job-lines")
    spark.createDataFrame([("1704067200000 north cityA 1 2",), ("bad line",)], "value string").write.mode(
        "append").text(src)
    name = f"ads-{uuid.uuid4().hex[:8]}"
    jobs.run_realtime(spark, adslog.text_lines(spark, src), name, trigger={"availableNow": True}).awaitTermination()
    paths = adstream.StreamPaths(f"{shared_dir(spark)}/{name}")
    row = adstream.batch_stats(spark, paths).first()
    assert (row.lines, row.rejected) == (2, 1)
    held = {(r.key, r.field, r.value) for r in hashstore.read_store(spark, paths.store).collect()}
    assert ("area_city_ads_daycount", "north:cityA:2:2024-01-01", "1") in held
    assert ("top3_ads_per_day:2024-01-01", "north", '[{"2":1}]') in held


def test_shared_folder_paths(spark, monkeypatch):
    plain = shared_dir(spark).removeprefix("file:")
    for base in (plain, "file:" + plain, "file://" + plain):
        monkeypatch.setattr(session, "shared_dir", lambda spark, base=base: base)
        where = fresh_subdir(spark, "x")
        assert where.startswith("file:")
        spark.range(3).write.mode("overwrite").parquet(where)
        assert spark.read.parquet(where).count() == 3
