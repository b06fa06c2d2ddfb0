"""Table sinks."""
import uuid

import pytest
from pyspark.sql import functions as F

from clickscope.session import fresh_subdir
from clickscope.sinks.tables import append_task, preview, replace_table, with_task_id
from clickscope.sources import tables as tb

from .conftest import SF_SMALL


def test_replace_table_twice(spark):
    where = fresh_subdir(spark, "warehouse") + "/city_info_t"
    ci = tb.city_info(spark, SF_SMALL)
    replace_table(ci, "city_info_t", path=where)
    replace_table(ci, "city_info_t", path=where)          # replace, not append
    got = sorted(map(tuple, spark.table("city_info_t").collect()))
    assert got == sorted(map(tuple, ci.collect()))
    spark.sql("DROP VIEW IF EXISTS city_info_t")


def test_readers_see_the_old_or_the_new_rows_and_a_failed_write_changes_nothing(spark):
    where, name = fresh_subdir(spark, "swap"), f"swap_{uuid.uuid4().hex[:8]}"
    replace_table(spark.range(3), name, path=where)
    reading = spark.table(name)
    replace_table(spark.range(5).withColumn("more", F.lit("x")), name, path=where)  # other columns too
    assert reading.count() == 3 and spark.table(name).columns == ["id", "more"]
    assert spark.table(name).count() == 5
    with pytest.raises(Exception, match="dead task"):
        replace_table(spark.range(2).select(F.raise_error(F.lit("dead task")).alias("id")), name, path=where)
    assert spark.table(name).count() == 5
    spark.sql(f"DROP VIEW {name}")
    spark.range(2).write.saveAsTable(name, path=where + "/old")
    replace_table(spark.range(7), name, path=where)  # a table of that name goes
    assert spark.table(name).count() == 7
    spark.sql(f"DROP VIEW {name}")


def test_tasks_share_a_table(spark):
    where, name = fresh_subdir(spark, "tasks") + "/t", f"tasks_{uuid.uuid4().hex[:8]}"
    append_task(spark.range(3), name, "a", path=where)
    append_task(spark.range(5), name, "b-2", path=where)
    append_task(spark.range(2), name, "a", path=where)  # again: its own rows only
    assert sorted(map(tuple, spark.table(name).collect())) == [(0, "a"), (0, "b-2"), (1, "a"), (1, "b-2"),
                                                               (2, "b-2"), (3, "b-2"), (4, "b-2")]
    with pytest.raises(ValueError):
        append_task(spark.range(1), name, "it's", path=where)
    spark.sql(f"DROP TABLE {name}")


def test_task_id_and_preview(spark):
    df = with_task_id(tb.city_info(spark, SF_SMALL), "t-1")
    assert df.columns[0] == "task_id"
    assert preview(df, 3).count() == 3


def test_raw_preview_prints_batches(spark):
    import os
    import tempfile

    from clickscope.session import fresh_subdir
    from clickscope.streaming.adstream import start_raw_preview_first_rows
    src = tempfile.mkdtemp(dir=fresh_subdir(spark, "preview").removeprefix("file:"))
    with open(os.path.join(src, "a.txt"), "w") as fh:
        fh.write("1704067200000 north cityA 7 3\n")
    q = start_raw_preview_first_rows(spark.readStream.format("text").load(src), {"availableNow": True})
    q.awaitTermination()
    # the console output goes to the JVM's stdout; check the query's progress
    prog = [p for p in q.recentProgress if p["numInputRows"]]
    assert prog and prog[0]["numInputRows"] == 1
    assert "Console" in prog[0]["sink"]["description"]
