import time

from pyspark.sql import functions as F

from clickscope.llm.shared import landed


def test_a_landed_frame_leaves_no_shuffle_behind(spark):
    tracker = spark.sparkContext._jsc.sc().env().mapOutputTracker()
    rows = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    before = tracker.shuffleStatuses().size()
    out = landed(rows, "shuffles")
    for _ in range(50):  # they go in the background
        if tracker.shuffleStatuses().size() <= before:
            break
        time.sleep(0.1)
    assert tracker.shuffleStatuses().size() <= before
    assert rows.count() == out.count() == 100 and out.agg(F.sum("count")).first()[0] == 10_000
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
