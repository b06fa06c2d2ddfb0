"""Long ban lists as bitmaps: exact, and the events stay where they are."""
import random

from pyspark.sql import functions as F

from clickscope.operators import ads
from clickscope.plans.joins import BITMAP_BYTES, anti_join_ids, marked_by_bitmaps


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_marks_equal_membership_at_every_kind_of_id(spark):
    rnd = random.Random(4)
    edge = [0, 1, -1, 32767, 32768, 32769, -32768, -32769, 2**62, -2**62, 65536, 7, 8, 9]
    ids = edge[::2] + [rnd.randrange(-10**6, 10**6) for _ in range(500)]
    rows = edge + ids + [rnd.randrange(-10**6, 10**6) for _ in range(500)] + [None]
    df = spark.createDataFrame([(x, i) for i, x in enumerate(rows)], "uid long, i long")
    listed = spark.createDataFrame([(x,) for x in ids + [None]], "uid long")
    got = {r.i: r.hit for r in marked_by_bitmaps(df, listed, "uid", "hit").collect()}
    assert got == {i: None if x is None else x in set(ids) for i, x in enumerate(rows)}


def test_ten_million_bans_shuffle_no_event(spark):
    banned = spark.range(0, 30_000_000, 3).select(F.col("id").alias("uid"))
    events = spark.range(0, 200_000).select((F.col("id") * 151).alias("uid"), F.col("id").alias("event_id"))
    kept = anti_join_ids(events, banned, "uid", max_rows=2_000_000)
    plan = _plan(kept)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning(uid" not in plan
    assert "hashpartitioning(_b#" not in plan
    assert kept.count() == sum(1 for i in range(200_000) if i * 151 >= 30_000_000 or i * 151 % 3)


def test_all_three_ways_give_the_same(spark):
    events = spark.range(0, 5000).select((F.col("id") % 700).alias("uid"), F.col("id").alias("e"))
    ids = spark.range(0, 700, 7).select(F.col("id").alias("uid"))
    ways = [anti_join_ids(events, ids, "uid"), anti_join_ids(events, ids, "uid", max_rows=5),
            anti_join_ids(events, ids, "uid", max_rows=5, max_bytes=BITMAP_BYTES - 1)]
    want = sorted(e for e in range(5000) if e % 700 % 7)
    for df in ways:
        assert sorted(r.e for r in df.collect()) == want
    assert "SortMergeJoin" in _plan(ways[2]) and "SortMergeJoin" not in _plan(ways[1])


def test_survivors_of_a_long_list_equal_the_join(spark):
    rnd = random.Random(6)
    rows = [(i, rnd.randrange(60), rnd.randrange(10)) for i in range(3000)] + [(3000, None, 1)]
    df = spark.createDataFrame(rows, "event_id long, uid long, batch long")
    bans = spark.createDataFrame([(u, rnd.randrange(10)) for u in range(0, 60, 2)], "uid long, banned_batch long")
    want = sorted(r.event_id for r in ads.blacklist_filter(df, bans).collect())
    got = ads.survivors(df, bans, max_rows=3)
    assert got.columns == df.columns and sorted(r.event_id for r in got.collect()) == want
    assert sorted(r.event_id for r in ads.survivors(df, bans).collect()) == want
