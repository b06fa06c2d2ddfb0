"""Hand-made edge cases of the ad-log parser and the batch ad reports."""
from pyspark.sql import functions as F

from clickscope.operators import ads
from clickscope.sources import adslog

DAY0 = 1704067200000  # 2024-01-01 00:00:00 UTC in ms


def test_parser_rejects_and_accepts(spark):
    lines = spark.createDataFrame([
        (f"{DAY0} north cityA 7 3",),          # ok
        (f"{DAY0} north cityA 7 3 extra",),    # 6th field ignored
        (f"{DAY0} north cityA 7",),            # short
        (f"{DAY0} north cityA x 3",),          # non-numeric uid
        (f"abc north cityA 7 3",),             # non-numeric ts
        (f"{DAY0} north cityA 7 3.5",),        # non-integer ad
        ("9223372036854775807 north cityA 7 3",),  # ts past year 9999
    ], "value string")
    ok = adslog.parse_ads_lines(lines).collect()
    assert [(r.ts, r.area, r.city, r.uid, r.ads_id, r.dt) for r in ok] == \
        [(DAY0, "north", "cityA", 7, 3, "2024-01-01")] * 2
    assert adslog.rejected_ads_lines(lines).count() == 5


def _ads(spark, rows):
    """rows: (event_id, ts_ms, uid, ads_id)"""
    data = [(e, ts, "north", "cityA", u, a) for e, ts, u, a in rows]
    df = spark.createDataFrame(data, "event_id long, ts long, area string, city string, uid long, ads_id long")
    from pyspark.sql import functions as F
    return df.withColumn("dt", F.date_format(F.timestamp_millis("ts"), "yyyy-MM-dd"))


def test_ban_mid_batch_then_everything_dropped(spark):
    b0, b1, b2 = DAY0, DAY0 + 5000, DAY0 + 10000
    rows = [
        (1, b0 + 1, 1, 1), (2, b0 + 2, 1, 1),            # batch 0: two clicks on ad 1
        (3, b1 + 1, 1, 1), (4, b1 + 2, 1, 2),            # batch 1: third click -> ban; rest kept
        (5, b1 + 3, 1, 1),
        (6, b2 + 1, 1, 3),                               # batch 2: other ad -> dropped
        (7, b2 + 86400000, 1, 1),                        # later day -> dropped
        (8, b2 + 2, 2, 1),                               # other user kept
    ]
    a = ads.with_batch(_ads(spark, rows))
    bans = ads.ban_batches(a, threshold=3)
    assert [(r.uid, r.banned_batch) for r in bans.collect()] == [(1, (b1 // 5000))]
    kept = sorted(r.event_id for r in ads.blacklist_filter(a, bans).collect())
    assert kept == [1, 2, 3, 4, 5, 8]
    counts = {(r.uid, r.ads_id): r.clicks for r in ads.user_ads_daycount(ads.blacklist_filter(a, bans)).collect()}
    assert counts == {(1, 1): 4, (1, 2): 1, (2, 1): 1}


def test_counts_do_not_cross_days(spark):
    rows = [(1, DAY0 + 1, 1, 1), (2, DAY0 + 2, 1, 1), (3, DAY0 + 86400000, 1, 1)]
    a = ads.with_batch(_ads(spark, rows))
    assert ads.ban_batches(a, threshold=3).count() == 0


def test_top_ads_json_and_ties(spark):
    counts = spark.createDataFrame(
        [("north", 1, "2024-01-01", 5), ("north", 2, "2024-01-01", 9), ("north", 3, "2024-01-01", 5),
         ("north", 4, "2024-01-01", 1), ("south", 7, "2024-01-01", 2)],
        "area string, ads_id long, dt string, clicks long")
    got = {(r.dt, r.area): r.top3_json for r in ads.top_ads_per_day(counts, 3).collect()}
    assert got == {("2024-01-01", "north"): '[{"2":9},{"1":5},{"3":5}]',
                   ("2024-01-01", "south"): '[{"7":2}]'}


def test_last_hour_window_edges(spark):
    end = DAY0 + 3 * 3600000 + 9999          # a pane end
    rows = [
        (1, end, 1, 1),                       # newest, inside
        (2, end - 3600000, 1, 1),             # exactly one hour before: outside (half-open)
        (3, end - 3600000 + 1, 1, 1),         # just inside
        (4, end - 60000, 1, 2),
    ]
    m = ads.last_hour_ads_minutes(_ads(spark, rows))
    got = sorted((r.ads_id, r.hour_minute, r.clicks) for r in m.collect())
    assert got == [(1, "02:00", 1), (1, "03:00", 1), (2, "02:59", 1)]
    j = {r.ads_id: r.minutes_json for r in ads.last_hour_ads_click(m).collect()}
    assert j == {1: '[{"02:00":1},{"03:00":1}]', 2: '[{"02:59":1}]'}


def test_latest_event_is_found_backwards_without_reading_older_ranges(spark):
    now, hour = 1_700_000_000_000, 3_600_000
    read = []

    def scan_of(times):
        df = spark.createDataFrame([(t,) for t in times], "ts long")

        def scan(since, until):
            read.append((since, until))
            return df.where((F.col("ts") < until) & (F.lit(True) if since is None else F.col("ts") >= since))
        return scan

    for times, probes in (([now - 5, now - 40 * hour, now + 9], 1), ([now - 2 * hour, 7], 2), ([now - 100 * hour], 3),
                          ([-5], 6), ([], 6), ([now + 1], 6)):
        read.clear()
        want = max([t for t in times if t <= now], default=None)
        assert ads.latest_event_back(scan_of(times), now, factor=16) == want
        assert len(read) == probes
        assert all(a[0] == b[1] for a, b in zip(read, read[1:]))  # ranges touch and never overlap
