"""The stream equals the batch reports on the same input, also after crashes.

The ad records of sf0.001 become log lines in four time-ordered files; the
stream reads one file per micro-batch, so the batch form numbers batches by
file.
"""
import os
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from clickscope.operators import ads
from clickscope.params import TEST_THRESHOLD
from clickscope.session import fresh_subdir, shared_dir
from clickscope.sinks import hashstore, kv
from clickscope.sinks.merged import MergedTable
from clickscope.sources import adslog
from clickscope.sources import tables as tb
from clickscope.streaming import adstream as pl
from clickscope.streaming import running

from .conftest import SF_SMALL

N_FILES = 4
KVC = ["key", "field", "value"]
DAY = 1704067200000  # 2024-01-01


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def source(spark, files):
    """A folder with one text file of lines per micro-batch, in order."""
    base = shared_dir(spark).removeprefix("file:")
    os.makedirs(base, exist_ok=True)
    src = tempfile.mkdtemp(prefix="lines-", dir=base)
    for i, lines in enumerate(files):
        path = os.path.join(src, f"part-{i:03d}.txt")
        with open(path, "w") as fh:
            fh.write("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + i * 10, 1_700_000_000 + i * 10))
    return src


def parsed_batches(spark, src):
    static = spark.read.text(src).withColumn(
        "batch", F.regexp_extract(F.input_file_name(), r"part-(\d+)", 1).cast("bigint"))
    return adslog.parse_ads_lines(static, keep=["batch"])


def expected(parsed, threshold):
    """What the stream must hold, from the batch operators."""
    bans = ads.ban_batches(parsed, threshold)
    surv = ads.blacklist_filter(parsed, bans)
    acc = ads.area_city_ads_daycount(surv)
    return {
        "bans": _rows(bans, ["uid", "banned_batch"]),
        "survivors": _rows(surv, ["ts", "area", "city", "uid", "ads_id", "dt"]),
        kv.USER_ADS_DAYCOUNT: _rows(kv.kv_user_ads_daycount(ads.user_ads_daycount(surv)), KVC),
        kv.AREA_CITY_ADS_DAYCOUNT: _rows(kv.kv_area_city_ads_daycount(acc), KVC),
        kv.TOP3_ADS_PER_DAY: _rows(kv.kv_top3_ads_per_day(ads.top_ads_per_day(ads.area_ads_daycount(acc), 3)), KVC),
        kv.LAST_HOUR_ADS_CLICK: _rows(kv.kv_last_hour_ads_click(
            ads.last_hour_ads_click(ads.last_hour_ads_minutes(surv))), KVC),
    }


def held(spark, paths):
    return {
        "bans": _rows(pl.current_bans(spark, paths), ["uid", "banned_batch"]),
        "survivors": _rows(pl.current_survivors(spark, paths), ["ts", "area", "city", "uid", "ads_id", "dt"]),
        **{k: _rows(pl.kv_current(spark, paths, k), KVC) for k in (
            kv.USER_ADS_DAYCOUNT, kv.AREA_CITY_ADS_DAYCOUNT, kv.TOP3_ADS_PER_DAY, kv.LAST_HOUR_ADS_CLICK)},
    }


@pytest.fixture(scope="module")
def real_files(spark):
    rows = [r.value for r in adslog.ads_lines(tb.ads_log(spark, SF_SMALL), keep=["ts"]).orderBy("ts").collect()]
    per = (len(rows) + N_FILES - 1) // N_FILES
    files = [rows[i * per:(i + 1) * per] for i in range(N_FILES)]
    files[2] = files[2] + [f"{DAY} north cityA 7", "oops north cityA 7 3"]  # short / non-numeric
    return files


def run(spark, src, paths, threshold=TEST_THRESHOLD, **options):
    lines = adslog.text_lines(spark, src, max_files_per_trigger=1)
    return pl.run_available_now(spark, lines, paths, threshold, keep_survivors=True, **options)


def test_stream_equals_batch_and_counts_every_line(spark, real_files):
    old = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")  # fewer than the batches
    try:
        src, paths = source(spark, real_files), pl.StreamPaths(fresh_subdir(spark, "stream-out"))
        seen = run(spark, src, paths)
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", old)
    assert seen == {"lines": sum(map(len, real_files)), "rejected": 2}
    want = expected(parsed_batches(spark, src), TEST_THRESHOLD)
    assert want["bans"] and want[kv.LAST_HOUR_ADS_CLICK]
    assert held(spark, paths) == want
    assert run(spark, src, paths) == {"lines": 0, "rejected": 0}  # nothing new


@pytest.mark.parametrize("step", ["survivors", "user counts", "panes"])
def test_one_restart_after_a_crash_goes_on_exactly_once(spark, real_files, step):
    """The query dies after ``step`` of a batch; 'panes' is after the last
    write, before the batch's offset is committed."""
    src, paths = source(spark, real_files[:3]), pl.StreamPaths(fresh_subdir(spark, "stream-crash"))

    def die(at, batch_id):
        if at == step and batch_id == 1:
            raise RuntimeError("killed")
    with pytest.raises(StreamingQueryException):
        run(spark, src, paths, after=die)
    run(spark, src, paths)
    assert held(spark, paths) == expected(parsed_batches(spark, src), TEST_THRESHOLD)
    total = pl.batch_stats(spark, paths).agg(F.sum("lines")).first()[0]
    assert total == sum(map(len, real_files[:3]))


def test_hot_user_far_future_line_and_late_clicks(spark):
    line = lambda ms, uid, ad: f"{ms} north cityA {uid} {ad}"
    first = [line(DAY + i * 1000, 1 if i % 3 == 0 else 100 + i, 1 + i % 4) for i in range(300)]
    odd = [line(253402300000000, 5, 9)]  # year 9999
    later = [line(DAY + 3 * 3_600_000 + i * 1000, 200 + i, 2) for i in range(30)]
    late = [line(DAY + i * 1000, 300 + i, 7) for i in range(20)]  # three hours late
    src, paths = source(spark, [first + odd, later, late]), pl.StreamPaths(fresh_subdir(spark, "stream-odd"))
    run(spark, src, paths, threshold=20)
    parsed = parsed_batches(spark, src)
    want = expected(parsed, 20)
    assert [u for u, _ in want["bans"]] == [1]
    got = held(spark, paths)
    assert got == want  # the batch form's window does not follow the odd line either
    assert [r[1] for r in got[kv.LAST_HOUR_ADS_CLICK]] == ["2"]
    assert any("9999" in r[1] for r in got[kv.AREA_CITY_ADS_DAYCOUNT])
    hours = {r.hour for r in pl.panes(spark, paths).read().select("hour").distinct().collect()}
    end = (DAY + 3 * 3_600_000) // pl.HOUR_MS
    assert hours <= {end, end - 1}  # one hour of panes is kept


def test_a_batch_writes_its_changed_fields_to_the_store(spark):
    src = source(spark, [[f"{DAY} north cityA 1 1", f"{DAY} south cityC 1 2"], [f"{DAY + 1000} north cityB 2 1"]])
    paths = pl.StreamPaths(fresh_subdir(spark, "stream-store"))
    run(spark, src, paths, threshold=100)
    told = {tuple(r) for r in spark.read.parquet(paths.store).where("batch = 1").select("key", "field", "value").collect()}
    day = "2024-01-01"
    assert told == {
        (kv.AREA_CITY_ADS_DAYCOUNT, f"north:cityB:1:{day}", "1"), (kv.USER_ADS_DAYCOUNT, f"2:1:{day}", "1"),
        (f"{kv.TOP3_ADS_PER_DAY}:{day}", "north", '[{"1":2}]'), (kv.LAST_HOUR_ADS_CLICK, None, None),
        (kv.LAST_HOUR_ADS_CLICK, "1", '[{"00:00":2}]'), (kv.LAST_HOUR_ADS_CLICK, "2", '[{"00:00":1}]')}


def test_a_batch_runs_its_state_once_and_in_few_tasks(spark, monkeypatch):
    seen = []
    real = hashstore.write_batch

    def spy(rows, path, batch, writer="main"):
        if writer == "running":
            seen.append((rows._jdf.queryExecution().toString(), rows.rdd.getNumPartitions()))
        return real(rows, path, batch, writer)
    monkeypatch.setattr(hashstore, "write_batch", spy)
    paths = pl.StreamPaths(fresh_subdir(spark, "stream-once"))
    lines = [[f"{DAY + b * 1000 + i} north city{i % 5} {i} {i % 4}" for i in range(200)] for b in range(2)]
    run(spark, source(spark, lines), paths, threshold=2)
    assert len(seen) == 2
    # a plan on the aggregate's own frame restores and saves the state again
    assert not any("ExistingRDD" in plan for plan, _ in seen)
    assert [tasks for _, tasks in seen] == [1, 1]
    files = [f for at, _, names in os.walk(paths.counts.removeprefix("file:")) for f in names if f.endswith(".parquet")]
    assert len(files) == 2  # a day in each of two batches


def test_no_python_in_the_plans(spark, monkeypatch):
    plans = []
    real = MergedTable.merge

    def spy(self, rows, batch_id, **options):
        plans.append(rows._jdf.queryExecution().toString())
        return real(self, rows, batch_id, **options)
    monkeypatch.setattr(MergedTable, "merge", spy)
    run(spark, source(spark, [[f"{DAY} north cityA 1 1"]]), pl.StreamPaths(fresh_subdir(spark, "stream-plan")))
    assert len(plans) == 3  # panes, bans, top lists
    assert not any("Python" in p or "Pandas" in p or "Arrow" in p for p in plans)


def test_totals_are_keyed_state_in_rocksdb(spark):
    paths = pl.StreamPaths(fresh_subdir(spark, "stream-state"))
    files = [[f"{DAY + d * 86_400_000 + i * 1000} north city{i} {i} {i % 3}" for i in range(20)] for d in range(4)]
    src = source(spark, files)
    sizes = []

    def look(step, batch):
        if step == "area counts":
            sizes.append(batch)
    run(spark, src, paths, threshold=100, keep_days=1, after=look)
    assert sizes == [0, 1, 2, 3]
    # a batch appends the keys of its day only: users, cities and areas x ads
    rows = spark.read.parquet(paths.counts).groupBy("seen", "dt").count().collect()
    assert sorted((r.seen, str(r.dt), r["count"]) for r in rows) == [
        (d, f"2024-01-0{d + 1}", 20 + 20 + 3) for d in range(4)]
    state = spark.read.format("statestore").load(paths.running_checkpoint)
    days = {str(r.event_day)[:10] for r in state.select("key.event_day").distinct().collect()}
    assert "2024-01-01" not in days and "2024-01-04" in days  # old days leave the state
    meta = spark.read.format("state-metadata").load(paths.running_checkpoint).first()
    assert meta.operatorName == "stateStoreSave"


def test_clicks_later_than_the_watermark_still_count(spark):
    line = lambda d, uid, ad: f"{DAY + d * 86_400_000} north cityA {uid} {ad}"
    files = [[line(0, 1, 1)] * 2 + [line(0, 2, 2)], [line(9, 3, 1)], [line(0, 1, 1)] * 2 + [line(0, 4, 3)],
             [line(20, 3, 1)], [line(0, 1, 1), line(9, 5, 1)]]
    src, paths = source(spark, files), pl.StreamPaths(fresh_subdir(spark, "stream-late"))
    run(spark, src, paths, threshold=4, keep_days=1)
    assert held(spark, paths) == expected(parsed_batches(spark, src), 4)
    assert running.exists(spark, f"{paths.odd}/dt=2024-01-01")
    # user 1 reached the threshold by late clicks, in batch 2; the click of batch 4 is dropped
    assert [tuple(r) for r in pl.current_bans(spark, paths).collect()] == [(1, 2)]


def test_one_day_batch_reads_one_day(spark):
    t = MergedTable(spark, fresh_subdir(spark, "merged") + "/t", "p string, k string, n long", "p", ["p", "k"],
                    {"n": "sum"})
    t.merge(spark.createDataFrame([(f"2024-01-{d:02d}", "a", d) for d in range(1, 31)], "p string, k string, n long"), 0)
    one = t.read(["2024-01-07"])
    assert [tuple(r) for r in one.collect()] == [("2024-01-07", "a", 7)]
    assert "PartitionFilters: [isnotnull(p" in one._jdf.queryExecution().toString() or \
        "PartitionFilters: [(p" in one._jdf.queryExecution().toString()
    read = one._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-07" in read.split("PartitionFilters")[1]


top_rows = st.lists(st.lists(st.tuples(st.sampled_from(["d1", "d2"]), st.sampled_from(["n", "s"]), st.integers(1, 6),
                                       st.integers(1, 4)), max_size=12), min_size=1, max_size=4)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(top_rows)
def test_top_lists_by_changed_keys_equal_a_full_ranking(spark, batches):
    kind = "dt string, area string, ads_id long, clicks long"
    total, held_lists = {}, spark.createDataFrame([], kind)
    for batch in batches:
        for dt, area, ad, n in batch:
            total[dt, area, ad] = total.get((dt, area, ad), 0) + n
        changed = {k: total[k] for k in {r[:3] for r in batch}}
        rows = sorted(tuple(r) for r in running.new_top(
            held_lists, spark.createDataFrame([(*k, n) for k, n in changed.items()], kind)).collect())
        held_lists = spark.createDataFrame(rows, kind)
        full = running.best(spark.createDataFrame([(*k, n) for k, n in total.items()], kind))
        assert rows == sorted(tuple(r) for r in full.select("dt", "area", "ads_id", "clicks").collect())


def test_merged_table_replay_and_crash_between_partitions(spark):
    t = MergedTable(spark, fresh_subdir(spark, "merged") + "/t", "p long, k string, n long", "p", ["p", "k"], {"n": "sum"})
    rows = lambda *r: spark.createDataFrame(list(r), "p long, k string, n long")
    t.merge(rows((1, "a", 1), (2, "a", 5)), 0)
    t.merge(rows((1, "a", 1), (1, "b", 1)), 1)
    t.merge(rows((1, "a", 1), (1, "b", 1)), 1)  # replay
    assert _rows(t.read(), ["p", "k", "n"]) == [(1, "a", 2), (1, "b", 1), (2, "a", 5)]
    t.merge(rows((1, "a", 7)), 2)  # as if the batch died before partition 2
    t.merge(rows((1, "a", 7), (2, "a", 1)), 2)
    assert _rows(t.read(), ["p", "k", "n"]) == [(1, "a", 9), (1, "b", 1), (2, "a", 6)]
    t.merge(rows((2, "z", 3)), 3, replace=True)
    assert _rows(t.read(), ["p", "k", "n"]) == [(1, "a", 9), (1, "b", 1), (2, "z", 3)]
    t.drop_parts(2)
    assert _rows(t.read(), ["p", "k", "n"]) == [(2, "z", 3)]


def test_live_query_with_processing_time_trigger(spark):
    src = source(spark, [[f"{DAY + i * 1000} north cityA {1 + i % 2} {1 + i % 3}" for i in range(12)]])
    paths = pl.StreamPaths(fresh_subdir(spark, "live-out"))
    q = pl.start(adslog.text_lines(spark, src), paths, threshold=100, trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    counts = pl.kv_current(spark, paths, kv.AREA_CITY_ADS_DAYCOUNT)
    assert sum(int(r.value) for r in counts.collect()) == 12
    assert pl.kv_current(spark, paths, kv.LAST_HOUR_ADS_CLICK).count() == 3
