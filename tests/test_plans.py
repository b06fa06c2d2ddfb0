"""The physical plans keep their scale properties."""
import contextlib
import io

import __spark_entry__ as E
from clickscope.plans import reports

from .conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_date_bounds_reach_the_scan(spark):
    p = plan(E.queries()["user_visit_filter"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(ts,2024-01-05T00:00)" in p
    assert "LessThan(ts,2024-01-26T00:00)" in p


def test_scans_read_only_needed_columns(spark):
    p = plan(E.queries()["category_action_counts"](spark, SF_SMALL))
    reads = [line for line in p.splitlines() if line.startswith("ReadSchema") and "props" in line]
    assert reads and all("value" not in r and "event_type" in r for r in reads)


def test_top_k_is_limited_before_the_shuffle(spark):
    for key in ("area_top3_product", "top10_session", "top3_ads_per_day"):
        p = plan(E.queries()[key](spark, SF_SMALL))
        assert p.count("WindowGroupLimit") >= 2, key  # partial + final around the exchange


def test_dimensions_broadcast_after_size_check(spark):
    p = plan(E.queries()["area_city_clicks"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "BuildRight" in p


def test_pairing_scans_events_once(spark):
    df = E.queries()["session_page_pairs"](spark, SF_SMALL)
    df.collect()
    p = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "rangepartitioning" not in p and "Scan ExistingRDD" not in p
    assert "ReusedExchange" in p  # both halves read the one clustering by session and hour


def test_last_hour_range_reaches_the_scan(spark):
    p = plan(E.queries()["last_hour_ads_click"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(ts,2024-" in p and "LessThan(ts,2024-" in p


def test_ban_list_orders_only_keys_that_reach_the_threshold(spark):
    p = plan(E.queries()["blacklist_users"](spark, SF_SMALL))
    assert "LeftSemi" in p and "BroadcastHashJoin" in p


def test_products_are_not_shuffled_for_the_top_list(spark):
    p = plan(E.queries()["area_top3_product"](spark, SF_SMALL))
    part = p[p.index("p_partkey"):] if "p_partkey" in p else p
    assert "BroadcastExchange" in p and "hashpartitioning(p_partkey" not in part and "hashpartitioning(product_id" not in p


def test_no_python_in_batch_reports(spark):
    for key in reports.registry():
        if key.startswith("stream_"):
            continue
        p = plan(E.queries()[key](spark, SF_SMALL))
        assert "ArrowEvalPython" not in p and "BatchEvalPython" not in p, key


def test_bounded_broadcast_checks(spark):
    from clickscope.plans.joins import bounded_broadcast
    from clickscope.sources import tables as tb
    ci = tb.city_info(spark, SF_SMALL)
    hinted = lambda df: "broadcast" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(bounded_broadcast(ci))
    assert not hinted(bounded_broadcast(ci, max_rows=3))          # row bound
    assert not hinted(bounded_broadcast(ci, max_bytes=10))        # input size bound, no job
    assert not hinted(bounded_broadcast(ci, max_files=0))         # file count bound, no job
