"""Hand-made edge cases of the offline reports."""
from pyspark.sql import functions as F

from clickscope.functions.city_remark import city_remark_by_group, register_city_remark
from clickscope.operators import areas, categories, pages, visits
from clickscope.params import (VisitParams, condition_from_properties, flow_pairs, parse_condition,
                               parse_properties)
from clickscope.schemas import USER_VISIT_ACTION

CONDITION = """{targetPageFlow: "4,9,2", gender:"", endAge:"37", startAge: "18", endDate:"2023-06-30",
  startDate:"2023-03-05", keywords:"a, b: c"}"""


def uva_rows(spark, rows):
    """rows: dicts with any subset of the visit columns."""
    names = [f.name for f in USER_VISIT_ACTION.fields]
    full = []
    for i, r in enumerate(rows):
        d = {n: None for n in names}
        d.update(event_id=i, date="2024-01-01", user_id=1, session_id="s1", page_id=1,
                 action_time="2024-01-01 00:00:00", click_category_id=-1, click_product_id=-1, city_id=1)
        d.update(r)
        full.append(tuple(d[n] for n in names))
    return spark.createDataFrame(full, USER_VISIT_ACTION)


def test_parse_condition():
    p = parse_condition(CONDITION)
    assert p.visits == VisitParams("2023-03-05", "2023-06-30", 18, 37)
    assert p.target_page_flow == (4, 9, 2)
    q = parse_condition('{startDate:"", endDate:"2023-06-30", startAge:"", endAge:"37", targetPageFlow:"1, 2"}')
    assert q.visits.start_date is None and q.visits.start_age is None
    assert q.target_page_flow == (1, 2)


PROPERTIES = """! the run's condition
other.key : x
condition.params.json = {endAge: "37", startAge: "18", \\
    targetPageFlow:"4,9,2", startDate:"2023-03-05", endDate:"2023-06-30"}
"""


def test_condition_from_properties():
    assert parse_properties(PROPERTIES)["other.key"] == "x"
    p = condition_from_properties(PROPERTIES)
    assert p.visits == VisitParams("2023-03-05", "2023-06-30", 18, 37)
    assert p.target_page_flow == (4, 9, 2)


def test_remark_one_city_and_two_cities(spark):
    rows = [("A", 1, "X")] + [("A", 2, "X"), ("A", 2, "X"), ("A", 2, "Y")]
    df = spark.createDataFrame(rows, "area string, pid long, city_name string")
    out = {r.pid: (r.clicount, r.remark)
           for r in city_remark_by_group(df, ["area", "pid"], "city_name").collect()}
    assert out[1] == (1, "X:100.0%,其他:0.0%")
    assert out[2] == (3, "X:66.6%,Y:33.3%,其他:0.1%")


def test_remark_three_cities_and_tie(spark):
    rows = [("A", 1, c) for c in ["B", "A", "C", "C"]]
    df = spark.createDataFrame(rows, "area string, pid long, city_name string")
    (r,) = city_remark_by_group(df, ["area", "pid"], "city_name").collect()
    # C leads; A and B tie at one click each, A wins on the name
    assert r.remark == "C:50.0%,A:25.0%,其他:25.0%"


def test_remark_sql_function_equals_composition(spark):
    register_city_remark(spark, "city_remark_t")
    rows = [("A", i % 4, c) for i, c in enumerate("XYZXXYQXZZYX" * 3)]
    df = spark.createDataFrame(rows, "area string, pid long, city_name string")
    df.groupBy("area", "pid", "city_name").count().createOrReplaceTempView("remark_t")
    sql = spark.sql("""select area, pid, sum(count) clicount,
                              city_remark_t(collect_list(named_struct('city', city_name, 'n', count))) remark
                       from remark_t group by area, pid""")
    comp = city_remark_by_group(df, ["area", "pid"], "city_name")
    assert sorted(map(tuple, sql.collect())) == sorted(map(tuple, comp.collect()))


def test_category_kinds_and_id_lists(spark):
    v = uva_rows(spark, [
        {"click_category_id": 5, "order_category_ids": "1"},        # click only
        {"order_category_ids": "1,2,", "pay_category_ids": "3"},     # order only, two ids
        {"pay_category_ids": ""},                                    # no token
        {"pay_category_ids": "3"},
        {"click_category_id": None},                                 # not a click, nothing
    ])
    out = {r.cid: (r.click_count, r.order_count, r.pay_count)
           for r in categories.category_action_counts(v).collect()}
    assert out == {"5": (1, 0, 0), "1": (0, 1, 0), "2": (0, 1, 0), "3": (0, 0, 1)}


def test_category_top_order_and_sessions(spark):
    rows = []
    for cid, n in [(1, 3), (2, 3), (3, 1)]:
        for i in range(n):
            rows.append({"click_category_id": cid, "session_id": f"s{i % 2}"})
    rows.append({"order_category_ids": "2"})
    v = uva_rows(spark, rows)
    counts = categories.category_action_counts(v)
    top = categories.category_top(counts, 2)
    assert [r.cid for r in top.collect()] == ["2", "1"]  # tie on clicks, 2 has an order
    sess = categories.top_sessions(categories.category_session_counts(v, top), 1)
    got = sorted((r.category_id, r.session_id, r.click_count) for r in sess.collect())
    assert got == [("1", "s0", 2), ("2", "s0", 2)]


def test_visit_filter_bounds(spark):
    v = uva_rows(spark, [{"user_id": u, "date": d} for u, d in
                         [(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")]])
    users = spark.createDataFrame([(1, 15), (2, 30), (3, 60)], "user_id long, age int")
    ids = lambda p: sorted(r.user_id for r in visits.user_visit_filter(v, users, p).collect())
    assert ids(VisitParams()) == [1, 2, 3]
    assert ids(VisitParams("", "", None, None)) == [1, 2, 3]
    assert ids(VisitParams("2024-01-02", None, 20, 50)) == [2]
    assert ids(VisitParams(None, None, 20, 50, as_written=True)) == [3]


def test_flow_pairs_and_pages(spark):
    assert flow_pairs((1, 2, 1, 2)) == [(1, 2), (2, 1)]
    rows = [  # session a: 1 -> 2 -> 9 ; session b: 1 -> 2 ; session c: 1 (single action)
        {"session_id": "a", "page_id": 1, "action_time": "t1"},
        {"session_id": "a", "page_id": 2, "action_time": "t2"},
        {"session_id": "a", "page_id": 9, "action_time": "t3"},
        {"session_id": "b", "page_id": 2, "action_time": "t2"},
        {"session_id": "b", "page_id": 1, "action_time": "t1"},
        {"session_id": "c", "page_id": 1, "action_time": "t1"},
    ] + [{"session_id": f"x{i}", "page_id": 2, "action_time": "t1"} for i in range(14)]
    v = uva_rows(spark, rows)
    flow = (1, 2, 3, 1, 2)
    vc = pages.page_visit_counts(v, flow)
    assert dict((r.page_id, r.visits) for r in vc.collect()) == {1: 3, 2: 16}
    jc = pages.page_jump_counts(pages.session_page_pairs(v), flow)
    assert dict((r.page_jump, r.jumps) for r in jc.collect()) == {"1-2": 2}   # 2-3, 3-1 never seen
    ratio = dict((r.page_jump, r.ratio) for r in pages.page_convert_ratio(jc, vc).collect())
    assert ratio == {"1-2": 66.7}
    assert pages.page_jump_counts(pages.session_page_pairs(v), (1,)).count() == 0


def test_ratio_half_up(spark):
    jumps = spark.createDataFrame([("1-2", 1)], "page_jump string, jumps long")
    vc = spark.createDataFrame([(1, 16)], "page_id long, visits long")
    (r,) = pages.page_convert_ratio(jumps, vc).collect()
    assert r.ratio == 6.3


def test_missing_product_drops_slot(spark):
    pc = spark.createDataFrame(
        [("A", 1, 9, "r"), ("A", 2, 8, "r"), ("A", 3, 7, "r"), ("A", 4, 6, "r")],
        "area string, click_product_id long, clicount long, remark string")
    prod = spark.createDataFrame([(1, "p1"), (3, "p3"), (4, "p4")],
                                 "product_id long, product_name string")
    got = [r.product_name for r in areas.area_top3_product(pc, prod).orderBy(F.desc("clicount")).collect()]
    assert got == ["p1", "p3"]
