"""DuckDB SQL for each registered report, over the pre-registered tables.

The bindings of the click-stream model become CTEs (the oracle may only name
the driver's tables). Ties, rounding and text forms follow the Spark side.
"""

from __future__ import annotations

from dataclasses import replace

from ..params import (BATCH_MS, FILTER_PARAMS, REPORT_PARAMS, REPORT_TASK_ID, SLIDE_MS, TASKS, TEST_THRESHOLD,
                      WINDOW_MS, flow_pairs)

EV = "ev AS (SELECT *, cast(json_extract_string(props,'$.k') AS BIGINT) AS k FROM events)"

UVA = """uva AS (
  SELECT event_id,
         strftime(ts,'%Y-%m-%d') AS date,
         user_id,
         concat(user_id,'-',strftime(ts,'%Y-%m-%d')) AS session_id,
         k%10+1 AS page_id,
         strftime(ts,'%Y-%m-%d %H:%M:%S') AS action_time,
         CASE WHEN event_type IN ('view','signup','error') THEN event_type END AS search_keyword,
         CASE WHEN event_type='click' THEN k%20+1 ELSE -1 END AS click_category_id,
         CASE WHEN event_type='click' THEN k+1 ELSE -1 END AS click_product_id,
         CASE WHEN event_type='purchase' AND event_id%2=0 THEN array_to_string(list_slice([k%20+1,(k+7)%20+1,(k+13)%20+1],1,event_id%3+1),',') END AS order_category_ids,
         CASE WHEN event_type='purchase' AND event_id%2=0 THEN cast(k+1 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type='purchase' AND event_id%2=1 THEN array_to_string(list_slice([k%20+1,(k+7)%20+1,(k+13)%20+1],1,event_id%3+1),',') END AS pay_category_ids,
         CASE WHEN event_type='purchase' AND event_id%2=1 THEN cast(k+1 AS VARCHAR) END AS pay_product_ids,
         user_id%25 AS city_id
  FROM ev)"""

USER_INFO = """user_info AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name,
         cast(10+c_custkey%50 AS INTEGER) AS age, c_mktsegment AS professional,
         CASE WHEN c_custkey%5<3 THEN 'M' ELSE 'F' END AS gender
  FROM customer)"""

PRODUCT_INFO = """product_info AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS extend_info FROM part)"""

CITY_INFO = """city_info AS (
  SELECT cast(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey=r_regionkey)"""

ADS = """ads AS (
  SELECT event_id, epoch_us(ts)//1000 AS ts, area, city_name AS city, user_id AS uid,
         k%6+1 AS ads_id, strftime(ts,'%Y-%m-%d') AS dt
  FROM ev JOIN city_info ON user_id%25=city_id)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _visit_filter(p, name="uva_f") -> str:
    """Visits of known users within the bounds of ``p``, with the age."""
    bounds = [("date", ">=", p.start_date and f"'{p.start_date}'"), ("date", "<=", p.end_date and f"'{p.end_date}'"),
              ("age", ">=", p.start_age), ("age", ">=" if p.as_written else "<=", p.end_age)]
    tests = "".join(f" AND {col} {op} {value}" for col, op, value in bounds if value is not None)
    return f"""{name} AS (
  SELECT * FROM (SELECT visit.*, known.age FROM uva AS visit INNER JOIN user_info AS known USING (user_id))
  WHERE user_id IS NOT NULL{tests})"""


# ---- R3 ------------------------------------------------------------------

def _remark_ctes(src: str) -> list[str]:
    return [
        f"""cc AS (SELECT area, click_product_id, city_name, count(*) AS n FROM {src}
  GROUP BY area, click_product_id, city_name)""",
        """ranked AS (SELECT *, sum(n) OVER (PARTITION BY area, click_product_id) AS total,
  row_number() OVER (PARTITION BY area, click_product_id ORDER BY n DESC, city_name) AS rk FROM cc)""",
        """top2 AS (SELECT *, (n*1000)//total AS t FROM ranked)""",
        """apc AS (SELECT area, click_product_id, cast(max(total) AS BIGINT) AS clicount,
  string_agg(CASE WHEN rk<=2 THEN city_name || ':' || cast(t/10.0 AS DOUBLE) || '%' END, ',' ORDER BY rk)
  || CASE WHEN count(*) FILTER (WHERE rk<=2) > 0 THEN ',' ELSE '' END
  || '其他:' || cast((1000 - sum(CASE WHEN rk<=2 THEN t ELSE 0 END))/10.0 AS DOUBLE) || '%' AS remark
  FROM top2 GROUP BY area, click_product_id)""",
    ]


LOCATED = """located AS (
  SELECT town.area, town.city_name, visit.click_product_id
  FROM uva AS visit INNER JOIN city_info AS town USING (city_id) WHERE visit.click_product_id > 0)"""

STAR_LOCATED = """located AS (
  SELECT town.area, town.city_name, item.l_partkey AS click_product_id
  FROM lineitem AS item INNER JOIN orders ON o_orderkey = item.l_orderkey
  INNER JOIN customer ON c_custkey = o_custkey
  INNER JOIN city_info AS town ON town.city_id = cast(c_nationkey AS BIGINT))"""

BEST_THREE = """SELECT best.area, goods.product_name, best.clicount, best.remark
FROM apc AS best INNER JOIN product_info AS goods ON goods.product_id = best.click_product_id
WHERE (best.area, best.click_product_id) IN (
  SELECT (area, click_product_id) FROM apc
  QUALIFY row_number() OVER (PARTITION BY area ORDER BY clicount DESC, click_product_id) <= 3)"""


def r3_sql() -> dict[str, str]:
    located = [EV, UVA, CITY_INFO, LOCATED]
    products = _remark_ctes("located")
    return {
        "area_city_clicks": _with(*located) + "SELECT * FROM located",
        "area_product_clicks": _with(*located, *products)
        + "SELECT area, click_product_id, clicount, remark FROM apc",
        "area_top3_product": _with(*located, PRODUCT_INFO, *products) + BEST_THREE,
        "area_top3_product_star": _with(CITY_INFO, PRODUCT_INFO, STAR_LOCATED, *products) + BEST_THREE,
    }


# ---- R0, R1, R2, R4 --------------------------------------------------------

def _category_ctes() -> list[str]:
    return [
        """acts AS (SELECT
  CASE WHEN click_category_id IS NOT NULL AND click_category_id <> -1 THEN 'click'
       WHEN order_category_ids IS NOT NULL THEN 'order'
       WHEN pay_category_ids IS NOT NULL THEN 'pay' END AS kind,
  CASE WHEN click_category_id IS NOT NULL AND click_category_id <> -1 THEN [cast(click_category_id AS VARCHAR)]
       WHEN order_category_ids IS NOT NULL THEN list_filter(string_split(order_category_ids, ','), lambda x: x <> '')
       WHEN pay_category_ids IS NOT NULL THEN list_filter(string_split(pay_category_ids, ','), lambda x: x <> '') END AS ids
  FROM uva_f)""",
        """cat AS (SELECT kind, unnest(ids) AS cid FROM acts WHERE kind IS NOT NULL)""",
        """counts AS (SELECT cid,
  count(*) FILTER (WHERE kind='click') AS click_count,
  count(*) FILTER (WHERE kind='order') AS order_count,
  count(*) FILTER (WHERE kind='pay') AS pay_count
  FROM cat GROUP BY cid)""",
        """top AS (SELECT * FROM counts ORDER BY click_count DESC, order_count DESC, pay_count DESC, cid LIMIT 10)""",
        """scc AS (SELECT cast(click_category_id AS VARCHAR) AS category_id, session_id, count(*) AS click_count
  FROM uva_f WHERE click_category_id IN (SELECT cast(cid AS BIGINT) FROM top)
  GROUP BY click_category_id, session_id)""",
    ]


def _page_ctes(flow) -> list[str]:
    pages = ",".join(str(p) for p in sorted(set(flow[:-1]))) or "NULL"
    jumps = ",".join(f"'{a}-{b}'" for a, b in flow_pairs(flow)) or "NULL"
    return [
        f"""pvc AS (SELECT page_id, count(*) AS visits FROM uva_f WHERE page_id IN ({pages}) GROUP BY page_id)""",
        """pairs AS (SELECT * FROM (SELECT session_id, page_id AS from_page,
  lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS to_page FROM uva_f)
  WHERE to_page IS NOT NULL)""",
        f"""pjc AS (SELECT from_page || '-' || to_page AS page_jump, count(*) AS jumps FROM pairs
  WHERE from_page || '-' || to_page IN ({jumps}) GROUP BY 1)""",
        """pcr AS (SELECT page_jump,
  floor(cast(jumps AS DOUBLE)*1000.0/cast(coalesce(visits, 100000) AS DOUBLE) + 0.5)/10.0 AS ratio
  FROM pjc LEFT JOIN pvc ON cast(split_part(page_jump,'-',1) AS BIGINT)=pvc.page_id)""",
    ]


def offline_sql() -> dict[str, str]:
    base = [EV, UVA, USER_INFO]
    filt = _with(*base, _visit_filter(FILTER_PARAMS))
    written = _with(*base, _visit_filter(replace(FILTER_PARAMS, as_written=True)))
    rep = [*base, _visit_filter(REPORT_PARAMS.visits)]
    cats = _with(*rep, *_category_ctes())
    pages = _with(*rep, *_page_ctes(REPORT_PARAMS.target_page_flow))
    return {
        "user_visit_filter": filt + "SELECT event_id, user_id, date, age FROM uva_f",
        "user_visit_filter_as_written": written + "SELECT event_id, user_id, date, age FROM uva_f",
        "category_action_counts": cats + "SELECT * FROM counts",
        "category_top10": cats + "SELECT * FROM top",
        "report_tasks": cats + "SELECT t.task_id, top.* FROM top, (VALUES "
        + ", ".join(f"('{t}')" for t in TASKS) + ") t(task_id)",
        "category_session_counts": cats + "SELECT * FROM scc",
        "top10_session": cats + """SELECT category_id, session_id, click_count FROM (
  SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY click_count DESC, session_id) AS rn FROM scc)
WHERE rn<=10""",
        "page_visit_counts": pages + "SELECT * FROM pvc",
        "session_page_pairs": pages + "SELECT * FROM pairs",
        "page_jump_counts": pages + "SELECT * FROM pjc",
        "page_convert_ratio": pages + "SELECT * FROM pcr",
        "page_convert_ratio_task": pages + f"SELECT '{REPORT_TASK_ID}' AS task_id, * FROM pcr",
    }


# ---- ads: R5-R8 -----------------------------------------------------------

def _ads_ctes(threshold: int = TEST_THRESHOLD, batch_sql: str = f"ts//{BATCH_MS}") -> list[str]:
    # The ban is written here in its direct form: the batch of the N-th
    # event (by time, then id) of each (user, ad, day), minimum per user.
    return [
        f"b AS (SELECT *, {batch_sql} AS batch FROM ads)",
        f"""nth AS (SELECT uid, batch FROM (
  SELECT uid, batch, row_number() OVER (PARTITION BY uid, ads_id, dt ORDER BY ts, event_id) AS rn FROM b)
  WHERE rn = {threshold})""",
        "bans AS (SELECT uid, min(batch) AS banned_batch FROM nth GROUP BY uid)",
        """surv AS (SELECT b.* FROM b LEFT JOIN bans ON b.uid=bans.uid
  WHERE bans.banned_batch IS NULL OR b.batch <= bans.banned_batch)""",
        "acc AS (SELECT area, city, ads_id, dt, count(*) AS clicks FROM surv GROUP BY area, city, ads_id, dt)",
        "aad AS (SELECT area, ads_id, dt, cast(sum(clicks) AS BIGINT) AS clicks FROM acc GROUP BY area, ads_id, dt)",
        """top3 AS (SELECT dt, area,
  '[' || string_agg('{"' || ads_id || '":' || clicks || '}', ',' ORDER BY rn) || ']' AS top3_json
  FROM (SELECT *, row_number() OVER (PARTITION BY dt, area ORDER BY clicks DESC, ads_id) AS rn FROM aad)
  WHERE rn <= 3 GROUP BY dt, area)""",
        f"""lhm AS (SELECT ads_id, strftime(make_timestamp(ts*1000),'%H:%M') AS hour_minute,
  ts - (ts % 60000) AS minute_ms, count(*) AS clicks
  FROM surv
  WHERE ts > (SELECT max(ts) - (max(ts) % {SLIDE_MS}) + {SLIDE_MS - 1} FROM surv) - {WINDOW_MS}
    AND ts <= (SELECT max(ts) - (max(ts) % {SLIDE_MS}) + {SLIDE_MS - 1} FROM surv)
  GROUP BY ALL)""",
    ]


def ads_sql() -> dict[str, str]:
    base = _with(EV, CITY_INFO, ADS, *_ads_ctes())
    return {
        "ads_log_parse": _with(EV, CITY_INFO, ADS)
        + "SELECT event_id, ts, area, city, uid, ads_id, dt FROM ads",
        "blacklist_users": base + "SELECT * FROM bans",
        "blacklist_filter": base + "SELECT event_id, uid, ads_id FROM surv",
        "user_ads_daycount": base + "SELECT uid, ads_id, dt, count(*) AS clicks FROM surv GROUP BY ALL",
        "area_city_ads_daycount": base + "SELECT * FROM acc",
        "area_ads_daycount": base + "SELECT * FROM aad",
        "top3_ads_per_day": base + "SELECT * FROM top3",
        "last_hour_ads_minutes": base + "SELECT ads_id, hour_minute, clicks FROM lhm",
        "last_hour_ads_click": base + """SELECT ads_id,
  '[' || string_agg('{"' || hour_minute || '":' || clicks || '}', ',' ORDER BY minute_ms) || ']' AS minutes_json
  FROM lhm GROUP BY ads_id""",
        "kv_area_city_ads_daycount": base + """SELECT 'area_city_ads_daycount' AS key,
  area || ':' || city || ':' || ads_id || ':' || dt AS field, cast(clicks AS VARCHAR) AS value FROM acc""",
        "kv_top3_ads_per_day": base + """SELECT 'top3_ads_per_day:' || dt AS key, area AS field,
  top3_json AS value FROM top3""",
        "kv_last_hour_ads_click": base + """SELECT 'last_hour_ads_click' AS key, cast(ads_id AS VARCHAR) AS field,
  '[' || string_agg('{"' || hour_minute || '":' || clicks || '}', ',' ORDER BY minute_ms) || ']' AS value
  FROM lhm GROUP BY ads_id""",
        "kv_user_ads_daycount": base + """SELECT 'user_ads_daycount' AS key,
  uid || ':' || ads_id || ':' || dt AS field, cast(count(*) AS VARCHAR) AS value
  FROM surv GROUP BY uid, ads_id, dt""",
        "kv_blacklist": base + "SELECT 'blacklist' AS key, cast(uid AS VARCHAR) AS field, '' AS value FROM bans",
    }


# ---- stream replay (batch k = k-th time block) -------------------------------

def stream_sql() -> dict[str, str]:
    from .streams import BLOCK_DAYS
    batch = f"dense_rank() OVER (ORDER BY (ts//86400000)//{BLOCK_DAYS}) - 1"
    base = _with(EV, CITY_INFO, ADS, *_ads_ctes(TEST_THRESHOLD, batch))
    line_area = "replace(area, ' ', '_')"
    return {
        "stream_blacklist_users": base + "SELECT * FROM bans",
        "stream_blacklist_filter": base + "SELECT ts, area, city, uid, ads_id, dt FROM surv",
        "stream_user_ads_daycount": base + """SELECT 'user_ads_daycount' AS key,
  uid || ':' || ads_id || ':' || dt AS field, cast(count(*) AS VARCHAR) AS value
  FROM surv GROUP BY uid, ads_id, dt""",
        "stream_area_city_ads_daycount": base + f"""SELECT 'area_city_ads_daycount' AS key,
  {line_area} || ':' || city || ':' || ads_id || ':' || dt AS field, cast(clicks AS VARCHAR) AS value FROM acc""",
        "stream_top3_ads_per_day": base + f"""SELECT 'top3_ads_per_day:' || dt AS key, {line_area} AS field,
  top3_json AS value FROM top3""",
        "stream_last_hour_ads_click": base + """SELECT 'last_hour_ads_click' AS key, cast(ads_id AS VARCHAR) AS field,
  '[' || string_agg('{"' || hour_minute || '":' || clicks || '}', ',' ORDER BY minute_ms) || ']' AS value
  FROM lhm GROUP BY ads_id""",
    }


def sink_sql() -> dict[str, str]:
    return {"table_replace": _with(CITY_INFO) + "SELECT * FROM city_info"}


def all_sql() -> dict[str, str]:
    out = {}
    out.update(sink_sql())
    out.update(stream_sql())
    out.update(ads_sql())
    out.update(offline_sql())
    out.update(r3_sql())
    return out
