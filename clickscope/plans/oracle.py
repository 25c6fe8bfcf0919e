"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark plans: plain GROUP BY / window / string_agg
SQL over the driver's views, with the fixture mapping as CTEs. Percentages
use the same exact integer HALF_UP form as the library.
"""

from __future__ import annotations

from clickscope.plans.params import (
    FILTERS,
    FIXTURE_PROFESSIONS,
    REMARK_TOP_CITIES,
    RUN_ID,
    SAMPLE_SEED,
    SAMPLE_SIZE,
    TARGET_FLOW,
    VISITS_DATE,
)

TIME_FMT = "'%Y-%m-%d %H:%M:%S'"

MODEL = f"""
ev AS (
  SELECT event_id, ts, user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
),
actions AS (
  SELECT event_id AS action_id,
         strftime(ts, '%Y-%m-%d') AS date,
         user_id,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id,
         k % 10 + 1 AS page_id,
         strftime(ts, {TIME_FMT}) AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 6 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k % 20 + 1 ELSE -1 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN (k * 3) % 20 + 1 ELSE -1 END AS click_product_id,
         CASE WHEN event_type = 'signup'
              THEN CAST(k % 20 + 1 AS VARCHAR) || ',' || CAST((k + 7) % 20 + 1 AS VARCHAR) END AS order_category_ids,
         CASE WHEN event_type = 'signup'
              THEN CAST((k * 3) % 20 + 1 AS VARCHAR) || ',' || CAST((k * 3 + 11) % 20 + 1 AS VARCHAR) END AS order_product_ids,
         CASE WHEN event_type = 'purchase'
              THEN CAST(k % 20 + 1 AS VARCHAR) || ',' || CAST((k + 5) % 20 + 1 AS VARCHAR) || ','
                   || CAST((k + 13) % 20 + 1 AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'purchase'
              THEN CAST((k * 3) % 20 + 1 AS VARCHAR) || ',' || CAST((k * 3 + 4) % 20 + 1 AS VARCHAR) END AS pay_product_ids,
         (user_id * 7 + k) % 25 AS city_id
  FROM ev
),
user_info AS (
  SELECT c_custkey AS user_id, c_name AS username, c_name AS name, CAST(10 + c_custkey % 50 AS INTEGER) AS age,
         c_mktsegment AS professional, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender
  FROM customer
),
product_info AS (SELECT p_partkey AS product_id, p_name AS product_name, p_brand AS extend_info FROM part),
city_info AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
base_all AS (
  SELECT a.date, a.user_id, u.username AS user_name, u.professional, a.session_id, a.page_id, a.action_time,
         a.search_keyword, a.click_category_id, a.click_product_id, p.product_name, a.order_category_ids,
         a.order_product_ids, a.pay_category_ids, a.pay_product_ids, a.city_id, a.action_id, u.age, u.gender
  FROM actions a
  JOIN user_info u ON a.user_id = u.user_id
  LEFT JOIN product_info p ON a.click_product_id > 0 AND a.click_product_id = p.product_id
),
base AS (SELECT * EXCLUDE (age, gender) FROM base_all)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join([MODEL.strip(), *[c.strip() for c in ctes]]) + "\n"


def _pct(n: str, t: str) -> str:
    return f"CASE WHEN {t} > 0 THEN CAST((({n}) * 20000 + ({t})) // (2 * ({t})) AS DOUBLE) / 100.0 END"


def _pct_text(n: str, t: str) -> str:
    h = f"((({n}) * 20000 + ({t})) // (2 * ({t})))"
    return f"CAST({h} // 100 AS VARCHAR) || '.' || lpad(CAST({h} % 100 AS VARCHAR), 2, '0')"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) if isinstance(v, str) else str(int(v)) for v in values) + ")"


def _where(cond) -> str:
    preds = ["TRUE"]
    if cond.start_date:
        preds.append(f"date >= {_q(cond.start_date)}")
    if cond.end_date:
        preds.append(f"date <= {_q(cond.end_date)}")
    if cond.start_age is not None:
        preds.append(f"age >= {int(cond.start_age)}")
    if cond.end_age is not None:
        preds.append(f"age <= {int(cond.end_age)}")
    if cond.professionals:
        preds.append(f"professional IN {_in(cond.professionals)}")
    if cond.city is not None:
        preds.append(f"city_id = {int(cond.city)}")
    if cond.gender:
        preds.append(f"gender = {_q(cond.gender)}")
    if cond.keywords:
        preds.append(f"search_keyword IN {_in(cond.keywords)}")
    if cond.category_ids:
        preds.append(f"click_category_id IN {_in(cond.category_ids)}")
    return " AND ".join(preds)


def _agg_list(expr: str, keep: str) -> str:
    return f"coalesce(string_agg({expr}, ',' ORDER BY action_time, action_id) FILTER (WHERE {keep}), '')"


def _secs(a: str, b: str) -> str:
    return f"CAST(date_diff('second', strptime({a}, {TIME_FMT}), strptime({b}, {TIME_FMT})) AS BIGINT)"


def _rollup_select(source: str) -> str:
    ne = lambda c: f"coalesce({c}, '') <> ''"
    return f"""
SELECT {_q(RUN_ID)} AS taskId, session_id AS sessionId, min(action_time) AS startTime,
       {_agg_list('search_keyword', ne('search_keyword'))} AS searchKeywords,
       {_agg_list('CAST(click_category_id AS VARCHAR)', 'click_category_id > 0')} AS clickCategoryIds,
       count(*) AS stepLength,
       {_secs('min(action_time)', 'max(action_time)')} AS visitLength,
       {_agg_list('CAST(click_product_id AS VARCHAR)', 'click_product_id > 0')} AS clickProductIds,
       {_agg_list('order_category_ids', ne('order_category_ids'))} AS orderCategoryIds,
       {_agg_list('order_product_ids', ne('order_product_ids'))} AS orderProductIds,
       {_agg_list('pay_category_ids', ne('pay_category_ids'))} AS payCategoryIds,
       {_agg_list('pay_product_ids', ne('pay_product_ids'))} AS payProductIds,
       coalesce(max(professional) FILTER (WHERE {ne('professional')}), '') AS professional
FROM {source}
GROUP BY session_id"""


SESSION_STATS = f"""
sess AS (
  SELECT session_id, min(action_time) AS startTime, count(*) AS stepLength,
         {_secs('min(action_time)', 'max(action_time)')} AS visitLength
  FROM base GROUP BY session_id
)"""

CATEGORY_COUNTS = """
cat_events AS (
  SELECT CAST(click_category_id AS VARCHAR) AS category_id, 'click' AS kind FROM base WHERE click_category_id > 0
  UNION ALL
  SELECT unnest(string_split(order_category_ids, ',')) AS category_id, 'order' AS kind
  FROM base WHERE order_category_ids IS NOT NULL
  UNION ALL
  SELECT unnest(string_split(pay_category_ids, ',')) AS category_id, 'pay' AS kind
  FROM base WHERE pay_category_ids IS NOT NULL
),
cat_counts AS (
  SELECT category_id,
         count(*) FILTER (WHERE kind = 'click') AS click_count,
         count(*) FILTER (WHERE kind = 'order') AS order_count,
         count(*) FILTER (WHERE kind = 'pay') AS pay_count
  FROM cat_events WHERE category_id <> '' GROUP BY category_id
)"""

CATEGORY_TOP = f"""
cat_top AS (
  SELECT {_q(RUN_ID)} AS taskId, category_id, click_count, order_count, pay_count
  FROM cat_counts ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10
)"""

_pairs = []
for _a, _b in zip(TARGET_FLOW, TARGET_FLOW[1:]):
    if (_a, _b) not in _pairs:
        _pairs.append((_a, _b))
PAIR_FILTER = " OR ".join(f"(from_page = {a} AND to_page = {b})" for a, b in _pairs)

PAGE_JUMPS = f"""
steps AS (
  SELECT session_id, page_id AS from_page,
         lead(page_id) OVER (PARTITION BY session_id ORDER BY action_time, action_id) AS to_page
  FROM base
),
jumps AS (
  SELECT CAST(from_page AS VARCHAR) || '_' || CAST(to_page AS VARCHAR) AS pageJump, from_page, to_page,
         count(*) AS jump_count
  FROM steps WHERE {PAIR_FILTER} GROUP BY from_page, to_page
),
views AS (
  SELECT page_id, count(*) AS view_count FROM base WHERE page_id IN {_in(sorted(set(TARGET_FLOW)))} GROUP BY page_id
)"""

AREA_CLICKS = """
per_city AS (
  SELECT a.click_product_id, c.area, c.city_name, count(*) AS n
  FROM actions a JOIN city_info c ON a.city_id = c.city_id
  WHERE a.click_product_id > 0
  GROUP BY a.click_product_id, c.area, c.city_name
),
per_city_t AS (
  SELECT *, sum(n) OVER (PARTITION BY click_product_id, area) AS t,
         row_number() OVER (PARTITION BY click_product_id, area ORDER BY n DESC, city_name) AS pos
  FROM per_city
)"""


def _area_clicks_select(top_n: int | None) -> str:
    item = f"city_name || '=' || {_pct_text('n', 't')} || '%'"
    if top_n is None:
        remark = f"string_agg({item}, ',' ORDER BY n DESC, city_name)"
    else:
        head = f"string_agg({item}, ',' ORDER BY n DESC, city_name) FILTER (WHERE pos <= {top_n})"
        rest = f"sum(n) FILTER (WHERE pos > {top_n})"
        remark = (f"{head} || CASE WHEN count(*) > {top_n} "
                  f"THEN ',other=' || {_pct_text(rest, 'max(t)')} || '%' ELSE '' END")
    return f"""
SELECT click_product_id, area, CAST(sum(n) AS BIGINT) AS "count", {remark} AS city_remark
FROM per_city_t GROUP BY click_product_id, area"""


HOT = """
hot AS (
  SELECT click_product_id AS product_id, count(*) AS click_count FROM base WHERE click_product_id > 0
  GROUP BY click_product_id ORDER BY click_count DESC, product_id LIMIT 10
),
paid AS (
  SELECT DISTINCT action_id, user_id, CAST(x AS BIGINT) AS product_id
  FROM (SELECT action_id, user_id, unnest(string_split(pay_product_ids, ',')) AS x
        FROM base WHERE pay_product_ids IS NOT NULL)
  WHERE x <> ''
),
buyers AS (
  SELECT product_id, user_id, purchase_count FROM (
    SELECT product_id, user_id, count(*) AS purchase_count,
           row_number() OVER (PARTITION BY product_id ORDER BY count(*) DESC, user_id) AS rn
    FROM paid WHERE product_id IN (SELECT product_id FROM hot)
    GROUP BY product_id, user_id)
  WHERE rn <= 2
)"""

REPEAT = """
per_product AS (
  SELECT session_id, click_product_id, count(*) AS n,
         max(professional) FILTER (WHERE coalesce(professional, '') <> '') AS prof
  FROM base GROUP BY session_id, click_product_id
),
repeat_groups AS (
  SELECT session_id AS group_id, coalesce(max(prof), '') AS professional
  FROM per_product GROUP BY session_id
  HAVING max(CASE WHEN click_product_id > 0 AND n >= 2 THEN 1 ELSE 0 END) = 1
)"""

_BASE_COLS = ("date, user_id, user_name, professional, session_id, page_id, action_time, search_keyword, "
              "click_category_id, click_product_id, product_name, order_category_ids, order_product_ids, "
              "pay_category_ids, pay_product_ids, city_id, action_id")

_share_cols = ", ".join(
    f"{_pct(f'count(*) FILTER (WHERE professional = {_q(label)})', 'count(*)')} AS {name}"
    for name, label in FIXTURE_PROFESSIONS.items())

ORACLE_SQL: dict[str, str] = {
    "city_dimension": _with() + "SELECT city_id, city_name, area FROM city_info",
    "base_actions": _with() + "SELECT * FROM base",
    **{name: _with() + f"SELECT {_BASE_COLS} FROM base_all WHERE {_where(cond)}" for name, cond in FILTERS.items()},
    "session_rollup": _with() + _rollup_select("base"),
    "session_bucket_stats": _with(SESSION_STATS) + f"""
SELECT {_q(RUN_ID)} AS taskId, '{{}}' AS contiditions, count(*) AS session_count,
       {_pct('count(*) FILTER (WHERE visitLength <= 10)', 'count(*)')} AS session_visitLength_le_10s_ratio,
       {_pct('count(*) FILTER (WHERE visitLength > 10)', 'count(*)')} AS session_visitLength_gt_10s_ratio,
       {_pct('count(*) FILTER (WHERE stepLength <= 5)', 'count(*)')} AS session_stepLength_le_5_ratio,
       {_pct('count(*) FILTER (WHERE stepLength > 5)', 'count(*)')} AS session_stepLength_gt_5_ratio
FROM sess""",
    "hourly_session_counts": _with(SESSION_STATS)
    + "SELECT split_part(startTime, ':', 1) AS hour, count(*) AS session_count FROM sess GROUP BY 1",
    "session_sample": _with(SESSION_STATS, f"""
hours AS (SELECT split_part(startTime, ':', 1) AS hour, count(*) AS hour_count FROM sess GROUP BY 1),
shares AS (
  SELECT hour, hour_count, sum(hour_count) OVER () AS total, least({SAMPLE_SIZE}, sum(hour_count) OVER ()) AS drawn FROM hours
),
parts AS (
  SELECT hour, (hour_count * drawn) // total AS base, (hour_count * drawn) % total AS rest, drawn FROM shares
),
quotas AS (
  SELECT hour, base + CASE WHEN row_number() OVER (ORDER BY rest DESC, hour) <= drawn - sum(base) OVER () THEN 1 ELSE 0 END AS quota
  FROM parts
),
ranked AS (
  SELECT session_id, split_part(startTime, ':', 1) AS hour,
         row_number() OVER (PARTITION BY split_part(startTime, ':', 1)
                            ORDER BY md5({_q(SAMPLE_SEED)} || session_id), session_id) AS rn
  FROM sess
),
picked AS (SELECT r.session_id FROM ranked r JOIN quotas q ON r.hour = q.hour WHERE r.rn <= q.quota),
picked_actions AS (SELECT * FROM base WHERE session_id IN (SELECT session_id FROM picked))""")
    + _rollup_select("picked_actions"),
    "category_event_counts": _with(CATEGORY_COUNTS) + "SELECT * FROM cat_counts",
    "category_top10": _with(CATEGORY_COUNTS, CATEGORY_TOP) + "SELECT * FROM cat_top",
    "top_sessions_per_top_category": _with(CATEGORY_COUNTS, CATEGORY_TOP, """
cs AS (
  SELECT CAST(click_category_id AS VARCHAR) AS categoryId, session_id, count(*) AS clickCount
  FROM base
  WHERE click_category_id > 0 AND CAST(click_category_id AS VARCHAR) IN (SELECT category_id FROM cat_top)
  GROUP BY 1, 2
)""") + f"""
SELECT {_q(RUN_ID)} AS taskId, categoryId, session_id AS sessionId, clickCount FROM (
  SELECT *, row_number() OVER (PARTITION BY categoryId ORDER BY clickCount DESC, session_id) AS rn FROM cs)
WHERE rn <= 10""",
    "targeted_page_views": _with(PAGE_JUMPS) + "SELECT page_id, view_count FROM views",
    "page_jumps": _with(PAGE_JUMPS) + "SELECT pageJump, from_page, to_page, jump_count FROM jumps",
    "page_conversion_rate": _with(PAGE_JUMPS) + f"""
SELECT {_q(RUN_ID)} AS taskId, pageJump, {_pct('jump_count', 'view_count')} AS rate
FROM jumps JOIN views ON jumps.from_page = views.page_id""",
    "area_product_clicks": _with(AREA_CLICKS) + _area_clicks_select(None),
    "city_remark": _with(AREA_CLICKS, f"remarks AS ({_area_clicks_select(REMARK_TOP_CITIES)})")
    + "SELECT click_product_id, area, city_remark FROM remarks",
    "area_top3_products": _with(AREA_CLICKS, f"groups AS ({_area_clicks_select(None)})") + """
SELECT r.area, p.product_name, r."count", CAST(r.rank AS INTEGER) AS "rank", r.city_remark FROM (
  SELECT *, row_number() OVER (PARTITION BY area ORDER BY "count" DESC, click_product_id) AS rank FROM groups
) r JOIN product_info p ON r.click_product_id = p.product_id
WHERE r.rank <= 3""",
    "repeat_click_sessions": _with(REPEAT) + "SELECT group_id, professional FROM repeat_groups",
    "professional_share": _with(REPEAT)
    + f"SELECT {_q(RUN_ID)} AS taskId, count(*) AS userCount, {_share_cols} FROM repeat_groups",
    "product_click_top10": _with(HOT) + f"SELECT {_q(RUN_ID)} AS taskId, product_id, click_count FROM hot",
    "paid_hot_actions": _with(HOT) + """
SELECT * FROM base
WHERE action_id IN (SELECT action_id FROM paid WHERE product_id IN (SELECT product_id FROM hot))""",
    "user_product_purchases": _with(HOT)
    + "SELECT user_id, product_id, count(*) AS purchase_count FROM paid GROUP BY user_id, product_id",
    "top2_buyers_per_hot_product": _with(HOT)
    + f"SELECT {_q(RUN_ID)} AS taskId, product_id, user_id, purchase_count FROM buyers",
    "hot_product_user_visits": _with(HOT) + f"""
SELECT {_q(RUN_ID)} AS taskId, b.product_id, p.product_name, CAST(a.user_id AS VARCHAR) AS user_id, a.user_name,
       a.action_time,
       CASE WHEN coalesce(a.pay_product_ids, '') <> '' THEN 'pay'
            WHEN coalesce(a.order_product_ids, '') <> '' THEN 'order'
            WHEN coalesce(a.search_keyword, '') <> '' THEN 'search'
            WHEN a.click_product_id > 0 THEN 'click' ELSE '' END AS operation_type,
       CASE WHEN coalesce(a.pay_product_ids, '') <> '' THEN a.pay_product_ids
            WHEN coalesce(a.order_product_ids, '') <> '' THEN a.order_product_ids
            WHEN coalesce(a.search_keyword, '') <> '' THEN a.search_keyword
            WHEN a.click_product_id > 0 THEN CAST(a.click_product_id AS VARCHAR) ELSE '' END AS operation_obj
FROM buyers b
JOIN base a ON a.user_id = b.user_id
LEFT JOIN product_info p ON p.product_id = b.product_id
ORDER BY a.action_time, a.action_id, b.product_id""",
    "table_overwrite": _with(CATEGORY_COUNTS, CATEGORY_TOP) + "SELECT * FROM cat_top",
}
ORACLE_SQL["hot_product_user_visits_day"] = ORACLE_SQL["hot_product_user_visits"].replace(
    "ORDER BY a.action_time", f"WHERE a.date = {_q(VISITS_DATE)}\nORDER BY a.action_time")
ORACLE_SQL["runs_replaced"] = _with(CATEGORY_COUNTS, CATEGORY_TOP) + """
SELECT * REPLACE ('run-a' AS taskId) FROM cat_top UNION ALL SELECT * REPLACE ('run-b' AS taskId) FROM cat_top"""
# other ways to the same rows
for _name, _same in (("catalog_date_range", "filter_date_range"), ("area_top3_products_sql", "area_top3_products"),
                     ("session_rollup_measured", "session_rollup"), ("page_jumps_measured", "page_jumps"),
                     ("session_sample_large", "session_sample")):
    ORACLE_SQL[_name] = ORACLE_SQL[_same]
