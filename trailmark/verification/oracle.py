"""SQL twins of the registered queries, in the dialect of the checking engine.

Written from the definitions, not from the plans: counts come from separate joins,
bad input from regular expressions, the blacklist from click-by-click numbering.
"""

from __future__ import annotations

_EVENTS = """
ev AS (
  SELECT event_id, ts, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events
)"""

_ACTIONS = (
    _EVENTS
    + """,
dated AS (
  SELECT *, (day(ts) - 1) // (1 + user_id % 30) AS sno, 1 + user_id % 30 AS span FROM ev
),
placed AS (
  SELECT *, DATE '2024-01-01' + CAST(sno * span AS INTEGER) AS sday FROM dated
),
user_visit_action AS (
  SELECT event_id,
         strftime(sday, '%Y-%m-%d') AS update_date,
         user_id,
         CAST(user_id AS VARCHAR) || '_' || CAST(sno AS VARCHAR) AS session_id,
         k % 10 AS page_id,
         CAST(sday AS TIMESTAMP) + to_hours(CAST(user_id % 24 AS INTEGER)) + to_seconds(
           (epoch_us(ts) - epoch_us(CAST(sday AS TIMESTAMP))) // 1200000000) AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || CAST(k % 10 AS VARCHAR) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k END AS click_category_id,
         CASE WHEN event_type = 'click' THEN 7 * k % 100 END AS click_product_id,
         CASE WHEN event_type = 'purchase' THEN
           CAST(k AS VARCHAR) || ',' || CAST((k + 1) % 100 AS VARCHAR) END AS order_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(3 * k % 100 AS VARCHAR) END
           AS order_product_ids,
         CASE WHEN event_type = 'signup' THEN CAST(k AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'signup' THEN CAST(5 * k % 100 AS VARCHAR) END AS pay_product_ids,
         user_id % 25 AS city_id
  FROM placed
)"""
)

_USERS = """
user_info AS (
  SELECT c_custkey AS user_id, CAST(18 + c_custkey % 50 AS INTEGER) AS age,
         c_mktsegment AS professional, n_name AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS sex
  FROM customer JOIN nation ON c_nationkey = n_nationkey
)"""

_CITIES = """
city_info AS (
  SELECT CAST(n_nationkey AS BIGINT) AS city_id, n_name AS city_name, r_name AS area
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""

_PRODUCTS = """
product_info AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         '{"product_status": ' || CAST(p_size % 2 AS VARCHAR) || '}' AS extend_info
  FROM part
)"""

_LOG = """
log AS (
  SELECT * FROM user_visit_action WHERE update_date BETWEEN '2024-01-01' AND '2024-01-30'
)"""

_SESSIONS = """
rollup AS (
  SELECT session_id, min(user_id) AS user_id, min(action_time) AS start_time,
         max(action_time) AS end_time, count(*) AS step_length,
         (epoch_us(max(action_time)) - epoch_us(min(action_time))) // 1000000 AS visit_length,
         string_agg(DISTINCT search_keyword, ',' ORDER BY search_keyword) AS search_keywords
  FROM log GROUP BY session_id
),
sessions AS (
  SELECT r.*, u.age, u.professional, u.city, u.sex
  FROM rollup r JOIN user_info u ON r.user_id = u.user_id
)"""

_DETAIL = """
detail AS (SELECT * FROM log WHERE session_id IN (SELECT session_id FROM sessions))"""

_TOUCHES = """
clicked AS (
  SELECT session_id, click_category_id AS category_id FROM {log}
  WHERE click_category_id IS NOT NULL
),
ordered AS (
  SELECT session_id, CAST(unnest(string_split(order_category_ids, ',')) AS BIGINT) AS category_id
  FROM {log} WHERE order_category_ids IS NOT NULL
),
paid AS (
  SELECT session_id, CAST(unnest(string_split(pay_category_ids, ',')) AS BIGINT) AS category_id
  FROM {log} WHERE pay_category_ids IS NOT NULL
)"""

_CATEGORY_COUNTS = (
    _TOUCHES.format(log="detail")
    + """,
touched AS (
  SELECT category_id FROM clicked UNION SELECT category_id FROM ordered
  UNION SELECT category_id FROM paid
),
category_counts AS (
  SELECT t.category_id, coalesce(c.n, 0) AS click_count, coalesce(o.n, 0) AS order_count,
         coalesce(p.n, 0) AS pay_count
  FROM touched t
  LEFT JOIN (SELECT category_id, count(*) AS n FROM clicked GROUP BY 1) c USING (category_id)
  LEFT JOIN (SELECT category_id, count(*) AS n FROM ordered GROUP BY 1) o USING (category_id)
  LEFT JOIN (SELECT category_id, count(*) AS n FROM paid GROUP BY 1) p USING (category_id)
),
top10 AS (
  SELECT CAST(1 AS BIGINT) AS task_id, * FROM category_counts
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10
),
top_sessions AS (
  SELECT task_id, category_id, session_id, click_count FROM (
    SELECT CAST(1 AS BIGINT) AS task_id, category_id, session_id, count(*) AS click_count,
           row_number() OVER (PARTITION BY category_id
                              ORDER BY count(*) DESC, session_id) AS place
    FROM clicked WHERE category_id IN (SELECT category_id FROM top10)
    GROUP BY category_id, session_id
  ) WHERE place <= 10
)"""
)

_QUOTA = """
hour_counts AS (
  SELECT strftime(start_time, '%Y-%m-%d') AS date, strftime(start_time, '%H') AS hour,
         count(*) AS session_count
  FROM sessions WHERE start_time IS NOT NULL GROUP BY 1, 2
),
day_counts AS (
  SELECT date, CAST(sum(session_count) AS BIGINT) AS day_count FROM hour_counts GROUP BY date
),
quota AS (
  SELECT h.date, h.hour, h.session_count, d.day_count, n.days, 600 // n.days AS per_day,
         least(h.session_count, h.session_count * (600 // n.days) // d.day_count) AS quota
  FROM hour_counts h JOIN day_counts d USING (date),
       (SELECT count(*) AS days FROM day_counts) n
),
sample AS (
  SELECT session_id FROM (
    SELECT s.session_id, q.quota,
           row_number() OVER (PARTITION BY q.date, q.hour
                              ORDER BY md5(s.session_id || '|0'), s.session_id) AS place
    FROM sessions s JOIN quota q
      ON q.date = strftime(s.start_time, '%Y-%m-%d') AND q.hour = strftime(s.start_time, '%H')
  ) WHERE place <= quota
)"""

_PAIRS = """
paired AS (
  SELECT event_id, session_id,
         lag(page_id) OVER (PARTITION BY session_id ORDER BY action_time, event_id) AS from_page,
         page_id AS to_page
  FROM log
),
pairs AS (SELECT * FROM paired WHERE from_page IS NOT NULL)"""

_FLOW = (
    _PAIRS
    + """,
steps AS (SELECT * FROM (VALUES (1, 1, 2), (2, 2, 3), (3, 3, 4)) s(step, from_page, to_page)),
matched AS (
  SELECT CAST(s.step AS INTEGER) AS step, CAST(s.from_page AS BIGINT) AS from_page,
         CAST(s.to_page AS BIGINT) AS to_page, count(p.event_id) AS pv
  FROM steps s LEFT JOIN pairs p ON p.from_page = s.from_page AND p.to_page = s.to_page
  GROUP BY 1, 2, 3
),
matches AS (
  SELECT *, CASE WHEN step = 1 THEN (SELECT count(*) FROM log WHERE page_id = 1)
                 ELSE lag(pv) OVER (ORDER BY step) END AS previous_pv
  FROM matched
),
rates AS (
  SELECT step, from_page || '_' || to_page AS page_pair, pv,
         (200 * pv + previous_pv) // nullif(2 * previous_pv, 0) / 100.0::DOUBLE AS convert_rate
  FROM matches
)"""
)

_LOCATED = """
clicks AS (
  SELECT city_id, click_product_id AS product_id FROM user_visit_action
  WHERE click_product_id IS NOT NULL AND action_time >= TIMESTAMP '2024-01-01 00:00:00'
    AND action_time < TIMESTAMP '2024-01-31 00:00:00'
),
located AS (
  SELECT k.city_id, c.city_name, c.area, k.product_id
  FROM clicks k JOIN city_info c ON k.city_id = c.city_id
)"""

_AREA_COUNTS = """
area_counts AS (
  SELECT area, product_id, count(*) AS click_count,
         string_agg(DISTINCT CAST(city_id AS VARCHAR) || ':' || city_name, ','
                    ORDER BY CAST(city_id AS VARCHAR) || ':' || city_name) AS city_infos
  FROM located GROUP BY area, product_id
)"""

_ENRICHED = """
enriched AS (
  SELECT a.*, p.product_name,
         CASE WHEN json_extract_string(p.extend_info, '$.product_status') = '0'
              THEN '自营商品' ELSE '第三方商品' END AS product_status
  FROM area_counts a JOIN product_info p ON a.product_id = p.product_id
)"""


def _level(area: str) -> str:
    return (
        f"CASE WHEN {area} IN ('ASIA', 'EUROPE') THEN 'A' WHEN {area} = 'AMERICA' THEN 'B' "
        f"WHEN {area} = 'AFRICA' THEN 'C' ELSE 'D' END"
    )


def _clicks(seconds: int) -> str:
    return (
        _EVENTS
        + f""",
ad_click AS (
  SELECT e.event_id, e.ts, strftime(e.ts, '%Y-%m-%d') AS day, e.event_type,
         r_name AS province, n_name AS city, e.user_id, e.k % 2 AS ad_id,
         epoch_us(e.ts) // 1000000 // {seconds} AS batch
  FROM ev e JOIN nation ON n_nationkey = e.user_id % 25 JOIN region ON r_regionkey = n_regionkey
)"""
    )


def _blacklist(seconds: int, threshold: int) -> str:
    return (
        _clicks(seconds)
        + f""",
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY day, user_id, ad_id
                               ORDER BY batch, ts, event_id) AS nth
  FROM ad_click
),
blacklist AS (
  SELECT user_id, min(batch) AS since_batch FROM numbered
  WHERE nth = {threshold + 1} GROUP BY user_id
),
kept AS (
  SELECT c.* FROM ad_click c LEFT JOIN blacklist b ON c.user_id = b.user_id
  WHERE b.user_id IS NULL OR c.batch <= b.since_batch
)"""
    )


_DETAIL_RECORD = """CAST(1 AS BIGINT) AS task_id, d.user_id, d.session_id, d.page_id,
       strftime(d.action_time, '%Y-%m-%d %H:%M:%S') AS action_time, d.search_keyword,
       coalesce(d.click_category_id, 0) AS click_category_id,
       coalesce(d.click_product_id, 0) AS click_product_id,
       d.order_category_ids, d.order_product_ids, d.pay_category_ids, d.pay_product_ids"""

_VISIT_RANGES = {
    "1s_3s": "BETWEEN 1 AND 3",
    "4s_6s": "BETWEEN 4 AND 6",
    "7s_9s": "BETWEEN 7 AND 9",
    "10s_30s": "BETWEEN 10 AND 30",
    "30s_60s": "BETWEEN 31 AND 60",
    "1m_3m": "BETWEEN 61 AND 180",
    "3m_10m": "BETWEEN 181 AND 600",
    "10m_30m": "BETWEEN 601 AND 1800",
    "30m": "> 1800",
}
_STEP_RANGES = {
    "1_3": "BETWEEN 1 AND 3",
    "4_6": "BETWEEN 4 AND 6",
    "7_9": "BETWEEN 7 AND 9",
    "10_30": "BETWEEN 10 AND 30",
    "30_60": "BETWEEN 31 AND 60",
    "60": "> 60",
}


def _bucket_counts() -> dict[str, str]:
    visits = {
        f"visit_length_{name}": f"count(*) FILTER (WHERE visit_length {inside})"
        for name, inside in _VISIT_RANGES.items()
    }
    steps = {
        f"step_length_{name}": f"count(*) FILTER (WHERE step_length {inside})"
        for name, inside in _STEP_RANGES.items()
    }
    return visits | steps


def _histogram(prefix: str) -> str:
    counts = [
        f"{count} AS {name}" for name, count in _bucket_counts().items() if name.startswith(prefix)
    ]
    return f"SELECT count(*) AS session_count, {', '.join(counts)} FROM sessions"


def _ratios() -> str:
    ratios = [
        f"(200 * {count} + count(*)) // nullif(2 * count(*), 0) / 100.0::DOUBLE AS {name}_ratio"
        for name, count in _bucket_counts().items()
    ]
    return (
        "SELECT CAST(1 AS BIGINT) AS task_id, count(*) AS session_count, "
        f"{', '.join(ratios)} FROM sessions"
    )


_FILTERED = (
    "SELECT session_id, user_id, age, professional, city, sex, visit_length, step_length "
    "FROM sessions WHERE "
)
_AGE = "age BETWEEN 20 AND 50"
_CITY = "city IN (" + ", ".join(f"'NATION_{n}'" for n in range(15)) + ")"
_KEYWORD = (
    "session_id IN (SELECT session_id FROM log WHERE search_keyword IN ('kw1', 'kw2', 'kw3'))"
)
_CATEGORY = (
    "session_id IN (SELECT session_id FROM log WHERE click_category_id IN "
    "(1, 2, 12, 21, 33, 42, 54, 65, 77, 80, 91))"
)


def _with(select: str, *parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select.strip()


def _on_log(select: str, *parts: str) -> str:
    return _with(select, _ACTIONS, _LOG, *parts)


def _on_sessions(select: str, *parts: str) -> str:
    return _on_log(select, _USERS, _SESSIONS, *parts)


def oracle_sql() -> dict[str, str]:
    sql = {
        "action_scan_by_date": _with(
            """
SELECT * REPLACE (strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time)
FROM user_visit_action WHERE update_date >= '2024-01-05' AND update_date <= '2024-01-20'""",
            _ACTIONS,
        ),
        "click_scan_by_time": _with(
            """
SELECT city_id, click_product_id AS product_id FROM user_visit_action
WHERE click_product_id IS NOT NULL
  AND strftime(action_time, '%Y-%m-%d') BETWEEN '2024-01-05' AND '2024-01-20'""",
            _ACTIONS,
        ),
        "city_dim": _with("SELECT * FROM city_info", _CITIES),
        "task_params": """
SELECT c_custkey AS task_id,
       '2024-01-' || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') AS start_date,
       '2024-01-30' AS end_date,
       CASE WHEN c_custkey % 3 = 0 THEN CAST(18 + c_custkey % 50 AS VARCHAR) END AS start_age,
       CASE WHEN c_custkey % 2 = 0 THEN '60' END AS end_age,
       c_mktsegment || ',MACHINERY' AS professionals,
       'NATION_' || CAST(c_nationkey AS VARCHAR) AS cities,
       CASE WHEN c_custkey % 5 = 0 THEN 'male' END AS sex,
       'kw1,kw2' AS keywords,
       '1,' || CAST(c_custkey AS VARCHAR) AS category_ids,
       '1,2,3,4' AS page_flow
FROM customer""",
        "session_rollup": _on_log(
            """
SELECT r.session_id, r.user_id, strftime(r.start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
       strftime(r.end_time, '%Y-%m-%d %H:%M:%S') AS end_time, r.step_length, r.visit_length,
       r.search_keywords, c.click_category_ids
FROM rollup r LEFT JOIN (
  SELECT session_id,
         string_agg(CAST(category_id AS VARCHAR), ',' ORDER BY category_id) AS click_category_ids
  FROM (SELECT DISTINCT session_id, click_category_id AS category_id FROM log
        WHERE click_category_id IS NOT NULL)
  GROUP BY session_id
) c ON r.session_id = c.session_id""",
            _USERS,
            _SESSIONS,
        ),
        "session_user_join": _on_sessions(
            """
SELECT session_id, user_id, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
       strftime(end_time, '%Y-%m-%d %H:%M:%S') AS end_time, step_length, visit_length,
       age, professional, city, sex
FROM sessions"""
        ),
        "session_filter_age": _on_sessions(_FILTERED + _AGE),
        "session_filter_profession": _on_sessions(
            _FILTERED + "professional IN ('HOUSEHOLD', 'MACHINERY')"
        ),
        "session_filter_city": _on_sessions(_FILTERED + _CITY),
        "session_filter_sex": _on_sessions(_FILTERED + "sex = 'male'"),
        "session_filter_keywords": _on_sessions(_FILTERED + _KEYWORD),
        "session_filter_categories": _on_sessions(_FILTERED + _CATEGORY),
        "session_filter_all": _on_sessions(
            _FILTERED
            + f"{_AGE} AND professional IN ('HOUSEHOLD', 'MACHINERY', 'BUILDING') "
            + f"AND {_CITY} AND sex = 'male' AND {_KEYWORD} AND {_CATEGORY}"
        ),
        "session_detail": _on_sessions(
            """
SELECT * REPLACE (strftime(action_time, '%Y-%m-%d %H:%M:%S') AS action_time) FROM detail""",
            _DETAIL,
        ),
        "visit_length_histogram": _on_sessions(_histogram("visit")),
        "step_length_histogram": _on_sessions(_histogram("step")),
        "session_stat_ratios": _on_sessions(_ratios()),
        "session_hour_counts": _on_sessions(
            "SELECT *, date || '_' || hour AS date_hour FROM hour_counts", _QUOTA
        ),
        "sample_quota": _on_sessions("SELECT * FROM quota", _QUOTA),
        "session_sample": _on_sessions(
            """
SELECT CAST(1 AS BIGINT) AS task_id, s.session_id,
       strftime(s.start_time, '%Y-%m-%d %H:%M:%S') AS start_time, s.search_keywords,
       c.click_category_ids
FROM sessions s JOIN sample x ON s.session_id = x.session_id LEFT JOIN (
  SELECT session_id,
         string_agg(CAST(category_id AS VARCHAR), ',' ORDER BY category_id) AS click_category_ids
  FROM (SELECT DISTINCT session_id, click_category_id AS category_id FROM log
        WHERE click_category_id IS NOT NULL)
  GROUP BY session_id
) c ON s.session_id = c.session_id""",
            _QUOTA,
        ),
        "session_sample_detail": _on_sessions(
            f"""
SELECT {_DETAIL_RECORD}, 'sample' AS source
FROM detail d JOIN sample x ON d.session_id = x.session_id""",
            _DETAIL,
            _QUOTA,
        ),
        "category_distinct": _on_log(
            """
SELECT category_id FROM clicked UNION SELECT category_id FROM ordered
UNION SELECT category_id FROM paid""",
            _TOUCHES.format(log="log"),
        ),
        "category_click_counts": _on_log(
            "SELECT category_id, count(*) AS click_count FROM clicked GROUP BY category_id",
            _TOUCHES.format(log="log"),
        ),
        "category_order_counts": _on_log(
            "SELECT category_id, count(*) AS order_count FROM ordered GROUP BY category_id",
            _TOUCHES.format(log="log"),
        ),
        "category_pay_counts": _on_log(
            "SELECT category_id, count(*) AS pay_count FROM paid GROUP BY category_id",
            _TOUCHES.format(log="log"),
        ),
        "category_counts": _on_sessions(
            "SELECT * FROM category_counts", _DETAIL, _CATEGORY_COUNTS
        ),
        "category_ranked": _on_sessions(
            """
SELECT * FROM category_counts
ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id""",
            _DETAIL,
            _CATEGORY_COUNTS,
        ),
        "category_top10": _on_sessions("SELECT * FROM top10", _DETAIL, _CATEGORY_COUNTS),
        "session_category_clicks": _on_log(
            """
SELECT session_id, category_id, count(*) AS click_count FROM clicked
GROUP BY session_id, category_id""",
            _TOUCHES.format(log="log"),
        ),
        "category_top_sessions": _on_sessions(
            "SELECT * FROM top_sessions", _DETAIL, _CATEGORY_COUNTS
        ),
        "category_top_session_detail": _on_sessions(
            f"""
SELECT {_DETAIL_RECORD}, 'top_category' AS source, t.category_id AS top_category_id
FROM detail d JOIN top_sessions t ON d.session_id = t.session_id""",
            _DETAIL,
            _CATEGORY_COUNTS,
        ),
        "page_pairs": _on_log("SELECT * FROM pairs", _PAIRS),
        "page_pair_counts": _on_log(
            "SELECT from_page, to_page, count(*) AS pv FROM pairs GROUP BY from_page, to_page",
            _PAIRS,
        ),
        "start_page_pv": _on_log("SELECT count(*) AS start_pv FROM log WHERE page_id = 1"),
        "page_flow_matches": _on_log("SELECT * FROM matches", _FLOW),
        "page_convert_rate": _on_log("SELECT * FROM rates", _FLOW),
        "page_convert_text": _on_log(
            """
SELECT CAST(1 AS BIGINT) AS task_id,
       string_agg(page_pair || '=' || coalesce(CAST(convert_rate AS VARCHAR), ''), '|'
                  ORDER BY step) AS convert_rate
FROM rates""",
            _FLOW,
        ),
        "click_city_join": _with("SELECT * FROM located", _ACTIONS, _CITIES, _LOCATED),
        "area_product_counts": _with(
            "SELECT * FROM area_counts", _ACTIONS, _CITIES, _LOCATED, _AREA_COUNTS
        ),
        "area_product_enriched": _with(
            "SELECT * FROM enriched",
            _ACTIONS,
            _CITIES,
            _PRODUCTS,
            _LOCATED,
            _AREA_COUNTS,
            _ENRICHED,
        ),
        "area_top3": _with(
            f"""
SELECT CAST(1 AS BIGINT) AS task_id, area, {_level('area')} AS area_level, product_id,
       city_infos, click_count, product_name, product_status
FROM (SELECT *, row_number() OVER (PARTITION BY area
                                   ORDER BY click_count DESC, product_id) AS place
      FROM enriched)
WHERE place <= 3""",
            _ACTIONS,
            _CITIES,
            _PRODUCTS,
            _LOCATED,
            _AREA_COUNTS,
            _ENRICHED,
        ),
        "product_status": _with(
            """
SELECT product_id, product_name, json_extract_string(extend_info, '$.product_status') AS status,
       CASE WHEN json_extract_string(extend_info, '$.product_status') = '0'
            THEN '自营商品' ELSE '第三方商品' END AS product_status
FROM product_info""",
            _PRODUCTS,
        ),
        "area_level": _with(
            f"SELECT *, {_level('area')} AS area_level FROM city_info", _CITIES
        ),
        "time_functions": """
WITH t AS (
  SELECT event_id, ts, CASE WHEN event_type <> 'error' THEN date_trunc('second', ts) END AS time
  FROM events
)
SELECT event_id,
       strftime(time, '%Y-%m-%d %H:%M:%S') AS time_text,
       strftime(time, '%Y-%m-%d') AS date_text,
       strftime(time, '%Y%m%d') AS date_key,
       strftime(time, '%Y%m%d%H%M') AS minute_text,
       strftime(time, '%Y-%m-%d_%H') AS date_hour,
       strftime(ts, '%Y-%m-%d') AS key_date,
       coalesce(time < TIMESTAMP '2024-01-15 09:05:07', false) AS is_before,
       coalesce(time > TIMESTAMP '2024-01-15 09:05:07', false) AS is_after,
       coalesce((epoch_us(time) - epoch_us(TIMESTAMP '2024-01-15 09:05:07')) // 1000000, 0)
         AS seconds,
       strftime(make_date(year(ts), 1, 1) + to_months(CAST(month(ts) + 12 AS INTEGER))
         + to_days(CAST(day(ts) + 30 AS INTEGER)) + to_hours(hour(ts) + 24)
         + to_minutes(minute(ts) + 75) + to_seconds(second(ts) + 61), '%Y-%m-%d %H:%M:%S')
         AS rolled_over
FROM t""",
        "string_functions": """
WITH t AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS u, json_extract_string(props, '$.k') AS k,
         CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS keyword
  FROM events
)
SELECT event_id, keyword = '' AS is_empty, keyword <> '' AS is_not_empty,
       k || ',' || u || ',' AS trimmed,
       CASE WHEN length(k) = 2 THEN k ELSE '0' || k END AS padded,
       u AS record_user, nullif(keyword, '') AS record_keyword, k AS record_page,
       CAST(NULL AS VARCHAR) AS record_absent,
       'userid=' || u || '|keyword=' || keyword || '|page=home|page=x' AS record_changed
FROM t""",
        "ad_log_parse": _with(
            """
SELECT event_id,
       epoch_us(ts) // 1000 * CASE WHEN event_id % 50 = 7 THEN 1000000 ELSE 1 END AS millis,
       replace(province, ' ', '_') AS province,
       replace(city, ' ', '_') AS city, user_id,
       CASE WHEN event_type <> 'error' THEN ad_id END AS ad_id,
       event_type = 'error' OR event_id % 50 = 7 AS malformed
FROM ad_click""",
            _clicks(21600),
        ),
        "ad_blacklist": _with("SELECT * FROM blacklist", _blacklist(21600, 4)),
        "ad_filter_blacklist": _with(
            "SELECT event_id, day, user_id, ad_id, batch FROM kept", _blacklist(21600, 4)
        ),
        "ad_daily_counts": _with(
            """
SELECT day, user_id, ad_id, count(*) AS click_count FROM kept GROUP BY day, user_id, ad_id""",
            _blacklist(21600, 4),
        ),
        "ad_stream_counts": _with(
            """
SELECT day, user_id, ad_id, count(*) AS click_count FROM kept GROUP BY day, user_id, ad_id""",
            _blacklist(864000, 4),
        ),
        "ad_upserted_counts": _with(
            """
SELECT day, user_id, ad_id, count(*) AS click_count FROM kept GROUP BY day, user_id, ad_id""",
            _blacklist(864000, 4),
        ),
        "ad_stream_blacklist": _with(
            """
SELECT user_id, since_batch - (SELECT min(batch) FROM ad_click) AS since_batch
FROM blacklist""",
            _blacklist(864000, 4),
        ),
        "ad_stream_filter": _with(
            """
SELECT batch - (SELECT min(batch) FROM ad_click) AS batch_id, count(*) AS kept_clicks
FROM kept GROUP BY batch""",
            _blacklist(864000, 4),
        ),
    }
    return {name: text.strip() for name, text in sql.items()}
