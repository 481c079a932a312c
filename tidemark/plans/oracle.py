"""The registered queries in DuckDB SQL over the same tables, written as the metric is defined
rather than as the Spark operator computes it."""

from __future__ import annotations

EVENT_TYPE = """CASE event_type WHEN 'view' THEN 'product' WHEN 'click' THEN 'cart'
  WHEN 'purchase' THEN 'purchase' WHEN 'signup' THEN 'home' WHEN 'error' THEN 'department' END"""

BROWSER = """CASE TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) % 5 WHEN 0 THEN 'Chrome'
  WHEN 1 THEN 'Safari' WHEN 2 THEN 'Firefox' WHEN 3 THEN 'IE' ELSE 'Other' END"""


def _until(ts: str, as_of: str) -> str:
    return f"({ts} IS NULL OR CAST({ts} AS DATE) <= DATE '{as_of}')"


def _web(as_of: str) -> str:
    return f"""web AS (
  SELECT user_id, CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS session_id,
         {EVENT_TYPE} AS event_type, ts AS created_at, CAST(ts AS DATE) AS day, {BROWSER} AS browser
  FROM events WHERE {_until('ts', as_of)})"""


def _country(name: str) -> str:
    return f"CASE {name} WHEN 'NATION_5' THEN 'NATION_0' WHEN 'NATION_7' THEN 'NATION_2' ELSE {name} END"


CUSTOMERS = f"""customers AS (
  SELECT c_custkey AS id, min(o_orderdate) AS created_at, min({_country('n_name')}) AS country
  FROM customer JOIN orders ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey
  GROUP BY c_custkey)"""

SHIPMENTS = f"""shipments AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, CAST(l_shipdate AS DATE) AS day,
         {_country('n_name')} AS country
  FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey
  WHERE {_until('l_shipdate', '1998-06-30')})"""

PERIODS = f"""{SHIPMENTS},
recent AS (
  SELECT country, CAST(count(*) FILTER (WHERE day >= DATE '1998-05-31') AS BIGINT) AS cur,
         CAST(count(*) FILTER (WHERE day < DATE '1998-05-31') AS BIGINT) AS prev
  FROM shipments WHERE day >= DATE '1998-05-01' GROUP BY country),
base AS (SELECT country, count(*) AS total FROM shipments GROUP BY country)"""

DATA_END_DATE = f"WITH {_web('2024-02-15')} SELECT max(day) AS data_end_date FROM web"

MAU = """
SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, count(DISTINCT o_custkey) AS mau
FROM orders WHERE date_trunc('month', o_orderdate) < DATE '2001-08-01' GROUP BY 1"""

ACTIVE_USERS = f"""
WITH {_web('2024-01-31')}
SELECT count(DISTINCT user_id) AS mau_30_days FROM web
WHERE day >= DATE '2024-01-01' AND day < DATE '2024-01-31'"""

CONVERSION = f"""
WITH {_web('2024-01-31')},
sessions AS (
  SELECT session_id, list(DISTINCT event_type) AS kinds FROM web
  WHERE day >= DATE '2024-01-01' AND day < DATE '2024-01-31' GROUP BY session_id),
counts AS (
  SELECT count(*) FILTER (WHERE list_contains(kinds, 'product')) AS product_sessions,
         count(*) FILTER (WHERE list_contains(kinds, 'product') AND list_contains(kinds, 'purchase'))
           AS purchase_sessions
  FROM sessions)
SELECT product_sessions, purchase_sessions,
       CAST(purchase_sessions AS DOUBLE) / nullif(product_sessions, 0) AS purchase_conversion_rate
FROM counts"""

KPI = f"""
SELECT '2024-01-31' AS last_updated_date, mau_30_days, purchase_conversion_rate
FROM ({ACTIVE_USERS}) CROSS JOIN ({CONVERSION})"""

RETENTION = f"""
WITH {CUSTOMERS},
cohort AS (
  SELECT id, CAST(date_trunc('month', created_at) AS DATE) AS cohort_month
  FROM customers WHERE date_trunc('month', created_at) < DATE '1995-10-01'),
active AS (
  SELECT DISTINCT o_custkey AS id, CAST(date_trunc('month', o_orderdate) AS DATE) AS active_month
  FROM orders WHERE {_until('o_orderdate', '1995-10-15')}),
cells AS (
  SELECT cohort_month, 0 AS age_month, count(*) AS users FROM cohort GROUP BY cohort_month
  UNION ALL
  SELECT cohort_month, CAST(datediff('month', cohort_month, active_month) AS INTEGER), count(DISTINCT id)
  FROM cohort JOIN active USING (id) WHERE datediff('month', cohort_month, active_month) > 0
  GROUP BY 1, 2),
ranked AS (
  SELECT cohort_month, count(*) AS size, dense_rank() OVER (ORDER BY cohort_month DESC) AS newest
  FROM cohort GROUP BY cohort_month)
SELECT cohort_month, strftime(cohort_month, '%Y-%m') AS cohort_label, CAST(age_month AS INTEGER) AS age_month,
       CAST(users AS DOUBLE) / nullif(size, 0) AS retention_rate
FROM cells JOIN ranked USING (cohort_month)
WHERE newest <= 4 AND size >= 50 AND age_month <= 4"""

PLATFORM = f"""
WITH {_web('2024-02-15')},
placed AS (
  SELECT user_id, created_at, CASE lower(browser) WHEN 'safari' THEN 'iOS' WHEN 'chrome' THEN 'Android'
         WHEN 'firefox' THEN 'Desktop' WHEN 'ie' THEN 'Desktop' ELSE 'Web' END AS platform
  FROM web),
latest AS (
  SELECT platform, row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC, platform DESC) AS nth
  FROM placed)
SELECT platform, count(*) AS users,
       CAST(count(*) AS DOUBLE) / nullif(CAST(sum(count(*)) OVER () AS BIGINT), 0) AS share
FROM latest WHERE nth = 1 GROUP BY platform"""

USERS_BY_COUNTRY = f"""
WITH {CUSTOMERS}
SELECT country, count(*) AS users FROM customers
WHERE country IS NOT NULL AND {_until('created_at', '2001-12-31')} GROUP BY country"""

COUNTRY_TRENDS = f"""
WITH {PERIODS},
changes AS (
  SELECT country, cur, prev, CAST(cur - prev AS DOUBLE) / prev AS pct FROM recent WHERE prev >= 10),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY pct DESC, country) AS up, row_number() OVER (ORDER BY pct, country) AS down
  FROM changes)
SELECT country, cur AS current_users, prev AS previous_users, pct AS pct_change,
       CASE WHEN up <= 5 THEN 'Top Growth' ELSE 'Top Decline' END AS trend_type
FROM ranked WHERE up <= 5 OR down <= 5"""

COUNTRY_INCREASES = f"""
WITH {PERIODS}
SELECT country, cur AS increase_number, CAST(cur AS DOUBLE) / total * 100 AS increase_percentage
FROM recent JOIN base USING (country) WHERE prev > 0 AND cur > 0 AND total >= 50
ORDER BY increase_percentage DESC, country LIMIT 3"""

COUNTRY_DECREASES = f"""
WITH {PERIODS}
SELECT country, prev - cur AS decrease_number, CAST(prev - cur AS DOUBLE) / total * 100 AS decrease_percentage
FROM recent JOIN base USING (country) WHERE cur < prev AND prev >= 10 AND total >= 50
ORDER BY decrease_percentage DESC, country LIMIT 3"""

FUNNEL_COUNTS = f"""{_web('2024-02-15')},
sessions AS (
  SELECT session_id, list(DISTINCT event_type) AS kinds FROM web
  WHERE date_trunc('month', day) = DATE '2024-01-01' GROUP BY session_id),
steps AS (
  SELECT 1 AS step, 'Product View' AS step_name, count(*) AS sessions FROM sessions
  WHERE list_contains(kinds, 'product')
  UNION ALL
  SELECT 2, 'Add to Cart', count(*) FROM sessions WHERE list_has_all(kinds, ['product', 'cart'])
  UNION ALL
  SELECT 3, 'Purchase', count(*) FROM sessions WHERE list_has_all(kinds, ['product', 'cart', 'purchase'])),
firsts AS (SELECT sessions AS s1 FROM steps WHERE step = 1)"""

FUNNEL = f"""
WITH {FUNNEL_COUNTS}
SELECT CAST(step AS INTEGER) AS step, step_name, sessions,
       CASE step WHEN 1 THEN CAST(100 AS DOUBLE)
         ELSE round(CAST(100 AS DOUBLE) * sessions / nullif(s1, 0), 1) END AS percentage
FROM steps, firsts"""

FUNNEL_PCT = f"""
WITH {FUNNEL_COUNTS}
SELECT CAST(step AS INTEGER) AS step, step_name, sessions,
       CASE step WHEN 1 THEN CAST(100 AS DOUBLE)
         ELSE round(CAST(100 AS DOUBLE) * sessions / nullif(s1, 0), 1) END AS percentage,
       CASE step WHEN 1 THEN CAST(1 AS DOUBLE)
         ELSE round(CAST(sessions AS DOUBLE) / nullif(s1, 0), 3) END AS fraction
FROM steps, firsts"""

FUNNEL_STEP_CONVERSION = f"""
WITH {FUNNEL_COUNTS},
pairs AS (SELECT step, sessions, lag(sessions) OVER (ORDER BY step) AS prev FROM steps)
SELECT CAST(step AS INTEGER) AS step, sessions,
       CASE WHEN prev > 0 THEN CAST(sessions AS DOUBLE) / prev WHEN prev = 0 THEN CAST(0 AS DOUBLE) END
         AS conversion
FROM pairs"""

REGISTERED = f"""{_web('2024-02-28')},
signed AS (
  SELECT user_id AS id, max(ts) AS created_at FROM events
  WHERE event_type = 'signup' AND ts < TIMESTAMP '2024-02-29' GROUP BY user_id),
fresh AS (
  SELECT * FROM signed
  WHERE CAST(created_at AS DATE) BETWEEN DATE '2023-12-30' AND DATE '2024-01-29'),
followed AS (
  SELECT id, fresh.created_at AS registered, event_type, web.created_at AS happened
  FROM fresh JOIN web ON web.user_id = fresh.id
  WHERE web.day >= CAST(fresh.created_at AS DATE) AND event_type IN ('product', 'cart', 'purchase'))"""

REGISTRATION_UNORDERED = f"""
WITH {REGISTERED}
SELECT 1 AS step, 'New User Registration' AS step_name, count(DISTINCT id) AS users FROM fresh
UNION ALL
SELECT 2, 'Product View', count(DISTINCT id) FROM followed WHERE event_type = 'product'
UNION ALL
SELECT 3, 'Add to Cart', count(DISTINCT id) FROM followed WHERE event_type = 'cart'
UNION ALL
SELECT 4, 'Purchase', count(DISTINCT id) FROM followed WHERE event_type = 'purchase'"""

FIRST_TIMES = """SELECT {person}, {signup},
         min(CASE event_type WHEN 'product' THEN happened END) AS first_product_view,
         min(CASE event_type WHEN 'cart' THEN happened END) AS first_add_to_cart,
         min(CASE event_type WHEN 'purchase' THEN happened END) AS first_purchase
  FROM {rows} GROUP BY ALL"""

FIRST_EVENT_PIVOT = f"""WITH {REGISTERED}
{FIRST_TIMES.format(person="id AS user_id", signup="registered AS registration_date", rows="followed")}"""

REGISTRATION_ORDERED = f"""
WITH {REGISTERED},
firsts AS (
  {FIRST_TIMES.format(person="id", signup="created_at", rows="fresh LEFT JOIN followed USING (id)")}),
reached AS (
  SELECT id, CASE WHEN first_product_view IS NULL AND first_add_to_cart IS NULL AND first_purchase IS NULL THEN NULL
                  WHEN first_product_view IS NULL THEN 0
                  WHEN first_add_to_cart IS NULL OR first_add_to_cart < first_product_view THEN 1
                  WHEN first_purchase IS NULL OR first_purchase < first_add_to_cart THEN 2 ELSE 3 END AS depth
  FROM firsts)
SELECT n + 1 AS step,
       ['New User Registration', 'Product View', 'Add to Cart', 'Purchase'][n + 1] AS step_name,
       CAST(CASE n WHEN 0 THEN count(id) ELSE sum(CASE WHEN depth >= n THEN 1 WHEN depth < n THEN 0 END) END AS BIGINT)
         AS users
FROM (VALUES (0), (1), (2), (3)) AS steps(n) LEFT JOIN reached ON true GROUP BY n"""

EXPORT_EVENTS = """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props FROM events"""

EXPORT_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate, o_orderpriority
FROM orders"""

UPSERT = """
WITH changed AS (
  SELECT doc_id * 2 AS doc_id, 'changed: ' || text AS text, n_chars + 9 AS n_chars FROM documents)
SELECT coalesce(t.doc_id, s.doc_id) AS doc_id,
       CASE WHEN s.doc_id IS NULL THEN t.text ELSE s.text END AS text, t.lang, t.source,
       CASE WHEN s.doc_id IS NULL THEN t.n_chars ELSE s.n_chars END AS n_chars
FROM documents t FULL OUTER JOIN changed s ON t.doc_id = s.doc_id"""

UPDATE = """
SELECT d.doc_id, d.text,
       CASE WHEN l.quality = 1 OR l.toxic = 1 THEN CASE WHEN l.toxic = 1 THEN 'unsafe' END ELSE d.lang END AS lang,
       CASE WHEN l.quality = 1 OR l.toxic = 1 THEN CASE WHEN l.quality = 1 THEN 'good' END ELSE d.source END
         AS source,
       d.n_chars
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""

LATEST_RECORD = """
SELECT conv_id, turn, role, text FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC) AS nth FROM conversations)
WHERE nth = 1"""

DOCUMENT_SUMMARIES = """summaries AS (
  SELECT CAST(doc_id AS VARCHAR) AS run_id, TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS run_ts,
         CAST(TIMESTAMP '2024-01-01' + to_minutes(doc_id) AS DATE) AS data_end_date, text,
         '{"n":' || n_chars || '}' AS facts_json, CAST(NULL AS VARCHAR) AS sent_slack_ts,
         CAST(NULL AS VARCHAR) AS sent_email_id
  FROM documents)"""

LATEST_SUMMARY = f"WITH {DOCUMENT_SUMMARIES} SELECT * FROM summaries ORDER BY run_ts DESC, run_id DESC LIMIT 1"

# The characters that count as whitespace.
BLANKS = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
BLANK_CLASS = "[" + "".join(rf"\x{{{code:x}}}" for code in BLANKS) + "]"
BLANK_TEXT = " || ".join(f"chr({code})" for code in BLANKS)

TAILED = """tailed AS (
  SELECT doc_id, n_chars, text
    || CASE WHEN doc_id % 4 = 0 THEN '\\n\\nnext\\nline' ELSE '' END
    || CASE WHEN doc_id % 5 = 0 THEN chr(10) || '```json' || chr(10) || '{"a": 1}' || chr(10) || '```' || chr(10)
       ELSE '' END
    || chr(10) || chr(10) || 'facts_json:' || chr(10)
    || CASE WHEN doc_id % 7 = 0 THEN '{"current_mau": ' || doc_id || ', "retention_rate": ,}'
       ELSE '{"retention_rate": 0.' || (doc_id % 89 + 1) || '5, '
         || CASE WHEN doc_id % 11 = 0 THEN '"current_mau": -1, ' ELSE '' END
         || '"extra": {"list": [1.0, null, "}"]}, "current_mau": ' || n_chars
         || ', "platform_share": "12.' || (doc_id % 10) || '%", "dominant_platform": "i\\"OS"}' END AS text
  FROM documents)"""

FACTS = f"""{TAILED},
found AS (SELECT *, regexp_extract(text, 'facts_json.*?(\\{{.*\\}})', 1, 's') AS block FROM tailed),
facts AS (SELECT *, CASE WHEN json_valid(block) THEN block END AS facts FROM found)"""

EXTRACT_FACTS = f"""
WITH {FACTS}
SELECT doc_id, coalesce(facts, '{{}}') AS facts_json,
       CASE WHEN facts IS NOT NULL THEN 'read' WHEN block <> '' THEN 'unreadable' ELSE 'none' END AS facts_state,
       CASE WHEN facts IS NOT NULL THEN CAST(n_chars AS VARCHAR) END AS current_mau,
       json_extract_string(facts, '$.dominant_platform') AS dominant_platform,
       json_extract_string(facts, '$.platform_share') AS platform_share,
       json_extract_string(facts, '$.conversion_rate') AS conversion_rate,
       regexp_extract(facts, '"retention_rate": ([0-9.]+)', 1) AS retention_rate,
       json_extract_string(facts, '$.growth_trend') AS growth_trend
FROM facts"""


def _cleaned(text: str) -> str:
    for pattern, new, flags in [
        ("facts_json.*", "''", "gis"),
        ("```json.*?```", "''", "gis"),
        ("```.*?```", "''", "gs"),
    ]:
        text = f"regexp_replace({text}, '{pattern}', {new}, '{flags}')"
    text = f"replace(replace({text}, '\\n\\n', chr(10) || chr(10)), '\\n', chr(10))"
    text = f"regexp_replace({text}, '\\n{BLANK_CLASS}*\\n', chr(10) || chr(10), 'g')"
    return f"trim({text}, {BLANK_TEXT})"


CLEAN_TEXT = f"WITH {TAILED} SELECT doc_id, {_cleaned('text')} AS text FROM tailed"

REFRESH_SUMMARIES = f"""
WITH {DOCUMENT_SUMMARIES}, {FACTS},
fresh AS (
  SELECT CAST(doc_id * 2 AS VARCHAR) AS run_id, DATE '2024-02-15' AS data_end_date,
         {_cleaned('text')} AS text, coalesce(facts, '{{}}') AS facts_json
  FROM facts)
SELECT coalesce(t.run_id, s.run_id) AS run_id,
       CASE WHEN s.run_id IS NULL THEN t.run_ts ELSE TIMESTAMP '2030-01-01' END AS run_ts,
       CASE WHEN s.run_id IS NULL THEN t.data_end_date ELSE s.data_end_date END AS data_end_date,
       CASE WHEN s.run_id IS NULL THEN t.text ELSE s.text END AS text,
       CASE WHEN s.run_id IS NULL THEN t.facts_json ELSE s.facts_json END AS facts_json,
       t.sent_slack_ts, t.sent_email_id
FROM summaries t FULL OUTER JOIN fresh s ON t.run_id = s.run_id"""

MARTS = {
    "mau": MAU,
    "retention": RETENTION,
    "users_by_country": USERS_BY_COUNTRY,
    "platform_share": PLATFORM,
    "funnel": FUNNEL,
    "data_end_date": DATA_END_DATE,
    "country_trends": COUNTRY_TRENDS,
    "country_increases": COUNTRY_INCREASES,
    "country_decreases": COUNTRY_DECREASES,
    "kpi_metrics": KPI,
}


def _plain(value: str) -> str:
    """A fraction without an exponent or closing zeros."""
    return f"rtrim(rtrim(CAST(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 20)) AS VARCHAR), '0'), '.')"


FRACTIONS = ["retention_rate", "share", "purchase_conversion_rate"]


def _json_cell(column: str) -> str:
    if column in FRACTIONS:
        return f"""'"{column}":' || coalesce({_plain(column)}, 'null')"""
    return f"trim(CAST(to_json(struct_pack({column} := {column})) AS VARCHAR)[2:-2])"


def _json_section(section: str, columns: list[str], rows: str, order: str = "") -> str:
    cells = " || ',' || ".join(map(_json_cell, columns))
    position = f"row_number() OVER (ORDER BY {order})" if order else "1"
    return f"""SELECT '{section}' AS section, CAST({position} AS INTEGER) AS position,
      '{{' || {cells} || '}}' AS row_json FROM ({rows})"""


def _payload(months: int, end_date: str) -> list[str]:
    mau = f"SELECT CAST(month AS VARCHAR) AS month, mau FROM ({MAU}) ORDER BY month DESC LIMIT {months}"
    retention = f"SELECT * REPLACE (CAST(cohort_month AS VARCHAR) AS cohort_month) FROM ({RETENTION})"
    return [
        _json_section("mau", ["month", "mau"], mau, "month DESC"),
        _json_section(
            "retention",
            ["cohort_month", "cohort_label", "age_month", "retention_rate"],
            retention,
            "cohort_month, age_month",
        ),
        _json_section("platform", ["platform", "users", "share"], PLATFORM, "users DESC, platform"),
        _json_section("funnel", ["step", "step_name", "sessions"], FUNNEL, "step"),
        _json_section("kpi_metrics", ["last_updated_date", "mau_30_days", "purchase_conversion_rate"], KPI),
        _json_section("data_end_date", ["data_end_date"], end_date),
    ]


MART_ROWS_JSON = " UNION ALL ".join(_payload(18, "SELECT '2024-02-15' AS data_end_date"))

CHAT_ROWS_JSON = " UNION ALL ".join(
    [
        *_payload(6, f"SELECT CAST(data_end_date AS VARCHAR) AS data_end_date FROM ({DATA_END_DATE})"),
        _json_section("latest_summary", ["text", "facts_json"], LATEST_SUMMARY),
    ]
)

TABLE_ROW_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS rows FROM ({sql})" for name, sql in MARTS.items()
)

DQ_NOT_NULL = " UNION ALL ".join(
    f"SELECT '{mart}' AS table_name, '{column}' AS column_name, "
    f"count(*) FILTER (WHERE {column} IS NULL) AS failures FROM ({MARTS[mart]})"
    for mart, column in [("mau", "month"), ("mau", "mau"), ("users_by_country", "country")]
)

DQ_MART_PROFILE = " UNION ALL ".join(
    f"SELECT '{mart}' AS mart, {metric} AS metric, CAST({value} AS VARCHAR) AS value FROM ({MARTS[mart]})"
    for mart, metric, value in [
        ("mau", "'months'", "count(*)"),
        ("mau", "'first_month'", "min(month)"),
        ("mau", "'last_month'", "max(month)"),
        ("mau", "'peak_mau'", "max(mau)"),
        ("retention", "'cohorts'", "count(DISTINCT cohort_month)"),
        ("retention", "'min_rate'", _plain("min(retention_rate)")),
        ("retention", "'max_rate'", _plain("max(retention_rate)")),
        ("users_by_country", "'countries'", "count(*)"),
        ("users_by_country", "'total_users'", "sum(users)"),
        ("users_by_country", "'largest_country'", "max(users)"),
        ("platform_share", "'platforms'", "count(*)"),
        ("platform_share", "'total_users'", "sum(users)"),
        ("platform_share", "'users ' || platform", "users"),
        ("platform_share", "'share ' || platform", _plain("share")),
        ("data_end_date", "'data_end_date'", "data_end_date"),
    ]
)

HEADLINE_FACTS = f"""
WITH months AS (
  SELECT month, mau, CASE WHEN datediff('month', lag(month) OVER (ORDER BY month), month) = 1
                     THEN mau - lag(mau) OVER (ORDER BY month) END AS change FROM ({MAU})),
steps AS (SELECT month, mau, change - lag(change) OVER (ORDER BY month) AS step FROM months),
current AS (SELECT mau, step FROM steps ORDER BY month DESC LIMIT 1),
top AS (SELECT platform, share FROM ({PLATFORM}) ORDER BY users DESC, platform LIMIT 1),
newest AS (SELECT retention_rate FROM ({RETENTION}) ORDER BY cohort_month DESC, age_month DESC LIMIT 1)
SELECT mau AS current_mau, platform AS dominant_platform, share AS platform_share,
       purchase_conversion_rate AS conversion_rate, (SELECT retention_rate FROM newest) AS retention_rate,
       CASE WHEN step > 0 THEN 'accelerating' WHEN step = 0 THEN 'stable' WHEN step < 0 THEN 'declining' END
         AS growth_trend
FROM current, top, ({KPI})"""

ORACLE_SQL: dict[str, str] = {
    "data_end_date": DATA_END_DATE,
    "mau_monthly": MAU,
    "mau_recent": f"SELECT * FROM ({MAU}) ORDER BY month DESC LIMIT 18",
    "active_users_trailing": ACTIVE_USERS,
    "session_conversion_trailing": CONVERSION,
    "kpi_metrics": KPI,
    "retention_cohorts": RETENTION,
    "platform_share": PLATFORM,
    "users_by_country": USERS_BY_COUNTRY,
    "country_trends": COUNTRY_TRENDS,
    "country_increases": COUNTRY_INCREASES,
    "country_decreases": COUNTRY_DECREASES,
    "session_funnel": FUNNEL,
    "funnel_pct_of_first": FUNNEL_PCT,
    "funnel_step_conversion": FUNNEL_STEP_CONVERSION,
    "registration_funnel_unordered": REGISTRATION_UNORDERED,
    "first_event_pivot": FIRST_EVENT_PIVOT,
    "registration_funnel_ordered": REGISTRATION_ORDERED,
    "export_stringify": EXPORT_EVENTS,
    "export_stringify_orders": EXPORT_ORDERS,
    "upsert_by_key": UPSERT,
    "update_by_key": UPDATE,
    "latest_record": LATEST_RECORD,
    "latest_summary": LATEST_SUMMARY,
    "refresh_summaries": REFRESH_SUMMARIES,
    "extract_facts": EXTRACT_FACTS,
    "facts_by_path": EXTRACT_FACTS,
    "clean_text": CLEAN_TEXT,
    "mart_rows_json": MART_ROWS_JSON,
    "chat_rows_json": CHAT_ROWS_JSON,
    "table_row_counts": TABLE_ROW_COUNTS,
    "dq_not_null": DQ_NOT_NULL,
    "dq_mart_profile": DQ_MART_PROFILE,
    "headline_facts": HEADLINE_FACTS,
    "mau_monthly_from_sets": MAU,
    "active_users_from_sets": ACTIVE_USERS,
    "retention_from_sets": RETENTION,
}
