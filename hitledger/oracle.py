"""The same answers in DuckDB SQL, one statement per registered query.

Every statement starts with the access-log tables as CTEs over the test tables,
by the rules of `sources.driver_tables`. Rates are rounded half up on integers,
because the two engines' `round` differ on ties of binary fractions.
"""

from __future__ import annotations

# Country codes, devices, event types and plans, as in `sources.driver_tables`
# and `schemas`.
_COUNTRIES = "['US', 'JP', 'GB', 'DE', 'FR', 'CA', 'AU', 'SG', 'IN', 'BR']"
_DEVICES = "['desktop', 'mobile', 'tablet']"
_EVENT_TYPES = "('page_view', 'click', 'purchase', 'sign_up', 'add_to_cart', 'checkout')"
_PLAN_TYPES = "('free', 'premium')"

_TABLES = f"""
WITH raw_events AS (
    SELECT e.event_id, e.user_id,
           'session_' || e.user_id || '_' || strftime(e.ts, '%Y%m%d') AS session_id,
           CASE e.event_type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'sign_up'
                ELSE e.event_type END AS event_type,
           CAST(NULL AS VARCHAR) AS page_url,
           e.ts AS event_timestamp,
           {_DEVICES}[e.user_id % 3 + 1] AS device_type,
           {_COUNTRIES}[c.c_nationkey % 10 + 1] AS country,
           CAST(e.ts AS DATE) AS event_date
    FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id
), users AS (
    SELECT c_custkey AS user_id,
           DATE '2023-08-03' + CAST(c_custkey % 181 AS INTEGER) AS signup_date,
           {_COUNTRIES}[c_nationkey % 10 + 1] AS country,
           CASE WHEN c_mktsegment = 'BUILDING' THEN 'premium' ELSE 'free' END AS plan_type,
           c_acctbal > 2000 AS is_active
    FROM customer WHERE c_acctbal > 0
), sessions AS (
    SELECT session_id, user_id,
           min(event_timestamp) AS session_start, max(event_timestamp) AS session_end,
           count(*) FILTER (event_type = 'page_view') AS page_views, device_type
    FROM raw_events GROUP BY session_id, user_id, device_type
    HAVING count(*) FILTER (event_type = 'page_view') >= 1
), daily AS (
    SELECT event_date, count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
           count(DISTINCT session_id) AS unique_sessions
    FROM raw_events GROUP BY event_date
), country_daily AS (
    SELECT e.event_date, u.country, count(*) AS event_count, count(DISTINCT e.user_id) AS user_count,
           count(DISTINCT e.event_id) FILTER (e.event_type = 'purchase') AS purchase_count
    FROM raw_events e JOIN users u USING (user_id) GROUP BY e.event_date, u.country
)
"""


def _half_up(part: str, whole: str, digits: int) -> str:
    """`part / whole` of two integers, rounded half up to `digits`."""
    scale = 10**digits
    return f"(({part} * {2 * scale} + {whole}) // (2 * {whole})) / {scale}.0"


_DAILY_SUMMARY = """
    SELECT e.event_date, upper(u.country) AS country, count(*) AS event_count,
           count(DISTINCT e.user_id) AS unique_users,
           count(*) FILTER (e.event_type = 'purchase') AS purchase_count
    FROM raw_events e JOIN users u USING (user_id)
    WHERE e.event_id IS NOT NULL GROUP BY ALL
"""

_STG_EVENTS = """
    SELECT event_id, user_id, session_id, event_type, event_timestamp, event_date
    FROM raw_events WHERE event_id IS NOT NULL AND user_id IS NOT NULL
"""

_RECENT = """
    SELECT event_date, event_count, unique_users FROM daily WHERE event_date >= DATE '2024-01-23'
"""

_COUNTRY_RATE = f"""
    SELECT event_date, country, event_count, purchase_count,
           {_half_up("purchase_count", "user_count", 4)} AS purchase_rate
    FROM country_daily WHERE event_date >= DATE '2024-01-23'
"""

_MODEL_CHECKS = f"""
    , stg_events AS ({_STG_EVENTS}), mart AS ({_DAILY_SUMMARY})
    SELECT 'stg_events' AS model, 'event_id' AS column_name, 'unique' AS check_name,
           count(*) AS failures
    FROM (SELECT event_id FROM stg_events GROUP BY event_id HAVING count(*) > 1)
    UNION ALL SELECT 'stg_events', 'event_id', 'not_null', count(*) FROM stg_events WHERE event_id IS NULL
    UNION ALL SELECT 'stg_events', 'user_id', 'not_null', count(*) FROM stg_events WHERE user_id IS NULL
    UNION ALL SELECT 'stg_events', 'event_date', 'not_null', count(*) FROM stg_events WHERE event_date IS NULL
    UNION ALL SELECT 'stg_users', 'user_id', 'unique', count(*)
    FROM (SELECT user_id FROM users WHERE user_id IS NOT NULL GROUP BY user_id HAVING count(*) > 1)
    UNION ALL SELECT 'stg_users', 'user_id', 'not_null', count(*) FROM users WHERE user_id IS NULL
    UNION ALL SELECT 'daily_summary', 'event_date', 'not_null', count(*) FROM mart WHERE event_date IS NULL
    UNION ALL SELECT 'daily_summary', 'country', 'not_null', count(*) FROM mart WHERE country IS NULL
    UNION ALL SELECT 'daily_summary', 'event_count', 'not_null', count(*) FROM mart WHERE event_count IS NULL
"""

_WEEKLY = """
    , weeks AS (SELECT *, CAST(date_trunc('week', event_date) AS DATE) AS week_start FROM daily)
    SELECT week_start, week_start + 6 AS week_end,
           CAST(sum(event_count) AS BIGINT) AS event_count,
           CAST(sum(unique_users) AS BIGINT) AS unique_users
    FROM weeks GROUP BY week_start
"""

_GAP_SESSIONS = """
    , marked AS (
        SELECT *, coalesce(event_timestamp - lag(event_timestamp) OVER w > INTERVAL 30 MINUTE, true) AS starts
        FROM raw_events WINDOW w AS (PARTITION BY user_id ORDER BY event_timestamp, event_id)
    ), numbered AS (
        SELECT *, sum(starts::INT) OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id
                                         ROWS UNBOUNDED PRECEDING) AS session_no
        FROM marked
    ), gap_sessions AS (
        SELECT user_id, session_no::BIGINT AS session_no, min(event_timestamp) AS session_start,
               max(event_timestamp) AS session_end, count(*) AS event_count,
               count(*) FILTER (event_type = 'page_view') AS page_views,
               count(*) FILTER (event_type = 'purchase') AS purchases,
               date_sub('second', min(event_timestamp), max(event_timestamp)) AS duration_seconds
        FROM numbered GROUP BY ALL
    )
"""

_HOME_EVENTS = """
    , home AS (
        SELECT e.event_date, e.event_type, e.user_id, u.country
        FROM raw_events e JOIN users u USING (user_id)
    )
"""

_STATEMENTS = {
    "event_sample": "SELECT * EXCLUDE (event_date) FROM raw_events ORDER BY event_id LIMIT 10",
    "purchases_in_countries": """
        SELECT event_id, user_id, event_type, event_timestamp, country FROM raw_events
        WHERE event_type = 'purchase' AND country IN ('US', 'JP') ORDER BY event_id LIMIT 20
    """,
    "event_types": "SELECT DISTINCT event_type FROM raw_events ORDER BY event_type",
    "purchases_with_user": """
        SELECT e.event_id, e.user_id, e.event_type, e.event_timestamp, u.country, u.plan_type
        FROM raw_events e JOIN users u USING (user_id)
        WHERE e.event_type = 'purchase' ORDER BY e.event_id LIMIT 20
    """,
    "orphan_events": """
        SELECT e.event_id, e.user_id, u.plan_type FROM raw_events e LEFT JOIN users u USING (user_id)
        WHERE u.user_id IS NULL ORDER BY e.event_id LIMIT 20
    """,
    "daily_event_counts": """
        SELECT event_date, event_count AS total_events, unique_users FROM daily ORDER BY event_date DESC
    """,
    "country_funnel": """
        SELECT u.country, count(*) AS total_events,
               count(*) FILTER (e.event_type = 'page_view') AS pageview_count,
               count(*) FILTER (e.event_type = 'purchase') AS purchase_count
        FROM raw_events e JOIN users u USING (user_id) GROUP BY u.country ORDER BY total_events DESC
    """,
    "heavy_users": """
        SELECT user_id, count(*) AS event_count FROM raw_events
        GROUP BY user_id HAVING count(*) > 75 ORDER BY event_count DESC
    """,
    "recent_daily_events": _RECENT,
    "daily_purchase_rate": f"""
        , bought AS (
            SELECT event_date, count(*) AS purchases FROM raw_events
            WHERE event_type = 'purchase' GROUP BY event_date
        ), both_counts AS (
            SELECT d.event_date, d.event_count, d.unique_users, coalesce(b.purchases, 0) AS purchase_count
            FROM daily d LEFT JOIN bought b USING (event_date)
        )
        SELECT *, {_half_up("purchase_count", "event_count", 4)} AS purchase_rate FROM both_counts
    """,
    "conversion_tiers": f"""
        , performance AS (
            SELECT e.event_date, u.country, u.plan_type, count(*) AS event_count,
                   count(DISTINCT e.user_id) AS user_count,
                   count(DISTINCT e.event_id) FILTER (e.event_type = 'purchase') AS purchase_count
            FROM raw_events e JOIN users u USING (user_id)
            WHERE e.event_timestamp >= DATE '2024-01-16' GROUP BY ALL
        ), rated AS (
            SELECT *, {_half_up("event_count", "user_count", 2)} AS events_per_user,
                   {_half_up("purchase_count", "user_count", 4)} AS purchase_rate
            FROM performance
        )
        SELECT *, CASE WHEN purchase_rate >= 0.05 THEN 'High' WHEN purchase_rate >= 0.02 THEN 'Medium'
                  ELSE 'Low' END AS conversion_tier
        FROM rated
    """,
    "v_daily_events": "SELECT * FROM daily",
    "v_daily_events_recent": "SELECT * FROM daily WHERE event_date >= DATE '2024-01-23'",
    "v_country_daily_summary": "SELECT * FROM country_daily",
    "country_purchase_rate": _COUNTRY_RATE,
    "refresh_daily_summary": "SELECT * FROM daily ORDER BY event_date DESC LIMIT 10",
    "weekly_summary": _WEEKLY,
    "stg_events": _STG_EVENTS,
    "stg_users": "SELECT * REPLACE (upper(country) AS country) FROM users",
    "daily_summary": _DAILY_SUMMARY,
    "model_build": _DAILY_SUMMARY,
    "model_build_checks": _MODEL_CHECKS,
    "table_row_counts": """
        SELECT 'USERS' AS table_name, count(*) AS row_count FROM users
        UNION ALL SELECT 'SESSIONS', count(*) FROM sessions
        UNION ALL SELECT 'RAW_EVENTS', count(*) FROM raw_events
    """,
    "users_read_back": "SELECT * FROM users ORDER BY user_id LIMIT 5",
    "sessions_read_back": "SELECT * FROM sessions ORDER BY session_id LIMIT 5",
    "orphaned_sessions": """
        SELECT count(*) AS orphaned_sessions FROM sessions s
        WHERE NOT EXISTS (SELECT 1 FROM users u WHERE u.user_id = s.user_id)
    """,
    "orphaned_events": """
        SELECT count(*) AS orphaned_events FROM raw_events e
        WHERE NOT EXISTS (SELECT 1 FROM users u WHERE u.user_id = e.user_id)
    """,
    "orphaned_events_by_session": """
        SELECT count(*) AS orphaned_events_by_session FROM raw_events e
        WHERE NOT EXISTS (SELECT 1 FROM sessions s WHERE s.session_id = e.session_id)
    """,
    "users_by_country": "SELECT country, count(*) AS user_count FROM users GROUP BY country",
    "event_type_distribution": "SELECT event_type, count(*) AS event_count FROM raw_events GROUP BY event_type",
    "top_users": """
        SELECT user_id, count(*) AS event_count FROM raw_events
        GROUP BY user_id ORDER BY event_count DESC, user_id LIMIT 10
    """,
    "device_session_stats": f"""
        , totals AS (
            SELECT device_type, count(*) AS session_count, CAST(sum(page_views) AS BIGINT) AS views,
                   max(page_views) AS max_page_views
            FROM sessions GROUP BY device_type
        )
        SELECT device_type, session_count, {_half_up("views", "session_count", 2)} AS avg_page_views,
               max_page_views
        FROM totals
    """,
    "null_dates_check": "SELECT count(*) AS null_dates FROM daily WHERE event_date IS NULL",
    "negative_counts_check": "SELECT count(*) AS negative_counts FROM daily WHERE event_count < 0",
    "model_checks": _MODEL_CHECKS,
    "accepted_values_check": f"""
        SELECT event_type, count(*) AS failures FROM raw_events
        WHERE event_type NOT IN {_EVENT_TYPES}
        GROUP BY event_type
    """,
    "accepted_plans_check": f"""
        SELECT count(*) AS failures FROM users WHERE plan_type NOT IN {_PLAN_TYPES}
    """,
    "accepted_range_check": """
        SELECT session_id, page_views FROM sessions WHERE page_views NOT BETWEEN 1 AND 3
    """,
    "stored_failures": """
        SELECT user_id, count(*) AS failures FROM raw_events e
        WHERE NOT EXISTS (SELECT 1 FROM users u WHERE u.user_id = e.user_id) GROUP BY user_id
    """,
    "appended_twice": "SELECT event_date, 2::BIGINT AS copies, 2 * event_count AS event_count FROM daily",
    "value_counts": """
        SELECT 'users.plan_type' AS column_name, plan_type AS value, count(*) AS n FROM users GROUP BY value
        UNION ALL SELECT 'users.country', country, count(*) FROM users GROUP BY country
        UNION ALL SELECT 'sessions.device_type', device_type, count(*) FROM sessions GROUP BY device_type
        UNION ALL SELECT 'raw_events.event_type', event_type, count(*) FROM raw_events GROUP BY event_type
        UNION ALL SELECT 'raw_events.device_type', device_type, count(*) FROM raw_events GROUP BY device_type
    """,
    "page_views_describe": """
        SELECT count(page_views) AS count, round(avg(page_views), 9) AS mean,
               round(stddev_samp(page_views), 9) AS std, min(page_views) AS min,
               quantile_cont(page_views, 0.25) AS p25, quantile_cont(page_views, 0.5) AS p50,
               quantile_cont(page_views, 0.75) AS p75, max(page_views) AS max
        FROM sessions
    """,
    "csv_load": "SELECT * FROM users",
    "csv_load_sessions": """
        SELECT * REPLACE (date_trunc('second', session_start) AS session_start,
                          date_trunc('second', session_end) AS session_end)
        FROM sessions
    """,
    "csv_load_raw_events": """
        SELECT * EXCLUDE (event_date) REPLACE (date_trunc('second', event_timestamp) AS event_timestamp)
        FROM raw_events
    """,
    "csv_to_table": """
        SELECT * EXCLUDE (event_date) REPLACE (date_trunc('second', event_timestamp) AS event_timestamp)
        FROM raw_events
    """,
    "clustered_recent_events": _RECENT,
    "country_purchase_rate_by_day_table": _COUNTRY_RATE,
    "clean_events": """
        , written AS (
            SELECT event_id, CASE WHEN event_id % 50 = 1 THEN 2 ELSE 1 END AS copies,
                   CASE WHEN event_id % 97 = 5 THEN 'user_id: not a bigint'
                        WHEN event_id % 89 = 7 THEN 'event_timestamp: no value in a required column'
                        WHEN event_id % 83 = 3 THEN 'country: text longer than 2' END AS reason
            FROM raw_events
        )
        SELECT 'accepted' AS outcome, count(*) AS records, sum(event_id)::BIGINT AS event_ids
        FROM written WHERE reason IS NULL
        UNION ALL SELECT 'event_id: repeated', count(*), sum(event_id)::BIGINT
        FROM written WHERE reason IS NULL AND copies = 2
        UNION ALL SELECT reason, sum(copies)::BIGINT, sum(copies * event_id)::BIGINT
        FROM written WHERE reason IS NOT NULL GROUP BY reason
    """,
    # All events are counted; the second load touches the late days and those from 23 January on.
    "nightly_daily": """
        SELECT *, CASE WHEN event_date > DATE '2024-01-22' OR event_date IN (
                       SELECT event_date FROM raw_events WHERE event_id % 50 = 0
                       AND event_date BETWEEN DATE '2024-01-08' AND DATE '2024-01-12')
                  THEN 2 ELSE 1 END::BIGINT AS last_load
        FROM daily
    """,
    "nightly_weekly": _WEEKLY,
    "nightly_active_users": """
        SELECT user_id, max(event_date) AS last_active, count(*) AS event_count FROM raw_events
        WHERE event_date > (SELECT max(event_date) FROM raw_events) - 30 GROUP BY user_id
    """,
    "gap_sessions": f"{_GAP_SESSIONS} SELECT * FROM gap_sessions",
    "session_summary": f"""
        {_GAP_SESSIONS}, days AS (
            SELECT session_start::DATE AS session_date, count(*) AS session_count,
                   count(DISTINCT user_id) AS user_count, sum(event_count)::BIGINT AS event_count,
                   count(*) FILTER (event_count = 1) AS single_event_sessions,
                   sum(duration_seconds)::BIGINT AS seconds, max(duration_seconds) AS longest_seconds
            FROM gap_sessions GROUP BY session_date
        )
        SELECT * EXCLUDE (seconds), {_half_up("event_count", "session_count", 2)} AS events_per_session,
               {_half_up("seconds", "session_count", 2)} AS avg_seconds
        FROM days
    """,
    "funnel_report": """
        , clicked AS (
            SELECT DISTINCT v.user_id, v.event_timestamp AS viewed_at, c.event_timestamp AS clicked_at
            FROM raw_events v JOIN raw_events c ON c.user_id = v.user_id
             AND c.event_timestamp > v.event_timestamp
             AND c.event_timestamp <= v.event_timestamp + INTERVAL 3 DAY
            WHERE v.event_type = 'page_view' AND c.event_type = 'click'
        ), bought AS (
            SELECT DISTINCT c.user_id FROM clicked c JOIN raw_events p ON p.user_id = c.user_id
             AND p.event_timestamp > c.clicked_at AND p.event_timestamp <= c.viewed_at + INTERVAL 3 DAY
            WHERE p.event_type = 'purchase'
        ), active AS (
            SELECT user_id, bool_or(event_type = 'page_view') AS viewed FROM raw_events
            WHERE event_type IN ('page_view', 'click', 'purchase') GROUP BY user_id
        )
        SELECT u.country, count(*) FILTER (viewed) AS viewed_users,
               count(*) FILTER (user_id IN (SELECT user_id FROM clicked)) AS clicked_users,
               count(*) FILTER (user_id IN (SELECT user_id FROM bought)) AS bought_users
        FROM active JOIN users u USING (user_id) GROUP BY u.country
    """,
    "monthly_kpi": f"""
        {_HOME_EVENTS}, months AS (
            SELECT date_trunc('month', event_date)::DATE AS month_start, country,
                   count(*) AS event_count, count(*) FILTER (event_type = 'purchase') AS purchase_count,
                   count(DISTINCT user_id) AS active_users
            FROM home GROUP BY month_start, country
        )
        SELECT *, {_half_up("purchase_count", "active_users", 4)} AS purchase_rate FROM months
    """,
    "period_users": f"""
        {_HOME_EVENTS}, periods AS (
            SELECT 'day' AS period, event_date AS period_start, user_id FROM home
            UNION ALL SELECT 'week', date_trunc('week', event_date)::DATE, user_id FROM home
            UNION ALL SELECT 'month', date_trunc('month', event_date)::DATE, user_id FROM home
        )
        SELECT period, period_start, count(*) AS event_count, count(DISTINCT user_id) AS active_users
        FROM periods GROUP BY period, period_start
    """,
    "active_users": """
        , days AS (
            SELECT unnest(range(min(event_date), max(event_date) + 1, INTERVAL 1 DAY))::DATE AS day
            FROM raw_events
        )
        SELECT day AS event_date, w::INT AS window_days, count(DISTINCT user_id) AS active_users
        FROM days, (VALUES (1), (7), (30)) AS t(w)
        LEFT JOIN raw_events e ON e.event_date <= day AND e.event_date > day - w
        GROUP BY day, w
    """,
    "retention": f"""
        , user_weeks AS (
            SELECT DISTINCT user_id, date_trunc('week', event_date)::DATE AS week FROM raw_events
        ), firsts AS (
            SELECT user_id, min(week) AS cohort_week, max(week) AS last_week FROM user_weeks GROUP BY user_id
        ), cohorts AS (
            SELECT cohort_week, count(*) AS cohort_size FROM firsts GROUP BY cohort_week
        ), grid AS (
            SELECT cohort_week, cohort_size, unnest(range(
                (SELECT (max(week) - cohort_week) // 7 + 1 FROM user_weeks)))::INT AS week_no
            FROM cohorts
        ), members AS (
            SELECT g.*, f.user_id, f.last_week,
                   w.user_id IS NOT NULL AS is_active, b.user_id IS NOT NULL AS was_active
            FROM grid g JOIN firsts f USING (cohort_week)
            LEFT JOIN user_weeks w ON w.user_id = f.user_id AND w.week = cohort_week + 7 * week_no
            LEFT JOIN user_weeks b ON b.user_id = f.user_id AND b.week = cohort_week + 7 * week_no - 7
        ), counted AS (
            SELECT cohort_week, week_no, cohort_size, count(*) FILTER (is_active) AS active_users,
                   count(*) FILTER (is_active AND NOT was_active AND week_no > 0) AS returned_users,
                   count(*) FILTER (last_week < cohort_week + 7 * week_no) AS churned_users
            FROM members GROUP BY cohort_week, week_no, cohort_size
        )
        SELECT *, {_half_up("active_users", "cohort_size", 4)} AS retention FROM counted
    """,
    "dashboard": f"""
        , home AS (
            SELECT e.event_date, e.event_type, e.user_id, u.country, u.plan_type
            FROM raw_events e JOIN users u USING (user_id)
        ), levels AS (
            SELECT CASE WHEN grouping(event_date) = 0 THEN 'day' WHEN grouping(country) = 0 THEN 'country'
                        WHEN grouping(plan_type) = 0 THEN 'plan' ELSE 'total' END AS level,
                   event_date, country, plan_type, count(*) AS event_count,
                   count(*) FILTER (event_type = 'purchase') AS purchase_count,
                   count(DISTINCT user_id) AS active_users
            FROM home GROUP BY GROUPING SETS ((event_date), (country), (plan_type), ())
        )
        SELECT *, {_half_up("purchase_count", "active_users", 4)} AS purchase_rate FROM levels
    """,
    "week_over_week": f"""
        {_HOME_EVENTS}, weeks AS (
            SELECT unnest(range(date_trunc('week', min(event_date))::DATE,
                                max(event_date) + 1, INTERVAL 7 DAY))::DATE AS week_start FROM home
        ), filled AS (
            SELECT w.week_start, c.country, count(h.user_id) AS event_count,
                   count(DISTINCT h.user_id) AS active_users
            FROM weeks w CROSS JOIN (SELECT DISTINCT country FROM home) c
            LEFT JOIN home h ON h.country = c.country AND date_trunc('week', h.event_date)::DATE = w.week_start
            GROUP BY w.week_start, c.country
        ), compared AS (
            SELECT *, lag(event_count) OVER (PARTITION BY country ORDER BY week_start) AS previous_count
            FROM filled
        )
        SELECT *, event_count - previous_count AS change,
               CASE WHEN previous_count > 0 THEN sign(event_count - previous_count)
                    * {_half_up("abs(event_count - previous_count)", "previous_count", 4)} END AS change_rate
        FROM compared
    """,
}

ORACLE_SQL: dict[str, str] = {name: _TABLES + sql for name, sql in _STATEMENTS.items()}
