"""DuckDB SQL for each registered query (the correctness oracle).

Tables are the driver's views. Times are returned as epoch microseconds or
text, doubles rounded, counts as BIGINT, so both engines hash alike.
"""

from __future__ import annotations

from .adapters import PAGE_OF_TYPE


def _page_case() -> str:
    arms = " ".join(f"WHEN '{t}' THEN '{p}'" for t, p in PAGE_OF_TYPE)
    return f"CASE event_type {arms} END"


def pv_cte(gap_s: int = 1800, neighbours: bool = False) -> str:
    """The page-view adapter + sessions (+ in-session neighbours) as CTEs
    ending in a relation named ``pv``."""
    gap_us = gap_s * 1_000_000
    sql = f"""
pv0 AS (
  SELECT event_id, ts, user_id, event_type,
    {_page_case()} AS page,
    CASE WHEN event_type = 'click' AND k % 2 = 0 THEN 307 ELSE 200 END AS status,
    CASE WHEN event_type IN ('view', 'click') THEN 'GET' ELSE 'PUT' END AS method,
    CASE WHEN k % 3 = 0 THEN 'Logged Out' ELSE 'Logged In' END AS auth,
    CASE WHEN k % 2 = 1 THEN 'paid' ELSE 'free' END AS level,
    value AS duration,
    CASE WHEN user_id % 2 = 0 THEN 'control' ELSE 'test' END AS tag
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
),
pv1 AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS _p FROM pv0),
pv2 AS (SELECT *, CASE WHEN _p IS NULL OR epoch_us(ts) - epoch_us(_p) > {gap_us}
                       THEN 1 ELSE 0 END AS _new FROM pv1),
pv3 AS (SELECT *, sum(_new) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                  ROWS UNBOUNDED PRECEDING) AS _sn FROM pv2),
pvs AS (SELECT * EXCLUDE (_p, _new, _sn),
          first_value(event_id) OVER (PARTITION BY user_id, _sn ORDER BY ts, event_id) AS session_id,
          CAST(row_number() OVER (PARTITION BY user_id, _sn ORDER BY ts, event_id) - 1 AS INTEGER)
            AS item_in_session
        FROM pv3)"""
    if not neighbours:
        return sql + ",\npv AS (SELECT * FROM pvs)"
    return sql + """,
pvn AS (SELECT *, lag(ts) OVER s AS prev_ts, lead(ts) OVER s AS next_ts,
               lead(page) OVER s AS next_page, lag(page) OVER s AS _lp
        FROM pvs WINDOW s AS (PARTITION BY session_id ORDER BY ts, event_id)),
pv AS (SELECT * EXCLUDE (_lp),
         last_value(CASE WHEN NOT (status BETWEEN 300 AND 398) THEN _lp END IGNORE NULLS)
           OVER (PARTITION BY session_id ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS previous_page
       FROM pvn)"""


def _win(seconds: int, inner: str, extra_cols: str = "", group_extra: str = "",
         agg: str = "count(*) AS count") -> str:
    s_us = seconds * 1_000_000
    return f"""
SELECT strftime(make_timestamp(ws * {s_us}), '%Y-%m-%d %H:%M:%S') AS timestamp_minute,
       CAST(ws * {seconds} AS BIGINT) AS unix_timestamp{extra_cols}, {agg}
FROM ({inner}) GROUP BY ws{group_extra}"""


HOUR = 3600

SQL: dict[str, str] = {}

SQL["sliding_count"] = _win(
    10, "SELECT epoch_us(ts) // 10000000 - r.k AS ws FROM events, range(6) r(k)")
SQL["tumbling_count"] = _win(30, "SELECT epoch_us(ts) // 30000000 AS ws FROM events")
SQL["window_by_key"] = _win(
    60, "SELECT epoch_us(ts) // 60000000 AS ws, event_type FROM events",
    ", event_type", ", event_type")
SQL["distinct_users_window"] = _win(
    HOUR, "SELECT epoch_us(ts) // 3600000000 AS ws, user_id FROM events",
    agg="count(DISTINCT user_id) AS users")
SQL["approx_users_window"] = _win(
    HOUR, "SELECT epoch_us(ts) // 3600000000 AS ws, user_id FROM events",
    agg="count(DISTINCT user_id) AS users_exact, true AS approx_ok")

SQL["ordered_windows"] = _win(HOUR, "SELECT epoch_us(ts) // 3600000000 AS ws FROM events")

SQL["date_parts"] = """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS date, CAST(month(ts) AS BIGINT) AS month,
       CAST(year(ts) AS BIGINT) AS year, CAST(hour(ts) AS BIGINT) AS hour,
       CAST(minute(ts) AS BIGINT) AS minute, CAST(second(ts) AS BIGINT) AS second
FROM events"""

SQL["decode_events"] = f"""
WITH {pv_cte()}
SELECT strftime(make_timestamp((epoch_us(ts) // 1000) * 1000), '%Y-%m-%d %H:%M:%S.%g') AS ts_timestamp,
       epoch_us(ts) // 1000 AS ts, CAST(session_id AS BIGINT) AS sessionid, page, auth, method,
       CAST(status AS INTEGER) AS status, level, CAST(item_in_session AS INTEGER) AS iteminsession,
       CAST(NULL AS VARCHAR) AS city, CAST(user_id AS BIGINT) AS userid, duration, tag,
       'page_view_events' AS topic, CAST(user_id % 5 AS INTEGER) AS partition, event_id AS offset
FROM pv"""

SQL["listens"] = f"""
WITH {pv_cte()}
SELECT event_id, epoch_us(ts) AS ts_us, session_id, item_in_session, auth, level, user_id,
       duration, tag
FROM pv WHERE page = 'NextSong'"""

SQL["status_changes"] = f"""
WITH {pv_cte()}
SELECT event_id, epoch_us(ts) AS ts_us, session_id, item_in_session, auth, level, user_id, tag
FROM pv WHERE page IN ('Submit Downgrade', 'Submit Upgrade')"""

SQL["auth_attempts"] = f"""
WITH {pv_cte(neighbours=True)}
SELECT event_id, epoch_us(ts) AS ts_us, session_id, item_in_session, level, user_id, tag,
       auth = 'Logged In' AS success
FROM pv WHERE previous_page = 'Login'"""

SQL["previous_page"] = f"""
WITH {pv_cte(12 * HOUR, neighbours=True)}
SELECT event_id, session_id, page, status, previous_page FROM pv"""

SQL["item_numbers"] = f"""
WITH {pv_cte(12 * HOUR)}
SELECT event_id, session_id, item_in_session FROM pv"""

SQL["sessionize"] = f"""
WITH {pv_cte()}
SELECT event_id, user_id, session_id, item_in_session FROM pv"""

SQL["session_summary"] = f"""
WITH {pv_cte(12 * HOUR)}
SELECT session_id, user_id, epoch_us(min(ts)) AS session_start, epoch_us(max(ts)) AS session_end,
       count(*) AS n_events, arg_max(page, (ts, event_id)) AS last_page,
       arg_max(level, (ts, event_id)) AS last_level,
       round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0, 6) AS duration_s
FROM pv GROUP BY session_id, user_id"""

SQL["transition_matrix"] = f"""
WITH {pv_cte(12 * HOUR, neighbours=True)},
e AS (SELECT page AS source, coalesce(next_page, '(end)') AS dest, count(*) AS n
      FROM pv GROUP BY 1, 2)
SELECT source, dest, n, round(n / sum(n) OVER (PARTITION BY source), 9) AS p FROM e"""

SQL["event_gaps"] = f"""
WITH {pv_cte(12 * HOUR, neighbours=True)}
SELECT user_id, round(avg((epoch_us(ts) - epoch_us(prev_ts)) / 1000000.0), 3) AS mean_event_gap_s,
       count(*) AS n_gaps
FROM pv WHERE prev_ts IS NOT NULL GROUP BY user_id"""

SQL["session_gaps"] = f"""
WITH {pv_cte()},
s AS (SELECT session_id, user_id, min(ts) AS st, max(ts) AS en FROM pv GROUP BY 1, 2),
g AS (SELECT user_id, st, lag(en) OVER (PARTITION BY user_id ORDER BY st, session_id) AS pe FROM s)
SELECT user_id, round(avg((epoch_us(st) - epoch_us(pe)) / 1000000.0), 3) AS mean_session_gap_s,
       count(*) AS n_gaps
FROM g WHERE pe IS NOT NULL GROUP BY user_id"""

SQL["play_through"] = f"""
WITH {pv_cte(12 * HOUR, neighbours=True)}
SELECT event_id, session_id,
       CASE WHEN next_ts IS NULL THEN NULL
            ELSE epoch_us(next_ts) >= epoch_us(ts) + CAST(floor(duration) AS BIGINT) * 1000000
       END AS played_through
FROM pv WHERE page = 'NextSong'"""

SQL["hourly_profile"] = """
SELECT CAST(hour(ts) AS BIGINT) AS hour, count(*) AS n_events FROM events GROUP BY 1"""

SQL["weekday_class"] = """
WITH c AS (SELECT ts, CASE WHEN strftime(ts, '%m-%d') IN ('01-01', '07-04', '12-25') THEN 'holiday'
                           WHEN dayofweek(ts) IN (0, 6) THEN 'weekend' ELSE 'workday' END AS day_class
           FROM events)
SELECT day_class, count(*) AS n_events, count(DISTINCT CAST(ts AS DATE)) AS n_days,
       round(count(*) / count(DISTINCT CAST(ts AS DATE)), 6) AS events_per_day
FROM c GROUP BY 1"""

SQL["user_growth"] = """
WITH f AS (SELECT user_id, min(ts) AS first_ts FROM events GROUP BY 1),
d AS (SELECT strftime(first_ts, '%Y-%m-%d') AS date, count(*) AS new_users FROM f GROUP BY 1)
SELECT date, new_users,
       CAST(sum(new_users) OVER (ORDER BY date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total_users
FROM d"""

SQL["churned_users"] = f"""
WITH {pv_cte()}
SELECT user_id, arg_max(auth, (ts, event_id)) AS last_auth FROM pv GROUP BY 1
HAVING arg_max(auth, (ts, event_id)) = 'Logged Out'"""

SQL["tag_comparison"] = f"""
WITH {pv_cte()}
SELECT tag, count(DISTINCT user_id) AS users, count(*) AS events,
       count(DISTINCT session_id) AS sessions,
       round(count(*) / count(DISTINCT user_id), 6) AS events_per_user
FROM pv GROUP BY 1"""

SQL["level_changes"] = f"""
WITH {pv_cte()}
SELECT strftime(ts, '%Y-%m-%d') AS date,
       CAST(sum(CASE WHEN page = 'Submit Upgrade' THEN 1 ELSE 0 END) AS BIGINT) AS upgrades,
       CAST(sum(CASE WHEN page = 'Submit Downgrade' THEN 1 ELSE 0 END) AS BIGINT) AS downgrades
FROM pv WHERE page IN ('Submit Upgrade', 'Submit Downgrade') GROUP BY 1"""

SQL["mask_users"] = f"""
WITH {pv_cte()}
SELECT event_id, auth, CASE WHEN auth = 'Logged In' THEN user_id END AS user_id,
       CASE WHEN auth = 'Logged In' THEN tag END AS tag
FROM pv"""

SQL["tagged_users"] = f"""
WITH {pv_cte()}
SELECT event_id, CASE WHEN auth = 'Logged In' THEN
         CASE WHEN user_id % 2 = 0 THEN 'even' ELSE 'odd' END END AS tag
FROM pv"""

SQL["clean_fields"] = """
SELECT p_partkey, p_brand || '     ' || replace(p_name, chr(9), '     ') AS name FROM part"""

SQL["time_range"] = """
SELECT event_id, epoch_us(ts) AS ts_us, event_type FROM events
WHERE ts > TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'"""

SQL["retain_days"] = """
SELECT event_id, epoch_us(ts) AS ts_us FROM events
WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY"""

SQL["ordered_events"] = """
SELECT event_id, epoch_us(ts) AS ts_us,
       row_number() OVER (ORDER BY ts, event_id) - 1 AS pos
FROM events"""

SQL["listen_counts"] = """
WITH c AS (SELECT 'SO' || l_partkey AS song_id, sum(CAST(l_quantity AS BIGINT)) AS plays
           FROM lineitem GROUP BY 1)
SELECT 'TR' || p_partkey AS track_id, p_brand AS artist, p_name AS title,
       CAST(p_size AS DOUBLE) * 10.0 AS duration, c.plays AS count
FROM part JOIN c ON c.song_id = 'SO' || p_partkey
WHERE c.plays > 0"""

SQL["similar_pairs"] = """
WITH src AS (SELECT l_orderkey, arg_min(l_partkey, (l_linenumber, l_partkey)) AS src_part,
                    min(l_linenumber) AS first_line
             FROM lineitem GROUP BY 1)
SELECT 'TR' || s.src_part AS track_id, 'TR' || l.l_partkey AS similar_id,
       l.l_quantity AS score
FROM lineitem l JOIN src s ON l.l_orderkey = s.l_orderkey
WHERE l.l_linenumber <> s.first_line"""

SQL["similar_weights"] = """
WITH src AS (SELECT l_orderkey, arg_min(l_partkey, (l_linenumber, l_partkey)) AS src_part,
                    min(l_linenumber) AS first_line
             FROM lineitem GROUP BY 1),
pairs AS (SELECT 'TR' || s.src_part AS track_id, 'TR' || l.l_partkey AS similar_id,
                 l.l_quantity AS score
          FROM lineitem l JOIN src s ON l.l_orderkey = s.l_orderkey
          WHERE l.l_linenumber <> s.first_line),
c AS (SELECT 'TR' || l_partkey AS similar_id, sum(CAST(l_quantity AS BIGINT)) AS weight
      FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
j AS (SELECT pairs.*, c.weight FROM pairs JOIN c USING (similar_id))
SELECT track_id, similar_id, score, weight,
       sum(weight) OVER (PARTITION BY track_id) AS total_weight
FROM j"""

SQL["geo_dimension"] = """
WITH g AS (SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip, count(*) AS population,
                  round(avg(c_acctbal), 6) AS lat
           FROM customer GROUP BY 1),
p AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 5, '0') AS zip, lower(n_name) AS city,
             r_name AS state
      FROM nation JOIN region ON n_regionkey = r_regionkey)
SELECT g.zip, g.population, g.lat, p.city, p.state FROM g JOIN p USING (zip)"""

SQL["prefix_weights"] = """
SELECT p_partkey,
       coalesce(sum(CAST(p_size AS BIGINT)) OVER (ORDER BY p_partkey
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo,
       sum(CAST(p_size AS BIGINT)) OVER (ORDER BY p_partkey ROWS UNBOUNDED PRECEDING) AS hi
FROM part"""

SQL["weighted_pick"] = f"""
WITH r AS ({SQL["prefix_weights"]}),
k AS (SELECT c_custkey, (c_custkey * 7919) % (SELECT sum(CAST(p_size AS BIGINT)) FROM part) AS k
      FROM customer)
SELECT c_custkey, p_partkey FROM k JOIN r ON k.k >= r.lo AND k.k < r.hi"""

SQL["next_track"] = f"""
WITH c AS ({SQL["listen_counts"]}),
pairs AS (SELECT DISTINCT track_id, similar_id FROM ({SQL["similar_pairs"]})),
w AS (SELECT p.track_id, p.similar_id AS next_track, c.count AS weight,
             CAST(substr(p.similar_id, 3) AS BIGINT) AS ok
      FROM pairs p JOIN c ON c.track_id = p.similar_id),
r AS (SELECT track_id, next_track,
             coalesce(sum(weight) OVER (PARTITION BY track_id ORDER BY ok
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo,
             sum(weight) OVER (PARTITION BY track_id ORDER BY ok ROWS UNBOUNDED PRECEDING) AS hi,
             sum(weight) OVER (PARTITION BY track_id) AS tot
      FROM w),
t AS (SELECT DISTINCT track_id, tot FROM r),
g AS (SELECT track_id AS next_track,
             coalesce(sum(count) OVER (ORDER BY CAST(substr(track_id, 3) AS BIGINT)
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lo,
             sum(count) OVER (ORDER BY CAST(substr(track_id, 3) AS BIGINT)
                      ROWS UNBOUNDED PRECEDING) AS hi
      FROM c),
req AS (SELECT l_orderkey, l_linenumber, l_partkey, 'TR' || l_partkey AS track_id,
               l_orderkey * 7919 + l_linenumber * 31 + l_partkey AS key FROM lineitem),
a AS (SELECT req.*, t.tot FROM req LEFT JOIN t USING (track_id))
SELECT a.l_orderkey, a.l_linenumber, a.track_id, r.next_track
FROM a JOIN r ON r.track_id = a.track_id AND a.key % a.tot >= r.lo AND a.key % a.tot < r.hi
WHERE a.tot IS NOT NULL
UNION ALL
SELECT a.l_orderkey, a.l_linenumber, a.track_id, g.next_track
FROM a JOIN g ON a.key % (SELECT sum(count) FROM c) >= g.lo
             AND a.key % (SELECT sum(count) FROM c) < g.hi
WHERE a.tot IS NULL"""

SQL["decode_all_topics"] = f"""
WITH {pv_cte(neighbours=True)},
t AS (
  SELECT 'page_view_events' AS topic, * FROM pv
  UNION ALL SELECT 'listen_events', * FROM pv WHERE page = 'NextSong'
  UNION ALL SELECT 'status_change_events', * FROM pv
            WHERE page IN ('Submit Downgrade', 'Submit Upgrade')
  UNION ALL SELECT 'auth_events', * FROM pv WHERE previous_page = 'Login')
SELECT topic, count(*) AS n_rows, count(DISTINCT session_id) AS n_sessions,
       CAST(max(item_in_session) AS BIGINT) AS max_item, count(user_id) AS n_with_user
FROM t GROUP BY topic"""

SQL["transition_matrix_closed"] = f"""
WITH {pv_cte(12 * HOUR, neighbours=True)},
closed AS (SELECT session_id FROM pv GROUP BY session_id
           HAVING epoch_us(max(ts)) + {12 * HOUR * 1_000_000}
                  <= (SELECT epoch_us(max(ts)) FROM events)),
e AS (SELECT page AS source, coalesce(next_page, '(end)') AS dest, count(*) AS n
      FROM pv WHERE session_id IN (SELECT session_id FROM closed) GROUP BY 1, 2)
SELECT source, dest, n, round(n / sum(n) OVER (PARTITION BY source), 9) AS p FROM e"""
