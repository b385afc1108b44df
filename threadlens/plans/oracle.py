"""Reference SQL (DuckDB dialect) for every SQL-expressible query.

Used by the correctness gate: the driver runs the Spark query and this SQL
on the same parquet tables and compares rows, schema and values.  The
prelude rebuilds the feeds of ``threadlens.sources.adapters`` and the layers
of ``threadlens.plans.layers`` in plain SQL; each query appends its SELECT.
"""

from __future__ import annotations

PRELUDE = r"""
WITH
ev AS (
  SELECT *, concat('t', CAST(user_id * 4 + event_id % 4 AS VARCHAR)) AS thread_id FROM events
),
deliv AS (
  SELECT thread_id, event_id, ts, user_id, event_type, 0 AS d FROM ev
  UNION ALL
  SELECT thread_id, event_id, ts, user_id, event_type, 1 AS d FROM ev WHERE event_id % 50 = 0
),
bronze AS (
  SELECT thread_id,
    event_type AS checkpoint_ns,
    concat('c', CAST(event_id AS VARCHAR)) AS checkpoint_id,
    CASE WHEN event_id < 4 THEN NULL ELSE concat('c', CAST(event_id - 4 AS VARCHAR)) END AS parent_checkpoint_id,
    'checkpoint' AS type,
    CASE WHEN event_id % 97 = 0 THEN '{"v":'
         ELSE concat('{"v":"4","id":"c', CAST(event_id AS VARCHAR), '","ts":"',
                     strftime(ts, '%Y-%m-%d %H:%M:%S.%f'),
                     '","channel_versions":{"__start__":"', CAST(event_id % 7 AS VARCHAR), '"}}') END AS checkpoint,
    CASE WHEN event_id % 41 = 0 THEN NULL
         ELSE concat('{"step":"', CAST(event_id % 20 AS VARCHAR), '","source":"', event_type, '"}') END AS metadata,
    CASE WHEN event_id % 13 = 0 THEN concat('{"user_id":"', CAST(user_id AS VARCHAR), '"}') END AS _rescued_data,
    ts + (event_id % 600 + d * 3600) * INTERVAL '1' SECOND AS ingested_at
  FROM deliv
),
raw_lookup AS (
  SELECT user_id * 4 + event_id % 4 AS thread_id, user_id,
    concat('team_', CAST((user_id + CAST(floor(event_id / 2500) AS BIGINT)) % 5 AS VARCHAR)) AS team,
    ts, event_id
  FROM events WHERE user_id % 11 <> 0
),
feed AS (
  SELECT concat('t', CAST(thread_id AS VARCHAR)) AS thread_id, concat('u', CAST(user_id AS VARCHAR)) AS user_id,
    team, ts AS updated_at, event_id
  FROM raw_lookup
),
hist_all AS (
  SELECT thread_id, user_id, team, updated_at, updated_at AS __START_AT,
    lead(updated_at) OVER (PARTITION BY thread_id ORDER BY updated_at, event_id) AS __END_AT
  FROM feed
),
chg AS (
  SELECT thread_id, user_id, team, updated_at, event_id FROM (
    SELECT *, row_number() OVER w AS rn, lag(user_id) OVER w AS pu, lag(team) OVER w AS pt
    FROM feed WINDOW w AS (PARTITION BY thread_id ORDER BY updated_at, event_id)) z
  WHERE rn = 1 OR pu IS DISTINCT FROM user_id OR pt IS DISTINCT FROM team
),
hist AS (
  SELECT thread_id, user_id, team, updated_at, updated_at AS __START_AT,
    lead(updated_at) OVER (PARTITION BY thread_id ORDER BY updated_at, event_id) AS __END_AT
  FROM chg
),
cur AS (SELECT thread_id, user_id, team FROM hist WHERE __END_AT IS NULL),
parsed AS (
  SELECT thread_id, checkpoint_ns, checkpoint_id, parent_checkpoint_id, type,
    CASE WHEN json_valid(checkpoint) THEN checkpoint END AS cpj,
    CASE WHEN json_valid(metadata) THEN metadata END AS mdj
  FROM bronze
),
fields AS (
  SELECT thread_id, checkpoint_ns, checkpoint_id, parent_checkpoint_id, type,
    TRY_CAST(json_extract_string(cpj, '$.ts') AS TIMESTAMP) AS checkpoint_ts,
    TRY_CAST(json_extract_string(cpj, '$.v') AS INTEGER) AS checkpoint_v,
    json_extract_string(cpj, '$.id') AS checkpoint_id_parsed,
    TRY_CAST(json_extract_string(mdj, '$.step') AS INTEGER) AS metadata_step_int,
    json_extract_string(mdj, '$.source') AS metadata_source,
    json_extract_string(cpj, '$.channel_versions.__start__') AS channel_versions_start
  FROM parsed
),
silver_all AS (
  SELECT f.thread_id, checkpoint_ns, checkpoint_id, parent_checkpoint_id, type, checkpoint_ts,
    CAST(checkpoint_ts AS DATE) AS checkpoint_date,
    date_trunc('hour', checkpoint_ts) AS checkpoint_hour,
    checkpoint_v, checkpoint_id_parsed, metadata_step_int, metadata_source, channel_versions_start,
    c.user_id, c.team
  FROM fields f LEFT JOIN cur c ON f.thread_id = c.thread_id
),
silver AS (SELECT * FROM silver_all WHERE checkpoint_ts IS NOT NULL),
gold_user AS (
  SELECT checkpoint_date, user_id, team,
    count(*) AS checkpoint_count,
    count(DISTINCT thread_id) AS thread_count,
    count(DISTINCT checkpoint_id_parsed) AS unique_checkpoints,
    min(checkpoint_ts) AS first_checkpoint_ts, max(checkpoint_ts) AS last_checkpoint_ts,
    min(metadata_step_int) AS min_step, max(metadata_step_int) AS max_step,
    avg(metadata_step_int) AS avg_step
  FROM silver GROUP BY checkpoint_date, user_id, team
  HAVING checkpoint_date IS NOT NULL AND user_id IS NOT NULL AND team IS NOT NULL
),
gold_team AS (
  SELECT team, checkpoint_date,
    count(*) AS checkpoint_count,
    count(DISTINCT user_id) AS user_count,
    count(DISTINCT thread_id) AS thread_count,
    count(DISTINCT checkpoint_id_parsed) AS unique_checkpoints,
    min(checkpoint_ts) AS first_checkpoint_ts, max(checkpoint_ts) AS last_checkpoint_ts,
    min(metadata_step_int) AS min_step, max(metadata_step_int) AS max_step,
    avg(metadata_step_int) AS avg_step
  FROM silver GROUP BY team, checkpoint_date
  HAVING checkpoint_date IS NOT NULL AND team IS NOT NULL
),
newest AS (SELECT max(checkpoint_date) AS d FROM silver),
orders_chg AS (
  SELECT o_custkey, o_orderstatus, o_orderdate, o_orderkey FROM (
    SELECT o_custkey, o_orderstatus, o_orderdate, o_orderkey,
      row_number() OVER w AS rn, lag(o_orderstatus) OVER w AS ps
    FROM orders WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)) z
  WHERE rn = 1 OR ps IS DISTINCT FROM o_orderstatus
)
"""


def _dup_list(col: str, distinct: bool) -> str:
    item = f"""'"' || {col} || '"'"""
    d = "DISTINCT " if distinct else ""
    return f"'[' || coalesce(string_agg({d}{item}, ',' ORDER BY {item}), '') || ']'"


_DUP_BRONZE = """
  SELECT 'bronze_checkpoints' AS table_name, thread_id, checkpoint_ns, checkpoint_id,
    CAST(NULL AS VARCHAR) AS user_ids, CAST(NULL AS VARCHAR) AS teams,
    count(*) AS duplicate_count, min(ingested_at) AS first_seen, max(ingested_at) AS last_seen
  FROM bronze GROUP BY thread_id, checkpoint_ns, checkpoint_id HAVING count(*) > 1
"""

_DUP_LOOKUP = f"""
  SELECT 'silver_thread_lookup_history' AS table_name, thread_id,
    CAST(NULL AS VARCHAR) AS checkpoint_ns, CAST(NULL AS VARCHAR) AS checkpoint_id,
    {_dup_list('user_id', False)} AS user_ids, {_dup_list('team', False)} AS teams,
    count(*) AS duplicate_count, min(updated_at) AS first_seen, max(updated_at) AS last_seen
  FROM {{src}} GROUP BY thread_id HAVING count(*) > 1
"""

_DUP_SILVER = f"""
  SELECT 'silver_checkpoints' AS table_name, thread_id, checkpoint_ns, checkpoint_id,
    {_dup_list('user_id', True)} AS user_ids, {_dup_list('team', True)} AS teams,
    count(*) AS duplicate_count, min(checkpoint_ts) AS first_seen, max(checkpoint_ts) AS last_seen
  FROM silver GROUP BY thread_id, checkpoint_ns, checkpoint_id HAVING count(*) > 1
"""


def _null_arm(table: str, src: str, col: str) -> str:
    return f"""
  SELECT '{table}' AS table_name, '{col}' AS column_name,
    CASE WHEN count(*) > 0 THEN round(100.0 * CAST(count(*) FILTER (WHERE {col} IS NULL) AS DOUBLE) / count(*), 2) END AS null_percentage,
    count(*) AS total_records
  FROM {src}"""


_NULL_ARMS = (
    [("bronze_checkpoints", "bronze", c) for c in ["thread_id", "checkpoint_id", "checkpoint_ns", "type", "metadata"]]
    + [("silver_thread_lookup_history", "hist", c) for c in ["thread_id", "user_id", "team"]]
    + [("silver_checkpoints", "silver", c)
       for c in ["checkpoint_ts", "user_id", "team", "metadata_step_int", "metadata_source"]]
)

_LAG = """
lagged AS (
  SELECT CAST(s.checkpoint_ts AS DATE) AS event_date,
    CAST(floor(epoch(b.ingested_at)) AS BIGINT) - CAST(floor(epoch(s.checkpoint_ts)) AS BIGINT) AS lag_s
  FROM silver s JOIN bronze b
    ON s.thread_id = b.thread_id AND s.checkpoint_ns = b.checkpoint_ns AND s.checkpoint_id = b.checkpoint_id
  WHERE s.checkpoint_ts IS NOT NULL
),
ranked AS (
  SELECT event_date, lag_s, lag_s / 60 AS lag_m,
    row_number() OVER (PARTITION BY event_date ORDER BY lag_s) AS rn,
    count(*) OVER (PARTITION BY event_date) AS n
  FROM lagged
)
SELECT event_date, count(*) AS record_count,
  round(avg(lag_s) / 60, 2) AS avg_lag_minutes,
  round(min(lag_s) / 60, 2) AS min_lag_minutes,
  round(max(lag_s) / 60, 2) AS max_lag_minutes,
  round(min(lag_m) FILTER (WHERE rn >= ceil(0.5 * n)), 2) AS median_lag_minutes,
  round(min(lag_m) FILTER (WHERE rn >= ceil(0.95 * n)), 2) AS p95_lag_minutes
FROM ranked GROUP BY event_date
"""

_CHECKS = """
SELECT 'history_threads_within_feed' AS "check",
  CAST((SELECT count(DISTINCT thread_id) FROM hist) AS DOUBLE) AS observed,
  CAST((SELECT count(DISTINCT thread_id) FROM feed) AS DOUBLE) AS threshold,
  (SELECT count(DISTINCT thread_id) FROM hist) <= (SELECT count(DISTINCT thread_id) FROM feed) AS passed
UNION ALL
SELECT 'orphan_thread_ratio', r, 0.5, coalesce(r < 0.5, true) FROM (
  SELECT CAST(count(*) FILTER (WHERE c.thread_id IS NULL) AS DOUBLE) / nullif(count(*), 0) AS r
  FROM (SELECT DISTINCT thread_id FROM silver) t LEFT JOIN (SELECT DISTINCT thread_id FROM cur) c
    ON t.thread_id = c.thread_id)
UNION ALL
SELECT 'gold_sum_equals_silver_rows', g, s, g = s FROM (
  SELECT CAST((SELECT coalesce(sum(checkpoint_count), 0) FROM gold_user) AS DOUBLE) AS g,
         CAST((SELECT count(*) FROM silver WHERE checkpoint_date IS NOT NULL AND user_id IS NOT NULL
               AND team IS NOT NULL) AS DOUBLE) AS s)
UNION ALL
SELECT 'null_thread_ids', CAST(count(*) FILTER (WHERE thread_id IS NULL) AS DOUBLE), 0.0,
  count(*) FILTER (WHERE thread_id IS NULL) = 0 FROM silver
UNION ALL
SELECT 'null_user_ratio', r, 0.2, coalesce(r < 0.2, true) FROM (
  SELECT CAST(count(*) FILTER (WHERE user_id IS NULL) AS DOUBLE) / nullif(count(*), 0) AS r FROM silver)
UNION ALL
SELECT 'timestamps_out_of_range', CAST(n AS DOUBLE), 0.0, n = 0 FROM (
  SELECT count(*) FILTER (WHERE checkpoint_ts < TIMESTAMP '2020-01-01' OR checkpoint_ts > TIMESTAMP '2030-12-31') AS n
  FROM silver)
UNION ALL
SELECT 'nonpositive_counts', CAST(n AS DOUBLE), 0.0, n = 0 FROM (
  SELECT count(*) FILTER (WHERE checkpoint_count <= 0) AS n FROM gold_user)
UNION ALL
SELECT 'team_totals_match_user_metrics', CAST(n AS DOUBLE), 0.0, n = 0 FROM (
  SELECT count(*) FILTER (WHERE NOT coalesce(t.checkpoint_count = u.c AND t.user_count = u.u, false)) AS n
  FROM gold_team t FULL OUTER JOIN (
    SELECT team, checkpoint_date, sum(checkpoint_count) AS c, count(DISTINCT user_id) AS u
    FROM gold_user GROUP BY team, checkpoint_date) u
  ON t.team = u.team AND t.checkpoint_date = u.checkpoint_date)
UNION ALL
SELECT 'user_mapping_coverage', r, 0.8, coalesce(r >= 0.8, true) FROM (
  SELECT CAST(count(*) FILTER (WHERE user_id IS NOT NULL) AS DOUBLE) / nullif(count(*), 0) AS r
  FROM silver WHERE thread_id IS NOT NULL)
UNION ALL
SELECT 'team_coverage', r, 0.8, coalesce(r >= 0.8, true) FROM (
  SELECT CAST(count(*) FILTER (WHERE g.team IS NOT NULL) AS DOUBLE) / nullif(count(*), 0) AS r
  FROM (SELECT DISTINCT team FROM silver WHERE team IS NOT NULL) s
  LEFT JOIN (SELECT DISTINCT team FROM gold_team) g ON s.team = g.team)
UNION ALL
SELECT 'gold_counts_match_silver_detail', CAST(n AS DOUBLE), 0.0, n = 0 FROM (
  SELECT count(*) FILTER (WHERE NOT coalesce(g.checkpoint_count = d.n, false)) AS n
  FROM gold_user g FULL OUTER JOIN (
    SELECT checkpoint_date, user_id, team, count(*) AS n FROM silver
    WHERE checkpoint_date IS NOT NULL AND user_id IS NOT NULL AND team IS NOT NULL
    GROUP BY checkpoint_date, user_id, team) d
  ON g.checkpoint_date = d.checkpoint_date AND g.user_id = d.user_id AND g.team = d.team)
UNION ALL
SELECT 'first_not_after_last', CAST(n AS DOUBLE), 0.0, n = 0 FROM (
  SELECT count(*) FILTER (WHERE first_checkpoint_ts > last_checkpoint_ts) AS n FROM gold_user)
UNION ALL
SELECT 'smallest_layer_rows', CAST(m AS DOUBLE), 1.0, m >= 1 FROM (
  SELECT least((SELECT count(*) FROM bronze), (SELECT count(*) FROM silver), (SELECT count(*) FROM gold_user)) AS m)
UNION ALL
SELECT 'days_since_newest_checkpoint', CAST(n AS DOUBLE), 730.0, coalesce(n <= 730, false) FROM (
  SELECT date_diff('day', CAST(max(checkpoint_ts) AS DATE), (SELECT d FROM newest)) AS n FROM silver)
"""

_REPORT = """
SELECT 'silver_checkpoints' AS dataset, rule, condition, total, failed, total - failed AS passed,
  CASE WHEN total > 0 THEN round(CAST(failed AS DOUBLE) * 100.0 / total, 2) END AS failed_pct
FROM (
  SELECT 'checkpoint_ts_not_null' AS rule, 'checkpoint_ts IS NOT NULL' AS condition, count(*) AS total,
    count(*) FILTER (WHERE NOT coalesce(checkpoint_ts IS NOT NULL, false)) AS failed FROM silver_all
  UNION ALL
  SELECT 'valid_user_id', 'user_id IS NOT NULL', count(*),
    count(*) FILTER (WHERE user_id IS NULL) FROM silver_all
  UNION ALL
  SELECT 'valid_team', 'team IS NOT NULL', count(*),
    count(*) FILTER (WHERE team IS NULL) FROM silver_all
  UNION ALL
  SELECT 'valid_checkpoint_date', 'checkpoint_date IS NOT NULL', count(*),
    count(*) FILTER (WHERE checkpoint_date IS NULL) FROM silver_all
)
"""

_SILVER_COLS = """thread_id, checkpoint_ns, checkpoint_id, parent_checkpoint_id, type, checkpoint_ts,
  checkpoint_date, checkpoint_hour, checkpoint_v, checkpoint_id_parsed, metadata_step_int,
  metadata_source, channel_versions_start, user_id, team"""

_COLUMN_STATS_COLS = ["thread_id", "checkpoint_ns", "checkpoint_id", "parent_checkpoint_id",
                      "type", "checkpoint", "metadata", "_rescued_data"]


def _column_stats() -> str:
    arms = [
        f"""SELECT '{c}' AS column_name, count(*) AS row_count,
    count(*) FILTER (WHERE {c} IS NULL) AS null_count,
    min({c}) AS min_value, max({c}) AS max_value FROM bronze"""
        for c in _COLUMN_STATS_COLS
    ]
    return "\nUNION ALL\n".join(arms)


QUERIES_SQL: dict[str, str] = {
    "lookup_cleaned": """
SELECT CAST(thread_id AS VARCHAR) AS thread_id, CAST(user_id AS VARCHAR) AS user_id, team, ts AS updated_at
FROM raw_lookup""",
    "checkpoint_json_fields": """
SELECT thread_id, checkpoint_id, checkpoint_ts, checkpoint_v, checkpoint_id_parsed,
  metadata_step_int, metadata_source, channel_versions_start FROM fields""",
    "silver_checkpoints": f"SELECT {_SILVER_COLS} FROM silver",
    "gold_user_team_metrics": "SELECT * FROM gold_user",
    "gold_team_summary": "SELECT * FROM gold_team",
    "team_daily": """
SELECT team, checkpoint_date, sum(checkpoint_count) AS team_checkpoint_count,
  sum(thread_count) AS team_thread_count, count(DISTINCT user_id) AS team_user_count,
  max(checkpoint_date) AS latest_date
FROM gold_user GROUP BY team, checkpoint_date""",
    "scd2_history": "SELECT thread_id, user_id, team, updated_at, __START_AT, __END_AT FROM hist_all",
    "scd2_collapsed": "SELECT thread_id, user_id, team, updated_at, __START_AT, __END_AT FROM hist",
    "scd2_hot_split": "SELECT thread_id, user_id, team, updated_at, __START_AT, __END_AT FROM hist",
    "scd2_current": "SELECT thread_id, user_id, team FROM cur",
    "scd2_asof": """
SELECT thread_id, user_id, team, __START_AT, __END_AT FROM hist
WHERE __START_AT <= (SELECT CAST(max(CAST(updated_at AS DATE)) - INTERVAL 15 DAY AS TIMESTAMP) FROM feed)
  AND (__END_AT IS NULL OR (SELECT CAST(max(CAST(updated_at AS DATE)) - INTERVAL 15 DAY AS TIMESTAMP) FROM feed) < __END_AT)""",
    **dict.fromkeys(("scd2_asof_join", "scd2_asof_join_split"), """
SELECT f.thread_id, checkpoint_ns, checkpoint_id, checkpoint_ts, h.user_id, h.team
FROM fields f LEFT JOIN hist h ON f.thread_id = h.thread_id
  AND h.__START_AT <= f.checkpoint_ts AND (h.__END_AT IS NULL OR f.checkpoint_ts < h.__END_AT)"""),
    "scd2_orders_ties": """
SELECT o_custkey, o_orderstatus, o_orderdate, o_orderkey, o_orderdate AS __START_AT,
  lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS __END_AT
FROM orders_chg""",
    "thread_history": """
SELECT thread_id, user_id, team, __START_AT AS valid_from, __END_AT AS valid_to FROM hist
WHERE thread_id = (SELECT thread_id FROM hist GROUP BY thread_id ORDER BY count(*) DESC, thread_id LIMIT 1)""",
    "daily_counts": """
SELECT 'bronze_checkpoints' AS layer, CAST(ingested_at AS DATE) AS date, count(*) AS record_count
FROM bronze GROUP BY 2
UNION ALL SELECT 'silver_thread_lookup_history', CAST(updated_at AS DATE), count(*) FROM hist GROUP BY 2
UNION ALL SELECT 'silver_checkpoints', checkpoint_date, count(*) FROM silver GROUP BY 2
UNION ALL SELECT 'gold_user_team_metrics', checkpoint_date, count(*) FROM gold_user GROUP BY 2
UNION ALL SELECT 'gold_team_summary', checkpoint_date, count(*) FROM gold_team GROUP BY 2""",
    "null_profile": "\nUNION ALL".join(_null_arm(t, s, c) for t, s, c in _NULL_ARMS),
    "null_wide": """
SELECT 'silver_checkpoints' AS table_name,
  CASE WHEN count(*) > 0 THEN round(CAST(count(*) FILTER (WHERE user_id IS NULL) AS DOUBLE) * 100.0 / count(*), 2) END AS user_id_null_pct,
  CASE WHEN count(*) > 0 THEN round(CAST(count(*) FILTER (WHERE team IS NULL) AS DOUBLE) * 100.0 / count(*), 2) END AS team_null_pct
FROM silver""",
    "dup_bronze": _DUP_BRONZE,
    "dup_lookup": _DUP_LOOKUP.format(src="hist"),
    "dup_lookup_current": _DUP_LOOKUP.format(src="(SELECT * FROM hist WHERE __END_AT IS NULL)"),
    "dup_silver": _DUP_SILVER,
    "duplicates": _DUP_BRONZE + "UNION ALL" + _DUP_LOOKUP.format(src="hist") + "UNION ALL" + _DUP_SILVER,
    "processing_lag": "__LAG__",
    "volume_by_date": """
SELECT checkpoint_date, count(*) AS row_count, count(DISTINCT thread_id) AS distinct_threads
FROM silver GROUP BY checkpoint_date""",
    "user_metrics_last7": """
SELECT checkpoint_date, user_id, team, checkpoint_count, thread_count, avg_step FROM gold_user
WHERE checkpoint_date >= (SELECT d FROM newest) - INTERVAL 7 DAY""",
    "team_summary_last7": """
SELECT team, checkpoint_date, checkpoint_count, user_count, thread_count, avg_step FROM gold_team
WHERE checkpoint_date >= (SELECT d FROM newest) - INTERVAL 7 DAY""",
    "team_dashboard": """
SELECT checkpoint_date, team, user_count, thread_count, checkpoint_count,
  round(CAST(checkpoint_count AS DOUBLE) / user_count, 2) AS avg_checkpoints_per_user
FROM gold_team WHERE checkpoint_date >= (SELECT d FROM newest) - INTERVAL 30 DAY""",
    "latest_bronze": """
SELECT thread_id, checkpoint_id, type, checkpoint, metadata, ingested_at FROM bronze
ORDER BY ingested_at DESC, checkpoint_id DESC, thread_id DESC LIMIT 10""",
    "latest_lookup": """
SELECT thread_id, user_id, team, updated_at FROM hist
ORDER BY updated_at DESC, thread_id DESC LIMIT 50""",
    "latest_silver": """
SELECT thread_id, user_id, team, checkpoint_ts, checkpoint_date, checkpoint_v, metadata_step_int, metadata_source
FROM silver ORDER BY checkpoint_ts DESC, thread_id DESC, checkpoint_id DESC LIMIT 20""",
    "orphan_threads": """
SELECT DISTINCT thread_id FROM silver s
WHERE NOT EXISTS (SELECT 1 FROM cur c WHERE c.thread_id = s.thread_id)""",
    "missing_teams": """
SELECT DISTINCT team FROM silver s WHERE team IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM gold_team g WHERE g.team = s.team)""",
    "expect_lookup": "SELECT thread_id, user_id, team, updated_at FROM feed WHERE thread_id IS NOT NULL",
    "expect_silver": f"SELECT {_SILVER_COLS} FROM silver_all",
    "expect_lookup_nulls": "SELECT thread_id, user_id, team, updated_at FROM feed WHERE event_id % 17 <> 0",
    "expect_warn_counts": """
SELECT 'checkpoint_ts_not_null' AS rule, count(*) AS total, count(*) FILTER (WHERE checkpoint_ts IS NULL) AS failed
FROM silver_all""",
    "open_version_duplicates": """
SELECT thread_id, count(*) AS open_versions FROM (
  SELECT thread_id FROM cur UNION ALL SELECT thread_id FROM cur WHERE CAST(substr(user_id, 2) AS BIGINT) % 3 = 0) z
GROUP BY thread_id HAVING count(*) > 1""",
    "missing_teams_found": """
SELECT DISTINCT team FROM silver s WHERE team IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM gold_team g WHERE g.team = s.team AND g.team <> 'team_0')""",
    "expect_quarantine": f"SELECT {_SILVER_COLS} FROM silver_all WHERE checkpoint_ts IS NULL",
    "expect_report": _REPORT,
    "checks": _CHECKS,
    "conversation_checkpoints": """
SELECT thread_id, checkpoint_ns, checkpoint_id, parent_checkpoint_id, type, checkpoint_ts,
  CAST(checkpoint_ts AS DATE) AS checkpoint_date, date_trunc('hour', checkpoint_ts) AS checkpoint_hour,
  checkpoint_v, checkpoint_id_parsed, metadata_step_int, metadata_source, channel_versions_start
FROM (
  SELECT concat('conv', CAST(conv_id AS VARCHAR)) AS thread_id, role AS checkpoint_ns,
    concat('k', CAST(conv_id AS VARCHAR), '_', CAST(turn AS VARCHAR)) AS checkpoint_id,
    CAST(NULL AS VARCHAR) AS parent_checkpoint_id, 'checkpoint' AS type,
    TIMESTAMP '2024-02-01 00:00:00' + turn * INTERVAL '1' MINUTE AS checkpoint_ts,
    1 AS checkpoint_v,
    concat('k', CAST(conv_id AS VARCHAR), '_', CAST(turn AS VARCHAR)) AS checkpoint_id_parsed,
    CAST(turn AS INTEGER) AS metadata_step_int, role AS metadata_source,
    CAST(NULL AS VARCHAR) AS channel_versions_start
  FROM conversations)""",
    "rescued_rows": "SELECT count(*) FILTER (WHERE _rescued_data IS NOT NULL) AS rescued_row_count FROM bronze",
    "column_stats": _column_stats(),
}


def _lag_sql() -> str:
    # processing_lag needs two more CTEs after the prelude's.
    return PRELUDE.rstrip() + ",\n" + _LAG


def oracle_sql() -> dict[str, str]:
    from threadlens.plans.files_catalog import FILE_ORACLE_SQL

    out = {}
    for name, body in {**QUERIES_SQL, **FILE_ORACLE_SQL}.items():
        out[name] = _lag_sql() if body == "__LAG__" else PRELUDE + body
    return out
