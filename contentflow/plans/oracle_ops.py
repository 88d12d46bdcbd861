"""DuckDB oracle SQL for the operational queries (see registry_ops)."""

from __future__ import annotations

from .oracle import AS_OF, LOGS

SEV_ERR = "('ERROR', 'CRITICAL', 'ALERT', 'EMERGENCY')"

EXEC = """executions AS (
  SELECT ts, 'job-' || CAST(user_id % 4 AS VARCHAR) AS job_name,
         CASE WHEN event_type = 'error' THEN 'failed' ELSE 'succeeded' END AS result,
         value AS execution_time
  FROM events)"""

UPTIME = """uptime AS (
  SELECT ts, 'h' || CAST(user_id % 2 AS VARCHAR) AS host, 'r' || CAST(user_id % 3 AS VARCHAR) AS region,
         event_type <> 'error' AS check_passed
  FROM events)"""

AUDIT = """audit AS (
  SELECT ts,
         CASE WHEN user_id % 4 = 3 THEN 'projects/p/logs/cloudaudit.googleapis.com%2Factivity'
              ELSE 'projects/p/logs/cloudaudit.googleapis.com%2Fdata_access' END AS log_name,
         'user' || CAST(user_id AS VARCHAR) || '@example.com' AS principal,
         CASE user_id % 3 WHEN 0 THEN 'bigquery.googleapis.com' WHEN 1 THEN 'storage.googleapis.com'
              ELSE 'secretmanager.googleapis.com' END AS service,
         CASE event_type WHEN 'view' THEN 'storage.objects.get' WHEN 'click' THEN 'tabledata.list'
              WHEN 'signup' THEN 'jobservice.insert' WHEN 'purchase' THEN 'tabledata.insertAll'
              WHEN 'error' THEN 'AccessSecretVersion' END AS method,
         CASE user_id % 5 WHEN 0 THEN 'projects/p/datasets/d/tables/speakers'
              WHEN 1 THEN 'projects/p/secrets/gemini-api-key'
              ELSE 'tables/t' || CAST(user_id % 5 AS VARCHAR) END AS resource,
         CAST(ts AS DATE) AS ingest_date
  FROM events)"""

BILLING = """billing AS (
  SELECT 'id-' || CAST(l_suppkey % 7 AS VARCHAR) AS service_id, 'Service ' || l_returnflag AS description,
         l_extendedprice AS cost, l_linestatus AS currency, l_shipdate AS usage_ts,
         strftime(l_shipdate, '%Y%m%d') AS suffix, CAST(l_shipdate AS DATE) AS ingest_date
  FROM lineitem)"""


def bucket(period_s: int, col: str = "ts") -> str:
    if period_s % (7 * 86400) == 0:
        return f"time_bucket(INTERVAL '{period_s // 86400} days', {col})"
    return f"time_bucket(INTERVAL '{period_s} seconds', {col})"


def pend(period_s: int) -> str:
    return f"period_start + INTERVAL '{period_s} seconds'"


def phrase_counter(period_s: int, scale: str = "") -> str:
    return f"""WITH {LOGS},
m AS (SELECT {bucket(period_s)} AS period_start, json_extract_string(json_payload, '$.k') AS label
      FROM logs WHERE job_name = 'job-1'
        AND (coalesce(regexp_matches(text_payload, 'purchase'), false)
             OR coalesce(regexp_matches(json_extract_string(json_payload, '$.message'), 'purchase'), false)))
SELECT period_start, {pend(period_s)} AS period_end, label, count(*){scale} AS value FROM m GROUP BY 1, 3"""


def success_counts(period_s: int) -> str:
    return f"""WITH {EXEC}
SELECT {bucket(period_s)} AS period_start, {bucket(period_s)} + INTERVAL '{period_s} seconds' AS period_end,
       count(*) FILTER (WHERE result = 'succeeded') AS succeeded, count(*) AS total,
       count(*) FILTER (WHERE result = 'succeeded') / count(*) AS success_ratio
FROM executions GROUP BY 1, 2"""


def duration(period_s: int) -> str:
    return f"""WITH {EXEC}
SELECT {bucket(period_s)} AS period_start, {bucket(period_s)} + INTERVAL '{period_s} seconds' AS period_end,
       job_name, round(avg(execution_time), 9) AS value
FROM executions GROUP BY 1, 2, 3"""


FIRINGS = f"""{EXEC},
firings AS (SELECT job_name, {bucket(60)} AS period_start, count(*) / 60.0 AS rate
            FROM executions WHERE result = 'failed' GROUP BY 1, 2)"""


def incidents(gap: str) -> str:
    return f"""WITH {FIRINGS},
s AS (SELECT *, CASE WHEN period_start - lag(period_start) OVER (PARTITION BY job_name ORDER BY period_start)
                     <= INTERVAL '{gap}' THEN 0 ELSE 1 END AS new FROM firings),
t AS (SELECT *, sum(new) OVER (PARTITION BY job_name ORDER BY period_start) AS sid FROM s)
SELECT job_name, min(period_start) AS opened_at, max(period_start) AS last_firing,
       max(period_start) + INTERVAL '{gap}' AS closed_at, count(*) AS n_firings
FROM t GROUP BY job_name, sid"""


ANY_INCIDENTS = f"""WITH {EXEC},
m AS (SELECT job_name, date_trunc('minute', ts) AS mi, 0 AS c FROM executions WHERE result = 'failed'
      UNION ALL SELECT job_name, date_trunc('minute', ts), 1 FROM executions WHERE execution_time > 95),
s AS (SELECT *, CASE WHEN mi - lag(mi) OVER (PARTITION BY job_name ORDER BY mi, c) <= INTERVAL '1 hour' THEN 0 ELSE 1 END AS new FROM m),
t AS (SELECT *, sum(new) OVER (PARTITION BY job_name ORDER BY mi, c ROWS UNBOUNDED PRECEDING) AS sid FROM s)
SELECT job_name, min(mi) AS opened_at, max(mi) AS last_firing, max(mi) + INTERVAL '1 hour' AS closed_at,
       count(*) AS n_events, count(DISTINCT c) AS n_conditions
FROM t GROUP BY job_name, sid"""


NEXT_OLDER = f"""{UPTIME},
a AS (SELECT host, region, {bucket(60)} AS m, max({{'t': ts, 'v': check_passed}}).v AS v FROM uptime GROUP BY 1, 2, 3),
b AS (SELECT host, region, min(m) AS lo, max(m) AS hi FROM a GROUP BY 1, 2),
g AS (SELECT host, region, unnest(generate_series(lo, hi, INTERVAL '60 seconds')) AS m FROM b),
f AS (SELECT g.host, g.region, g.m,
             last_value(a.v IGNORE NULLS) OVER (PARTITION BY g.host, g.region ORDER BY g.m
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS v
      FROM g LEFT JOIN a ON a.host = g.host AND a.region = g.region AND a.m = g.m)"""


def downtime_sql(cond: str) -> str:
    return f"""WITH {NEXT_OLDER},
c AS (SELECT host, m, count(*) FILTER (WHERE NOT v) AS cf FROM f WHERE v IS NOT NULL GROUP BY 1, 2),
bad AS (SELECT host, m, CAST(epoch(m) AS BIGINT) // 60 - row_number() OVER (PARTITION BY host ORDER BY m) AS grp
        FROM c WHERE {cond}),
runs AS (SELECT host, grp, min(m) AS run_start, max(m) AS last_m, count(*) AS n FROM bad GROUP BY 1, 2)
SELECT host, run_start, last_m + INTERVAL '60 seconds' AS run_end, n AS n_periods,
       run_start + INTERVAL '300 seconds' AS fired_at
FROM runs WHERE n * 60 >= 300"""


def cost(where: str, group_struct: bool = False, limit: str = "") -> str:
    grp = "service_id, description, currency" if group_struct else "description, currency"
    return f"""WITH {BILLING}
SELECT description AS service_name, CAST(sum(CAST(cost AS DECIMAL(18,2))) AS DOUBLE) AS total_cost, currency
FROM billing WHERE {where} GROUP BY {grp}
ORDER BY total_cost DESC, service_name, currency {limit}"""


SQL_OPS: dict[str, str] = {
    "ts_job_errors": f"""WITH {LOGS}
SELECT {bucket(60)} AS period_start, {bucket(60)} + INTERVAL '60 seconds' AS period_end,
       job_name, severity, count(*) AS value
FROM logs WHERE severity IN {SEV_ERR} GROUP BY 1, 2, 3, 4""",

    "ts_phrase_mentions": phrase_counter(60),
    "w_mentions_rate": phrase_counter(60, " / 60.0"),
    "w_mentions_7d": phrase_counter(7 * 86400),

    "w_exec_success": f"""WITH {EXEC}
SELECT {bucket(60)} AS period_start, {bucket(60)} + INTERVAL '60 seconds' AS period_end,
       job_name, count(*) / 60.0 AS value
FROM executions WHERE result = 'succeeded' GROUP BY 1, 2, 3""",

    "w_exec_failed": f"""WITH {EXEC}
SELECT {bucket(60)} AS period_start, {bucket(60)} + INTERVAL '60 seconds' AS period_end,
       job_name, count(*) / 60.0 AS value
FROM executions WHERE result = 'failed' GROUP BY 1, 2, 3""",

    "w_error_rate": f"""WITH {LOGS}
SELECT {bucket(60)} AS period_start, {bucket(60)} + INTERVAL '60 seconds' AS period_end,
       job_name, severity, count(*) / 60.0 AS value
FROM logs WHERE severity IN {SEV_ERR} GROUP BY 1, 2, 3, 4""",

    "w_uptime": f"""WITH {UPTIME},
a AS (SELECT {bucket(60)} AS period_start, host, region, avg(CAST(check_passed AS DOUBLE)) AS v
      FROM uptime GROUP BY 1, 2, 3),
r AS (SELECT period_start, period_start + INTERVAL '60 seconds' AS period_end, avg(v) AS value FROM a GROUP BY 1)
SELECT period_start, period_end, round(value, 9) AS value,
       CASE WHEN value >= 0.99 THEN 'ok' WHEN value >= 0.95 THEN 'degraded' ELSE 'low' END AS level
FROM r""",

    "w_total_24h": f"""WITH {EXEC}
SELECT {bucket(86400)} AS period_start, {bucket(86400)} + INTERVAL '86400 seconds' AS period_end,
       count(*) AS value FROM executions GROUP BY 1, 2""",

    "w_success_24h": success_counts(86400),
    "w_success_7d": success_counts(7 * 86400),
    "w_duration": duration(60),
    "w_duration_1h": duration(3600),

    "w_job_results_7d": f"""WITH {EXEC}
SELECT {bucket(7 * 86400)} AS period_start, {bucket(7 * 86400)} + INTERVAL '7 days' AS period_end,
       job_name, result, count(*) AS value FROM executions GROUP BY 1, 2, 3, 4""",

    "w_ocr_errors_7d": f"""WITH {LOGS}
SELECT {bucket(7 * 86400)} AS period_start, {bucket(7 * 86400)} + INTERVAL '7 days' AS period_end,
       job_name, count(*) AS value
FROM logs WHERE severity IN {SEV_ERR} AND job_name = 'job-1' GROUP BY 1, 2, 3""",

    "w_success_vs_failed": f"""WITH {EXEC}
SELECT {bucket(3600)} AS period_start, {bucket(3600)} + INTERVAL '1 hour' AS period_end, job_name,
       count(*) FILTER (WHERE result = 'succeeded') AS succeeded,
       count(*) FILTER (WHERE result = 'failed') AS failed
FROM executions GROUP BY 1, 2, 3""",

    "alert_job_failure": f"""WITH {FIRINGS}
SELECT job_name, period_start, period_start + INTERVAL '60 seconds' AS period_end, rate FROM firings""",

    "alert_incidents": incidents("24 hours"),
    "alert_incidents_1h": incidents("1 hour"),

    "alert_incidents_any": ANY_INCIDENTS,
    "stream_incidents_any": ANY_INCIDENTS,
    "stream_downtime": downtime_sql("cf >= 1"),
    "alert_downtime": downtime_sql("cf >= 1"),
    "alert_downtime_literal": downtime_sql("cf < 1"),
    "align_next_older": f"""WITH {NEXT_OLDER}
SELECT host, region, m AS period_start, m + INTERVAL '60 seconds' AS period_end, v AS value FROM f""",
    "reduce_count_false": f"""WITH {NEXT_OLDER}
SELECT m AS period_start, m + INTERVAL '60 seconds' AS period_end, host, count(*) FILTER (WHERE NOT v) AS value
FROM f WHERE v IS NOT NULL GROUP BY 1, 2, 3""",

    "src_budget_messages": """SELECT event_id AS message_id, value AS cost_amount,
       CASE WHEN user_id % 10 IN (0, 5) THEN CAST(0 AS DOUBLE) ELSE CAST(50 AS DOUBLE) END AS budget_amount
FROM events""",

    "budget_decision": """SELECT event_id AS message_id, ts, value AS cost_amount,
       CASE WHEN user_id % 10 IN (0, 5) THEN CAST(0 AS DOUBLE) ELSE CAST(50 AS DOUBLE) END AS budget_amount,
       CASE WHEN user_id % 10 IN (0, 5) THEN NULL ELSE value / CAST(50 AS DOUBLE) END AS ratio,
       CASE WHEN user_id % 10 IN (0, 5) THEN 'SKIP'
            WHEN value / CAST(50 AS DOUBLE) < 1 THEN 'OK' ELSE 'BREACH' END AS decision
FROM events""",

    "budget_thresholds": """WITH p AS (
  SELECT ts, event_id, CAST(value AS DECIMAL(18,2)) AS c, date_trunc('month', ts) AS month
  FROM events),
r AS (SELECT *, sum(c) OVER (PARTITION BY month ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS cum FROM p),
th(threshold) AS (VALUES (0.5), (0.9), (1.0))
SELECT CAST(month AS TIMESTAMP) AS month, CAST(threshold AS DOUBLE) AS threshold,
       CAST(threshold * 50000 AS DOUBLE) AS target_amount, min(ts) AS crossed_at
FROM r JOIN th ON r.cum >= th.threshold * 50000 GROUP BY 1, 2, 3""",

    "audit_today": f"""WITH {AUDIT}
SELECT ts, principal, service, method, resource FROM audit
WHERE ingest_date = DATE '2024-01-30' ORDER BY ts DESC, principal, service, method, resource LIMIT 100""",

    "audit_secret_access": f"""WITH {AUDIT}
SELECT ts, principal FROM audit WHERE resource LIKE '%gemini-api-key%' ORDER BY ts DESC""",

    "audit_table_writes": f"""WITH {AUDIT}
SELECT ts, principal, method FROM audit
WHERE resource LIKE '%tables/speakers%' AND method LIKE '%insert%' ORDER BY ts DESC""",

    "audit_downloads": f"""WITH {AUDIT}
SELECT ts, principal, resource FROM audit
WHERE service = 'storage.googleapis.com' AND method = 'storage.objects.get' ORDER BY ts DESC""",

    "snk_route_audit": f"""WITH {AUDIT}
SELECT ts, log_name, principal, service FROM audit
WHERE service IN ('bigquery.googleapis.com', 'storage.googleapis.com', 'secretmanager.googleapis.com')
  AND regexp_full_match(log_name, '.*cloudaudit.googleapis.com.*data_access')""",

    "snk_retention": f"""WITH {AUDIT}
SELECT ingest_date, count(*) AS n_rows FROM audit
WHERE ts >= {AS_OF} - INTERVAL 7 DAY GROUP BY 1""",

    "snk_tier_report": """WITH o AS (
  SELECT date_diff('day', CAST(l_shipdate AS DATE), DATE '2001-11-30') AS age,
         CAST(l_quantity * 1000 AS BIGINT) AS size_bytes FROM lineitem)
SELECT CASE WHEN age >= 90 THEN 'COLDLINE' WHEN age >= 30 THEN 'NEARLINE' ELSE 'STANDARD' END AS storage_class,
       count(*) AS n_objects, CAST(sum(size_bytes) AS BIGINT) AS total_bytes
FROM o GROUP BY 1""",

    "agg_cost_by_service": cost("strftime(usage_ts, '%Y%m%d') BETWEEN '19960101' AND '19961231'"),
    "agg_cost_by_service_literal": cost("suffix BETWEEN '19960101' AND '19961231'", group_struct=True),
    "agg_cost_last30_top10": cost("ingest_date >= DATE '2001-11-04' - INTERVAL 30 DAY", limit="LIMIT 10"),
}

from .oracle import SQL as _BASE  # noqa: E402

_BASE_OPS = SQL_OPS

SQL_OPS.update({
    "src_sharded_logs": f"""WITH {LOGS}
SELECT CAST(ts AS DATE) AS log_date, job_name, count(*) AS n_rows FROM logs
WHERE job_name IN ('job-0', 'job-1', 'job-2')
  AND CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-14'
GROUP BY 1, 2""",

    "src_manifest": """SELECT '2024-01-31T00:00:00+00:00' AS scraped_at, CAST(doc_id AS VARCHAR) AS chapter_number,
       'https://h/chapitre-' || CAST(doc_id AS VARCHAR) || '-vf/' AS url, n_chars AS image_count,
       'onepiecescan.fr' AS source, 'fr' AS language
FROM documents""",

    "stream_failures": _BASE["agg_weekly_failures"],

    "stream_job_errors": _BASE_OPS["ts_job_errors"],

    "stream_budget_decisions": SQL_OPS["budget_decision"],

    "stream_route_logs": f"""WITH {LOGS}
SELECT CAST(ts AS DATE) AS log_date, job_name, count(*) AS n_rows FROM logs
WHERE job_name IN ('job-0', 'job-1', 'job-2') GROUP BY 1, 2""",
    "stream_incidents": f"""WITH {EXEC},
m AS (SELECT job_name, date_trunc('minute', ts) AS firing_ts FROM executions WHERE result = 'failed'),
s AS (SELECT *, CASE WHEN firing_ts - lag(firing_ts) OVER (PARTITION BY job_name ORDER BY firing_ts)
                     <= INTERVAL '1 hour' THEN 0 ELSE 1 END AS new FROM m),
t AS (SELECT *, sum(new) OVER (PARTITION BY job_name ORDER BY firing_ts) AS sid FROM s),
g AS (SELECT job_name, min(firing_ts) AS opened_at, max(firing_ts) AS last_firing,
             max(firing_ts) + INTERVAL '1 hour' AS closed_at, count(*) AS n_failures
      FROM t GROUP BY job_name, sid)
SELECT *, closed_at > (SELECT max(firing_ts) FROM m) AS is_open FROM g""",
})
