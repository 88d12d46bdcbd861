"""DuckDB oracle SQL for registry_inventory."""

from __future__ import annotations

from .oracle import AS_OF, CHAPTERS, DIALOGUES, IMAGES, LINK_OCCURRENCES, LOGS, SQL, WATERMARK, speakers_cte
from .oracle_ops import AUDIT, BILLING, EXEC, SQL_OPS, UPTIME, bucket

SEV_ERR = "('ERROR', 'CRITICAL', 'ALERT', 'EMERGENCY')"
JOBS = "('job-0', 'job-1', 'job-2')"
WS = "'[\\t\\n\\f\\r ]+'"
PHRASE_PAGES = f"lower(regexp_replace(extracted_text, {WS}, ' ', 'g')) LIKE '%de la%'"


def running_crossings(src: str, amount: float) -> str:
    return f"""WITH {src},
r AS (SELECT *, sum(c) OVER (PARTITION BY month ORDER BY ts, id ROWS UNBOUNDED PRECEDING) AS cum FROM p),
th(threshold) AS (VALUES (0.5), (0.9), (1.0))
SELECT CAST(month AS TIMESTAMP) AS month, CAST(threshold AS DOUBLE) AS threshold,
       CAST(threshold * {amount} AS DOUBLE) AS target_amount, min(ts) AS crossed_at
FROM r JOIN th ON r.cum >= CAST(threshold * {amount} AS DECIMAL(38,2)) GROUP BY 1, 2, 3"""


SQL_INV: dict[str, str] = {
    "src_pages": "SELECT page_id, url, html FROM pages",
    "src_shard_suffix": f"""WITH {BILLING}
SELECT suffix, count(*) AS n_rows FROM billing WHERE suffix BETWEEN '19960101' AND '19961231' GROUP BY 1""",
    "src_partition_day": f"""WITH {BILLING}
SELECT ingest_date, count(*) AS n_rows FROM billing
WHERE ingest_date >= DATE '2001-11-04' - INTERVAL 30 DAY GROUP BY 1""",
    "src_optional_table": "SELECT doc_id, CAST(quality AS BIGINT) AS quality, CAST(toxic AS BIGINT) AS toxic FROM labels",

    "snk_manifest": """SELECT 'One Piece' AS manga, 'onepiecescan.fr' AS source, 'fr' AS language,
       count(*) AS total_chapters_available, count(*) AS n_chapters
FROM documents GROUP BY doc_id // 100""",
    "snk_manifest_document": """SELECT 'One Piece' AS manga, (SELECT count(*) FROM documents) AS total_chapters_available,
       doc_id AS chapter_number, 'https://h/chapitre-' || CAST(doc_id AS VARCHAR) || '-vf/' AS url, n_chars AS image_count,
       '2024-01-31T00:00:00+00:00' AS scraped_at
FROM documents""",
    "prj_format_chapter": """SELECT '2024-01-31T00:00:00+00:00' AS scraped_at, CAST(doc_id AS VARCHAR) AS chapter_number,
       'https://h/chapitre-' || CAST(doc_id AS VARCHAR) || '-vf/' AS url,
       CASE WHEN doc_id % 9 = 0 THEN 0 ELSE n_chars END AS image_count,
       'onepiecescan.fr' AS source, 'fr' AS language
FROM documents""",
    "snk_batch_append": f"""WITH {CHAPTERS} SELECT chapter_number, url, image_count FROM chapters""",
    "snk_chapter_append": "SELECT doc_id AS chapter_number, n_chars AS image_count FROM documents",
    "snk_create_if_absent": SQL["pipe_dialogues"],
    "snk_route_logs": SQL_OPS["stream_route_logs"],
    "snk_snapshot": SQL["agg_kpis"],

    "html_link_number": """WITH occ AS (
  SELECT 'https://h/chapitre-' || CAST(p_partkey AS VARCHAR) || '-vf/' AS href,
         CAST(p_partkey AS VARCHAR) AS number, true AS is_number FROM part
  UNION ALL
  SELECT 'https://h/chapitre-' || CAST(p_partkey AS VARCHAR) || '-vf/', CAST(p_partkey AS VARCHAR), true
  FROM part WHERE p_partkey % 7 = 0
  UNION ALL
  SELECT 'https://h/Chapitre-' || CAST(p_partkey AS VARCHAR) || '-VF/', NULL, false FROM part WHERE p_partkey % 11 = 0
  UNION ALL
  SELECT 'https://h/chapitre-' || CAST(p_partkey AS VARCHAR) || '.5-vf/', CAST(p_partkey AS VARCHAR) || '.5', true
  FROM part WHERE p_partkey % 13 = 0)
SELECT href, number, is_number FROM occ""",

    "flt_severity_at_least": f"""WITH {LOGS}
SELECT ts, severity, job_name FROM logs WHERE severity IN {SEV_ERR}""",
    "flt_jobs": f"""WITH {LOGS} SELECT ts, job_name FROM logs WHERE job_name IN {JOBS}""",
    "flt_recent": f"""WITH {LOGS}
SELECT ts, severity FROM logs WHERE ts >= TIMESTAMP '2024-02-15 00:00:00' - INTERVAL 1 MONTH""",
    "flt_log_payload": f"""WITH {LOGS}
SELECT ts, job_name, text_payload FROM logs
WHERE job_name IN {JOBS}
  AND (coalesce(regexp_matches(text_payload, 'purchase|signup'), false)
       OR coalesce(regexp_matches(json_extract_string(json_payload, '$.message'), 'purchase|signup'), false))""",
    "flt_audit_like": f"""WITH {AUDIT}
SELECT ts, principal, method, resource FROM audit
WHERE resource LIKE '%tables/%' AND method LIKE '%insert%' ORDER BY ts DESC""",
    "flt_bool_mask": f"""WITH {speakers_cte("l.quality = 0")}
SELECT chapter_number, page_number FROM speakers WHERE about_luffy AND NOT luffy_says_it""",
    "flt_after_watermark": f"""WITH {LINK_OCCURRENCES}
SELECT number, href FROM link_occ WHERE CAST(trunc(value) AS BIGINT) > {WATERMARK}""",

    "join_incremental": f"""WITH {LINK_OCCURRENCES}
SELECT number, value FROM links WHERE CAST(trunc(value) AS BIGINT) > {WATERMARK}""",
    "anti_page": f"""WITH {DIALOGUES}
SELECT chapter_number, page_number FROM dialogues WHERE {PHRASE_PAGES} AND turn % 5 = 4""",
    "set_difference": """SELECT l_orderkey AS chapter_number FROM lineitem
WHERE l_orderkey NOT IN (SELECT conv_id FROM conversations)""",
    "set_distinct_pairs": f"""WITH {speakers_cte()}
SELECT DISTINCT chapter_number, phrase FROM speakers WHERE luffy_says_it""",
    "srt_numeric": f"""WITH {LINK_OCCURRENCES} SELECT number, value FROM links ORDER BY value""",
    "srt_work_limit": f"""WITH {CHAPTERS}
SELECT chapter_number, url FROM chapters
WHERE chapter_number NOT IN (SELECT conv_id FROM conversations) ORDER BY chapter_number LIMIT 10""",
    "srt_latest_audit": f"""WITH {AUDIT}
SELECT ts, principal, service, method, resource FROM audit
WHERE ingest_date = DATE '2024-01-15' ORDER BY ts DESC LIMIT 100""",
    "srt_pages": f"""WITH {DIALOGUES}
SELECT chapter_number, page_number FROM dialogues WHERE {PHRASE_PAGES} ORDER BY 1, 2""",

    "win_is_max": f"""WITH {CHAPTERS},
b AS (SELECT CAST(floor(chapter_number / 100.0) * 100 AS BIGINT) AS bucket,
             round_even(avg(image_count), 1) AS mean
      FROM chapters WHERE chapter_number IS NOT NULL GROUP BY 1)
SELECT bucket, mean FROM b WHERE mean = (SELECT max(mean) FROM b)""",
    "win_top_rank": f"""WITH {CHAPTERS},
top AS (SELECT chapter_number, image_count FROM chapters WHERE image_count IS NOT NULL
        ORDER BY image_count DESC, chapter_number ASC LIMIT 10),
pos AS (SELECT *, row_number() OVER (ORDER BY image_count, chapter_number) - 1 AS position FROM top)
SELECT chapter_number, position, CAST(round(0.5 + 0.05 * position, 2) AS DOUBLE) AS weight FROM pos""",
    "win_page_number": """WITH imgs AS (
  SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS page_number,
         printf('/scans/%d/%d.jpg', l_orderkey, l_linenumber) AS image_url
  FROM lineitem WHERE l_linenumber % 3 <> 0)
SELECT l_orderkey AS chapter_number, page_number, image_url FROM imgs
WHERE l_orderkey IN (SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT conv_id FROM conversations))
  AND (l_orderkey + page_number) % 5 <> 0""",
    "win_budget_crossing": running_crossings(
        """p AS (SELECT l_shipdate AS ts, l_orderkey * 8 + l_linenumber AS id,
                CAST(l_extendedprice AS DECIMAL(18,2)) AS c, date_trunc('month', l_shipdate) AS month
         FROM lineitem)""", 20000000.0),

    "align_rate": f"""WITH {EXEC}
SELECT {bucket(60)} AS period_start, {bucket(60)} + INTERVAL '60 seconds' AS period_end,
       job_name, result, count(*) / 60.0 AS value FROM executions GROUP BY 1, 2, 3, 4""",
    "align_sum": f"""WITH {EXEC}
SELECT {bucket(3600)} AS period_start, {bucket(3600)} + INTERVAL '1 hour' AS period_end,
       job_name, result, count(*) AS value FROM executions GROUP BY 1, 2, 3, 4""",
    "align_mean": f"""WITH {EXEC}
SELECT {bucket(3600)} AS period_start, {bucket(3600)} + INTERVAL '1 hour' AS period_end,
       job_name, round(avg(execution_time), 9) AS value FROM executions GROUP BY 1, 2, 3""",
    "align_fraction_true": f"""WITH {UPTIME}
SELECT {bucket(60)} AS period_start, {bucket(60)} + INTERVAL '60 seconds' AS period_end,
       host, region, round(avg(CAST(check_passed AS DOUBLE)), 9) AS value FROM uptime GROUP BY 1, 2, 3, 4""",
    "reduce_sum": f"""WITH {EXEC}
SELECT {bucket(3600)} AS period_start, {bucket(3600)} + INTERVAL '1 hour' AS period_end,
       result, count(*) AS value FROM executions GROUP BY 1, 2, 3""",
    "reduce_mean": f"""WITH {UPTIME},
a AS (SELECT {bucket(3600)} AS period_start, host, region, avg(CAST(check_passed AS DOUBLE)) AS v
      FROM uptime GROUP BY 1, 2, 3)
SELECT period_start, period_start + INTERVAL '1 hour' AS period_end, host, round(avg(v), 9) AS value
FROM a GROUP BY 1, 2, 3""",
    "uptime_series": f"""WITH {UPTIME} SELECT ts, host, region, check_passed FROM uptime""",
    "html_link_quarantine": """SELECT p_partkey // 20 AS page_id,
       'https://h/Chapitre-' || CAST(p_partkey AS VARCHAR) || '-VF/' AS href, 'no_number' AS reason
FROM part WHERE p_partkey % 11 = 0""",
    "budget_quarantine": """SELECT event_id AS message_id,
       CASE user_id % 7 WHEN 3 THEN 'undecodable' WHEN 4 THEN 'not_object' WHEN 5 THEN 'bad_costAmount'
            ELSE 'bad_budgetAmount' END AS reason
FROM events WHERE user_id % 7 >= 3""",
    "pipe_unnumbered_chapters": f"""WITH {IMAGES},
d AS (SELECT conv_id AS c, turn + 1 AS p FROM conversations),
n AS (SELECT c, count(DISTINCT p) AS k FROM d GROUP BY 1)
SELECT CAST(doc_id AS VARCHAR) || CASE WHEN doc_id % 5 = 0 THEN '.5' ELSE '' END AS chapter_label,
       CASE WHEN doc_id % 5 <> 0 THEN doc_id END AS chapter_number, i.page_number, i.image_url,
       printf('chapitre-%s/page-%03d.%s', CAST(doc_id AS VARCHAR) || CASE WHEN doc_id % 5 = 0 THEN '.5' ELSE '' END, i.page_number,
              CASE WHEN lower(i.image_url) LIKE '%jpg%' THEN 'jpg' ELSE 'png' END) AS gcs_path
FROM documents t LEFT JOIN n ON n.c = t.doc_id JOIN imgs i ON i.l_orderkey = t.doc_id
WHERE coalesce(k, 0) < n_chars AND NOT EXISTS (SELECT 1 FROM d WHERE d.c = t.doc_id AND d.p = i.page_number)""",
    "snk_batch_replace": f"""WITH {CHAPTERS}
SELECT chapter_number, url, image_count, CASE WHEN chapter_number % 3 < 2 THEN 'a' ELSE 'b' END AS batch FROM chapters""",
    "stream_chapter_append": """SELECT CASE WHEN doc_id % 10 NOT IN (3, 6) AND n_chars > 0 THEN doc_id END AS chapter_number,
       CASE WHEN doc_id % 10 = 3 THEN 'x' || CAST(doc_id AS VARCHAR)
            WHEN doc_id % 10 = 6 OR n_chars = 0 THEN CAST(doc_id AS VARCHAR) END AS raw_number,
       CASE WHEN doc_id % 10 = 6 THEN 0 ELSE n_chars END AS image_count,
       CASE WHEN doc_id % 10 = 3 THEN 'no_number' WHEN doc_id % 10 = 6 OR n_chars = 0 THEN 'no_images' END AS reason
FROM documents""",
    "src_drifting_shards": """SELECT event_id, CAST(user_id AS DOUBLE) AS user_id,
       CASE WHEN event_id % 3 > 0 THEN value END AS value, 's' || CAST(event_id % 3 AS VARCHAR) AS shard FROM events""",
    "src_partition_days": f"""WITH {AUDIT},
d AS (SELECT DISTINCT ingest_date FROM audit WHERE method = 'AccessSecretVersion' AND ingest_date >= CAST({AS_OF} AS DATE) - 7)
SELECT ingest_date, count(*) AS n_rows, count(DISTINCT principal) AS n_principals
FROM audit WHERE ingest_date IN (SELECT ingest_date FROM d) GROUP BY 1""",
}
