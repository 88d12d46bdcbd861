"""DuckDB oracle SQL for registry_scalars (SCL-01..18).

DuckDB's ``printf``/``format`` round the exact binary value half-to-even, as
Python does, so the number-format oracle is independent of the Spark code.
"""

from __future__ import annotations

from .oracle import CHAPTERS, DIALOGUES, LOGS, WS, request_sql

STRIP = "regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"
PLAIN_DECIMAL = "'^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$'"
IMAGE_IS_WEBP = "l_linenumber % 3 = 0"
MESSAGES = "FROM events"

SQL_SCL: dict[str, str] = {
    "scl_collapse_ws": f"""SELECT conv_id AS chapter_number, turn + 1 AS page_number,
       lower(regexp_replace(replace(text, ' ', chr(10)), {WS}, ' ', 'g')) AS folded
FROM conversations""",

    "scl_strip": f"""WITH s AS (SELECT doc_id, regexp_split_to_array(text, '[.!?]') AS raw FROM documents),
t AS (SELECT doc_id, raw, list_transform(raw, lambda x: {STRIP.format(x='x')}) AS pieces FROM s)
SELECT doc_id,
       CAST(len(list_filter(pieces, lambda x: x <> '')) AS BIGINT) AS n_pieces,
       CAST(coalesce(list_sum(list_transform(pieces, lambda x: length(x))), 0) AS BIGINT) AS n_chars,
       CAST(len(list_filter(range(1, len(raw) + 1),
                            lambda i: length(raw[i]) <> length(pieces[i]))) AS BIGINT) AS n_trimmed
FROM t""",

    "scl_is_float": f"""WITH t AS (SELECT doc_id,
       list_filter(regexp_split_to_array(text, {WS}), lambda x: x <> '') AS toks FROM documents),
n AS (SELECT doc_id, toks, list_filter(toks, lambda x: regexp_matches(x, {PLAIN_DECIMAL})) AS nums FROM t)
SELECT doc_id, CAST(len(toks) AS BIGINT) AS n_tokens, CAST(len(nums) AS BIGINT) AS n_numeric,
       list_min(list_transform(nums, lambda x: CAST(trim(x) AS DOUBLE))) AS min_value,
       list_max(list_transform(nums, lambda x: CAST(trim(x) AS DOUBLE))) AS max_value
FROM n""",

    "scl_trunc": "SELECT event_id, value, CAST(trunc(value) AS BIGINT) AS value_trunc FROM events",

    "scl_object_path": f"""SELECT l_orderkey AS chapter_number, CAST(l_linenumber AS BIGINT) AS page_number,
       CASE WHEN {IMAGE_IS_WEBP} THEN printf('/img/%d/%d.webp', l_orderkey, l_linenumber)
            ELSE printf('/scans/%d/%d.jpg', l_orderkey, l_linenumber) END AS image_url,
       printf('chapitre-%d/page-%03d.%s', l_orderkey, l_linenumber,
              CASE WHEN {IMAGE_IS_WEBP} THEN 'png' ELSE 'jpg' END) AS gcs_path
FROM lineitem""",

    "scl_mime": f"""SELECT CASE WHEN {IMAGE_IS_WEBP} THEN 'image/png' ELSE 'image/jpg' END AS mime,
       count(*) AS n_images
FROM lineitem GROUP BY 1""",

    "scl_iso_utc": """SELECT event_id,
       CASE WHEN strftime(ts, '%f') = '000000' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
            ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END || '+00:00' AS ts_iso
FROM events""",

    "scl_week_day": f"""WITH {LOGS}
SELECT date_trunc('week', ts) AS week_start, date_trunc('day', ts) AS day_start, count(*) AS n_logs
FROM logs GROUP BY 1, 2""",

    "scl_bucket_label": """WITH b AS (SELECT CAST(floor(n_chars / 1000.0) * 1000 AS BIGINT) AS bucket FROM documents)
SELECT bucket, CAST(bucket AS VARCHAR) || '–' || CAST(bucket + 999 AS VARCHAR) AS label,
       count(*) AS n_docs
FROM b GROUP BY 1""",

    # Responses are generated per conversation turn (bindings.mention_responses):
    # truncated when turn % 5 = 4, fenced when turn is odd, one mention each.
    "scl_json_lenient": """SELECT conv_id AS chapter_number, turn + 1 AS page_number,
       turn % 5 <> 4 AS parsed, turn % 5 <> 4 AND turn % 2 = 1 AS fenced,
       CASE WHEN turn % 5 <> 4 THEN CAST(1 AS BIGINT) END AS n_mentions
FROM conversations""",

    "scl_json_default": """SELECT conv_id AS chapter_number, turn + 1 AS page_number,
       CASE turn % 3 WHEN 0 THEN 'inconnu' WHEN 1 THEN NULL ELSE role END AS speaker,
       CASE turn % 3 WHEN 0 THEN 'missing' WHEN 1 THEN 'null' ELSE 'value' END AS speaker_state
FROM conversations WHERE turn % 5 <> 4""",

    "scl_base64": f"""SELECT event_id AS message_id,
       '{{"costAmount":' || CAST(value AS VARCHAR)
       || CASE WHEN user_id % 10 = 5 THEN '}}'
               ELSE ',"budgetAmount":' || CASE WHEN user_id % 10 = 0 THEN '0' ELSE '50' END || '}}' END AS body
{MESSAGES}""",

    "scl_number_format": """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
       printf('%.1f', l_extendedprice) AS price_text,
       format('{:,}', CAST(trunc(l_quantity * 1000) AS BIGINT)) AS qty_text,
       printf('%.2f', l_discount * 100.0) || '%' AS discount_text
FROM lineitem""",

    "scl_ratio": f"""SELECT event_id AS message_id,
       CASE WHEN user_id % 10 IN (0, 5) THEN NULL ELSE value / 50.0 END AS ratio
{MESSAGES}""",

    "scl_first_annotation": f"""SELECT conv_id AS chapter_number, turn + 1 AS page_number,
       CASE WHEN turn % 5 = 0 OR turn % 7 = 0 THEN '' ELSE {STRIP.format(x='text')} END AS text
FROM conversations""",

    "scl_label_extract": f"""WITH {LOGS}
SELECT job_name, severity, json_extract_string(json_payload, '$.k') AS label, count(*) AS n_logs
FROM logs GROUP BY 1, 2, 3""",

    "scl_prompt": f"""WITH {DIALOGUES}
SELECT chapter_number, page_number, {request_sql('roi des pirates')} AS request FROM dialogues""",

    "scl_chapter_labels": f"""WITH {CHAPTERS}
SELECT chapter_number, 'Chapitre ' || CAST(chapter_number AS VARCHAR) AS chapter_label,
       CAST(image_count AS VARCHAR) || ' pages' AS pages_label,
       CAST(chapter_number AS VARCHAR) || ' chap.' AS chap_label
FROM chapters""",
}
