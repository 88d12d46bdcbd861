"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

The bindings of ``plans/bindings.py`` are restated as CTEs.  Where a Spark
query parses something the binding generated (HTML, JSON), the SQL computes
the expected rows straight from the generating table instead.
"""

from __future__ import annotations

import re

from ..schemas import MENTION_REQUEST_TEMPLATE

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
JOBS = "('job-0', 'job-1', 'job-2')"
WS = "'[\\t\\n\\f\\r ]+'"

LOGS = f"""logs AS (
  SELECT ts,
         CASE event_type WHEN 'view' THEN 'INFO' WHEN 'click' THEN 'WARNING'
              WHEN 'signup' THEN 'ERROR' WHEN 'purchase' THEN 'CRITICAL'
              WHEN 'error' THEN 'EMERGENCY' END AS severity,
         'job-' || CAST(user_id % 4 AS VARCHAR) AS job_name,
         event_type AS text_payload, props AS json_payload
  FROM events)"""

CHAPTERS = f"""chapters AS (
  SELECT {AS_OF} AS scraped_at, doc_id AS chapter_number, source, lang AS language,
         'https://h/chapitre-' || CAST(doc_id AS VARCHAR) || '-vf/' AS url,
         n_chars AS image_count
  FROM documents)"""

DIALOGUES = f"""dialogues AS (
  SELECT conv_id AS chapter_number, turn + 1 AS page_number,
         printf('/scans/%d/%d.jpg', conv_id, turn + 1) AS image_url,
         printf('chapitre-%d/page-%03d.jpg', conv_id, turn + 1) AS gcs_path,
         replace(text, ' ', chr(10)) AS extracted_text,
         {AS_OF} AS processed_at, turn
  FROM conversations)"""


def speakers_cte(about: str = "l.toxic = 1") -> str:
    return f"""speakers AS (
  SELECT c.conv_id AS chapter_number, c.turn + 1 AS page_number, c.role AS speaker,
         c.text AS phrase, (l.quality = 1) AS luffy_says_it, ({about}) AS about_luffy
  FROM conversations c LEFT JOIN labels l ON l.doc_id = c.conv_id)"""


# Chapter-link pages built from ``part`` (see bindings.link_pages): the
# numbers the extraction must find, one row per anchor occurrence.
LINK_OCCURRENCES = """link_occ AS (
  SELECT p_partkey // 20 AS page_id, CAST(p_partkey AS VARCHAR) AS number,
         CAST(p_partkey AS DOUBLE) AS value,
         'https://h/chapitre-' || CAST(p_partkey AS VARCHAR) || '-vf/' AS href
  FROM part
  UNION ALL
  SELECT p_partkey // 20, CAST(p_partkey AS VARCHAR), CAST(p_partkey AS DOUBLE),
         'https://h/chapitre-' || CAST(p_partkey AS VARCHAR) || '-vf/'
  FROM part WHERE p_partkey % 7 = 0
  UNION ALL
  SELECT p_partkey // 20, CAST(p_partkey AS VARCHAR) || '.5', p_partkey + 0.5,
         'https://h/chapitre-' || CAST(p_partkey AS VARCHAR) || '.5-vf/'
  FROM part WHERE p_partkey % 13 = 0),
links AS (SELECT DISTINCT page_id, number, value, href FROM link_occ)"""

WATERMARK = "(SELECT coalesce(max(doc_id), 0) FROM documents)"

IMAGES = """imgs AS (
  SELECT l_orderkey, l_linenumber,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS page_number,
         printf('/scans/%d/%d.jpg', l_orderkey, l_linenumber) AS image_url
  FROM lineitem WHERE l_linenumber % 3 <> 0)"""

NON_MARKUP = "'(?is)<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>|<!--.*?-->'"
ANCHOR = """'(?is)<a\\b[^>]*?\\shref\\s*=\\s*("[^"]*"|''[^'']*''|[^\\s>"'']+)'"""


def template_sql(template: str, **exprs: str) -> str:
    """A fixed text with ``{name}`` placeholders as a SQL concatenation of
    quoted literal pieces and the given SQL expressions."""
    parts = []
    for piece in re.split(r"(\{[a-z_]+\})", template):
        if re.fullmatch(r"\{[a-z_]+\}", piece):
            parts.append(f"CAST({exprs[piece[1:-1]]} AS VARCHAR)")
        elif piece:
            parts.append("'" + piece.replace("'", "''") + "'")
    return "(" + " || ".join(parts) + ")"


def request_sql(phrase: str) -> str:
    return template_sql(MENTION_REQUEST_TEMPLATE, chapter="chapter_number", page="page_number",
                        text="extracted_text", phrase="'" + phrase.replace("'", "''") + "'")


def failures_sql(grain: str = "week", severity: str | None = "IN ('ERROR','CRITICAL','ALERT','EMERGENCY')") -> str:
    sev = f"AND severity {severity}" if severity else ""
    return f"""WITH {LOGS},
recent AS (
  SELECT * FROM logs
  WHERE ts >= {AS_OF} - INTERVAL 3 MONTH {sev}
    AND job_name IN {JOBS})
SELECT date_trunc('{grain}', ts) AS period, job_name,
       count(*) AS n_failures,
       count(*) FILTER (WHERE severity = 'ERROR') AS n_error,
       count(*) FILTER (WHERE severity = 'CRITICAL') AS n_critical,
       count(*) FILTER (WHERE severity IN ('ALERT', 'EMERGENCY')) AS n_alert_emergency,
       min(ts) AS first_failure, max(ts) AS last_failure
FROM recent GROUP BY 1, 2
ORDER BY period DESC, n_failures DESC, job_name"""


ARCS_VALUES = """arcs(name, lo, hi, family) AS (VALUES
  ('East Blue', 1, 100, 'East Blue'), ('Arabasta', 101, 216, 'Grand Line'),
  ('Skypiea', 217, 302, 'Grand Line'), ('Water Seven', 303, 441, 'Grand Line'),
  ('Thriller Bark', 442, 489, 'Grand Line'), ('Summit War', 490, 597, 'Grand Line'),
  ('Fish-Man Island', 598, 653, 'New World'), ('Dressrosa', 654, 801, 'New World'),
  ('Whole Cake Island', 802, 902, 'New World'), ('Wano', 903, 1057, 'New World'),
  ('Egghead', 1058, 1172, 'New World'), ('Beyond', 5000, 6000, 'None'))"""

SQL: dict[str, str] = {
    "agg_weekly_failures": failures_sql(),
    "agg_weekly_failures_literal": failures_sql(severity=">= 'ERROR'"),
    "agg_daily_failures": failures_sql("day"),
    "agg_all_logs_weekly": failures_sql(severity=None),

    "agg_kpis": f"""WITH {CHAPTERS}
SELECT count(*) AS n_chapters, avg(image_count) AS mean_pages,
       CAST(sum(image_count) AS BIGINT) AS total_pages FROM chapters""",

    "prj_explorer": f"""WITH {CHAPTERS}
SELECT chapter_number AS chapter, image_count AS pages, scraped_at AS retrieved_at
FROM chapters WHERE chapter_number BETWEEN 1 AND 100""",

    "win_centered_mean": f"""WITH {CHAPTERS}
SELECT chapter_number, image_count,
       CASE WHEN count(image_count) OVER w = 50 THEN avg(image_count) OVER w END AS rolling_mean
FROM chapters
WINDOW w AS (ORDER BY chapter_number ROWS BETWEEN 25 PRECEDING AND 24 FOLLOWING)""",

    "win_centered_mean_by_source": f"""WITH {CHAPTERS}
SELECT source, chapter_number, image_count,
       CASE WHEN count(image_count) OVER w = 50 THEN avg(image_count) OVER w END AS rolling_mean
FROM chapters
WINDOW w AS (PARTITION BY source ORDER BY chapter_number ROWS BETWEEN 25 PRECEDING AND 24 FOLLOWING)""",

    "range_arcs": f"""WITH {CHAPTERS}, {ARCS_VALUES}
SELECT a.name, a.family, CAST(a.lo AS BIGINT) AS lo, CAST(a.hi AS BIGINT) AS hi,
       CAST(a.lo AS VARCHAR) || '–' || CAST(a.hi AS VARCHAR) AS label,
       count(c.chapter_number) AS n_chapters,
       CAST(count(c.chapter_number) AS VARCHAR) || ' chap.' AS text
FROM arcs a LEFT JOIN chapters c ON c.chapter_number BETWEEN a.lo AND a.hi
GROUP BY a.name, a.family, a.lo, a.hi""",

    "agg_bucket_mean": f"""WITH {CHAPTERS},
b AS (SELECT CAST(floor(chapter_number / 100.0) * 100 AS BIGINT) AS bucket,
             round_even(avg(image_count), 1) AS mean
      FROM chapters WHERE chapter_number IS NOT NULL GROUP BY 1)
SELECT bucket, CAST(bucket AS VARCHAR) || '–' || CAST(bucket + 99 AS VARCHAR) AS label, mean,
       coalesce(mean = (SELECT max(mean) FROM b), false) AS is_max
FROM b ORDER BY bucket""",

    "srt_top10": f"""WITH {CHAPTERS},
top AS (SELECT chapter_number, image_count FROM chapters WHERE image_count IS NOT NULL
        ORDER BY image_count DESC, chapter_number ASC LIMIT 10),
pos AS (SELECT *, row_number() OVER (ORDER BY image_count, chapter_number) - 1 AS position FROM top)
SELECT chapter_number, image_count, position,
       CAST(round(0.5 + 0.05 * position, 2) AS DOUBLE) AS weight,
       'Chapitre ' || CAST(chapter_number AS VARCHAR) AS label,
       CAST(image_count AS VARCHAR) || ' pages' AS text
FROM pos""",

    "agg_watermark": f"""WITH {CHAPTERS}
SELECT CAST(coalesce(max(chapter_number), 0) AS BIGINT) AS last_chapter FROM chapters""",

    "agg_mentions_per_chapter": f"""WITH {speakers_cte()}
SELECT chapter_number, count(*) AS occurrences FROM speakers
WHERE chapter_number IS NOT NULL GROUP BY 1 ORDER BY 1""",

    "agg_mention_kpis": f"""WITH {speakers_cte()}
SELECT count(*) AS total, count(*) FILTER (WHERE luffy_says_it) AS n_says,
       count(*) FILTER (WHERE about_luffy) AS n_about FROM speakers""",

    "agg_mention_split": f"""WITH {speakers_cte("l.quality = 0")},
k AS (SELECT count(*) AS t, count(*) FILTER (WHERE luffy_says_it) AS s,
             count(*) FILTER (WHERE about_luffy AND NOT luffy_says_it) AS a FROM speakers)
SELECT CAST(0 AS BIGINT) AS slot, 'says' AS category, 'Luffy le dit' AS label, s AS n FROM k
UNION ALL SELECT 1, 'about_only', 'Quelqu''un parle de Luffy', a FROM k
UNION ALL SELECT 2, 'other', 'Autre contexte', t - s - a FROM k""",

    "srt_distinct_examples": f"""WITH {speakers_cte()},
f AS (SELECT chapter_number, phrase, min(page_number) AS o FROM speakers
      WHERE luffy_says_it GROUP BY 1, 2)
SELECT chapter_number, phrase FROM f ORDER BY chapter_number, o, phrase LIMIT 10""",

    "html_anchor_links": f"""WITH x AS (
  SELECT page_id, regexp_extract_all(regexp_replace(html, {NON_MARKUP}, '', 'g'), {ANCHOR}, 1) AS v
  FROM pages),
e AS (SELECT page_id, generate_subscripts(v, 1) - 1 AS pos, unnest(v) AS raw FROM x)
SELECT page_id, CAST(pos AS BIGINT) AS pos,
       replace(replace(replace(replace(replace(replace(
         regexp_replace(raw, '^["'']|["'']$', '', 'g'),
         '&quot;', '"'), '&#39;', ''''), '&#x27;', ''''), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS href
FROM e""",

    "html_chapter_links": f"""WITH {LINK_OCCURRENCES}
SELECT page_id, href, number, value FROM link_occ""",

    "set_dedupe_first": f"""WITH {LINK_OCCURRENCES}
SELECT number, href AS url, page_id FROM links""",

    "agg_total_available": f"""WITH {LINK_OCCURRENCES}
SELECT count(DISTINCT number) AS total_chapters_available FROM link_occ""",

    "pipe_frontier": f"""WITH {LINK_OCCURRENCES}
SELECT number, value, href AS url, page_id FROM links
WHERE CAST(trunc(value) AS BIGINT) > {WATERMARK} ORDER BY value""",

    "pipe_frontier_strict": f"""WITH {LINK_OCCURRENCES}
SELECT number, value, href AS url, page_id FROM links
WHERE value > {WATERMARK} ORDER BY value""",

    "srt_limit_mode": f"""WITH {LINK_OCCURRENCES}
SELECT number, value, href AS url, page_id FROM links ORDER BY value LIMIT 25""",

    "html_lazy_images": f"""WITH {IMAGES}
SELECT l_orderkey AS page_id, page_number - 1 AS pos, image_url AS src FROM imgs""",

    "html_image_count": """SELECT l_orderkey AS page_id,
       count(*) FILTER (WHERE l_linenumber % 3 <> 0) AS image_count
FROM lineitem GROUP BY 1""",

    "pipe_chapters": f"""WITH {LINK_OCCURRENCES},
f AS (SELECT * FROM links WHERE CAST(trunc(value) AS BIGINT) > {WATERMARK}),
n AS (SELECT l_orderkey, count(*) FILTER (WHERE l_linenumber % 3 <> 0) AS n FROM lineitem GROUP BY 1)
SELECT {AS_OF} AS scraped_at, f.number AS chapter_label,
       CASE WHEN f.value = floor(f.value) THEN CAST(f.value AS BIGINT) END AS chapter_number,
       'onepiecescan.fr' AS source, 'fr' AS language, f.href AS url,
       coalesce(n.n, 0) AS image_count
FROM f LEFT JOIN n ON f.href = 'https://h/chapitre-' || CAST(n.l_orderkey AS VARCHAR) || '-vf/'""",

    "anti_chapter": f"""WITH {CHAPTERS}
SELECT chapter_number, url FROM chapters
WHERE chapter_number NOT IN (SELECT conv_id FROM conversations) ORDER BY 1""",

    "agg_distinct_keys": "SELECT DISTINCT conv_id AS chapter_number FROM conversations",

    "pipe_page_tasks": f"""WITH {IMAGES},
todo AS (SELECT doc_id AS chapter_number FROM documents
         WHERE doc_id NOT IN (SELECT conv_id FROM conversations)),
j AS (SELECT t.chapter_number, i.page_number, i.image_url,
             CASE WHEN lower(i.image_url) LIKE '%jpg%' THEN 'jpg' ELSE 'png' END AS ext
      FROM todo t JOIN imgs i ON i.l_orderkey = t.chapter_number)
SELECT chapter_number, page_number, image_url,
       printf('chapitre-%d/page-%03d.%s', chapter_number, page_number, ext) AS gcs_path,
       'image/' || ext AS content_type
FROM j""",

    "pipe_dialogues": f"""SELECT conv_id AS chapter_number, turn + 1 AS page_number,
       printf('/scans/%d/%d.jpg', conv_id, turn + 1) AS image_url,
       printf('chapitre-%d/page-%03d.jpg', conv_id, turn + 1) AS gcs_path,
       CASE WHEN turn % 5 = 0 OR turn % 7 = 0 THEN ''
            ELSE regexp_replace(text, '^\\s+|\\s+$', '', 'g') END AS extracted_text,
       {AS_OF} AS processed_at
FROM conversations WHERE turn % 11 <> 10""",

    "flt_phrase": f"""WITH {DIALOGUES}
SELECT chapter_number, page_number, extracted_text FROM dialogues
WHERE lower(regexp_replace(extracted_text, {WS}, ' ', 'g')) LIKE '%de la%'""",

    "pipe_mentions_from_responses": """SELECT conv_id AS chapter_number, turn + 1 AS page_number,
       CASE turn % 3 WHEN 0 THEN 'inconnu' WHEN 1 THEN NULL ELSE role END AS speaker,
       text AS phrase, role = 'user' AS luffy_says_it, role = 'assistant' AS about_luffy
FROM conversations WHERE turn % 5 <> 4""",

    "agg_distinct_pages": """SELECT DISTINCT conv_id AS chapter_number, turn + 1 AS page_number
FROM conversations WHERE turn % 5 <> 4""",

    "pipe_mention_worklist": f"""WITH {DIALOGUES}
SELECT chapter_number, page_number, extracted_text, {request_sql('de la')} AS request
FROM dialogues
WHERE lower(regexp_replace(extracted_text, {WS}, ' ', 'g')) LIKE '%de la%'
  AND turn % 5 = 4
ORDER BY chapter_number, page_number""",

    "pipe_mentions_rules": f"""WITH {DIALOGUES},
s AS (SELECT chapter_number, page_number,
             generate_subscripts(regexp_split_to_array(extracted_text, '[.!?]+'), 1) - 1 AS sidx,
             unnest(regexp_split_to_array(extracted_text, '[.!?]+')) AS s
      FROM dialogues),
f AS (SELECT chapter_number, page_number, sidx,
             regexp_replace(regexp_replace(s, {WS}, ' ', 'g'), '^\\s+|\\s+$', '', 'g') AS phrase FROM s),
t AS (SELECT *, regexp_matches(lower(phrase), '(je serai|je vais devenir|ce sera moi|je deviendrai|mon rêve)') AS says,
             regexp_matches(phrase, '(^|[^\\p{{L}}\\p{{N}}])(Luffy|L|Lu|Monkey|Monkey D\\. Luffy|le capitaine|chapeau de paille)($|[^\\p{{L}}\\p{{N}}])') AS alias_hit
      FROM f)
SELECT chapter_number, page_number, CAST(sidx AS BIGINT) AS sidx,
       CASE WHEN says THEN 'Luffy' ELSE 'inconnu' END AS speaker, phrase,
       says AS luffy_says_it, alias_hit AND NOT says AS about_luffy
FROM t WHERE lower(phrase) LIKE '%de la%'""",
}

SQL.update({
    "src_chapters": f"""WITH {CHAPTERS}
SELECT chapter_number, url, image_count, source, language, scraped_at FROM chapters ORDER BY chapter_number""",
    "src_speakers": f"""WITH {speakers_cte()}
SELECT chapter_number, speaker, phrase, luffy_says_it, about_luffy FROM speakers ORDER BY chapter_number""",
})

SQL.update({
    "pipe_page_ledger": """SELECT conv_id AS chapter_number, turn + 1 AS page_number,
       CASE WHEN turn % 5 = 4 THEN 'failed' ELSE 'mentions' END AS status,
       CAST(CASE WHEN turn % 5 = 4 THEN 0 ELSE 1 END AS BIGINT) AS n_mentions,
       CAST(0 AS BIGINT) AS n_bad
FROM conversations""",
    "pipe_mention_worklist_ledger": SQL["pipe_mention_worklist"],
})

from .oracle_ops import SQL_OPS  # noqa: E402

SQL.update(SQL_OPS)

from .oracle_inventory import SQL_INV  # noqa: E402

SQL.update(SQL_INV)

from .oracle_scalars import SQL_SCL  # noqa: E402

SQL.update(SQL_SCL)
