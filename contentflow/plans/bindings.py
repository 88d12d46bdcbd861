"""Logical tables derived from the benchmark tables.

Each function maps driver tables (``events``, ``documents``, ``conversations``
...) to one logical input of the pipeline (``logs``, ``chapters``,
``dialogues`` ...).  The mapping is row-wise (no shuffle) except where a page
of HTML is assembled from a bounded group (20 parts, <= 7 lines of an order).
``plans/oracle.py`` holds the same mappings as DuckDB CTEs; both sides must use
the same expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import zero_pad

# Reference instant for every "now"-relative filter over ``events``.
AS_OF = "2024-01-31 00:00:00"
# Job names as bound from events: 'job-' + user_id % 4; three of four are listed.
TEST_JOBS = ["job-0", "job-1", "job-2"]
HOST = "https://h"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _case(col: str, mapping: dict, default=None) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(F.col(col) == k, F.lit(v)) if out is None
               else out.when(F.col(col) == k, F.lit(v)))
    return out.otherwise(F.lit(default))


SEVERITY_BY_EVENT = {"view": "INFO", "click": "WARNING", "signup": "ERROR",
                     "purchase": "CRITICAL", "error": "EMERGENCY"}

METHOD_BY_EVENT = {"view": "storage.objects.get", "click": "tabledata.list",
                   "signup": "jobservice.insert", "purchase": "tabledata.insertAll",
                   "error": "AccessSecretVersion"}

SERVICE_BY_MOD3 = {0: "bigquery.googleapis.com", 1: "storage.googleapis.com",
                   2: "secretmanager.googleapis.com"}


def job_of_user() -> Column:
    return F.concat(F.lit("job-"), (F.col("user_id") % 4).cast("string"))


# --------------------------------------------------------------------------
# events -> logs / executions / uptime / budget messages / audit
# --------------------------------------------------------------------------

def logs(spark, sf_dir) -> DataFrame:
    return logs_from_events(table(spark, sf_dir, "events"))


def logs_from_events(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("ts").cast("timestamp").alias("ts"),
        _case("event_type", SEVERITY_BY_EVENT).alias("severity"),
        F.struct(F.lit("cloud_run_job").alias("type"),
                 F.struct(job_of_user().alias("job_name")).alias("labels")).alias("resource"),
        F.col("event_type").alias("text_payload"),
        F.col("props").alias("json_payload"),
    )


def executions(spark, sf_dir) -> DataFrame:
    return executions_from_events(table(spark, sf_dir, "events"))


def executions_from_events(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("ts").cast("timestamp").alias("ts"),
        job_of_user().alias("job_name"),
        F.when(F.col("event_type") == "error", "failed").otherwise("succeeded").alias("result"),
        F.col("value").alias("execution_time"),
    )


def uptime(spark, sf_dir) -> DataFrame:
    return uptime_from_events(table(spark, sf_dir, "events"))


def uptime_from_events(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("h"), (F.col("user_id") % 2).cast("string")).alias("host"),
        F.concat(F.lit("r"), (F.col("user_id") % 3).cast("string")).alias("region"),
        (F.col("event_type") != "error").alias("check_passed"),
    )


def budget_messages(spark, sf_dir) -> DataFrame:
    return budget_messages_from_events(table(spark, sf_dir, "events"))


def budget_messages_from_events(ev: DataFrame) -> DataFrame:
    """One message per event: costAmount = value, budgetAmount = 50, 0 when
    user_id % 10 = 0, key absent when user_id % 10 = 5; base64 of the JSON."""
    cost = F.col("value").cast("string")
    budget = F.when(F.col("user_id") % 10 == 0, F.lit("0")).otherwise(F.lit("50"))
    body = F.when(F.col("user_id") % 10 == 5,
                  F.concat(F.lit('{"costAmount":'), cost, F.lit("}"))) \
        .otherwise(F.concat(F.lit('{"costAmount":'), cost, F.lit(',"budgetAmount":'),
                            budget, F.lit("}")))
    return ev.select(F.col("event_id").alias("message_id"),
                     F.col("ts").cast("timestamp").alias("ts"),
                     F.base64(F.encode(body, "UTF-8")).alias("data"))


def audit_log(spark, sf_dir) -> DataFrame:
    return audit_log_from_events(table(spark, sf_dir, "events"))


def audit_log_from_events(ev: DataFrame) -> DataFrame:
    u = F.col("user_id")
    resource = (F.when(u % 5 == 0, F.lit("projects/p/datasets/d/tables/speakers"))
                .when(u % 5 == 1, F.lit("projects/p/secrets/gemini-api-key"))
                .otherwise(F.concat(F.lit("tables/t"), (u % 5).cast("string"))))
    log_name = F.when(u % 4 == 3, F.lit("projects/p/logs/cloudaudit.googleapis.com%2Factivity")) \
        .otherwise(F.lit("projects/p/logs/cloudaudit.googleapis.com%2Fdata_access"))
    service = (F.when(u % 3 == 0, F.lit(SERVICE_BY_MOD3[0]))
               .when(u % 3 == 1, F.lit(SERVICE_BY_MOD3[1]))
               .otherwise(F.lit(SERVICE_BY_MOD3[2])))
    return ev.select(
        F.col("ts").cast("timestamp").alias("ts"),
        log_name.alias("log_name"),
        F.struct(F.concat(F.lit("user"), u.cast("string"), F.lit("@example.com")).alias("principal"),
                 service.alias("service"),
                 _case("event_type", METHOD_BY_EVENT).alias("method"),
                 resource.alias("resource")).alias("payload"),
        F.to_date("ts").alias("ingest_date"),
    )


# --------------------------------------------------------------------------
# lineitem -> billing
# --------------------------------------------------------------------------

def billing(spark, sf_dir) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.struct(F.concat(F.lit("id-"), (F.col("l_suppkey") % 7).cast("string")).alias("id"),
                 F.concat(F.lit("Service "), F.col("l_returnflag")).alias("description")
                 ).alias("service"),
        F.col("l_extendedprice").alias("cost"),
        F.col("l_linestatus").alias("currency"),
        F.col("l_shipdate").cast("timestamp").alias("usage_ts"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("suffix"),
        F.to_date("l_shipdate").alias("ingest_date"),
    )


# --------------------------------------------------------------------------
# documents / conversations / labels -> chapters / dialogues / speakers
# --------------------------------------------------------------------------

def chapter_url(key: Column) -> Column:
    return F.concat(F.lit(HOST + "/chapitre-"), key.cast("string"), F.lit("-vf/"))


def scan_url(a: Column, b: Column) -> Column:
    """``/scans/{a}/{b}.jpg`` (concat: cheaper per row than format_string)."""
    return F.concat(F.lit("/scans/"), a.cast("string"), F.lit("/"), b.cast("string"), F.lit(".jpg"))


def page_path(chapter: Column, page: Column) -> Column:
    """``chapitre-{n}/page-{p:03d}.jpg``."""
    return F.concat(F.lit("chapitre-"), chapter.cast("string"), F.lit("/page-"), zero_pad(page, 3),
                    F.lit(".jpg"))


def chapters(spark, sf_dir) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.lit(AS_OF).cast("timestamp").alias("scraped_at"),
        F.col("doc_id").alias("chapter_number"),
        F.col("source"),
        F.col("lang").alias("language"),
        chapter_url(F.col("doc_id")).alias("url"),
        F.col("n_chars").alias("image_count"),
    )


def dialogues(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    page = F.col("turn") + 1
    return c.select(
        F.col("conv_id").alias("chapter_number"),
        page.alias("page_number"),
        scan_url(F.col("conv_id"), page).alias("image_url"),
        page_path(F.col("conv_id"), page).alias("gcs_path"),
        F.replace(F.col("text"), F.lit(" "), F.lit("\n")).alias("extracted_text"),
        F.lit(AS_OF).cast("timestamp").alias("processed_at"),
    )


def speakers(spark, sf_dir, *, about_from: str = "toxic") -> DataFrame:
    """conversations LEFT JOIN labels; says = (quality = 1); about = (toxic = 1),
    or (quality = 0) with ``about_from='quality0'``.  ``labels`` is keyed by
    doc_id; the join is an equi-join that Spark may broadcast only when AQE
    measures it small."""
    c = table(spark, sf_dir, "conversations")
    lab = table(spark, sf_dir, "labels")
    j = c.join(lab, c.conv_id == lab.doc_id, "left")
    about = (F.col("toxic") == 1) if about_from == "toxic" else (F.col("quality") == 0)
    return j.select(
        F.col("conv_id").alias("chapter_number"),
        (F.col("turn") + 1).alias("page_number"),
        F.col("role").alias("speaker"),
        F.col("text").alias("phrase"),
        (F.col("quality") == 1).alias("luffy_says_it"),
        about.alias("about_luffy"),
    )


def ocr_responses(spark, sf_dir) -> DataFrame:
    """Vision-style response per conversation turn: text wrapped in 3 newlines;
    an error when turn % 5 = 0; no annotation when turn % 7 = 0."""
    c = table(spark, sf_dir, "conversations")
    nl3 = F.lit("\n\n\n")
    ann = F.array(F.struct(F.concat(nl3, F.col("text"), nl3).alias("description")))
    empty = F.array().cast("array<struct<description:string>>")
    resp = F.struct(
        F.struct(F.when(F.col("turn") % 5 == 0, F.lit("quota exceeded"))
                 .otherwise(F.lit("")).alias("message")).alias("error"),
        F.when(F.col("turn") % 7 == 0, empty).otherwise(ann).alias("text_annotations"))
    return c.select(F.col("conv_id").alias("chapter_number"),
                    (F.col("turn") + 1).alias("page_number"),
                    F.to_json(resp).alias("response"))


def stored_pages(spark, sf_dir) -> DataFrame:
    """Page tasks whose image was stored: one per turn; the store failed
    (gcs_path NULL) when turn % 11 = 10."""
    c = table(spark, sf_dir, "conversations")
    page = F.col("turn") + 1
    return c.select(
        F.col("conv_id").alias("chapter_number"),
        page.alias("page_number"),
        scan_url(F.col("conv_id"), page).alias("image_url"),
        F.when(F.col("turn") % 11 == 10, F.lit(None).cast("string"))
        .otherwise(page_path(F.col("conv_id"), page))
        .alias("gcs_path"))


def mention_responses(spark, sf_dir) -> DataFrame:
    """One mention per turn as JSON text; fenced when turn is odd; truncated
    when turn % 5 = 4; speaker missing when turn % 3 = 0, null when turn % 3 = 1.

    Built in three projections: each text is used by several branches, and a
    separate projection keeps it computed once instead of re-inlined."""
    c = table(spark, sf_dir, "conversations")
    keys = [F.col("conv_id").alias("chapter_number"), (F.col("turn") + 1).alias("page_number")]
    base = F.to_json(F.struct(F.col("text").alias("phrase"),
                              (F.col("role") == "user").alias("luffy_says_it"),
                              (F.col("role") == "assistant").alias("about_luffy")))
    s1 = c.select(*keys, "turn", "role", base.alias("base"))
    inner = F.col("base").substr(F.lit(2), F.length("base"))  # without the leading '{'
    mention = (F.when(F.col("turn") % 3 == 0, F.col("base"))
               .when(F.col("turn") % 3 == 1, F.concat(F.lit('{"speaker":null,'), inner))
               .otherwise(F.concat(F.lit('{"speaker":"'), F.col("role"), F.lit('",'), inner)))
    s2 = s1.select("chapter_number", "page_number", "turn",
                   F.concat(F.lit('{"mentions":['), mention, F.lit("]}")).alias("doc"))
    doc = F.when(F.col("turn") % 5 == 4, F.col("doc").substr(F.lit(1), F.length("doc") - 3)) \
        .otherwise(F.col("doc"))
    s3 = s2.select("chapter_number", "page_number", "turn", doc.alias("doc"))
    raw = F.when(F.col("turn") % 2 == 1, F.concat(F.lit("```json\n"), F.col("doc"), F.lit("\n```"))) \
        .otherwise(F.col("doc"))
    return s3.select("chapter_number", "page_number", raw.alias("raw"))


# --------------------------------------------------------------------------
# part / lineitem / pages -> landed HTML pages
# --------------------------------------------------------------------------

def link_pages(spark, sf_dir) -> DataFrame:
    """Index pages of chapter links from ``part``: 20 parts per page
    (p_partkey div 20).  Per part one anchor ``/chapitre-{k}-vf/``; doubled when
    k % 7 = 0; plus ``/Chapitre-{k}-VF/`` when k % 11 = 0 (dropped: split is
    case-sensitive) and a half chapter ``/chapitre-{k}.5-vf/`` when k % 13 = 0."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey").cast("string")

    def a(href):
        return F.concat(F.lit('<a href="'), href, F.lit('">x</a>'))

    main = a(F.concat(F.lit(HOST + "/chapitre-"), k, F.lit("-vf/")))
    html = F.concat(
        main,
        F.when(F.col("p_partkey") % 7 == 0, main).otherwise(F.lit("")),
        F.when(F.col("p_partkey") % 11 == 0,
               a(F.concat(F.lit(HOST + "/Chapitre-"), k, F.lit("-VF/")))).otherwise(F.lit("")),
        F.when(F.col("p_partkey") % 13 == 0,
               a(F.concat(F.lit(HOST + "/chapitre-"), k, F.lit(".5-vf/")))).otherwise(F.lit("")),
    )
    parts = p.select(F.floor(F.col("p_partkey") / 20).alias("page_id"),
                     F.col("p_partkey"), html.alias("frag"))
    # Bounded group: at most 20 fragments per page, concatenated in key order.
    pages = parts.groupBy("page_id").agg(
        F.expr("listagg(frag, '') WITHIN GROUP (ORDER BY p_partkey)").alias("body"))
    return pages.select(
        F.col("page_id"),
        F.concat(F.lit(HOST + "/index/"), F.col("page_id").cast("string")).alias("url"),
        F.concat(F.lit("<html><body>"), F.col("body"), F.lit("</body></html>")).alias("html"))


def image_src(order: Column, line: Column) -> Column:
    return F.when(line % 3 == 0, F.concat(F.lit("/img/"), order.cast("string"), F.lit("/"),
                                          line.cast("string"), F.lit(".webp"))) \
        .otherwise(scan_url(order, line))


def image_pages(spark, sf_dir) -> DataFrame:
    """Chapter pages from ``lineitem``: one page per order (url of chapter
    o_orderkey), one ``<img data-src>`` per line; lines with l_linenumber % 3 = 0
    point to a ``.webp`` outside ``/scans/`` and are filtered out."""
    li = table(spark, sf_dir, "lineitem")
    frags = li.select(
        F.col("l_orderkey"), F.col("l_linenumber"),
        F.concat(F.lit('<img class="lazy" data-src="'),
                 image_src(F.col("l_orderkey"), F.col("l_linenumber")),
                 F.lit('" alt="">')).alias("frag"))
    # Bounded group: at most 7 lines per order, concatenated in line order.
    pages = frags.groupBy("l_orderkey").agg(
        F.expr("listagg(frag, '') WITHIN GROUP (ORDER BY l_linenumber)").alias("body"))
    return pages.select(
        F.col("l_orderkey").alias("page_id"),
        chapter_url(F.col("l_orderkey")).alias("url"),
        F.concat(F.lit("<html><body>"), F.col("body"), F.lit("</body></html>")).alias("html"))


def web_pages(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "pages")
