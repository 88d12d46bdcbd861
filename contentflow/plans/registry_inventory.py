"""One registered query per remaining inventory operator:
single filters, scans, sinks, window pieces and raw aligners/reducers that
the composite queries use internally."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.html import link_number_text
from ..functions.text import is_float_text, trunc_long
from ..operators import analytics as A
from ..operators import audit as AU
from ..operators import budget as BU
from ..operators import frontier as FR
from ..operators import logs as L
from ..operators import mentions as M
from ..operators import timeseries as TS
from ..schemas import DIALOGUES, MANIFEST
from ..sources import io as IO
from ..sources import tables as TB
from ..streaming import jobs as S
from . import bindings as B
from . import weekly as W
from .registry import TEST_PHRASE, out, query
from .registry_ops import BILLING_AS_OF

LABELS_SCHEMA = "doc_id bigint, quality int, toxic int"


def _r9(df, col="value"):
    return df.withColumn(col, F.round(F.col(col), 9))


# ------------------------------------------------------------------ sources
@query("src_pages")
def q_src_pages(spark, sf):
    return out(IO.read_pages(spark, f"{sf}/pages.parquet"))


@query("src_shard_suffix")
def q_src_shard_suffix(spark, sf):
    b = IO.shard_between(B.billing(spark, sf), "19960101", "19961231", "suffix")
    return out(b.groupBy("suffix").agg(F.count(F.lit(1)).alias("n_rows")))


@query("src_partition_day")
def q_src_partition_day(spark, sf):
    b = IO.recent_ingest(B.billing(spark, sf), as_of=BILLING_AS_OF, days=30)
    return out(b.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n_rows")))


@query("src_optional_table")
def q_src_optional_table(spark, sf):
    from pyspark.sql import types as T
    schema = T._parse_datatype_string(LABELS_SCHEMA)
    return out(IO.optional_table(spark, f"{sf}/labels.parquet", schema))


# ------------------------------------------------------------------ sinks
@query("snk_manifest")
def q_snk_manifest(spark, sf):
    path = S.scratch(spark, "manifest-docs")
    ch = B.chapters(spark, sf).withColumn("batch", F.floor(F.col("chapter_number") / 100)) \
        .withColumn("scraped_at", F.lit("2024-01-31T00:00:00+00:00"))
    IO.write_manifests(ch, path, batch="batch")
    docs = spark.read.schema(MANIFEST).json(path)
    return out(docs.select("manga", "source", "language", "total_chapters_available",
                           F.size("chapters").cast("long").alias("n_chapters")))


@query("snk_manifest_document")
def q_snk_manifest_document(spark, sf):
    """SNK-01: all chapters as one document that many tasks write, read back line by line."""
    path = S.scratch(spark, "manifest-document")
    IO.write_manifest_document(B.chapters(spark, sf).withColumn("scraped_at", F.lit("2024-01-31T00:00:00+00:00")), path)
    rows = IO.read_manifest_document(spark, path)
    return out(rows.select("manga", "total_chapters_available", F.col("chapter_number").cast("long").alias("chapter_number"),
                           "url", "image_count", "scraped_at"))


@query("prj_format_chapter")
def q_prj_format_chapter(spark, sf):
    """Manifest chapters where ``image_count`` is absent for every 9th chapter
    (the key is omitted from the JSON) -> formatted rows with 0 there."""
    path = S.scratch(spark, "manifest-missing")
    ch = (B.chapters(spark, sf)
          .withColumn("image_count", F.when(F.col("chapter_number") % 9 == 0, F.lit(None))
                      .otherwise(F.col("image_count")))
          .withColumn("batch", F.floor(F.col("chapter_number") / 100))
          .withColumn("scraped_at", F.lit("2024-01-31T00:00:00+00:00")))
    IO.write_manifests(ch, path, batch="batch")
    return out(FR.format_manifest_chapters(IO.read_manifest(spark, path)))


@query("snk_batch_append")
def q_snk_batch_append(spark, sf):
    """Idempotent append run twice: the second run adds nothing."""
    path = S.scratch(spark, "append")
    ch = B.chapters(spark, sf).select("chapter_number", "url", "image_count")
    IO.append(ch, path, keys=["chapter_number"])
    IO.append(ch, path, keys=["chapter_number"])
    return out(spark.read.parquet(path))


@query("snk_chapter_append")
def q_snk_chapter_append(spark, sf):
    """Streaming per-batch append, replayed from scratch twice into the same
    table: keys already present are skipped."""
    path = S.scratch(spark, "by-batch")
    for _ in range(2):
        stream = S.file_stream(spark, sf, "documents").select(
            F.col("doc_id").alias("chapter_number"), F.col("n_chars").alias("image_count"))
        S.append_by_batch(stream, path, ["chapter_number"], S.scratch(spark, "by-batch-ckpt")) \
            .awaitTermination()
    return out(spark.read.parquet(path))


@query("snk_create_if_absent")
def q_snk_create_if_absent(spark, sf):
    name = "dialogues_" + uuid.uuid4().hex[:12]
    IO.create_if_absent(spark, name, DIALOGUES, S.scratch(spark, "tbl"))
    IO.create_if_absent(spark, name, DIALOGUES)
    rows = FR.build_dialogues(B.stored_pages(spark, sf), B.ocr_responses(spark, sf),
                              processed_at=B.AS_OF)
    rows.select(*[f.name for f in DIALOGUES.fields]).write.insertInto(name)
    return out(spark.table(name))


@query("snk_route_logs")
def q_snk_route_logs(spark, sf):
    r = L.route_logs(B.logs(spark, sf), B.TEST_JOBS)
    return out(r.groupBy("log_date", F.col("resource.labels.job_name").alias("job_name"))
               .agg(F.count(F.lit(1)).alias("n_rows")))


@query("snk_snapshot")
def q_snk_snapshot(spark, sf):
    snap = A.snapshot(B.chapters(spark, sf))
    try:  # one row of figures; the cached rows go at once
        kpi = A.kpis(snap)
        return out(spark.createDataFrame(kpi.collect(), kpi.schema))
    finally:
        snap.unpersist()


# ------------------------------------------------------------------ html / filters
@query("html_link_number")
def q_html_link_number(spark, sf):
    links = FR.anchor_links(B.link_pages(spark, sf))
    num = link_number_text(F.col("href"))
    return out(links.select("href", num.alias("number"), is_float_text(num).alias("is_number")))


@query("flt_severity_at_least")
def q_flt_severity(spark, sf):
    lg = B.logs(spark, sf)
    return out(lg.where(L.severity_at_least("severity", "ERROR"))
               .select("ts", "severity", F.col("resource.labels.job_name").alias("job_name")))


@query("flt_jobs")
def q_flt_jobs(spark, sf):
    lg = B.logs(spark, sf)
    return out(lg.where(L.job_name_col(lg).isin(B.TEST_JOBS))
               .select("ts", F.col("resource.labels.job_name").alias("job_name")))


@query("flt_recent")
def q_flt_recent(spark, sf):
    lg = B.logs(spark, sf)
    return out(lg.where(L.recent("ts", as_of="2024-02-15 00:00:00", months=1)).select("ts", "severity"))


@query("flt_log_payload")
def q_flt_log_payload(spark, sf):
    lg = B.logs(spark, sf)
    return out(lg.where(L.payload_matches("purchase|signup", B.TEST_JOBS))
               .select("ts", F.col("resource.labels.job_name").alias("job_name"), "text_payload"))


@query("flt_audit_like")
def q_flt_audit_like(spark, sf):
    return out(AU.audit_access(B.audit_log(spark, sf), resource_like="%tables/%", method_like="%insert%",
                               fields=("principal", "method", "resource")))


@query("flt_bool_mask")
def q_flt_bool_mask(spark, sf):
    sp = B.speakers(spark, sf, about_from="quality0")
    return out(sp.where(F.col("about_luffy") & ~F.col("luffy_says_it")).select("chapter_number", "page_number"))


@query("flt_after_watermark")
def q_flt_after_watermark(spark, sf):
    links = FR.chapter_links(FR.anchor_links(B.link_pages(spark, sf)))
    wm = B.chapters(spark, sf).select(F.coalesce(F.max("chapter_number"), F.lit(0))).scalar()
    return out(links.where(trunc_long(F.col("value")) > wm).select("number", "href"))


# ------------------------------------------------------------------ joins / sets / sorts
@query("join_incremental")
def q_join_incremental(spark, sf):
    f = FR.frontier(B.link_pages(spark, sf), B.chapters(spark, sf))
    return out(f.select("number", "value"))


@query("anti_page")
def q_anti_page(spark, sf):
    rows, _ = M.mentions_from_responses(B.mention_responses(spark, sf))
    pages = M.with_phrase(B.dialogues(spark, sf).select("chapter_number", "page_number", "extracted_text"),
                          TEST_PHRASE)
    return out(FR.difference(pages, rows, ["chapter_number", "page_number"])
               .select("chapter_number", "page_number"))


@query("set_difference")
def q_set_difference(spark, sf):
    """Bag difference: one row per order line whose order has no dialogue."""
    lines = B.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("chapter_number"))
    done = B.dialogues(spark, sf).select("chapter_number")
    return out(FR.difference(lines, done, ["chapter_number"], null_safe=False))


@query("set_distinct_pairs")
def q_set_distinct_pairs(spark, sf):
    sp = B.speakers(spark, sf)
    return out(sp.where(F.col("luffy_says_it")).select("chapter_number", "phrase").dropDuplicates())


@query("srt_numeric")
def q_srt_numeric(spark, sf):
    links = FR.chapter_links(FR.anchor_links(B.link_pages(spark, sf)))
    d = FR.dedupe_first(links, "number", ["page_id", "pos"])
    return out(d.orderBy("value", "page_id", "pos").select("number", "value"))


@query("srt_work_limit")
def q_srt_work_limit(spark, sf):
    return out(FR.chapters_to_process(B.chapters(spark, sf), B.dialogues(spark, sf), limit=10))


@query("srt_latest_audit")
def q_srt_latest_audit(spark, sf):
    return out(AU.audit_latest(B.audit_log(spark, sf), as_of="2024-01-15", k=100))


@query("srt_pages")
def q_srt_pages(spark, sf):
    d = M.with_phrase(B.dialogues(spark, sf), TEST_PHRASE)
    return out(d.orderBy("chapter_number", "page_number").select("chapter_number", "page_number"))


# ------------------------------------------------------------------ windows
@query("win_is_max")
def q_win_is_max(spark, sf):
    return out(A.bucket_mean(B.chapters(spark, sf)).where("is_max").select("bucket", "mean"))


@query("win_top_rank")
def q_win_top_rank(spark, sf):
    return out(A.top_k(B.chapters(spark, sf)).select("chapter_number", "position", "weight"))


@query("win_page_number")
def q_win_page_number(spark, sf):
    """Page numbers are positions in the image list; pages whose upload failed
    ((chapter + page) % 5 = 0 here) are dropped afterwards, so gaps stay."""
    t = FR.page_tasks(B.chapters(spark, sf), B.dialogues(spark, sf), B.image_pages(spark, sf))
    return out(t.where((F.col("chapter_number") + F.col("page_number")) % 5 != 0)
               .select("chapter_number", "page_number", "image_url"))


WIN_BUDGET = 20_000_000.0


@query("win_budget_crossing")
def q_win_budget_crossing(spark, sf):
    li = B.table(spark, sf, "lineitem").select(
        F.col("l_shipdate").cast("timestamp").alias("ts"), F.col("l_extendedprice").alias("cost"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"))
    return out(BU.budget_crossings(li, amount=WIN_BUDGET, tiebreak="id"))


# ------------------------------------------------------------------ raw aligners / reducers
def _exec_ones(spark, sf):
    return B.executions(spark, sf).select("ts", "job_name", "result", F.lit(1).alias("value"))


@query("align_rate")
def q_align_rate(spark, sf):
    return out(TS.align(_exec_ones(spark, sf), ["job_name", "result"], "rate", "60 seconds"))


@query("align_sum")
def q_align_sum(spark, sf):
    return out(TS.align(_exec_ones(spark, sf), ["job_name", "result"], "sum", "1 hour"))


@query("align_mean")
def q_align_mean(spark, sf):
    ex = B.executions(spark, sf).select("ts", "job_name", F.col("execution_time").alias("value"))
    return out(_r9(TS.align(ex, ["job_name"], "mean", "1 hour")))


@query("align_fraction_true")
def q_align_fraction_true(spark, sf):
    up = B.uptime(spark, sf).select("ts", "host", "region", F.col("check_passed").alias("value"))
    return out(_r9(TS.align(up, ["host", "region"], "fraction_true", "60 seconds")))


@query("reduce_sum")
def q_reduce_sum(spark, sf):
    a = TS.align(_exec_ones(spark, sf), ["job_name", "result"], "sum", "1 hour")
    return out(TS.reduce_series(a, ["result"], "sum"))


@query("reduce_mean")
def q_reduce_mean(spark, sf):
    up = B.uptime(spark, sf).select("ts", "host", "region", F.col("check_passed").alias("value"))
    a = TS.align(up, ["host", "region"], "fraction_true", "1 hour")
    return out(_r9(TS.reduce_series(a, ["host"], "mean")))


@query("uptime_series")
def q_uptime_series(spark, sf):
    return out(B.uptime(spark, sf))


@query("html_link_quarantine")
def q_html_link_quarantine(spark, sf):
    """SCL-03: what the crawl job puts aside: links that look like chapters but carry
    no usable number."""
    chapters, links = S.scratch(spark, "crawl"), S.scratch(spark, "crawl-links")
    W.crawl(spark, B.link_pages(spark, sf), B.image_pages(spark, sf), chapters, scraped_at=B.AS_OF, limit=25, links_path=links)
    return out(spark.read.parquet(links).select("page_id", "href", "reason"))


@query("budget_quarantine")
def q_budget_quarantine(spark, sf):
    """SRC-08: messages that cannot be read, each with its reason."""
    ev = B.table(spark, sf, "events")
    kind = F.col("user_id") % 7
    body = (F.when(kind == 4, "[1]").when(kind == 5, '{"costAmount":"x","budgetAmount":5}')
            .when(kind == 6, '{"costAmount":1,"budgetAmount":null}').otherwise('{"costAmount":1,"budgetAmount":5}'))
    data = F.when(kind == 3, F.lit("{not base64")).otherwise(F.base64(F.encode(body, "UTF-8")))
    return out(BU.budget_quarantine(ev.select(F.col("event_id").alias("message_id"), data.alias("data"))).select("message_id", "reason"))


@query("pipe_unnumbered_chapters")
def q_pipe_unnumbered_chapters(spark, sf):
    """PIP-03 with chapters of which every fifth has no number, only a label: the page
    tasks that no dialogue row holds yet."""
    half = F.col("chapter_number") % 5 == 0

    def labelled(df):
        return df.withColumn("chapter_label", F.when(half, F.concat(F.col("chapter_number").cast("string"), F.lit(".5")))
                             .otherwise(F.col("chapter_number").cast("string"))).withColumn(
            "chapter_number", F.when(~half, F.col("chapter_number")))
    tasks = FR.open_page_tasks(labelled(B.chapters(spark, sf)), labelled(B.dialogues(spark, sf)), B.image_pages(spark, sf))
    return out(tasks.select("chapter_label", "chapter_number", "page_number", "image_url", "gcs_path"))


@query("snk_batch_replace")
def q_snk_batch_replace(spark, sf):
    """SNK-02 with co-located keys: two batches that overlap, the second one run twice."""
    name, path = "appended_" + uuid.uuid4().hex[:12], S.scratch(spark, "bucketed")
    ch = B.chapters(spark, sf).select("chapter_number", "url", "image_count")
    for batch, rows in (("a", ch.where("chapter_number % 3 < 2")), ("b", ch.where("chapter_number % 3 > 0")), ("b", ch.where("chapter_number % 3 > 0"))):
        TB.append_batch(rows, name, path, ["chapter_number"], batch, buckets=8)
    return out(spark.table(name).select("chapter_number", "url", "image_count", F.col(TB.BATCH).alias("batch")))


@query("stream_chapter_append")
def q_stream_chapter_append(spark, sf):
    """SNK-03 with row-level errors: good and bad rows of each micro-batch, two replays."""
    path = S.scratch(spark, "checked")
    number = F.col("raw_number").try_cast("long")
    rules = {"no_number": number.isNotNull(), "no_images": F.col("image_count") > 0}
    parse = {"chapter_number": number, "image_count": F.col("image_count")}
    for _ in range(2):
        raw = S.file_stream(spark, sf, "documents").select(
            F.when(F.col("doc_id") % 10 == 3, F.concat(F.lit("x"), F.col("doc_id").cast("string"))).otherwise(F.col("doc_id").cast("string")).alias("raw_number"),
            F.when(F.col("doc_id") % 10 == 6, F.lit(0)).otherwise(F.col("n_chars")).cast("long").alias("image_count"))
        TB.append_checked(raw, path, rules, parse, S.scratch(spark, "checked-ckpt")).awaitTermination()
    kinds = {"rows": T._parse_datatype_string("chapter_number bigint, image_count bigint"),
             "bad": T._parse_datatype_string("raw_number string, image_count bigint, reason string")}
    rows, bad = TB.read_checked(spark, path, kinds, ["chapter_number"])
    none = F.lit(None).cast("string")
    return out(rows.select("chapter_number", none.alias("raw_number"), "image_count", none.alias("reason")).unionByName(
        bad.select(F.lit(None).cast("long").alias("chapter_number"), "raw_number", "image_count", "reason")))


@query("src_drifting_shards")
def q_src_drifting_shards(spark, sf):
    """SRC-05 over shards of which one has a further column and one a wider type."""
    path = S.scratch(spark, "drift")
    ev = B.table(spark, sf, "events").select("event_id", "user_id", "value")
    third = F.col("event_id") % 3
    ev.where(third == 0).select(F.col("event_id").cast("int").alias("event_id"), F.col("user_id").cast("int").alias("user_id")).write.parquet(f"{path}/s0")
    ev.where(third == 1).select("event_id", F.col("user_id").cast("int").alias("user_id"), "value").write.parquet(f"{path}/s1")
    ev.where(third == 2).select("event_id", F.col("user_id").cast("double").alias("user_id"), "value").write.parquet(f"{path}/s2")
    return out(IO.read_sharded(spark, f"{path}/*/*.parquet"))


@query("src_partition_days")
def q_src_partition_days(spark, sf):
    """SRC-07 over a table written by day: the last seven days are pruned to, and days
    that had failed secret reads prune by a join."""
    path = S.scratch(spark, "audit-days")
    TB.write_partitioned(B.audit_log(spark, sf), path, "ingest_date")
    log = spark.read.parquet(path)
    recent = IO.recent_ingest(log, as_of=B.AS_OF, days=7)
    busy = TB.in_days_of(log, recent.where("payload.method = 'AccessSecretVersion'"), "ingest_date")
    return out(busy.groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("payload.principal").alias("n_principals")))
