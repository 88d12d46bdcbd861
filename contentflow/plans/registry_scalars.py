"""One registered query per scalar helper (SCL-01..18).

Each helper is a ``Column -> Column`` expression; the query applies it to a
whole table (all rows, whole texts), so the work grows with the data.  Per-row
expressions and higher-order array functions only: no shuffle unless the query
reports a grouped count.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import jsonx as J
from ..functions import text as X
from ..operators import mentions as M
from ..operators.logs import job_name_col
from ..schemas import MENTION_DEFAULTS
from . import bindings as B
from .registry import out, query

# Sentence and token separators used by the whole-text scalar queries.
SENTENCE_SPLIT = "[.!?]"
TOKEN_SPLIT = X.WS_CLASS + "+"


# ------------------------------------------------------------------ text
@query("scl_collapse_ws")
def q_scl_collapse_ws(spark, sf):
    d = B.dialogues(spark, sf)
    return out(d.select("chapter_number", "page_number",
                        X.collapse_ws("extracted_text").alias("folded")))


@query("scl_strip")
def q_scl_strip(spark, sf):
    """Every document split into sentence pieces, each piece stripped.  The
    arrays are built in their own projections (each is used several times;
    Catalyst keeps such projections apart instead of re-inlining them)."""
    d = B.table(spark, sf, "documents")
    raw = d.select("doc_id", F.split(F.col("text"), SENTENCE_SPLIT).alias("raw"))
    st = raw.select("doc_id", "raw", F.transform("raw", lambda p: X.strip_ws(p)).alias("pieces"))
    return out(st.select(
        "doc_id",
        F.size(F.filter("pieces", lambda p: p != F.lit(""))).alias("n_pieces"),
        F.length(F.array_join("pieces", "")).cast("long").alias("n_chars"),
        F.size(F.filter(F.arrays_zip(F.col("raw").alias("r"), F.col("pieces").alias("s")),
                        lambda z: F.length(z["r"]) != F.length(z["s"]))).alias("n_trimmed")))


@query("scl_is_float")
def q_scl_is_float(spark, sf):
    """Whitespace tokens of every document; count and range of plain decimals."""
    d = B.table(spark, sf, "documents")
    toks = d.select("doc_id", F.filter(F.split(F.col("text"), TOKEN_SPLIT),
                                       lambda t: t != F.lit("")).alias("toks"))
    nums = toks.select("doc_id", F.size("toks").alias("n_tokens"),
                       F.filter("toks", lambda t: X.is_float_text(t)).alias("nums"))
    vals = nums.select("doc_id", "n_tokens", F.size("nums").alias("n_numeric"),
                       F.transform("nums", lambda t: X.float_value(t)).alias("vals"))
    return out(vals.select("doc_id", "n_tokens", "n_numeric",
                           F.array_min("vals").alias("min_value"),
                           F.array_max("vals").alias("max_value")))


@query("scl_trunc")
def q_scl_trunc(spark, sf):
    ev = B.table(spark, sf, "events")
    return out(ev.select("event_id", "value", X.trunc_long("value").alias("value_trunc")))


# ------------------------------------------------------------------ paths, time
@query("scl_object_path")
def q_scl_object_path(spark, sf):
    li = B.table(spark, sf, "lineitem")
    url = B.image_src(F.col("l_orderkey"), F.col("l_linenumber"))
    return out(li.select(F.col("l_orderkey").alias("chapter_number"),
                         F.col("l_linenumber").alias("page_number"),
                         url.alias("image_url"),
                         X.object_path("l_orderkey", "l_linenumber", url).alias("gcs_path")))


@query("scl_mime")
def q_scl_mime(spark, sf):
    li = B.table(spark, sf, "lineitem")
    url = B.image_src(F.col("l_orderkey"), F.col("l_linenumber"))
    return out(li.groupBy(X.mime_type(url).alias("mime"))
               .agg(F.count(F.lit(1)).alias("n_images")))


@query("scl_iso_utc")
def q_scl_iso_utc(spark, sf):
    ev = B.table(spark, sf, "events")
    return out(ev.select("event_id", X.iso_utc(F.col("ts").cast("timestamp")).alias("ts_iso")))


@query("scl_week_day")
def q_scl_week_day(spark, sf):
    lg = B.logs(spark, sf)
    return out(lg.groupBy(F.date_trunc("WEEK", "ts").alias("week_start"),
                          F.date_trunc("DAY", "ts").alias("day_start"))
               .agg(F.count(F.lit(1)).alias("n_logs")))


@query("scl_bucket_label")
def q_scl_bucket_label(spark, sf):
    d = B.table(spark, sf, "documents")
    b = X.bucket_floor("n_chars", 1000)
    return out(d.groupBy(b.alias("bucket"))
               .agg(F.count(F.lit(1)).alias("n_docs"))
               .select("bucket", X.bucket_label("bucket", 1000).alias("label"), "n_docs"))


# ------------------------------------------------------------------ JSON, base64
@query("scl_json_lenient")
def q_scl_json_lenient(spark, sf):
    r = B.mention_responses(spark, sf)
    v = J.lenient_json("raw")
    plain = F.try_parse_json(X.strip_ws("raw"))
    return out(r.select("chapter_number", "page_number", F.explode(F.array(v)).alias("_v"),
                        plain.isNull().alias("fenced"))
               .select("chapter_number", "page_number",
                       F.col("_v").isNotNull().alias("parsed"),
                       (F.col("_v").isNotNull() & F.col("fenced")).alias("fenced"),
                       F.when(F.col("_v").isNotNull(),
                              F.size(F.try_variant_get("_v", "$.mentions", "array<variant>")))
                       .cast("long").alias("n_mentions")))


@query("scl_json_default")
def q_scl_json_default(spark, sf):
    r = B.mention_responses(spark, sf)
    m = (r.select("chapter_number", "page_number",
                  F.explode(F.try_variant_get(J.lenient_json("raw"), "$.mentions", "array<variant>"))
                  .alias("m")))
    present = F.variant_get("m", "$.speaker", "variant").isNotNull()
    state = (F.when(~present, F.lit("missing"))
             .when(F.try_variant_get("m", "$.speaker", "string").isNull(), F.lit("null"))
             .otherwise(F.lit("value")))
    return out(m.select("chapter_number", "page_number",
                        J.get_or_default(F.col("m"), "speaker", "string",
                                         MENTION_DEFAULTS["speaker"]).alias("speaker"),
                        state.alias("speaker_state")))


@query("scl_base64")
def q_scl_base64(spark, sf):
    msgs = B.budget_messages(spark, sf)
    return out(msgs.select("message_id", X.decode_base64_text("data").alias("body")))


# ------------------------------------------------------------------ numbers
@query("scl_number_format")
def q_scl_number_format(spark, sf):
    """``{:.1f}`` of prices (two-decimal values, so exact ties occur),
    ``{:,}`` of quantities in thousandths, ``{:.2%}`` of discounts."""
    li = B.table(spark, sf, "lineitem")
    return out(li.select("l_orderkey", "l_linenumber",
                         X.fixed_text("l_extendedprice", 1).alias("price_text"),
                         X.thousands(F.col("l_quantity") * F.lit(1000)).alias("qty_text"),
                         X.percent_text("l_discount", 2).alias("discount_text")))


@query("scl_ratio")
def q_scl_ratio(spark, sf):
    msgs = B.budget_messages(spark, sf)
    body = F.from_json(X.decode_base64_text("data"), "costAmount double, budgetAmount double")
    return out(msgs.select("message_id", body.alias("b"))
               .select("message_id",
                       X.safe_ratio(F.coalesce("b.costAmount", F.lit(0.0)),
                                    F.coalesce("b.budgetAmount", F.lit(0.0))).alias("ratio")))


@query("scl_first_annotation")
def q_scl_first_annotation(spark, sf):
    r = B.ocr_responses(spark, sf)
    return out(r.select("chapter_number", "page_number",
                        J.first_annotation_text("response").alias("text")))


@query("scl_label_extract")
def q_scl_label_extract(spark, sf):
    lg = B.logs(spark, sf)
    return out(lg.groupBy(job_name_col(lg).alias("job_name"), "severity",
                          F.get_json_object("json_payload", "$.k").alias("label"))
               .agg(F.count(F.lit(1)).alias("n_logs")))


@query("scl_prompt")
def q_scl_prompt(spark, sf):
    d = B.dialogues(spark, sf)
    return out(d.select("chapter_number", "page_number", M.request_text().alias("request")))


@query("scl_chapter_labels")
def q_scl_chapter_labels(spark, sf):
    ch = B.chapters(spark, sf)
    return out(ch.select("chapter_number",
                         X.chapter_label("chapter_number").alias("chapter_label"),
                         X.pages_label("image_count").alias("pages_label"),
                         X.chap_label("chapter_number").alias("chap_label")))
