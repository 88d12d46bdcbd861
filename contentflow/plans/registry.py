"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory, run over the benchmark tables via the bindings.

Output conventions (shared with ``plans/oracle.py``): every computed column is
aliased; timestamps are returned as TIMESTAMP_NTZ (naive UTC), positions and
counts as BIGINT.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.html import lazy_image_srcs
from ..operators import analytics as A
from ..operators import frontier as FR
from ..operators import logs as L
from ..operators import mentions as M
from ..schemas import arcs_frame
from . import bindings as B

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def out(df: DataFrame) -> DataFrame:
    """Normalise output types: TIMESTAMP -> TIMESTAMP_NTZ, INT -> BIGINT."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# --------------------------------------------------------------------------
# Log roll-ups (flagship)
# --------------------------------------------------------------------------

@query("agg_weekly_failures")
def q_weekly_failures(spark, sf):
    return out(L.failures(B.logs(spark, sf), B.TEST_JOBS, as_of=B.AS_OF))


@query("agg_weekly_failures_literal")
def q_weekly_failures_literal(spark, sf):
    return out(L.failures(B.logs(spark, sf), B.TEST_JOBS, as_of=B.AS_OF, literal=True))


@query("agg_daily_failures")
def q_daily_failures(spark, sf):
    return out(L.failures(B.logs(spark, sf), B.TEST_JOBS, as_of=B.AS_OF, grain="DAY"))


@query("agg_all_logs_weekly")
def q_all_logs_weekly(spark, sf):
    return out(L.failures(B.logs(spark, sf), B.TEST_JOBS, as_of=B.AS_OF, min_severity=None))


# --------------------------------------------------------------------------
# Chapter analytics
# --------------------------------------------------------------------------

@query("agg_kpis")
def q_kpis(spark, sf):
    return out(A.kpis(B.chapters(spark, sf)))


@query("prj_explorer")
def q_explorer(spark, sf):
    return out(A.explore(B.chapters(spark, sf), 1, 100))


@query("win_centered_mean")
def q_centered_mean(spark, sf):
    ch = B.chapters(spark, sf).select("chapter_number", "image_count")
    return out(A.centered_mean(ch, ["chapter_number"], "image_count", 50, block=256))


@query("win_centered_mean_by_source")
def q_centered_mean_by_source(spark, sf):
    ch = B.chapters(spark, sf).select("source", "chapter_number", "image_count")
    return out(A.centered_mean(ch, ["chapter_number"], "image_count", 50, partition=["source"]))


@query("range_arcs")
def q_range_arcs(spark, sf):
    dim = arcs_frame(spark, extra=[("Beyond", 5000, 6000, "None")])
    return out(A.interval_counts(B.chapters(spark, sf), dim, "chapter_number"))


@query("agg_bucket_mean")
def q_bucket_mean(spark, sf):
    return out(A.bucket_mean(B.chapters(spark, sf)))


@query("srt_top10")
def q_top10(spark, sf):
    return out(A.top_k(B.chapters(spark, sf), "image_count", "chapter_number", 10))


@query("agg_watermark")
def q_watermark(spark, sf):
    return out(FR.watermark(B.chapters(spark, sf)))


# --------------------------------------------------------------------------
# Mention analytics
# --------------------------------------------------------------------------

@query("agg_mentions_per_chapter")
def q_mentions_per_chapter(spark, sf):
    return out(A.count_by(B.speakers(spark, sf)))


@query("agg_mention_kpis")
def q_mention_kpis(spark, sf):
    return out(A.mention_kpis(B.speakers(spark, sf)))


@query("agg_mention_split")
def q_mention_split(spark, sf):
    return out(A.mention_split(B.speakers(spark, sf, about_from="quality0")))


@query("srt_distinct_examples")
def q_distinct_examples(spark, sf):
    return out(A.distinct_examples(B.speakers(spark, sf)))


# --------------------------------------------------------------------------
# HTML extraction and the crawl frontier
# --------------------------------------------------------------------------

@query("html_anchor_links")
def q_anchor_links(spark, sf):
    return out(FR.anchor_links(B.web_pages(spark, sf)))


@query("html_chapter_links")
def q_chapter_links(spark, sf):
    links = FR.chapter_links(FR.anchor_links(B.link_pages(spark, sf)))
    return out(links.select("page_id", "href", "number", "value"))


@query("set_dedupe_first")
def q_dedupe_first(spark, sf):
    links = FR.chapter_links(FR.anchor_links(B.link_pages(spark, sf)))
    return out(FR.dedupe_first(links, "number", ["page_id", "pos"])
               .select("number", F.col("href").alias("url"), "page_id"))


@query("agg_total_available")
def q_total_available(spark, sf):
    return out(FR.total_available(FR.chapter_links(FR.anchor_links(B.link_pages(spark, sf)))))


@query("pipe_frontier")
def q_frontier(spark, sf):
    f = FR.frontier(B.link_pages(spark, sf), B.chapters(spark, sf))
    return out(f.select("number", "value", "url", "page_id"))


@query("pipe_frontier_strict")
def q_frontier_strict(spark, sf):
    f = FR.frontier(B.link_pages(spark, sf), B.chapters(spark, sf), strict=True)
    return out(f.select("number", "value", "url", "page_id"))


@query("srt_limit_mode")
def q_limit_mode(spark, sf):
    f = FR.frontier(B.link_pages(spark, sf), None, limit=25)
    return out(f.select("number", "value", "url", "page_id"))


@query("html_lazy_images")
def q_lazy_images(spark, sf):
    pages = B.image_pages(spark, sf)
    return out(pages.select("page_id", F.posexplode(lazy_image_srcs(F.col("html"))).alias("pos", "src")))


@query("html_image_count")
def q_image_count(spark, sf):
    pages = B.image_pages(spark, sf)
    return out(pages.select("page_id", F.size(F.coalesce(lazy_image_srcs(F.col("html")),
                                                         F.array())).alias("image_count")))


@query("pipe_chapters")
def q_pipe_chapters(spark, sf):
    f = FR.frontier(B.link_pages(spark, sf), B.chapters(spark, sf))
    return out(FR.build_chapters(f, B.image_pages(spark, sf), scraped_at=B.AS_OF))


# --------------------------------------------------------------------------
# Page work planning and text extraction
# --------------------------------------------------------------------------

@query("anti_chapter")
def q_anti_chapter(spark, sf):
    return out(FR.chapters_to_process(B.chapters(spark, sf), B.dialogues(spark, sf)))


@query("agg_distinct_keys")
def q_distinct_keys(spark, sf):
    return out(FR.processed_keys(B.dialogues(spark, sf), ["chapter_number"]))


@query("pipe_page_tasks")
def q_page_tasks(spark, sf):
    return out(FR.page_tasks(B.chapters(spark, sf), B.dialogues(spark, sf), B.image_pages(spark, sf)))


@query("pipe_dialogues")
def q_dialogues(spark, sf):
    return out(FR.build_dialogues(B.stored_pages(spark, sf), B.ocr_responses(spark, sf),
                                  processed_at=B.AS_OF))


# --------------------------------------------------------------------------
# Mentions
# --------------------------------------------------------------------------

TEST_PHRASE = "de la"


@query("flt_phrase")
def q_phrase(spark, sf):
    d = B.dialogues(spark, sf).select("chapter_number", "page_number", "extracted_text")
    return out(M.with_phrase(d, TEST_PHRASE))


@query("pipe_mentions_from_responses")
def q_mentions_from_responses(spark, sf):
    rows, _bad = M.mentions_from_responses(B.mention_responses(spark, sf))
    return out(rows)


@query("agg_distinct_pages")
def q_distinct_pages(spark, sf):
    rows, _bad = M.mentions_from_responses(B.mention_responses(spark, sf))
    return out(FR.processed_keys(rows, ["chapter_number", "page_number"]))


@query("pipe_mention_worklist")
def q_mention_worklist(spark, sf):
    rows, _bad = M.mentions_from_responses(B.mention_responses(spark, sf))
    return out(M.mention_worklist(B.dialogues(spark, sf), rows, TEST_PHRASE))


@query("pipe_mentions_rules")
def q_mentions_rules(spark, sf):
    return out(M.mentions_by_rules(B.dialogues(spark, sf), TEST_PHRASE))


def new_scratch(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the session's (shared) checkpoint directory."""
    from ..session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{tag}-{uuid.uuid4().hex}"


# Monitoring, budget, audit, billing, sources and streaming queries register
# themselves on import.
from . import registry_ops as _ops  # noqa: E402,F401
from . import registry_io as _io  # noqa: E402,F401


@query("src_chapters")
def q_src_chapters(spark, sf):
    from ..sources.io import scan_chapters
    return out(scan_chapters(B.chapters(spark, sf)))


@query("src_speakers")
def q_src_speakers(spark, sf):
    from ..sources.io import scan_speakers
    return out(scan_speakers(B.speakers(spark, sf)))


@query("pipe_page_ledger")
def q_page_ledger(spark, sf):
    return out(M.page_ledger(B.mention_responses(spark, sf)))


@query("pipe_mention_worklist_ledger")
def q_worklist_ledger(spark, sf):
    ledger = M.page_ledger(B.mention_responses(spark, sf))
    return out(M.mention_worklist_from_ledger(B.dialogues(spark, sf), ledger, TEST_PHRASE))

from . import registry_inventory as _inv  # noqa: E402,F401
from . import registry_scalars as _scl  # noqa: E402,F401
