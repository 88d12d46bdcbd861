"""Crawl frontier and page-level work planning (HTM-01..05, SET-01, SET-03,
SRT-01..03, JN-01, JN-02, AGG-01, AGG-10, AGG-13, PIP-01..04, PRJ-01).

HTML is only ever touched row-wise in the scan stage (regex extraction); the
joins that follow carry the small extracted columns (url, hrefs, image lists)
rather than whole pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import anchor_hrefs, lazy_image_srcs, link_number_text
from ..functions.jsonx import first_annotation_text
from ..functions.text import float_value, mime_type, object_path, trunc_double, trunc_long
from ..schemas import CRAWL_LANGUAGE, CRAWL_SOURCE


def anchor_links(pages: DataFrame, html: str = "html", page_id: str = "page_id") -> DataFrame:
    """HTM-01: (page_id, pos, href) for every ``<a href>``, in document order."""
    return pages.select(F.col(page_id).alias("page_id"),
                        F.posexplode(anchor_hrefs(F.col(html))).alias("pos", "href"))


def anchor_links_parsed(pages: DataFrame, html: str = "html", page_id: str = "page_id") -> DataFrame:
    """HTM-01 fallback: the same (page_id, pos, href) rows from Python's
    standard-library HTML parser, per partition through ``mapInPandas`` (Arrow
    batches; no shuffle).  For markup the regex path does not cover; it is the
    slow path and also serves as its cross-check."""
    def parse(batches):
        import pandas as pd
        from html.parser import HTMLParser

        class Anchors(HTMLParser):
            def __init__(self):
                super().__init__()
                self.hrefs = []

            def handle_starttag(self, tag, attrs):
                if tag == "a":
                    found = [v for k, v in attrs if k == "href" and v is not None]
                    self.hrefs += found[-1:]  # of a repeated attribute the last counts

        for b in batches:
            ids, pos, hrefs = [], [], []
            for pid, doc in zip(b["page_id"], b["html"]):
                if doc is None:
                    continue
                p = Anchors()
                p.feed(doc)
                p.close()
                ids += [pid] * len(p.hrefs)
                pos += range(len(p.hrefs))
                hrefs += p.hrefs
            yield pd.DataFrame({"page_id": pd.Series(ids, dtype="int64"),
                                "pos": pd.Series(pos, dtype="int32"),
                                "href": pd.Series(hrefs, dtype="object")})

    return (pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(html).alias("html"))
            .mapInPandas(parse, "page_id long, pos int, href string"))


def chapter_links(links: DataFrame, must=("chapitre", "vf"), sep: str = "chapitre-",
                  end: str = "-vf") -> DataFrame:
    """HTM-02/03: keep hrefs containing every ``must`` word (case-insensitive)
    whose number text (between ``sep`` and ``end``, case-sensitive) is a plain
    decimal.  Adds ``number`` (text) and ``value`` (double)."""
    low = F.lower(F.col("href"))
    cond = F.lit(True)
    for m in must:
        cond = cond & low.contains(m)
    num = link_number_text(F.col("href"), sep, end)
    return (links.where(cond).withColumn("number", num)
            .withColumn("value", float_value(F.col("number")))
            .where(F.col("value").isNotNull()))


def link_quarantine(links: DataFrame, must=("chapitre", "vf"), sep: str = "chapitre-",
                    end: str = "-vf") -> DataFrame:
    """Hrefs that pass the word test of ``chapter_links`` but carry no usable number:
    ``reason`` is ``no_number`` (the separators do not occur) or ``not_decimal``."""
    low = F.lower(F.col("href"))
    cond = F.lit(True)
    for m in must:
        cond = cond & low.contains(m)
    out = links.where(cond).withColumn("number", link_number_text(F.col("href"), sep, end))
    out = out.withColumn("_v", float_value(F.col("number"))).where(F.col("_v").isNull()).drop("_v")
    return out.withColumn("reason", F.when(F.col("number").isNull(), F.lit("no_number")).otherwise(F.lit("not_decimal")))


def dedupe_first(df: DataFrame, key: list[str] | str, order: list[str]) -> DataFrame:
    """SET-01: one row per ``key`` -- the first in ``order``.  Implemented as a
    partial-aggregating ``min(struct(order, rest))``: a hot key is reduced
    inside each task before the shuffle."""
    key = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in key and c not in order]
    agg = df.groupBy(*key).agg(F.min(F.struct(*order, *rest)).alias("_r"))
    return agg.select(*key, *[F.col("_r")[c].alias(c) for c in order + rest]).select(*df.columns)


def watermark(df: DataFrame, col: str = "chapter_number") -> DataFrame:
    """AGG-01: one row ``last_chapter`` = max(col), 0 when empty or NULL."""
    return df.agg(F.coalesce(F.max(col), F.lit(0)).cast("long").alias("last_chapter"))


def total_available(links: DataFrame) -> DataFrame:
    """AGG-13: number of unique chapter numbers (text) in the frontier."""
    return links.agg(F.count_distinct("number").alias("total_chapters_available"))


def frontier(pages: DataFrame, chapters: DataFrame | None, *, limit: int = 0,
             strict: bool = False) -> DataFrame:
    """PIP-01: pages -> links -> keep-first per number -> numeric order ->
    (a) chapters past the watermark of ``chapters`` (JN-01), or (b) with
    ``limit > 0`` the first ``limit`` chapters, watermark bypassed (SRT-02).

    The watermark is a scalar subquery: one aggregate, inlined as a literal."""
    links = chapter_links(anchor_links(pages))
    uniq = dedupe_first(links, "number", ["page_id", "pos"])
    ordered_cols = [F.col("value"), F.col("page_id"), F.col("pos")]
    if limit > 0:
        out = uniq.orderBy(*ordered_cols).limit(limit)
    else:
        wm = (chapters.select(F.coalesce(F.max("chapter_number"), F.lit(0)).cast("long")).scalar()
              if chapters is not None else F.lit(0))
        past = (F.col("value") > wm) if strict else (trunc_double(F.col("value")) > wm)
        out = uniq.where(past).orderBy(*ordered_cols)
    return out.select("number", "value", F.col("href").alias("url"), "page_id", "pos")


def image_lists(pages: DataFrame, html: str = "html", wanted: DataFrame | None = None) -> DataFrame:
    """HTM-04: (url, images) per chapter url: those of its latest landing (the largest
    ``page_id``, where there is one).  ``wanted``: only pages whose url it holds are parsed."""
    if wanted is not None:
        pages = pages.join(wanted.select("url").distinct(), "url", "left_semi")
    landing = F.col("page_id") if "page_id" in pages.columns else F.lit(0)
    found = pages.select("url", landing.alias("_at"), lazy_image_srcs(F.col(html)).alias("images"))
    return found.groupBy("url").agg(F.max_by("images", "_at").alias("images"))


def lazy_images(pages: DataFrame, html: str = "html", needles=("scans", "jpg", "png")) -> DataFrame:
    """HTM-04 as rows: (url, pos, src) per lazy-loaded image, in document
    order, duplicates kept; pages without one produce no row."""
    return pages.select("url", F.posexplode(lazy_image_srcs(F.col(html), needles)).alias("pos", "src"))


def build_chapters(front: DataFrame, pages: DataFrame, *, scraped_at, landed_only: bool = False) -> DataFrame:
    """PIP-02 + HTM-05 + PRJ-01: chapter rows for the frontier.  A chapter
    whose page is missing gets ``image_count`` 0, or no row with ``landed_only``;
    of several landings of a page the latest counts.  Chapter numbers that are
    fractional, or beyond BIGINT, keep their text in ``chapter_label``;
    ``chapter_number`` is NULL for them."""
    counts = image_lists(pages, wanted=front).select("url", F.size("images").alias("n_img"))
    j = front.join(counts, "url", "inner" if landed_only else "left")
    integral = F.col("value") == trunc_double(F.col("value"))
    return j.select(
        F.lit(scraped_at).cast("timestamp").alias("scraped_at"),
        F.col("number").alias("chapter_label"),
        F.when(integral, trunc_long(F.col("value"))).alias("chapter_number"),
        F.lit(CRAWL_SOURCE).alias("source"),
        F.lit(CRAWL_LANGUAGE).alias("language"),
        F.col("url"),
        F.coalesce(F.col("n_img"), F.lit(0)).cast("long").alias("image_count"))


def format_manifest_chapters(manifest_rows: DataFrame) -> DataFrame:
    """PRJ-01 over manifest chapter rows: 6 columns, ``image_count`` 0 when
    missing, constant source/language, ``image_urls`` dropped."""
    return manifest_rows.select(
        F.col("scraped_at"),
        F.col("chapter_number"),
        F.col("url"),
        F.coalesce(F.col("image_count"), F.lit(0)).cast("long").alias("image_count"),
        F.lit(CRAWL_SOURCE).alias("source"),
        F.lit(CRAWL_LANGUAGE).alias("language"))


def processed_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """AGG-10: distinct processed keys."""
    return df.select(*keys).distinct()


def difference(all_: DataFrame, done: DataFrame, keys: list[str], *, null_safe: bool = True) -> DataFrame:
    """SET-03 / JN-02 / JN-03: rows of ``all_`` whose key is not in ``done``
    (bag semantics, duplicates of ``all_`` kept).  ``null_safe`` matches a
    NULL key against a NULL key, like membership in a Python set."""
    d = done.select(*[F.col(k).alias("_d_" + k) for k in keys])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col("_d_" + k)) if null_safe else (F.col(k) == F.col("_d_" + k))
        cond = c if cond is None else cond & c
    return all_.join(d, cond, "left_anti")


def chapter_key(df: DataFrame) -> Column:
    """Text that names a row's chapter: its number, or the label of a chapter without
    one (fractional, or beyond BIGINT); null where a row has neither."""
    number = F.col("chapter_number").cast("string")
    return F.coalesce(number, F.col("chapter_label")) if "chapter_label" in df.columns else number


def identity(df: DataFrame) -> list[str]:
    """The columns that name a chapter in ``df``."""
    return ["chapter_number", *(["chapter_label"] if "chapter_label" in df.columns else [])]


def chapters_to_process(chapters: DataFrame, dialogues: DataFrame, *, limit: int = 0) -> DataFrame:
    """JN-02 + SRT-03: chapters without any dialogue row, by number; the first
    ``limit`` when ``limit > 0``."""
    todo = difference(chapters.select("chapter_number", "url"),
                      dialogues.select("chapter_number"), ["chapter_number"], null_safe=False)
    todo = todo.orderBy("chapter_number")
    return todo.limit(limit) if limit > 0 else todo


def page_tasks(chapters: DataFrame, dialogues: DataFrame, pages: DataFrame, *,
               limit: int = 0) -> DataFrame:
    """PIP-03 + WIN-04 + SCL-05/06: one row per page image of every chapter not
    yet processed.  Page numbers are 1-based positions in the filtered image
    list; chapters with no image produce no row."""
    return _tasks(chapters_to_process(chapters, dialogues, limit=limit), pages)


def open_page_tasks(chapters: DataFrame, dialogues: DataFrame, pages: DataFrame, *,
                    limit: int = 0) -> DataFrame:
    """T8: the page images without a dialogue row, of every chapter that has fewer
    dialogue rows than images; a failed page is planned again."""
    pages_done = dialogues.select(chapter_key(dialogues).alias("_key"), "page_number")
    done = pages_done.groupBy(F.col("_key").alias("_dk")).agg(F.count_distinct("page_number").alias("_done"))
    keyed = chapters.withColumn("_key", chapter_key(chapters))
    todo = keyed.join(done, keyed["_key"].eqNullSafe(done["_dk"]), "left").where(F.coalesce("_done", F.lit(0)) < F.col("image_count"))
    todo = todo.select(*identity(chapters), "_key", "url").orderBy("chapter_number", "_key")
    tasks = _tasks(todo.limit(limit) if limit > 0 else todo, pages, extra=["_key"])
    return difference(tasks, pages_done, ["_key", "page_number"]).drop("_key")


def _tasks(todo: DataFrame, pages: DataFrame, extra: list[str] | None = None) -> DataFrame:
    imgs = image_lists(pages, wanted=todo)
    names = identity(todo)
    j = todo.join(imgs, "url", "inner")
    ex = j.select(*names, *(extra or []), F.posexplode("images").alias("pos", "image_url"))
    page = (F.col("pos") + 1).cast("long")
    label = F.col("chapter_label") if "chapter_label" in names else None
    return ex.select(*names, *(extra or []), page.alias("page_number"), "image_url",
                     object_path(F.col("chapter_number"), page, F.col("image_url"), label).alias("gcs_path"),
                     mime_type(F.col("image_url")).alias("content_type"))


def build_dialogues(stored: DataFrame, responses: DataFrame, *, processed_at) -> DataFrame:
    """PIP-04: stored page images (``gcs_path`` not NULL) joined to their text
    extraction response -> ``dialogues`` rows.  Pages whose image was not
    stored are dropped (page-number gaps stay); empty text is kept.  A chapter without
    number is met by its ``chapter_label``, which the rows keep."""
    ok = stored.where(F.col("gcs_path").isNotNull()).withColumn("_key", chapter_key(stored))
    answers = responses.select(chapter_key(responses).alias("_key"), "page_number", "response")
    j = ok.join(answers, ["_key", "page_number"], "inner")
    return j.select(*identity(stored), "page_number", "image_url", "gcs_path",
                    first_annotation_text(F.col("response")).alias("extracted_text"),
                    F.lit(processed_at).cast("timestamp").alias("processed_at"))
