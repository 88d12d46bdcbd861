"""The weekly batch jobs as table-to-table Spark jobs.

Each job reads the shared tables (a table that does not exist yet reads as
empty), applies the operators, and appends with keys, so a job that is
re-run -- after a failure, or by the weekly schedule -- adds nothing it
already wrote.  The external services (page fetch, text extraction,
mention classification) stay outside: their landed outputs are inputs here,
and the jobs emit the work lists those services consume.

    crawl               index pages + chapter pages -> chapters (new chapters only)
    plan_pages          chapters, dialogues, chapter pages -> page tasks
    extract_dialogues   stored pages + extraction responses -> dialogues
    plan_mentions       dialogues + ledger -> request worklist
    load_mentions       classifier responses -> speakers + ledger (+ quarantine)
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import frontier as FR
from ..operators import mentions as M
from ..schemas import DIALOGUES, PHRASE, SPEAKERS
from ..sources import io as IO

CHAPTER_TABLE = T.StructType([
    T.StructField("scraped_at", T.TimestampType()),
    T.StructField("chapter_label", T.StringType()),
    T.StructField("chapter_number", T.LongType()),
    T.StructField("source", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("image_count", T.LongType()),
])

LABEL = T.StructField("chapter_label", T.StringType())

DIALOGUES_STORED = T.StructType([*DIALOGUES.fields, LABEL])

LEDGER = T.StructType([
    T.StructField("chapter_number", T.LongType()),
    LABEL,
    T.StructField("page_number", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("n_mentions", T.LongType()),
    T.StructField("n_bad", T.LongType()),
    T.StructField("analysed_at", T.TimestampType()),
])

CRAWL_LEDGER = T.StructType([
    T.StructField("number", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("url", T.StringType()),
    T.StructField("page_id", T.LongType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("seen_at", T.TimestampType()),
])

SPEAKERS_STORED = T.StructType([*SPEAKERS.fields, LABEL, T.StructField("pos", T.IntegerType()),
                                T.StructField("chapter_block", T.LongType())])

QUARANTINE = T.StructType([
    T.StructField("chapter_number", T.LongType()),
    LABEL,
    T.StructField("page_number", T.LongType()),
    T.StructField("raw", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("pos", T.IntegerType()),
])

LINK_QUARANTINE = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("pos", T.IntegerType()),
    T.StructField("href", T.StringType()),
    T.StructField("number", T.StringType()),
    T.StructField("reason", T.StringType()),
    T.StructField("seen_at", T.TimestampType()),
])

FINAL = ("mentions", "no_mention")


def crawl(spark: SparkSession, index_pages: DataFrame, chapter_pages: DataFrame, chapters_path: str, *,
          scraped_at, limit: int = 0, strict: bool = False, ledger_path: str | None = None,
          links_path: str | None = None) -> None:
    """Frontier past the chapters table's watermark (or the first ``limit``
    chapters), image counts from the landed chapter pages, appended keyed on
    the chapter's number text.

    A chapter whose page has not landed gets no row; the ledger (``ledger_path``, by
    default next to the chapters) keeps it as ``missing``, and later runs look for its
    page again even when the watermark has passed it.  Links that look like chapters but
    carry no usable number go to ``links_path`` (by default next to the chapters), once
    per page, place and href."""
    ledger_path = ledger_path or f"{chapters_path.rstrip('/')}_ledger"
    chapters = IO.optional_table(spark, chapters_path, CHAPTER_TABLE)
    ledger = IO.optional_table(spark, ledger_path, CRAWL_LEDGER)
    cols = ["number", "value", "url", "page_id", "pos"]
    front = FR.frontier(index_pages, chapters, limit=limit, strict=strict).select(*cols)
    stored = chapters.select(F.col("chapter_label").alias("number"))
    waiting = FR.difference(ledger.where(F.col("status") == "missing").select(*cols), stored, ["number"])
    front = FR.dedupe_first(front.unionByName(waiting), "number", ["page_id", "pos"])
    odd = FR.link_quarantine(FR.anchor_links(index_pages)).withColumn("seen_at", F.lit(scraped_at).cast("timestamp"))
    IO.append(odd.select(*LINK_QUARANTINE.fieldNames()), links_path or f"{chapters_path.rstrip('/')}_links", keys=["page_id", "pos", "href"])
    # Written before the chapters: a run that fails between the two appends repeats both.
    rows = FR.build_chapters(front, chapter_pages, scraped_at=scraped_at, landed_only=True)
    absent = FR.difference(front, chapter_pages.select("url"), ["url"])
    IO.append(absent.withColumn("status", F.lit("missing")).withColumn("seen_at", F.lit(scraped_at).cast("timestamp"))
              .select(*CRAWL_LEDGER.fieldNames()), ledger_path, keys=["number", "status"])
    IO.append(rows.select(*CHAPTER_TABLE.fieldNames()), chapters_path, keys=["chapter_label"])


def plan_pages(spark: SparkSession, chapters_path: str, dialogues_path: str, chapter_pages: DataFrame, *,
               limit: int = 0) -> DataFrame:
    """Page tasks (one per image) without a dialogue yet, also of chapters that have some."""
    chapters = IO.optional_table(spark, chapters_path, CHAPTER_TABLE)
    dialogues = IO.optional_table(spark, dialogues_path, DIALOGUES_STORED)
    return FR.open_page_tasks(chapters, dialogues, chapter_pages, limit=limit)


def extract_dialogues(stored: DataFrame, responses: DataFrame, dialogues_path: str, *,
                      processed_at) -> None:
    """Dialogue rows from stored page images and their extraction responses,
    appended keyed on (chapter, page); the stored label names every chapter, numbered
    or not."""
    rows = FR.build_dialogues(stored, responses, processed_at=processed_at)
    rows = rows.withColumn("chapter_label", FR.chapter_key(rows))
    IO.append(rows.select(*DIALOGUES_STORED.fieldNames()), dialogues_path, keys=["chapter_label", "page_number"])


def plan_mentions(spark: SparkSession, dialogues_path: str, ledger_path: str, *,
                  phrase: str = PHRASE) -> DataFrame:
    """Pages with the phrase whose analysis is not final yet, with their
    request text (T8: the ledger, not the speakers table, says what is done)."""
    dialogues = IO.optional_table(spark, dialogues_path, DIALOGUES_STORED)
    ledger = IO.optional_table(spark, ledger_path, LEDGER)
    return M.mention_worklist_from_ledger(dialogues, ledger, phrase)


def load_mentions(spark: SparkSession, responses: DataFrame, speakers_path: str, ledger_path: str, *,
                  analysed_at, quarantine_path: str | None = None) -> None:
    """Classifier responses of pages not yet final -> speakers rows (well-formed
    mentions, with their place ``pos``), ledger rows (one status per page and run) and
    quarantined pages / elements (keyed, so a rerun adds none).

    A page's speakers rows are replaced as a whole: a retried page holds what its last
    answer said.  The table is partitioned by blocks of 100 chapters, and only the
    blocks of answered pages are rewritten (staged first, then overwritten).  The ledger
    is written last, so a run that fails before it is simply repeated."""
    def named(df: DataFrame) -> DataFrame:
        return df.withColumn("chapter_label", FR.chapter_key(df))

    keys = ["chapter_label", "page_number"]
    ledger = named(IO.optional_table(spark, ledger_path, LEDGER))
    done = ledger.where(F.col("status").isin(*FINAL)).select(*keys)
    todo = FR.difference(named(responses), done, keys)
    rows, bad = M.mentions_from_responses(todo, position=True)
    # Chapters without number lie in blocks of their own (-1 to -64): a block is never null.
    block = F.coalesce(F.floor(F.col("chapter_number") / 100), -1 - F.pmod(F.xxhash64("chapter_label"), F.lit(64))).cast("long")
    # A page that answers nothing readable keeps what it had.
    status = M.page_ledger(todo).withColumn("analysed_at", F.lit(analysed_at).cast("timestamp"))
    answered = status.where(F.col("status") != "failed").select("chapter_number", *keys)
    touched = answered.select(block.alias("chapter_block")).distinct()
    old = named(IO.optional_table(spark, speakers_path, SPEAKERS_STORED))
    kept = FR.difference(old.join(touched, "chapter_block", "left_semi"), answered, keys)
    new = rows.withColumn("chapter_block", block)
    # A folder of this run alone: two runs at a time do not mix.
    staged = f"{speakers_path.rstrip('/')}_staged/{uuid.uuid4().hex}"
    cols = SPEAKERS_STORED.fieldNames()
    kept.select(*cols).unionByName(new.select(*cols)).write.mode("overwrite").parquet(staged)
    # Static overwrite of a staged folder, dynamic overwrite of the table's touched blocks.
    (spark.read.schema(SPEAKERS_STORED).parquet(staged).repartition("chapter_block").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("chapter_block").parquet(speakers_path))
    if quarantine_path:
        old_bad = IO.optional_table(spark, quarantine_path, QUARANTINE)
        fresh = FR.difference(bad.select(*QUARANTINE.fieldNames()).distinct(), old_bad, QUARANTINE.fieldNames())
        IO.append(fresh, quarantine_path)
    IO.append(status.select(*LEDGER.fieldNames()), ledger_path, keys=[*keys, "status"])
