"""The weekly jobs end to end on the sf0.001 bindings: every job run twice;
the second run adds nothing, and each table holds what the operators give."""

import uuid

from pyspark.sql import functions as F

from contentflow.plans import bindings as B
from contentflow.plans import weekly as W
from contentflow.session import ensure_checkpoint_dir

from table_dirs import SF_SMALL


def _scratch(spark, tag):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def _n(spark, path):
    return spark.read.parquet(path).count()


def test_weekly_jobs_rerun_add_nothing(spark):
    chapters, dialogues = _scratch(spark, "chapters"), _scratch(spark, "dialogues")
    speakers, ledger, quarantine = (_scratch(spark, t) for t in ("speakers", "ledger", "quarantine"))
    index_pages, chapter_pages = B.link_pages(spark, SF_SMALL), B.image_pages(spark, SF_SMALL)

    # 1. crawl: everything past an empty table, then nothing new.
    for _ in range(2):
        W.crawl(spark, index_pages, chapter_pages, chapters, scraped_at=B.AS_OF)
    ch = spark.read.parquet(chapters)
    # Chapters k (and k.5 when k % 13 = 0) past the empty table's watermark 0:
    # int(float(number)) > 0, so 0 and 0.5 are not new.  Those without a landed page
    # (all k.5) wait in the ledger.
    n_numbers = spark.read.parquet(f"{SF_SMALL}/part.parquet").where("p_partkey > 0").selectExpr(
        "count(*) + count_if(p_partkey % 13 = 0) AS n").first().n
    waiting = spark.read.parquet(f"{chapters}_ledger")
    assert waiting.select("number").distinct().count() == waiting.count() > 0
    assert ch.count() + waiting.count() == n_numbers and ch.select("chapter_label").distinct().count() == ch.count()
    landed = chapter_pages.select("url").distinct()
    assert ch.join(landed, "url", "left_anti").count() == 0 == waiting.join(landed, "url").count()

    # 2. page tasks for chapters that have a landed page with images.
    tasks = W.plan_pages(spark, chapters, dialogues, chapter_pages)
    n_tasks = tasks.count()
    assert n_tasks > 0 and tasks.where(~F.col("gcs_path").startswith("chapitre-")).count() == 0

    # 3. the extraction service's answers: the image URL as the page text.
    resp = tasks.select("chapter_number", "page_number", F.to_json(F.struct(
        F.struct(F.lit("").alias("message")).alias("error"),
        F.array(F.struct(F.concat(F.lit("\n"), F.col("image_url")).alias("description")))
        .alias("text_annotations"))).alias("response"))
    for _ in range(2):
        W.extract_dialogues(tasks, resp, dialogues, processed_at=B.AS_OF)
    assert _n(spark, dialogues) == n_tasks
    assert W.plan_pages(spark, chapters, dialogues, chapter_pages).count() == 0

    # 4. mentions of "scans": every page; odd pages answer with two mentions,
    #    pages 3, 6, ... with a malformed second element (partial).
    work = W.plan_mentions(spark, dialogues, ledger, phrase="scans")
    assert work.count() == n_tasks
    m = F.to_json(F.struct(F.lit("narrateur").alias("speaker"), F.col("extracted_text").alias("phrase")))
    second = (F.when(F.col("page_number") % 3 == 0, F.lit("42"))
              .when(F.col("page_number") % 2 == 1, m))
    raw = F.concat(F.lit('{"mentions":['), m,
                   F.when(second.isNotNull(), F.concat(F.lit(","), second)).otherwise(F.lit("")),
                   F.lit("]}"))
    answers = work.select("chapter_number", "page_number", raw.alias("raw"))
    for _ in range(2):
        W.load_mentions(spark, answers, speakers, ledger, analysed_at=B.AS_OF,
                        quarantine_path=quarantine)
    pages = work.select("page_number")
    exp_rows = pages.select(F.when((F.col("page_number") % 2 == 1) & (F.col("page_number") % 3 != 0), 2)
                            .otherwise(1).alias("k")).agg(F.sum("k")).first()[0]
    assert _n(spark, speakers) == exp_rows
    n_partial = pages.where("page_number % 3 = 0").count()
    led = spark.read.parquet(ledger)
    assert led.where("status = 'partial'").count() == n_partial
    assert led.where("status = 'mentions'").count() == n_tasks - n_partial
    # Only the partial pages stay on the worklist.
    assert W.plan_mentions(spark, dialogues, ledger, phrase="scans").count() == n_partial
