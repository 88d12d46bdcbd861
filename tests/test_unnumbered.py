"""Chapters without a number keep their identity through the weekly jobs."""

import uuid

from pyspark.sql import functions as F

from contentflow.operators import frontier as FR
from contentflow.plans import bindings as B
from contentflow.plans import weekly as W
from contentflow.session import ensure_checkpoint_dir

PAGES = "page_id long, url string, html string"


def _path(spark, tag):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def _two(a, b):
    return f'<img data-src="/scans/{a}.jpg"><img data-src="/scans/{b}.jpg">'


def test_fractional_chapters_are_planned_each(spark):
    ch = spark.createDataFrame([(None, "10.5", "/a", 2), (None, "11.5", "/b", 2), (12, "12", "/c", 2)],
                               "chapter_number long, chapter_label string, url string, image_count long")
    pages = spark.createDataFrame([(1, "/a", _two(1, 2)), (2, "/b", _two(3, 4)), (3, "/c", _two(5, 6))], PAGES)
    done = spark.createDataFrame([(None, "10.5", 1), (None, "10.5", 2), (12, None, 2)], "chapter_number long, chapter_label string, page_number long")
    got = FR.open_page_tasks(ch, done, pages).collect()
    assert sorted((r["chapter_label"], r["page_number"], r["gcs_path"]) for r in got) == [
        ("11.5", 1, "chapitre-11.5/page-001.jpg"), ("11.5", 2, "chapitre-11.5/page-002.jpg"), ("12", 1, "chapitre-12/page-001.jpg")]


def test_weekly_jobs_with_fractional_chapters(spark):
    chapters, dialogues, speakers, ledger, bad = (_path(spark, t) for t in ("ch", "di", "sp", "le", "qu"))
    index = spark.createDataFrame([(1, "i", '<a href="/chapitre-10.5-vf/"><a href="/chapitre-11.5-vf/"><a href="/chapitre-12-vf/">'
                                    '<a href="/Chapitre-9-VF/"><a href="/chapitre-x-vf/"><a href="/about/">')], PAGES)
    pages = spark.createDataFrame([(i, f"/chapitre-{n}-vf/", _two(n, n + "b")) for i, n in enumerate(("10.5", "11.5", "12"))], PAGES)
    for _ in range(2):
        W.crawl(spark, index, pages, chapters, scraped_at=B.AS_OF)
    links = spark.read.parquet(f"{chapters}_links").collect()
    assert sorted((r["href"], r["reason"]) for r in links) == [("/Chapitre-9-VF/", "no_number"), ("/chapitre-x-vf/", "not_decimal")]
    for _ in range(2):
        tasks = W.plan_pages(spark, chapters, dialogues, pages)
        answer = F.lit('{"error":{"message":""},"text_annotations":[{"description":"roi des pirates"}]}')
        W.extract_dialogues(tasks, tasks.select("chapter_number", "chapter_label", "page_number", answer.alias("response")), dialogues, processed_at=B.AS_OF)
    assert spark.read.parquet(dialogues).count() == 6 and W.plan_pages(spark, chapters, dialogues, pages).count() == 0
    work = W.plan_mentions(spark, dialogues, ledger, phrase="roi des pirates")
    assert work.count() == 6 and work.where("request LIKE '%11.5%'").count() == 2
    said = F.concat(F.lit('{"mentions":[{"speaker":"'), F.col("chapter_label"), F.lit('"}]}'))
    W.load_mentions(spark, work.where("chapter_label = '10.5'").withColumn("raw", said), speakers, ledger, analysed_at=B.AS_OF, quarantine_path=bad)
    W.load_mentions(spark, W.plan_mentions(spark, dialogues, ledger, phrase="roi des pirates").withColumn("raw", said), speakers, ledger, analysed_at=B.AS_OF)
    rows = spark.read.parquet(speakers).collect()
    assert sorted((r["chapter_label"], r["page_number"], r["speaker"]) for r in rows) == sorted((c, p, c) for c in ("10.5", "11.5", "12") for p in (1, 2))
    assert W.plan_mentions(spark, dialogues, ledger, phrase="roi des pirates").count() == 0


def test_rows_without_any_chapter_are_kept(spark):
    speakers, ledger = _path(spark, "sp"), _path(spark, "le")
    one = '{{"mentions":[{{"speaker":"{}"}}]}}'
    for rows in ([(None, 1, one.format("A")), (5, 1, one.format("B"))], [(None, 2, one.format("C")), (5, 2, one.format("D"))]):
        W.load_mentions(spark, spark.createDataFrame(rows, "chapter_number long, page_number long, raw string"), speakers, ledger, analysed_at=B.AS_OF)
    got = spark.read.parquet(speakers).collect()
    assert sorted((r["chapter_number"] or 0, r["page_number"], r["speaker"]) for r in got) == [(0, 1, "A"), (0, 2, "C"), (5, 1, "B"), (5, 2, "D")]
    # A page that is answered again is replaced, the others stay.
    again = [(None, 1, '{"mentions":[1,{"speaker":"E"}]}')]
    W.load_mentions(spark, spark.createDataFrame(again, "chapter_number long, page_number long, raw string"), speakers, _path(spark, "le"), analysed_at=B.AS_OF)
    assert sorted(r["speaker"] for r in spark.read.parquet(speakers).collect()) == ["B", "C", "D", "E"]
