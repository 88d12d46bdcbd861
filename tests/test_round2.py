"""Faults found in round 1: markup, bad numbers and messages, retries, repeated names."""

import base64
import uuid

import pytest
from pyspark.sql import functions as F

from contentflow.functions.html import anchor_hrefs, lazy_image_srcs
from contentflow.functions.text import trunc_double, trunc_long
from contentflow.operators import analytics as A
from contentflow.operators import audit as AU
from contentflow.operators import budget as BU
from contentflow.operators import frontier as FR
from contentflow.operators import mentions as M
from contentflow.operators import timeseries as TS
from contentflow.plans import bindings as B
from contentflow.plans import weekly as W
from contentflow.session import ensure_checkpoint_dir
from contentflow.sources import io as IO

ANCHORS = [
    ('<a title="a>b" href="/1">x</a>', ["/1"]),
    ("<a title='x href=\"/bogus\"' href='/4'>", ["/4"]),
    ('<a x="1"href="/7">', ["/7"]),
    ('<a-b href="/3"><abbr href="/3"><a>no</a><a href>', []),
    ('<A HREF=/bare>x<a\nhref = "/5"\n>', ["/bare", "/5"]),
    ('<a href="&#47;a&#x2F;b&eacute;&amp;lt;&nosuch;">', ["/a/bé&lt;&nosuch;"]),
    ('<a href="/first" class=it\'s href="/last">', ["/last"]),
    ('<a title=it\'s href="/8"><a href=\'/9"\'>', ["/8", '/9"']),
    ("<script><a href='/no'></script><!-- <a href='/no'> --><a href='/yes'>", ["/yes"]),
    ("<a href='/open'", []),
    (None, None),
    ("", []),
]


def test_anchor_markup(spark):
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(ANCHORS)], "page_id long, html string")
    got = {r[0]: r[1] for r in df.select("page_id", anchor_hrefs("html")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(ANCHORS)}
    img = spark.createDataFrame([('<img alt="a>b" data-src="/s&amp;cans/1.jpg"><img src="data-src=/x.jpg"><image data-src="/y.jpg">',)], "html string")
    assert img.select(lazy_image_srcs("html")).first()[0] == ["/s&cans/1.jpg"]


def test_long_tag_does_not_overflow(spark):
    html = "<a " + " ".join(f'd{i}="{i}"' for i in range(2000)) + ' href="/x">' + "<a " + "q" * 50000
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(anchor_hrefs("html")).first()[0] == ["/x"]


def test_numbers_beyond_bigint(spark):
    df = spark.createDataFrame([(1e30,), (-2.7,), (2.7,), (float("nan"),), (None,), (9007199254740993.0,)], "x double")
    assert [r[0] for r in df.select(trunc_long("x")).collect()] == [None, -2, 2, None, None, 9007199254740992]
    assert [r[0] for r in df.select(trunc_double("x")).limit(3).collect()] == [1e30, -2.0, 2.0]
    pages = spark.createDataFrame([(1, "u", '<a href="/chapitre-1e30-vf/"><a href="/chapitre-5-vf/"><a href="/chapitre-1_000-vf/">'
                                              '<a href="/chapitre-nan-vf/"><a href="/vf/chapitre">')], "page_id long, url string, html string")
    front = FR.frontier(pages, None)
    assert sorted(r["number"] for r in front.collect()) == ["1e30", "5"]
    rows = FR.build_chapters(front, pages, scraped_at=B.AS_OF).collect()
    assert {r["chapter_label"]: r["chapter_number"] for r in rows} == {"1e30": None, "5": 5}
    bad = FR.link_quarantine(FR.anchor_links(pages)).collect()
    assert sorted((r["href"], r["reason"]) for r in bad) == [
        ("/chapitre-1_000-vf/", "not_decimal"), ("/chapitre-nan-vf/", "not_decimal"), ("/vf/chapitre", "no_number")]


def test_latest_landing_counts(spark):
    pages = spark.createDataFrame([(1, "/c", '<img data-src="/scans/1.jpg"><img data-src="/scans/2.jpg">'),
                                   (2, "/c", '<img data-src="/scans/1.jpg">')], "page_id long, url string, html string")
    front = spark.createDataFrame([("1", 1.0, "/c", 0, 0)], "number string, value double, url string, page_id long, pos int")
    assert [r["image_count"] for r in FR.build_chapters(front, pages, scraped_at=B.AS_OF).collect()] == [1]


def test_budget_quarantine(spark):
    def b64(s):
        return base64.b64encode(s.encode() if isinstance(s, str) else s).decode()

    rows = [(1, b64('{"costAmount":5,"budgetAmount":10}')), (2, b64("not json")), (3, "%%%"), (4, b64('{"costAmount":null}')),
            (5, b64("{}")), (6, b64("[1]")), (7, b64('{"costAmount":"x","budgetAmount":1}')), (8, None), (9, b64(b"\xff\xfe{}"))]
    df = spark.createDataFrame(rows, "message_id long, data string")
    assert {r["message_id"]: r["decision"] for r in BU.budget_decision(df).collect()} == {1: "OK", 5: "SKIP"}
    assert {r["message_id"]: r["reason"] for r in BU.budget_quarantine(df).collect()} == {
        2: "undecodable", 3: "undecodable", 4: "bad_costAmount", 6: "not_object", 7: "bad_costAmount", 8: "undecodable", 9: "undecodable"}


def test_crossings_with_credits(spark):
    rows = [(f"2024-01-01 00:00:{s:02d}", s, c) for s, c in enumerate([40.0, 30.0, -60.0, 50.0, 10.0])]
    rows += [("2024-01-03 10:00:00", 9, 100.0), ("2024-01-03 10:00:00", 8, -100.0), ("2024-01-04 10:00:00", 10, 500.0)]
    df = spark.createDataFrame(rows, "ts string, id int, cost double").withColumn("ts", F.to_timestamp("ts"))
    got = {r["threshold"]: str(r["crossed_at"]) for r in BU.budget_crossings(df, amount=100, thresholds=(0.5, 0.7, 1.0), tiebreak="id").collect()}
    assert got == {0.5: "2024-01-01 00:00:01", 0.7: "2024-01-01 00:00:01", 1.0: "2024-01-04 10:00:00"}


def test_interval_names_may_repeat(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,)], "chapter_number long")
    dim = spark.createDataFrame([("A", 1, 2, "f"), ("A", 3, 4, "f"), ("A", 3, 4, "f"), ("B", 9, 9, "f"), ("C", 3, 1, "f")],
                                "name string, lo long, hi long, family string")
    got = sorted((r["name"], r["lo"], r["n_chapters"]) for r in A.interval_counts(df, dim).collect())
    assert got == [("A", 1, 2), ("A", 3, 2), ("A", 3, 2), ("B", 9, 0), ("C", 3, 0)]
    assert A.kpis(spark.createDataFrame([(1, 2), (1, 2), (2, 4)], "chapter_number long, image_count long"),
                  distinct="chapter_number").first()["total_pages"] == 6


def test_plans_copy_no_table(spark):
    df = spark.range(5000).selectExpr("id % 3 as k", "id as n", "1 as v").repartition(5)
    idx = A.dense_index(df, ["n"], partition=["k"])
    assert idx.selectExpr("max(abs(_i - n div 3))").first()[0] == 0
    assert not any("RDDScan" in line or "ExistingRDD" in line for line in idx._jdf.queryExecution().toString().splitlines())


def test_carry_forward_scans_once(spark):
    """The aligned rows are read twice, for the days' summaries and for the fill, from one
    exchange; no window runs over a whole series."""
    up = B.uptime(spark, "/root/testdata/sf0.001")
    a = TS.align(up.select("ts", "host", "region", F.col("check_passed").alias("value")), ["host", "region"], "next_older", "60 seconds")
    filled = TS.carry_forward(a, ["host", "region"], "60 seconds")
    assert filled.count() > 0
    windows = [x for x in filled._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in x]
    assert len(windows) == 2 and all("_seg" in x.split("], [")[1] or "_blk" in x.split("], [")[1] for x in windows)
    filled.write.format("noop").mode("overwrite").save()


def test_rule_tagger_keeps_aliases_whole(spark):
    d = spark.createDataFrame([(1, 1, "Oui. Le roi des pirates sera Monkey D. Luffy! Fin.")], "chapter_number long, page_number long, extracted_text string")
    r = M.mentions_by_rules(d, phrase="roi des pirates", subject="X").collect()
    assert [(x["phrase"], x["about_luffy"]) for x in r] == [("Le roi des pirates sera Monkey D. Luffy", True)]


def _path(spark, tag):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def test_retried_mentions_replace_the_page(spark):
    speakers, ledger, bad = (_path(spark, t) for t in ("sp", "le", "qu"))

    def load(raw):
        rows = spark.createDataFrame([(1, 1, raw), (1, 2, '{"mentions":[{"speaker":"Z"}]}'), (250, 1, "nope")], "chapter_number long, page_number long, raw string")
        W.load_mentions(spark, rows, speakers, ledger, analysed_at=B.AS_OF, quarantine_path=bad)

    for _ in range(2):
        load('{"mentions":[{"speaker":"A"},7]}')
    assert spark.read.parquet(bad).count() == 2  # one element, one page; the rerun adds none
    for _ in range(2):
        load('{"mentions":[{"speaker":"A"},{"speaker":"B"}]}')
    got = sorted((r["page_number"], r["speaker"]) for r in spark.read.parquet(speakers).where("chapter_number = 1").collect())
    assert got == [(1, "A"), (1, "B"), (2, "Z")]
    done = {(r["page_number"], r["status"]) for r in spark.read.parquet(ledger).where("chapter_number = 1").collect()}
    assert done == {(1, "partial"), (1, "mentions"), (2, "mentions")}


def test_late_page_is_crawled_again(spark):
    chapters = _path(spark, "ch")
    index = spark.createDataFrame([(1, "i", '<a href="/chapitre-1-vf/"><a href="/chapitre-2-vf/">')], "page_id long, url string, html string")
    two = spark.createDataFrame([(7, "/chapitre-2-vf/", '<img data-src="/scans/a.jpg">')], "page_id long, url string, html string")
    one = spark.createDataFrame([(8, "/chapitre-1-vf/", '<img data-src="/scans/a.jpg"><img data-src="/scans/b.jpg">')], "page_id long, url string, html string")
    for pages, want in ((two, {2: 1}), (two, {2: 1}), (two.union(one), {1: 2, 2: 1}), (two.union(one), {1: 2, 2: 1})):
        W.crawl(spark, index, pages, chapters, scraped_at=B.AS_OF)
        rows = spark.read.parquet(chapters).collect()
        assert {r["chapter_number"]: r["image_count"] for r in rows} == want and len(rows) == len(want)


def test_failed_page_is_planned_again(spark):
    ch = spark.createDataFrame([(1, "/c", 2)], "chapter_number long, url string, image_count long")
    pages = spark.createDataFrame([(8, "/c", '<img data-src="/scans/a.jpg"><img data-src="/scans/b.jpg">')], "page_id long, url string, html string")
    d = spark.createDataFrame([(1, 1)], "chapter_number long, page_number long")
    assert [r["page_number"] for r in FR.open_page_tasks(ch, d, pages).collect()] == [2]


def test_shards_are_chosen_before_the_scan(spark):
    path = _path(spark, "shards")
    spark.range(30).selectExpr("id", "concat('2024010', id % 6) as log_date").write.partitionBy("log_date").parquet(path)
    df = IO.read_sharded(spark, f"{path}/log_date=*/*.parquet", between=("log_date=20240101", "log_date=20240102"))
    assert df.count() == 10 and {f.split("/")[-2] for f in df.inputFiles()} == {"log_date=20240101", "log_date=20240102"}
    assert IO.read_sharded(spark, f"{path}/log_date=*/*.parquet", between=("x", "y")).count() == 0


def test_expired_partitions_go(spark):
    path = _path(spark, "audit")
    spark.range(10).selectExpr("id", "cast(date_add(date'2024-01-01', cast(id as int)) as string) as ingest_date").write.partitionBy("ingest_date").parquet(path)
    assert AU.expire_partitions(spark, path, 4, as_of="2024-01-10") == [f"2024-01-0{d}" for d in range(1, 6)]
    assert spark.read.parquet(path).count() == 5


def test_no_shared_folder_on_a_cluster_is_an_error(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())
