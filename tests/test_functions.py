from datetime import datetime
from html.parser import HTMLParser

from pyspark.sql import functions as F

from contentflow.functions import text as TX
from contentflow.operators import frontier as FR

from table_dirs import SF_SMALL


def test_float_text_rules(spark):
    vals = ["12", " 12 ", "1e3", "-1.5", ".5", "12d", "1_000", "nan", "inf", "x", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = {r.s: (r.ok, r.v) for r in df.select("s", TX.is_float_text("s").alias("ok"),
                                                   TX.float_value("s").alias("v")).collect()}
    assert got["12"] == (True, 12.0) and got[" 12 "] == (True, 12.0) and got["1e3"] == (True, 1000.0)
    assert got[".5"] == (True, 0.5) and got["-1.5"] == (True, -1.5)
    for bad in ["12d", "1_000", "nan", "inf", "x", None]:
        assert got[bad] == (False, None)
    assert df.select(TX.trunc_long(F.lit(1100.9))).first()[0] == 1100


def test_whitespace_fold_and_strip(spark):
    df = spark.createDataFrame([("  A\u000b\tB\n\nC  ",)], "s string")
    r = df.select(TX.collapse_ws("s").alias("c"), TX.strip_ws("s").alias("st")).first()
    assert r.c == " a\u000b b c  "          # vertical tab and NBSP are not folded
    assert r.st == "A\u000b\tB\n\nC"             # Unicode strip removes NBSP at the edge


def test_strip_matches_python_strip(spark):
    vals = ["  a b  ", "\n\n\ntext\n\n\n", "\x1c\x1fx\x1e", "\u3000\xa0y\u2028", "\x0bz\x0b", "",
            "   ", "no-edge", "\u200bkeep\u200b"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(TX.strip_ws("s")).collect()]
    assert got == [v.strip() for v in vals]


def test_labels_and_formats(spark):
    df = spark.createDataFrame([(1234567, 0.12345, 5, datetime(2024, 1, 2, 3, 4, 5, 6))],
                               "n long, r double, b long, ts timestamp")
    r = df.select(TX.thousands("n").alias("t"), TX.percent_text("r").alias("p"),
                  TX.bucket_label(TX.bucket_floor(F.lit(-5))).alias("neg"),
                  TX.bucket_label(TX.bucket_floor(F.lit(100))).alias("hund"),
                  TX.iso_utc("ts").alias("iso"), TX.mime_type(F.lit("a.webp")).alias("m"),
                  TX.safe_ratio(F.lit(1), F.lit(0)).alias("z"),
                  TX.decode_base64_text(F.base64(F.lit("héllo"))).alias("d")).first()
    assert r.t == "1,234,567" and r.p == "12.35%"
    assert r.neg == "-100–-1" and r.hund == "100–199"
    assert r.iso == "2024-01-02T03:04:05.000006+00:00" and r.m == "image/png"
    assert r.z is None and r.d == "héllo"


class _Anchors(HTMLParser):
    def __init__(self):
        super().__init__()
        self.hrefs = []

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            for k, v in attrs:
                if k == "href" and v is not None:
                    self.hrefs.append(v)
                    break


def test_regex_links_match_stdlib_parser(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    ours = {}
    for r in FR.anchor_links(pages).orderBy("page_id", "pos").collect():
        ours.setdefault(r.page_id, []).append(r.href)
    for r in pages.collect():
        p = _Anchors()
        p.feed(r.html)
        assert ours.get(r.page_id, []) == p.hrefs, r.page_id


def test_parser_fallback_equals_regex_on_whole_table(spark):
    """HTM-01: the regex extraction and the stdlib-parser fallback give the
    same rows on every page of the sf0.01 table (distributed comparison)."""
    from table_dirs import SF_ORACLE
    pages = spark.read.parquet(f"{SF_ORACLE}/pages.parquet")
    a = FR.anchor_links(pages).select(F.col("page_id").cast("long"), "pos", "href")
    b = FR.anchor_links_parsed(pages)
    assert a.count() > 0
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_fixed_text_matches_python(spark):
    """``fixed_text`` / ``percent_text`` print exactly what Python prints,
    including exact binary ties (half-even) and near-ties (0.15, 2.65)."""
    import random
    rnd = random.Random(7)
    vals = [0.15, 2.65, 17.25, 17.35, 0.125, 0.375, 1234.25, -0.04, -2.5, 0.0, 5e-324,
            1e15 + 0.5, 123456789.45, 0.05, 0.06, 1.005]
    vals += [round(rnd.uniform(-1e4, 1e4), rnd.randint(0, 4)) for _ in range(3000)]
    vals += [rnd.randint(0, 10 ** 6) / 100 for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = df.select("x", TX.fixed_text("x", 1).alias("f1"), TX.fixed_text("x", 0).alias("f0"),
                    TX.fixed_text("x", 3).alias("f3"), TX.percent_text("x").alias("p")).collect()
    for r in got:
        assert r.f1 == "%.1f" % r.x, r
        assert r.f0 == "%.0f" % r.x, r
        assert r.f3 == "%.3f" % r.x, r
        assert r.p == "{:.2%}".format(r.x), r
    special = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),)], "x double")
    assert [r[0] for r in special.select(TX.fixed_text("x", 1)).collect()] == ["nan", "inf", "-inf"]


def test_zero_pad_and_object_path(spark):
    vals = [0, 5, 42, 999, 1000, 1234, 123456, -5, -1234]
    df = spark.createDataFrame([(v,) for v in vals], "p long")
    assert [r[0] for r in df.select(TX.zero_pad("p", 3)).collect()] == ["%03d" % v for v in vals]
    r = df.limit(1).select(TX.object_path(F.lit(5), F.lit(7), F.lit("a.JPG")).alias("a"),
                           TX.object_path(F.lit(5), F.lit(1234), F.lit("a.webp")).alias("b")).first()
    assert (r.a, r.b) == ("chapitre-5/page-007.jpg", "chapitre-5/page-1234.png")


def test_iso_utc_like_isoformat(spark):
    from datetime import timezone
    ts = [datetime(2024, 1, 2, 3, 4, 5), datetime(2024, 1, 2, 3, 4, 5, 120)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp")
    got = [r[0] for r in df.select(TX.iso_utc("ts")).collect()]
    assert got == [t.replace(tzinfo=timezone.utc).isoformat() for t in ts]


def test_request_template_fills_every_placeholder(spark):
    from contentflow.operators.mentions import request_text
    from contentflow.schemas import MENTION_REQUEST_TEMPLATE, PHRASE
    df = spark.createDataFrame([(12, 3, "Je serai le roi des pirates !")],
                               "chapter_number long, page_number long, extracted_text string")
    got = df.select(request_text()).first()[0]
    want = MENTION_REQUEST_TEMPLATE
    for k, v in (("chapter", "12"), ("page", "3"), ("text", "Je serai le roi des pirates !"),
                 ("phrase", PHRASE)):
        want = want.replace("{" + k + "}", v)
    assert got == want
    assert "(chapitre 12, page 3)" in got and "TEXTE:\nJe serai le roi des pirates !\n" in got
    assert "{phrase}" not in got and '{"mentions": []}' in got
