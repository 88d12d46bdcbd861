"""One manifest document written by many tasks (SNK-01), and doubles of every size as text (SCL-13)."""

import glob
import json
import math
import random
import struct

from pyspark.sql import functions as F

from contentflow.functions import text as TX
from contentflow.sources import io as IO
from contentflow.streaming.jobs import scratch

SCHEMA = "chapter_number double, url string, image_count long, scraped_at string"


def _joined(path: str) -> str:
    return "".join(open(p, encoding="utf-8").read() for p in sorted(glob.glob(path.removeprefix("file:") + "/part-*")))


def test_document_of_many_parts(spark):
    rows = [(float(i % 700), f"https://h/{i % 700}\n\"é\"", i % 5, None if i % 3 else "t") for i in range(2000)]
    rows += [(None, "none", 1, "t")] * 3 + [(7.0, "same", 1, "t")] * 900
    chapters = spark.createDataFrame(rows, SCHEMA).repartition(7)
    path = scratch(spark, "document")
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # several parts, small as the data are
    try:
        IO.write_manifest_document(chapters, path, {"scraped_at": "2024-01-31T00:00:00+00:00"})
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
    assert len(glob.glob(path.removeprefix("file:") + "/part-*")) >= 3
    doc = json.loads(_joined(path))
    assert doc["total_chapters_available"] == len(rows) and doc["scraped_at"] == "2024-01-31T00:00:00+00:00"
    got = [(float(c["chapter_number"]) if "chapter_number" in c else None, c["url"], c["image_count"], c.get("scraped_at"))
           for c in doc["chapters"]]
    assert sorted(got, key=repr) == sorted(rows, key=repr)
    numbers = [math.inf if c[0] is None else c[0] for c in got]
    assert numbers == sorted(numbers)
    back = IO.read_manifest_document(spark, path)
    assert back.count() == len(rows)
    assert back.where((F.col("total_chapters_available") != len(rows)) | F.col("manga").isNull()).count() == 0
    read = [(r.chapter_number and float(r.chapter_number), r.url, r.image_count, r.scraped_at) for r in back.collect()]
    assert sorted(read, key=repr) == sorted([(n and float(n), u, i, s) for n, u, i, s in rows], key=repr)


def test_empty_document(spark):
    path = scratch(spark, "document-empty")
    IO.write_manifest_document(spark.createDataFrame([], SCHEMA), path)
    assert json.loads(_joined(path))["chapters"] == []
    assert IO.read_manifest_document(spark, path).count() == 0


def test_fixed_text_of_every_exponent(spark):
    rnd = random.Random(5)
    vals = [struct.unpack("<d", struct.pack("<Q", rnd.getrandbits(64)))[0] for _ in range(3000)]
    vals += [rnd.choice((-1, 1)) * rnd.randrange(1, 1 << 54) * 2.0 ** rnd.randrange(-70, 20) for _ in range(3000)]
    vals += [rnd.randrange(-10 ** 6, 10 ** 6) / 2 ** rnd.randrange(0, 9) for _ in range(2000)]
    vals += [s * v for s in (1.0, -1.0) for k in range(40, 70) for v in (2.0 ** k, 2.0 ** k - 0.5, 2.0 ** k + 1)]
    vals += [0.0, -0.0, 5e-324, 1.7976931348623157e308, math.inf, -math.inf, 0.5, 1.5, 2.5, 0.95, 0.05, 0.9999999999, 999.95]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for digits in (0, 1, 2, 7):
        for r in df.select("x", TX.fixed_text("x", digits).alias("t")).collect():
            want = "nan" if math.isnan(r.x) else f"%.{digits}f" % r.x
            assert r.t == want, (r.x, digits)
    assert spark.createDataFrame([(None,)], "x double").select(TX.fixed_text("x")).first()[0] is None
