"""op3: targets by repeated resharing, taken words by a plain walk."""

import hashlib
import re
from collections import Counter

import duckdb

from contentflow.llm.mixing import ORACLE, mix_documents, mix_plan
from contentflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def reshared(sizes, weights=(5, 2, 1), cap=3):
    """Targets by giving the excess to the others until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total = sum(sizes.values())
    capped = {}
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > cap * sizes[s]]
        if not over:
            return capped | share
        capped |= {s: cap * sizes[s] for s in over}


def check(rows, plan):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += n_words(text)
    want = reshared(sizes)
    taken = Counter()
    for r in plan:
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) <= 1e-6 * max(1, want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1


ROWS = [(i, "w " * (i * 7 % 23), f"s{i % 5}") for i in range(200)] + [(900, "big " * 5000, "s1"), (901, None, "s1"), (902, "", None)] \
    + [(903, "a b c", None), (None, "x y", "s2"), (None, "x y", "s2"), (5, "again", "s0"), (904, None, "only-null")]


def test_small(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string").repartition(3)
    plan = mix_plan(df).collect()
    assert len(plan) == len(ROWS)
    check(ROWS, plan)
    assert sorted(map(str, plan)) == sorted(map(str, mix_plan(df.repartition(7)).collect()))


def test_documents(spark):
    df = spark.createDataFrame([(*r, n_words(r[1])) for r in ROWS], "doc_id long, text string, source string, size int")
    out = mix_documents(df)
    assert out.columns == df.columns
    taken = Counter()
    for r in out.collect():
        taken[r["source"]] += n_words(r["text"])
    want = Counter()
    for r in mix_plan(df).collect():
        want[r["source"]] += r["taken"]
    assert +taken == +want
    chars = df.selectExpr("doc_id", "text", "source", "cast(length(text) as bigint) n_chars")
    assert all(r["n_chars"] == len(r["text"]) for r in mix_documents(chars).collect())


def test_whole_table(spark):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    plan = mix_plan(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    check(rows, plan)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    sql = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE})").fetchall()
    df = QUERIES["op3_mixing"](spark, SF)
    assert df.columns == cols
    assert sorted(map(tuple, df.collect())) == sorted(sql)


def test_empty_and_wordless(spark):
    df = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix_plan(df).collect() == [] and mix_documents(df).collect() == []
    df = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [(r["target"], r["taken"]) for r in mix_plan(df).collect()] == [(0.0, 0)] * 2


def test_order_is_seeded():
    assert hashlib.md5(b"mix-1|5").hexdigest() != hashlib.md5(b"mix-2|5").hexdigest()
