"""Components against union-find, buckets against a dictionary."""

import random

import pyarrow as pa

from contentflow.llm.common import connected_components, id_bitmap, bitmap_slot, in_bitmap, shared_buckets, words_of
from contentflow.llm.common import hub_member_stream  # noqa: F401
import re


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(50)] + [(5000 - i, 5000 - i * 2) for i in range(1, 40)]
    edges += [(rng.randrange(9000, 9400), rng.randrange(9000, 9400)) for _ in range(300)] + [(7, 7), (20000, 19999), (20000, 19999)]
    edges = [e if rng.random() < 0.5 else e[::-1] for e in edges]
    parent = {x: x for e in edges for x in e if e[0] != e[1]}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(edges, "a long, b long").repartition(6)
    rows = connected_components(df, "t").collect()
    assert {r["node"]: r["comp"] for r in rows} == {x: find(x) for x in parent} and len(rows) == len(parent)
    assert connected_components(df.limit(0), "t").collect() == []


def test_shared_buckets(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(60), rng.randrange(25)) for _ in range(150)] + [(99, i) for i in range(3000)] + [(98, 5)] * 400
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    got = sorted(map(tuple, shared_buckets(spark.createDataFrame(rows, "bucket long, node long").repartition(5)).collect()))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    by = {}
    for b, v in rows:
        by.setdefault(b, set()).add(v)
    assert got == sorted((b, min(vs), v) for b, vs in by.items() if len(vs) > 1 for v in vs)


def test_bitmap(spark):
    df = spark.range(0, 200000, 7).selectExpr("id as x")
    bits = id_bitmap(df, "x", 1 << 18)
    import numpy as np
    slots = np.array([r["slot"] for r in df.select(bitmap_slot("x", 1 << 18)).collect()])
    assert in_bitmap(bits, slots).all() and not in_bitmap(bits, np.arange(1 << 18)).all()
    assert in_bitmap(bits, np.arange(1 << 18)).sum() == len(set(slots.tolist()))


def test_words():
    texts = [None, "", " ", "a\x0bb\x1cc\x85 d e\r\n\tF", "\x00 x", "é É Z"] * 2
    off, codes, words = words_of(pa.array(texts), lower=True)
    for i, t in enumerate(texts):
        want = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        assert [words[int(c)].as_py() for c in codes[off[i]:off[i + 1]]] == ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in want]
