"""op8 against brute force on the driver's small table and on planted chains."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from contentflow.llm.common import sketch_distances
from contentflow.llm.ngram_jaccard import band_tops, jaccard_components, keep_one_per_group, odd_sketch, signatures
from contentflow.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, n=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return frozenset()
    return frozenset([tuple(w)]) if len(w) < n else frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def brute(rows, percent=90):
    sets = [shingles(t) for _, t in rows]
    by = {}
    for i, s in enumerate(sets):
        for x in s:
            by.setdefault(x, []).append(i)
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        seen = {j for x in s for j in by[x] if j < i}
        for j in seen:
            both = len(s & sets[j])
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b, key=lambda k: rows[k][0])] = min(a, b, key=lambda k: rows[k][0])
    return {rows[i][0]: (len(sets[i]), rows[find(i)][0]) for i in range(len(rows))}


def got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()]
    assert got(QUERIES["op8_ngram_jaccard"](spark, d)) == brute(rows)


def test_chains_and_edges(spark):
    rng = random.Random(3)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "Ä x y"), (8, "ä x y")]
    base = [f"w{rng.randrange(500)}" for _ in range(130)]
    for i in range(60):  # a chain: each differs from the one before by one more word
        base = list(base)
        base[rng.randrange(len(base))] = f"z{i}"
        rows.append((100 + i, " ".join(base)))
    short = [f"s{k}" for k in range(20)]
    rows += [(300 + i, " ".join(short[i:i + 14])) for i in range(6)]
    long = [f"l{rng.randrange(9000)}" for _ in range(30000)]
    rows += [(400, " ".join(long)), (401, " ".join(long[:28500])), (402, " ".join(long[:20000]))]
    rows += [(500, rows[20][1]), (501, rows[20][1])]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert got(jaccard_components(df)) == want
    kept = keep_one_per_group(df.selectExpr("doc_id", "text", "1 as node", "2 as bucket"))
    assert kept.columns == ["doc_id", "text", "node", "bucket"]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if c == i)


def test_repeated_and_null_ids(spark):
    rows = [(9, "a b c d"), (9, "a b c d"), (None, "a b c d"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(str, jaccard_components(df).collect())) == sorted(map(str, [
        *[f"Row(doc_id={i}, n_shingles=2, component_id=9)" for i in (9, 9, None)],
        "Row(doc_id=None, n_shingles=0, component_id=None)"]))
    assert sorted(map(str, (r["doc_id"] for r in keep_one_per_group(df).collect()))) == ["9", "None"]


def test_links_through_rows_without_id(spark):
    """A - B - C, where the middle one has no doc_id: its set still links the other two."""
    words = [f"w{i}" for i in range(60)]
    a, b, c = words, words[3:] + ["x1", "x2", "x3"], words[6:] + [f"x{i}" for i in range(1, 7)]
    assert not 100 * len(shingles(" ".join(a)) & shingles(" ".join(c))) >= 90 * len(shingles(" ".join(a)) | shingles(" ".join(c)))
    rows = [(1, " ".join(a)), (None, " ".join(b)), (3, " ".join(c))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r["component_id"] for r in jaccard_components(df).collect()] == [1, 1, 1]
    assert [r["doc_id"] for r in keep_one_per_group(df).collect()] == [1]


def test_rows_with_one_id_and_two_texts(spark):
    """A text of its own is never dropped for its number; of a copy one row stays."""
    text = {k: " ".join(f"{k}{i}" for i in range(30)) for k in "abc"}
    rows = [(5, text["a"], "x"), (5, text["b"], "x"), (5, text["a"], "x"), (5, text["a"], "y"), (6, text["b"], "z"), (None, text["c"], "x"), (None, text["c"], "x"),
            (7, None, "x"), (7, "", "y"), (None, " ", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _print string").selectExpr("*", "1 as _doc", "2 as _rank", "3 as comp")
    kept = keep_one_per_group(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or 0, (r["text"] or "").strip()[:1]) for r in kept.collect()) == [(0, ""), (0, "c"), (5, "a"), (5, "b"), (7, "")]


@pytest.mark.parametrize("percent", [80, 90])
def test_sketches_grow_with_the_set(percent):
    """The bound holds at any pair of widths, and unrelated sets of any size are told apart."""
    rng = np.random.default_rng(percent)
    for size in (50, 700, 1100, 5000, 40000):
        a = rng.integers(0, 2**63, size).astype(np.uint64)
        for other in (a[: int(size * 0.85)], rng.integers(0, 2**63, int(size * 0.9)).astype(np.uint64)):
            x, y = (pa.array([odd_sketch(s, percent)]) for s in (a, other))
            bits = int(sketch_distances(x, y)[0])
            assert bits <= len(np.setxor1d(a, other))
            if other[0] != a[0]:
                assert bits * (100 + percent) > (100 - percent) * (len(a) + len(other))


def test_empty_table(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("size", [9, 10, 12, 19, 40, 200, 1500])
def test_signatures_cover_every_allowed_difference(size):
    rng = np.random.default_rng(size)
    tops = band_tops(90, 4000)
    for _ in range(30):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64) * np.uint64(2))
        drop = rng.integers(0, len(a) // 10 + 1)
        b = np.delete(a, rng.choice(len(a), drop, replace=False))
        add = 0
        while 100 * len(b) >= 90 * (len(a) + add + 1) and rng.random() < 0.7:
            add += 1
        b = np.unique(np.concatenate((b, rng.integers(0, 2**63, add).astype(np.uint64) * np.uint64(2) + np.uint64(1))))
        both = len(np.intersect1d(a, b))
        if 100 * both >= 90 * (len(a) + len(b) - both) and both != len(a):
            assert set(signatures(a, 90, tops)) & set(signatures(b, 90, tops))
