"""op2: keys, distances and classes against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from contentflow.llm import line_dedup
from contentflow.llm.line_dedup import (Powers, banded_distances, dedup_lines, line_keys, line_report, pair_sketch,
                                        threshold, without_repeated_lines)
from contentflow.llm.queries import QUERIES


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, line, n):
    s = list(line)
    for _ in range(n):
        p = rng.randrange(len(s) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            s.insert(p, rng.choice("abcé \U0001F600"))
        elif s and p < len(s):
            if kind == 1:
                del s[p]
            else:
                s[p] = rng.choice("abcé ")
    return "".join(s)


def test_distances():
    rng = random.Random(2)
    left, right = [], []
    for n in (0, 1, 2, 5, 9, 30, 64, 65, 130, 300):
        for k in range(12):
            a = "".join(rng.choice("abcé ") for _ in range(n))
            left.append(a)
            right.append(edited(rng, a, k % 7))
    for limit in (1, 2, 3, 5):
        got = banded_distances(left, right, limit)
        assert got.tolist() == [min(limit + 1, edit_distance(a, b)) for a, b in zip(left, right)]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_close_lines_share_a_key(edits):
    rng = random.Random(edits)
    powers = Powers()
    for _ in range(300):
        a = "".join(rng.choice("abcdef ") for _ in range(rng.randrange(8, 90)))
        b = edited(rng, a, rng.randrange(1, edits + 1))
        rows, keys = line_keys([a, b], edits, 10, powers)
        if a != b and edit_distance(a, b) <= threshold(min(len(a), len(b)), edits, 10):
            assert set(keys[rows == 0]) & set(keys[rows == 1])
            bits = bin(int.from_bytes(pair_sketch(a), "big") ^ int.from_bytes(pair_sketch(b), "big")).count("1")
            assert bits <= 4 * edits


def brute(rows, max_edits=2, per=10):
    """(doc_id, line_no) -> kept, by comparing all distinct lines."""
    blank = set(" \t\n\x0b\f\r")
    places = {}
    lines = {}
    for doc, text in rows:
        for no, line in enumerate(text.split("\n") if text is not None else []):
            places[(doc, no)] = line
            if set(line) - blank:
                lines.setdefault(line, len(lines))
    names = list(lines)
    parent = {x: x for x in names}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names.sort(key=len)
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            if len(b) - len(a) > max_edits:
                break
            t = threshold(len(a), max_edits, per)
            if t and len(b) - len(a) <= t and edit_distance(a, b) <= t:
                parent[find(b)] = find(a)
    first = {}
    for (doc, no), line in sorted(places.items(), key=lambda p: ((p[0][0] is None, p[0][0] or 0), p[0][1])):
        if line in parent:
            first.setdefault(find(line), (doc, no))
    return {k: line not in parent or first[find(line)] == k for k, line in places.items()}


def planted():
    rng = random.Random(8)
    base = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (5, 12, 19, 20, 25, 40, 70, 200)]
    rows = [(None, "ab\n" + base[5]), (0, None), (1, ""), (2, "\n \t\n"), (3, "short\nshort"), (4, "shorx")]
    chain = base[6]
    for i in range(10, 60):
        parts = [edited(rng, rng.choice(base), rng.randrange(4)).replace("\n", "") for _ in range(rng.randrange(1, 4))]
        chain = edited(rng, chain, 2)
        rows.append((i, "\n".join([*parts, chain])))
    return rows


def test_planted(spark):
    rows = planted()
    want = brute(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    lines, _ = dedup_lines(df)
    got = {(r["doc_id"], r["line_no"]): r["kept"] for r in lines.collect()}
    assert got == want
    extra = df.selectExpr("text", "doc_id", "1 as node", "'x' as comp")
    out = without_repeated_lines(extra)
    assert out.columns == extra.columns
    text = dict(rows)
    for r in out.collect():
        old = text[r["doc_id"]]
        assert r["text"] == (None if old is None else "\n".join(
            x for no, x in enumerate(old.split("\n")) if want[(r["doc_id"], no)]))
    report = {r["doc_id"]: r for r in line_report(df).collect()}
    assert set(report) == set(text)
    for doc, old in rows:
        mine = [k for k in want if k[0] == doc]
        assert (report[doc]["n_lines"], report[doc]["n_dropped"]) == (len(mine), sum(not want[k] for k in mine))


def test_query_equals_brute_force_on_equal_and_near_lines(spark, tmp_path):
    rows = planted()
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = brute(rows)
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"]) for r in QUERIES["op2_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {d: (sum(k[0] == d for k in want), sum(k[0] == d and not v for k, v in want.items())) for d, _ in rows}


def test_rows_with_one_id_or_none(spark):
    copy = "one line that is copied\nand a second one of them"
    rows = [(None, copy)] * 40 + [(5, copy)] * 40 + [
        (None, "alpha alone here\nbeta alone here\ngamma alone here"), (None, "x y z\n\n" + copy.split("\n")[0]),
        (8, "delta stands here\n" + copy.split("\n")[1]), (8, "unlike all others\nepsilon, only in this row")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "doc_id long, text string, i int").repartition(5)
    out = [(r["doc_id"], r["text"]) for r in without_repeated_lines(df).collect()]
    assert sorted(map(str, out)) == sorted(map(str, [(None, "")] * 40 + [(5, "")] * 39 + [
        (5, copy), rows[80], (None, "x y z\n"), (8, "delta stands here"), rows[83]]))
    report = {r["doc_id"]: r.asDict() for r in line_report(df).collect()}
    assert [report[5][k] for k in ("n_lines", "n_dropped", "n_kept")] == [80, 78, 2]
    assert [report[None][k] for k in ("n_lines", "n_blank", "n_dropped", "n_kept")] == [86, 1, 81, 4]
    assert report[5]["first_dropped_class"] is not None


def test_texts_are_split_once(spark, monkeypatch):
    plans = []
    classes = line_dedup.line_classes
    monkeypatch.setattr(line_dedup, "line_classes", lambda lines, *a: plans.append(lines) or classes(lines, *a))
    dedup_lines(spark.createDataFrame(planted(), "doc_id long, text string"))
    assert "Generate" not in plans[0]._jdf.queryExecution().optimizedPlan().toString()


def test_empty_table(spark):
    assert line_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("held", [1 << 22, 500])
def test_packed_keys_meet_as_by_brute_force(monkeypatch, held):
    monkeypatch.setattr(line_dedup, "HELD_PAIRS", held)
    monkeypatch.setattr(line_dedup, "PART_PAIRS", 64)
    rng = np.random.default_rng(4)
    keys = rng.integers(-1 << 63, (1 << 63) - 1, 700)[rng.integers(0, 700, 3000)]
    keys[rng.permutation(3000)[:1000]] = keys[0]  # a third has one key
    nodes = rng.integers(-50, 5000, 3000)
    want = {}
    for k, v in zip(keys.tolist(), nodes.tolist()):
        want.setdefault(k, set()).add(v)
    for bits in (0, 1, 5, 12):
        made = [line_dedup._blobs(keys[i::3].copy(), nodes[i::3].copy(), bits) for i in range(3)]
        table = pa.Table.from_batches(made).sort_by("part")
        out = pa.Table.from_batches(line_dedup._met_rows(iter(table.to_batches(max_chunksize=7)))).to_pylist()
        rest, got = {}, {}
        for r in out:
            (rest if r["hub"] is None else got).setdefault(r["bucket"], []).append((r["hub"], r["node"]))
        assert not set(rest) & set(got)
        assert bool(rest) == (held == 500)
        for k, v in want.items():
            if k in rest:
                assert {n for _, n in rest[k]} == v
            else:
                assert sorted(got.get(k, [])) == (sorted((min(v), n) for n in v) if len(v) > 1 else [])
