"""op12 against trees folded in plain Python, on the driver's table and on planted cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from contentflow.llm import merkle as M
from contentflow.llm.queries import QUERIES

COLS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(r):
    return H(*("-" if x is None else f"{len(str(x).encode())}:{x}" for x in r))


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def walk(levels, i):
    """(left part, right part) of every run on the way up, and the siblings."""
    path = []
    for nodes in levels[:-1]:
        run = [j for j in (i - i % 2, i - i % 2 + 1) if j < len(nodes)]
        path.append(([nodes[j] for j in run if j < i], [nodes[j] for j in run if j > i]))
        i //= 2
    return path


def brute(rows):
    langs = defaultdict(list)
    for r in rows:
        langs[(r[2] is not None, (r[2] or "").encode())].append(((r[0] is not None, r[0] or 0), leaf_of(r), r))
    keys = sorted(langs)
    trees = {k: tree([x[1] for x in sorted(langs[k], key=lambda x: x[:2])]) for k in keys}
    top = tree([trees[k][-1][0] for k in keys])
    root, out = top[-1][0], []
    for rank, k in enumerate(keys):
        for i, (_, leaf, r) in enumerate(sorted(langs[k], key=lambda x: x[:2])):
            path = walk(trees[k], i) + walk(top, rank)
            now = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                now = leaf_of((*r[:3], r[3] + 1, r[4]))
            for a, b in path:
                now = H(*a, now, *b)
            out.append((r[0], leaf, trees[k][-1][0], root, H(*(x for a, b in path for x in a + b)), now, now == root))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/documents.parquet").select(*COLS).collect()]
    res = got(QUERIES["op12_merkle_manifest"](spark, d))
    assert res == brute(rows)
    assert 0 < sum(not r[-1] for r in res) < len(res)


def planted():
    rnd = random.Random(8)
    rows = [(rnd.randrange(400), rnd.choice(["s", None, ""]), rnd.choice(["a", "a", "a", "a", "b", "", None, "é", "\U0001F600", "z"]), rnd.randint(0, 9), "x" * rnd.randint(0, 3))
            for _ in range(230)]
    rows += [(10**6 + i, "one", f"lone{i}", i, None) for i in range(5)]
    rows += [(None, None, None, None, None)] * 3 + [(None, "s", "a", 1, "t")] * 2 + [rows[0]] * 3
    rows += [(c, "s", "long", (1 << 63) - 1, "é\n" * 30000) for c in range(20)] + [(14, "s", "nochars", None, "t")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("height,group", [(2, 3), (3, 8), (12, 4096)])
def test_planted(spark, height, group):
    rows = planted()
    assert got(M.verified_manifest(spark.createDataFrame(rows, SCHEMA), height, group)) == brute(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 7, 8, 9])
def test_sizes_around_a_block(spark, n):
    rows = [(i, "s", "a", 1, "t") for i in range(n)]
    assert got(M.verified_manifest(spark.createDataFrame(rows, SCHEMA), 2, 3)) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    assert M.verified_manifest(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = planted()[:40]
    more = spark.createDataFrame([r + ("t", 1, 2, "l", 3, 4) for r in rows], SCHEMA + ", tree string, place int, level int, leaf string, part int, _s int")
    assert got(M.verified_manifest(more)) == brute(rows)


def test_any_set_of_leaves_fetches_the_least():
    """The union of missing nodes is what single proofs need, less what can be derived."""
    rnd = random.Random(3)
    for _ in range(200):
        size = rnd.randint(1, 70)
        levels = tree([H(str(i)) for i in range(size)])
        asked = sorted(rnd.sample(range(size), rnd.randint(1, size)))
        need = M.missing_nodes(np.array(asked), size)
        known = [set(asked)]
        for _ in levels[1:]:
            known.append({p >> 1 for p in known[-1]})
        single = {(lv, (p >> lv) ^ 1) for p in asked for lv in range(len(levels) - 1) if (p >> lv) ^ 1 < len(levels[lv])}
        assert sorted(need) == sorted((lv, p) for lv, p in single if p not in known[lv])
        derived = M.derive(np.array(asked), [levels[0][p] for p in asked], size, {c: levels[c[0]][c[1]] for c in need})
        assert derived[-1][0] == levels[-1][0]
        for p in asked:
            assert M.fold(levels[0][p], M.proof(p, size, derived)) == levels[-1][0]
