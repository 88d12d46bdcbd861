"""op1 against all cosines, on the driver's table and on planted cases."""

import numpy as np

from contentflow.llm.cover_tree import Tree, cosine_links, dual_links, unit
from contentflow.llm.queries import QUERIES


def brute(rows, cosine=0.98):
    links = {i: 0 for i, _, _ in rows}
    parent = {i: i for i, _, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ok = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        ok.append((i, np.array(v, float), label))
    for n, (i, v, l) in enumerate(ok):
        for j, w, m in ok[:n]:
            if l == m and len(v) == len(w) and v @ w / np.sqrt(v @ v) / np.sqrt(w @ w) >= cosine - 1e-15:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (links[i], find(i), find(i) == i) for i in links}


def got(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in spark.read.parquet(f"{d}/embeddings.parquet").collect()]
    assert got(QUERIES["op1_cover_tree"](spark, d)) == brute(rows)


def planted():
    rng = np.random.default_rng(5)
    rows = []
    for k in range(4):  # clusters of several widths
        c = rng.normal(size=16)
        for _ in range(60):
            rows.append((c + rng.normal(size=16) * (0.02, 0.1, 0.2, 0.5)[k] * np.sqrt((c * c).mean())).tolist())
    rows += [rows[3]] * 5 + [[x * 1e-30 for x in rows[3]], [x * 1e30 for x in rows[3]], [-x for x in rows[3]]]
    rows += [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [None] + [1.0] * 15, [float("inf")] * 16, [1.0, 2.0], [1.0, 2.0]]
    rng.shuffle(rows)
    return [(i, v, [0, 0, 0, 1, None][i % 5]) for i, v in enumerate(rows)]


def test_planted(spark):
    rows = planted()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert got(cosine_links(df, block=40, sample=30)) == brute(rows)


def test_empty(spark):
    assert cosine_links(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_dual_walk_counts():
    rng = np.random.default_rng(1)
    c = rng.normal(size=(30, 8))
    x = unit(np.repeat(c, 20, axis=0) + rng.normal(size=(600, 8)) * 0.08)
    y = unit(c + rng.normal(size=(30, 8)) * 0.05)
    w, u = rng.integers(1, 4, 600).astype(float), rng.integers(1, 4, 30).astype(float)
    for cosine in (0.9, 0.98, 0.999):
        hit = x @ y.T >= cosine
        a, b, ga, gb = dual_links(Tree(x, 4), Tree(y, 3), False, cosine, w, u)
        assert np.array_equal(a, hit @ u) and np.array_equal(b, w @ hit)
        assert all(ga[i] == gb[j] for i, j in zip(*np.nonzero(hit)))
        hit = x @ x.T >= cosine
        np.fill_diagonal(hit, False)
        t = Tree(x, 4)
        a, _, _, _ = dual_links(t, t, True, cosine, w, w)
        assert np.array_equal(a, hit @ w)
