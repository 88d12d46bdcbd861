"""op13 against all cosines: recall on the driver's table, equality on small cases."""

import math

import numpy as np
import pyarrow.parquet as pq

from contentflow.llm import graph_search as G
from contentflow.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>"


def cosine(a, b):
    a, b = ([x / max(map(abs, v)) for x in v] for v in (a, b))
    return math.fsum(x * y for x, y in zip(a, b)) / math.sqrt(math.fsum(x * x for x in a) * math.fsum(y * y for y in b))


def brute(rows, every=50, k=5):
    ok = {(i, tuple(v)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = []
    for i, v in ok:
        if i is None or i % every:
            continue
        near = [(-round(cosine(v, w), 12), j is None, j or 0) for j, w in ok if len(v) == len(w) and (j, w) != (i, v)]
        out += [(i, rank + 1, None if none else j, -s) for rank, (s, none, j) in enumerate(sorted(near)[:k])]
    return sorted(out, key=str)


def got(df):
    return sorted(((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 12)) for r in df.collect()), key=str)


def recall(found, table):
    ids = table.column("vec_id").to_numpy()
    x = np.array(table.column("embedding").to_pylist(), np.float64)
    x /= np.sqrt((x * x).sum(1, keepdims=True))
    place = {int(i): n for n, i in enumerate(ids)}
    hits = total = 0
    for q in ids[ids % 50 == 0]:
        s = x @ x[place[int(q)]]
        s[place[int(q)]] = -2
        mine = found[int(q)]
        assert [r for r, _, _ in mine] == list(range(1, len(mine) + 1)) and len({v for _, v, _ in mine}) == len(mine) == 5
        assert all(abs(s[place[v]] - score) < 1e-12 for _, v, score in mine)
        hits += sum(s[place[v]] >= np.sort(s)[-5] - 1e-12 for _, v, _ in mine)
        total += 5
    return hits / total


def by_query(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def test_recall_on_whole_tables(spark):
    for d in ("sf0.01", "sf0.1"):
        table = pq.read_table(f"/root/testdata/{d}/embeddings.parquet")
        assert recall(by_query(QUERIES["op13_graph_search"](spark, f"/root/testdata/{d}")), table) >= 0.95


def test_recall_over_many_shards(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    table = pq.read_table("/root/testdata/sf0.1/embeddings.parquet")
    assert recall(by_query(G.nearest(df, shard=300, block=10)), table) >= 0.97


def planted():
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 6))
    rows = [(i, base[i % 40].tolist()) for i in range(90)]  # copies of every vector
    rows += [(100 + i, (base[3] * 2.0 ** (i - 5)).tolist()) for i in range(12)]  # parallel vectors
    rows += [(200 + i, base[7].tolist()) for i in range(30)]
    rows += [(None, base[7].tolist()), (None, base[9].tolist()), (None, rng.normal(size=6).tolist())]
    rows += [(300, base[11].tolist())] * 3 + [(300, base[12].tolist()), (350, (-base[12]).tolist())]
    rows += [(400, None), (450, []), (500, [0.0] * 6), (550, [float("nan")] + [1.0] * 5), (600, [None] + [1.0] * 5), (650, [float("inf")] * 6)]
    rows += [(700, [1.0, 2.0]), (701, [2.0, 1.0]), (702, [1.0, 2.0]), (750, [3.0]), (800, [1e300] * 5 + [1e-300]), (850, [1e-300] * 6), (900, [-0.0, 1.0, 0.0, 0.0, 0.0, 0.0])]
    rng.shuffle(rows)
    return rows


def test_planted(spark):
    rows = planted()
    exp = brute(rows)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(G.nearest(df)) == exp
    assert got(G.nearest(df, shard=20, block=2)) == exp


def test_few_rows_empty_table_and_clashing_columns(spark):
    assert G.nearest(spark.createDataFrame([], SCHEMA)).collect() == []
    assert G.nearest(spark.createDataFrame([(0, [1.0, 1.0])], SCHEMA)).collect() == []
    assert got(G.nearest(spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0])], SCHEMA))) == [(0, 1, 1, round(math.sqrt(0.5), 12))]
    rows = [(i, [float(i % 7), 1.0, float(i % 3)]) for i in range(60)]
    more = spark.createDataFrame([r + (1, [1], 2, 3, 4.0) for r in rows], SCHEMA + ", q int, ids array<int>, dim int, hub int, score double")
    assert got(G.nearest(more)) == brute(rows)


def test_graph_keeps_diverse_edges():
    """Every kept edge is nearer to the point than, relaxed, to the edges kept before it;
    degrees are bounded and every node can be reached from the entry point."""
    rng = np.random.default_rng(1)
    u = G.unit(rng.normal(size=(700, 12))).astype(np.float32)
    graph, entry = G.build_graph(u, 10, 24, 1.2)
    assert ((graph >= 0).sum(1) <= 10).all() and not (graph == np.arange(700)[:, None]).any()
    assert all(len(set(r[r >= 0])) == (r >= 0).sum() for r in graph)
    seen, todo = {entry}, [entry]
    while todo:
        fresh = {int(x) for x in graph[todo.pop()] if x >= 0} - seen
        seen |= fresh
        todo += fresh
    assert len(seen) == 700
    points = np.arange(50)
    cand = np.tile(np.arange(700), (50, 1))
    kept = G.robust_prune(u, points, cand, 10, 1.2)
    dist = lambda a, b: np.sqrt(np.maximum(2 - 2 * (u[a] @ u[b]), 0))
    for p, row in zip(points, kept):
        want, rest = [], sorted((c for c in range(700) if c != p), key=lambda c: dist(p, c))
        for c in rest:
            if len(want) < 10 and all(1.2 * dist(c, w) > dist(p, c) for w in want):
                want.append(c)
        assert row[row >= 0].tolist() == want
