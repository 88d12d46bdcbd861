"""Approximate nearest neighbours by robust-pruned directed graphs, one per shard.

1. Rows with equal vectors become one point, which keeps its smallest ids only (more
   copies than are asked for can never be listed).  Points are dealt to shards of about
   ``shard`` points by hash: every row is indexed, a hot vector is one point.
2. Each shard builds a graph of unit vectors: points are inserted in growing batches, a
   greedy beam search from the entry point proposes neighbours (what the beam holds and
   what it opened on its way), relaxed pruning keeps at most ``degree`` diverse ones: of
   the candidates in order of distance, one falls if it is nearer to a kept one, by the
   factor ``relax``, than to the point.  Back edges are added and pruned the same way.
   The built shards are a table of their own.
3. Queries are dealt in blocks; every block meets every shard of its dimension, a beam
   search finds the points, and their exact cosines in double precision rank them.  The
   best of all shards are merged per query.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components
take no part; vectors of different lengths do not meet; repeated rows (same vec_id and
vector) count once, and never as neighbours of themselves; rows without vec_id are
candidates (last among ties) but no queries; a table without queries gives no row;
columns other than vec_id and embedding are not read.
"""

from __future__ import annotations

import io

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from contentflow.llm.common import save

BATCH = 1024  # points inserted, and queries searched, at a time


# ---------------------------------------------------------------- graph
def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled by a power of two (exact, nothing overflows), then to length one."""
    x = exact_scale(x)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def exact_scale(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    _, e = np.frexp(np.abs(x).max(axis=1, keepdims=True))
    return np.ldexp(x, -e)


def beam_search(x: np.ndarray, graph: np.ndarray, entry: int, q: np.ndarray, width: int):
    """Greedy beam search for every row of ``q`` at once.

    Returns the ``width`` most similar nodes found per row, best first (-1: none), and
    the nodes opened on the way, a column per step (-1: the row had ended)."""
    b = len(q)
    ids = np.full((b, width), -1, np.int64)
    sim = np.full((b, width), -np.inf, np.float32)
    seen = np.ones((b, width), bool)
    ids[:, 0], sim[:, 0], seen[:, 0] = entry, q @ x[entry], False
    opened = []
    while True:
        act = np.flatnonzero(~seen.all(axis=1))
        if len(act) == 0:
            return ids, np.stack(opened, axis=1) if opened else np.zeros((b, 0), np.int64)
        spot = np.argmin(seen[act], axis=1)  # rows stand best first
        node = ids[act, spot]
        seen[act, spot] = True
        step = np.full(b, -1, np.int64)
        step[act] = node
        opened.append(step)
        near = graph[node]
        s = np.matmul(x[near], q[act][:, :, None])[:, :, 0]
        s[(near < 0) | (near[:, :, None] == ids[act][:, None, :]).any(axis=2)] = -np.inf
        all_sim = np.concatenate((sim[act], s), axis=1)
        order = np.argsort(-all_sim, axis=1, kind="stable")[:, :width]
        sim[act] = np.take_along_axis(all_sim, order, axis=1)
        ids[act] = np.take_along_axis(np.concatenate((ids[act], near), axis=1), order, axis=1)
        fresh = np.concatenate((seen[act], np.isneginf(s)), axis=1)
        seen[act] = np.take_along_axis(fresh, order, axis=1)


def robust_prune(x: np.ndarray, points: np.ndarray, candidates: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """At most ``degree`` diverse out-edges per point (-1: none) of its candidates."""
    c = np.sort(candidates, axis=1)
    c[:, 1:][c[:, 1:] == c[:, :-1]] = -1
    alive = (c >= 0) & (c != points[:, None])
    vec = x[c]
    far = np.sqrt(np.maximum(2 - 2 * np.matmul(vec, x[points][:, :, None])[:, :, 0], 0))
    far[~alive] = np.inf
    order = np.argsort(far, axis=1, kind="stable")
    c, far, alive = (np.take_along_axis(a, order, axis=1) for a in (c, far, alive))
    vec = np.take_along_axis(vec, order[:, :, None], axis=1)
    out = np.full((len(points), degree), -1, np.int64)
    rows = np.arange(len(points))
    for k in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        pick = np.argmax(alive, axis=1)
        out[some, k] = c[rows, pick][some]
        apart = np.sqrt(np.maximum(2 - 2 * np.matmul(vec, vec[rows, pick][:, :, None])[:, :, 0], 0))
        alive &= relax * apart > far
        alive[rows, pick] = False
    return out


def build_graph(x: np.ndarray, degree: int, width: int, relax: float, seed: int = 3) -> tuple[np.ndarray, int]:
    """Out-edges of every row of ``x`` (distinct unit vectors) and the entry point."""
    n = len(x)
    graph = np.full((n, degree), -1, np.int64)
    order = np.random.default_rng(seed).permutation(n)
    entry = int(np.argmax(x @ x.mean(axis=0)))
    order = np.concatenate(([entry], order[order != entry]))
    done, size = 1, 64
    while done < n:
        new = order[done:done + size]
        beam, opened = beam_search(x, graph, entry, x[new], width)
        # Points of one batch do not find each other in the graph: neighbours in the order they came.
        mates = new[(np.arange(len(new))[:, None] + np.arange(1, min(9, len(new)))) % len(new)] if len(new) > 1 else np.zeros((1, 0), np.int64)
        graph[new] = robust_prune(x, new, np.concatenate((beam, opened, mates), axis=1), degree, relax)
        _add_back_edges(x, graph, new, degree, relax)
        done += len(new)
        size = min(BATCH, max(64, done // 2))
    return graph, entry


def _add_back_edges(x: np.ndarray, graph: np.ndarray, new: np.ndarray, degree: int, relax: float) -> None:
    at, k = np.nonzero(graph[new] >= 0)
    source, target = new[at], graph[new[at], k]
    sim = np.einsum("ij,ij->i", x[source], x[target])
    order = np.lexsort((-sim, target))
    source, target = source[order], target[order]
    first = np.ones(len(target), bool)
    first[1:] = target[1:] != target[:-1]
    group = np.cumsum(first) - 1
    place = np.arange(len(target)) - np.flatnonzero(first)[group] if len(target) else np.zeros(0, np.int64)
    keep = place < 2 * degree  # the nearest ones; the pruning takes at most ``degree``
    touched = target[first]
    for a in range(0, len(touched), BATCH):
        nodes = touched[a:a + BATCH]
        back = np.full((len(nodes), 2 * degree), -1, np.int64)
        mine = keep & (group >= a) & (group < a + len(nodes))
        back[group[mine] - a, place[mine]] = source[mine]
        both = np.concatenate((graph[nodes], back), axis=1)
        room = (both >= 0).sum(axis=1) <= degree
        pruned = robust_prune(x, nodes, both, degree, relax)
        if room.any():  # nothing has to go
            few = np.sort(both[room], axis=1)
            few[:, 1:][few[:, 1:] == few[:, :-1]] = -1
            pruned[room] = -np.sort(-few, axis=1)[:, :degree]
        graph[nodes] = pruned


# ---------------------------------------------------------------- shards
def usable(vec: Column) -> Column:
    def bad(v):
        return v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    return F.coalesce((F.size(vec) > 0) & ~F.exists(vec, bad) & F.exists(vec, lambda v: v != 0), F.lit(False))


def _pack(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _matrix(column) -> np.ndarray:
    flat = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _build(degree: int, width: int, relax: float):
    def run(key, table):
        x = _matrix(table.column("vec"))
        u, where = np.unique(unit(x).astype(np.float32), axis=0, return_inverse=True)  # parallel vectors: one node
        graph, entry = build_graph(u, degree, width, relax)
        of = np.argsort(where, kind="stable")
        lists = table.column("ids").combine_chunks()
        ids = lists.flatten()
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        size = np.diff(lists.offsets.to_numpy())
        blob = _pack(x=x, u=u, graph=graph.astype(np.int32), entry=entry, of=of, first=np.concatenate(([0], np.cumsum(np.bincount(where.ravel(), minlength=len(u))))),
                     ids=ids.fill_null(0).to_numpy(), known=known, start=np.concatenate(([0], np.cumsum(size))))
        return pa.table([pa.array([key[0].as_py()], pa.int64()), pa.array([blob], pa.binary())], names=["hub", "graph"])
    return run


FOUND = "query_id long, q long, vec_id long, score double"
NAMES, KINDS = ["query_id", "q", "vec_id", "score"], (pa.int64(), pa.int64(), pa.int64(), pa.float64())


def _search(k: int, width: int):
    def run(key, shards, blocks):
        if shards.num_rows == 0:  # no point was dealt to this shard
            return pa.table([pa.array([], t) for t in KINDS], names=NAMES)
        s = np.load(io.BytesIO(shards.column("graph")[0].as_py()))
        x = exact_scale(s["x"])
        u, graph, entry, of, first, ids, known, start = (s[c] for c in ("u", "graph", "entry", "of", "first", "ids", "known", "start"))
        norm = np.sqrt((x * x).sum(axis=1))
        out = [[], [], [], []]
        vecs = _matrix(blocks.column("vec"))
        for a in range(0, len(vecs), BATCH):
            q = exact_scale(vecs[a:a + BATCH])
            beam, _ = beam_search(u, graph.astype(np.int64), int(entry), unit(q).astype(np.float32), width)
            for i, (mine, number) in enumerate(zip(blocks.column("query_id")[a:a + BATCH].to_pylist(), blocks.column("q")[a:a + BATCH].to_pylist())):
                nodes = beam[i][beam[i] >= 0]
                points = np.concatenate([of[first[n]:first[n + 1]] for n in nodes])
                score = (x[points] @ q[i]) / (norm[points] * np.sqrt(q[i] @ q[i]))
                # All members of the points that can be among the best k.
                if len(points) > k + 1:
                    least = np.partition(score, -(k + 1))[-(k + 1)]
                    points, score = points[score >= least], score[score >= least]
                many = start[points + 1] - start[points]
                row = np.repeat(np.arange(len(points)), many)
                member = np.concatenate([np.arange(start[p], start[p + 1]) for p in points])
                same = (x[points] == q[i]).all(axis=1)
                ok = ~(same[row] & known[member] & (ids[member] == mine))
                row, member = row[ok], member[ok]
                best = np.lexsort((ids[member], ~known[member], -score[row]))[:k]
                out[0] += [mine] * len(best)
                out[1] += [number] * len(best)
                out[2] += [int(ids[m]) if known[m] else None for m in member[best]]
                out[3] += score[row[best]].tolist()
        return pa.table([pa.array(c, t) for c, t in zip(out, KINDS)], names=NAMES)
    return run


def nearest(vectors: DataFrame, every: int = 50, k: int = 5, *, shard: int = 8192, block: int = 1024, degree: int = 32,
            proposals: int = 64, width: int = 192, relax: float = 1.2) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found for every row whose
    vec_id is divisible by ``every``, among all other rows.

    ``proposals`` is the beam's width while building, ``width`` while searching."""
    rows = vectors.where(usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vec")).distinct()
    rows = save(rows, "graph-rows")
    # The k + 1 smallest ids of a vector: a query that is one of them leaves k.
    low = Window.partitionBy("vec").orderBy(F.col("vec_id").asc_nulls_last())
    points = rows.withColumn("r", F.row_number().over(low)).where(F.col("r") <= k + 1).groupBy("vec").agg(
        F.sort_array(F.collect_list(F.struct("r", "vec_id"))).alias("m")).select("vec", F.col("m.vec_id").alias("ids"), F.size("vec").cast("long").alias("dim"))
    points = save(points, "graph-points")
    shards = save(points.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard).alias("shards")), "graph-dims")
    hub = F.shiftleft("dim", 32) + F.pmod(F.xxhash64(F.lit(5), "vec"), F.col("shards"))
    graphs = save(points.join(shards, "dim").select(hub.alias("hub"), "vec", "ids").groupBy("hub").applyInArrow(
        _build(degree, proposals, relax), "hub long, graph binary"), "graph-shards")
    asked = rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.xxhash64("vec").alias("q"), "vec",
                                                          F.size("vec").cast("long").alias("dim"))
    # The stated queries against all rows: each block of queries meets each shard.
    blocks = asked.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks")).join(shards, "dim")
    dealt = asked.join(blocks, "dim").withColumn("block", F.pmod(F.xxhash64(F.lit(9), "query_id", "q"), F.col("blocks"))).select(
        "query_id", "q", "vec", "block", F.explode(F.sequence(F.shiftleft("dim", 32), F.shiftleft("dim", 32) + F.col("shards") - 1)).alias("hub"))
    pairs = dealt.select(F.col("hub").alias("to"), F.col("block").alias("part")).distinct()
    meet = graphs.join(pairs, graphs["hub"] == pairs["to"]).select("to", "part", "graph")
    found = meet.groupBy("to", "part").cogroup(dealt.groupBy("hub", "block")).applyInArrow(_search(k, width), FOUND)
    best = Window.partitionBy("query_id", "q").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
