"""Embedding near-dedup: exact threshold pairs by dual traversal of cover trees.

Vectors are compared as points of the unit sphere: cosine >= c there is a
Euclidean distance of at most sqrt(2 - 2c).  Per label:

1. equal vectors become one point with a multiplicity;
2. every point goes to its nearest pivot (farthest-first pivots from a bounded
   sample: they shape the cells only, no row is left out), and a cell larger than
   ``block`` points is split by hash, so that a hot label or cell is many blocks;
3. each block builds a cover tree: nested levels with halving radii, every node
   with its true covering radius;
4. pairs of blocks are pruned by the blocks' covering radii, the rest is walked
   node pair by node pair: apart (distance > r + r + limit) is dropped, within
   (distance + r + r <= limit) is accepted whole, anything else is opened; points
   are compared by their cosine in double precision.

A block pair returns a count of links and one representative per point, never
the pairs themselves; the representatives give the components.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and vectors without label, link with nothing (n_links 0, their own
component); vectors of different lengths do not link; equal vectors link with each
other, repeated rows included; a row without vec_id counts as a link of others, its
own component is null unless linked.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentflow.llm.common import connected_components, save

SLACK = 1e-7  # whole-node decisions stay this far from the limit; points decide the rest


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow in the squares
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Tree:
    """Cover tree of the rows of ``x`` (unit vectors), as nested lists.

    ``kids[i]`` are the children of node i (empty: a leaf with ``rows[i]``),
    ``at[i]`` its centre's row, ``radius[i]`` the largest distance to a row below.
    """

    def __init__(self, x: np.ndarray, leaf: int = 24):
        self.x = x
        self.at, self.radius, self.kids, self.rows = [], [], [], []
        self.leaf = leaf
        if len(x):
            self._node(0, np.arange(len(x)), 2.0)

    def _node(self, centre: int, rows: np.ndarray, level: float) -> int:
        me = len(self.at)
        dist = distance(self.x[rows], self.x[centre])
        self.at.append(centre)
        self.radius.append(float(dist.max()))
        self.kids.append([])
        self.rows.append(rows)
        if len(rows) <= self.leaf or self.radius[me] <= 1e-7:
            return me
        level /= 2
        while level >= self.radius[me]:
            level /= 2
        # Greedy net of radius ``level``: the centre first, then the first row not covered.
        groups = [(centre, rows[dist <= level])]
        left = rows[dist > level]
        while len(left):
            c = int(left[0])
            near = distance(self.x[left], self.x[c]) <= level
            near[0] = True
            groups.append((c, left[near]))
            left = left[~near]
        self.kids[me] = [self._node(c, r, level) for c, r in groups]
        return me


def distance(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return np.sqrt((d * d).sum(axis=1))


def dual_links(a: Tree, b: Tree, same: bool, cosine: float, weight_a, weight_b):
    """Links between the rows of two trees (``same``: within one tree).

    Returns ``(count_a, count_b, group_a, group_b)``: the weighted number of links
    of every row, and a group number shared by rows that the links connect.
    """
    limit = np.sqrt(2 - 2 * cosine)
    na, nb = len(a.x), len(b.x)
    count_a, count_b = np.zeros(na), np.zeros(nb)
    parent = np.arange(na + (0 if same else nb))
    shift = 0 if same else na

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def union(rows):
        roots = {find(int(r)) for r in rows}
        low = min(roots)
        for r in roots:
            parent[r] = low

    stack = [([0], [0])] if na and nb else []
    ra, rb = np.array(a.radius), np.array(b.radius)
    ca, cb = a.x[np.array(a.at, int)] if na else a.x, b.x[np.array(b.at, int)] if nb else b.x
    while stack:
        left, right = (np.array(s) for s in stack.pop())
        d = np.sqrt(np.maximum(0, 2 - 2 * (ca[left] @ cb[right].T)))
        reach = ra[left][:, None] + rb[right][None, :]
        near = d <= reach + limit + SLACK
        if same:  # subtrees are numbered in runs, so each pair is met once, lower node first
            near &= left[:, None] <= right[None, :]
        for i, j in zip(*np.nonzero(near)):
            p, q = left[i], right[j]
            whole = d[i, j] + reach[i, j] <= limit - SLACK and not (same and p == q)
            if whole:
                rows, cols = a.rows[p], b.rows[q]
                count_a[rows] += weight_b[cols].sum()
                count_b[cols] += weight_a[rows].sum()
                union(np.concatenate((rows, cols + shift)))
            elif not a.kids[p] and not b.kids[q]:
                rows, cols = a.rows[p], b.rows[q]
                hit = a.x[rows] @ b.x[cols].T >= cosine
                if same and p == q:
                    hit &= rows[:, None] < cols[None, :]
                count_a[rows] += hit @ weight_b[cols]
                count_b[cols] += weight_a[rows] @ hit
                for x in np.flatnonzero(hit.any(axis=1)):
                    union(np.concatenate((rows[x:x + 1], cols[hit[x]] + shift)))
            else:
                # Open the wider node (both, if they are the same one).
                if same and p == q:
                    stack.append((a.kids[p], a.kids[p]))
                elif not b.kids[q] or (a.kids[p] and ra[p] >= rb[q]):
                    stack.append((a.kids[p], [q]))
                else:
                    stack.append(([p], b.kids[q]))
    roots = np.array([find(i) for i in range(len(parent))], np.int64)
    if same:
        total = count_a + count_b
        return total, total, roots, roots
    return count_a, count_b, roots[:na], roots[na:]


def _pack(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _unpack(data) -> dict:
    with np.load(io.BytesIO(data), allow_pickle=False) as z:
        return {k: z[k] for k in z.files}


def _vectors(column) -> np.ndarray:
    """Equal-length lists -> 2-d array."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(column.flatten()).reshape(len(column), -1)


def cosine_links(vectors: DataFrame, cosine: float = 0.98, sample: int = 1024, block: int = 2048) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors(vec_id,
    embedding, label)``.

    ``sample`` bounds the rows that pivots are chosen from, per label and length.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    valid = (F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite
             & F.exists("embedding", lambda x: x != 0))
    # -0.0 and 0.0 are one value for grouping; Spark normalises them itself.
    good = rows.where(valid).withColumn("size", F.size("embedding"))
    points = good.groupBy("label", "size", "embedding").agg(
        F.min("vec_id").alias("low"), F.count("*").alias("copies"))
    points = save(points.withColumn("point", F.xxhash64("label", "embedding")), "cover-points")
    if points.groupBy("point").count().where("count > 1").limit(1).count():
        raise ValueError("two different vectors share a 64-bit key")
    sizes = points.groupBy("label", "size").agg(F.count("*").alias("n"))

    # Pivots: farthest first on a hash sample of bounded size.
    share = F.pmod(F.xxhash64("point", F.lit(5)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = points.join(sizes, ["label", "size"]).where((F.col("n") <= sample) | (share < F.lit(float(sample)) / F.col("n")))

    def pivots(key, table):
        table = table.sort_by([("point", "ascending")])
        x = unit(_vectors(table.column("embedding")))
        n = table.column("n")[0].as_py()
        want = int(min(len(x), 256, max(1, -(-n // block))))
        chosen = [0]
        d = distance(x, x[0])
        while len(chosen) < want and d.max() > 1e-6:
            chosen.append(int(d.argmax()))
            d = np.minimum(d, distance(x, x[chosen[-1]]))
        return pa.table({"label": pa.array([key[0].as_py()] * 1, table.column("label").type),
                         "size": pa.array([key[1].as_py()], pa.int32()), "pivots": [_pack(x=x[chosen])]})

    label = dict(vectors.dtypes)["label"]
    tops = drawn.groupBy("label", "size").applyInArrow(pivots, f"label {label}, size int, pivots binary")
    # A label's points meet its pivots in salted groups of bounded size.
    salted = points.join(sizes, ["label", "size"]).withColumn(
        "salt", F.pmod(F.xxhash64("point", F.lit(3)), F.ceil(F.col("n") / 8192)).cast("int"))
    tops = tops.join(sizes, ["label", "size"]).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), (F.ceil(F.col("n") / 8192) - 1).cast("int"))))

    def assign(key, left, right):
        if right.num_rows == 0 or left.num_rows == 0:
            cell = np.zeros(left.num_rows, np.int32)
        else:
            p = _unpack(right.column("pivots")[0].as_py())["x"]
            x = unit(_vectors(left.column("embedding")))
            cell = (x @ p.T).argmax(axis=1).astype(np.int32)
        return left.select(["label", "size", "point", "copies", "embedding"]).append_column("cell", pa.array(cell, pa.int32()))

    kind = dict(vectors.dtypes)["embedding"]
    placed = salted.groupBy("label", "size", "salt").cogroup(tops.groupBy("label", "size", "salt")).applyInArrow(
        assign, f"label {label}, size int, point long, copies long, embedding {kind}, cell int")
    placed = save(placed, "cover-cells")
    cells = placed.groupBy("label", "size", "cell").agg(F.ceil(F.count("*") / block).cast("int").alias("parts"))
    placed = placed.join(cells, ["label", "size", "cell"]).withColumn(
        "part", F.pmod(F.xxhash64("point", F.lit(9)), F.col("parts")).cast("int"))

    def build(key, table):
        table = table.sort_by([("point", "ascending")])
        raw = _vectors(table.column("embedding"))
        x = unit(raw)
        centre = x.mean(axis=0)
        return pa.table({
            "label": pa.array([key[0].as_py()], table.column("label").type), "size": pa.array([key[1].as_py()], pa.int32()),
            "block": pa.array([(key[2].as_py() << 32) + key[3].as_py()], pa.int64()),
            "centre": [centre.tolist()], "reach": [float(distance(x, centre).max())],
            "payload": [_pack(x=raw, point=table.column("point").to_numpy(), copies=table.column("copies").to_numpy())]})

    blocks = save(placed.groupBy("label", "size", "cell", "part").applyInArrow(
        build, f"label {label}, size int, block long, centre array<double>, reach double, payload binary"), "cover-blocks")
    # Block pairs of a label that their covering radii cannot tell apart.
    meta = blocks.select("label", "size", "block", "centre", "reach")
    other = meta.select("label", "size", F.col("block").alias("block2"), F.col("centre").alias("centre2"),
                        F.col("reach").alias("reach2"))
    apart = F.sqrt(F.aggregate(F.zip_with("centre", "centre2", lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, v: s + v))
    limit = float(np.sqrt(2 - 2 * cosine)) + SLACK
    pairs = (meta.join(other, ["label", "size"]).where("block <= block2")
             .where(apart <= F.col("reach") + F.col("reach2") + limit).select("label", "size", "block", "block2"))
    right = blocks.select("label", "size", F.col("block").alias("block2"), F.col("payload").alias("payload2"))
    pairs = pairs.join(blocks.select("label", "size", "block", "payload"), ["label", "size", "block"]).join(
        right, ["label", "size", "block2"]).select("block", "block2", "payload", "payload2")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                same = batch.column("block")[r].as_py() == batch.column("block2")[r].as_py()
                a = _unpack(batch.column("payload")[r].as_py())
                b = a if same else _unpack(batch.column("payload2")[r].as_py())
                ta = Tree(unit(a["x"]))
                tb = ta if same else Tree(unit(b["x"]))
                wa, wb = a["copies"].astype(float), b["copies"].astype(float)
                count_a, count_b, group_a, group_b = dual_links(ta, tb, same, cosine, wa, wb)
                point = a["point"] if same else np.concatenate((a["point"], b["point"]))
                count = count_a if same else np.concatenate((count_a, count_b))
                group = group_a if same else np.concatenate((group_a, group_b))
                k = count > 0
                if k.any():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(point[k]), pa.array(count[k].astype(np.int64)), pa.array(point[group[k]])],
                        ["point", "links", "root"])

    # One block pair per row; small batches keep one pair of payloads in memory at a time.
    pairs = save(pairs, "cover-pairs").repartition("block", "block2")
    found = save(pairs.mapInArrow(walk, "point long, links long, root long"), "cover-links")
    comps = connected_components(found.select(F.col("point").alias("a"), F.col("root").alias("b")), "cover")
    low = comps.join(points.select(F.col("point").alias("node"), "low"), "node")
    low = low.join(low.groupBy("comp").agg(F.min("low").alias("first")), "comp").select(F.col("node").alias("point"), "first")
    links = found.groupBy("point").agg(F.sum("links").alias("links"))
    by_point = points.select("point", "copies", F.col("low")).join(links, "point", "left").join(low, "point", "left").select(
        "point", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("first", "low").alias("component_id"))
    keyed = rows.withColumn("point", F.when(valid, F.xxhash64("label", "embedding")))
    return keyed.join(by_point, "point", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.col("vec_id") == F.coalesce("component_id", "vec_id")).alias("kept"))
