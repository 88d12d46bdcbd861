"""Helpers shared by the operators of this folder.

* ``save``: cut a lineage by writing a table under ``spark.checkpoint.dir``.
* ``words_of`` and the 64-bit hashes: vectorised word handling inside tasks.
* ``shared_buckets`` / ``resolve_links``: turn "these rows share a key" into the
  connected components of an exact predicate without emitting all pairs.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentflow.session import ensure_checkpoint_dir

U64 = np.uint64


# ---------------------------------------------------------------- storage
def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder the cluster names."""
    return f"{ensure_checkpoint_dir(spark)}/llm/{tag}-{uuid.uuid4().hex}"


def save(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


# ---------------------------------------------------------------- hashing
def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift, multiply)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def hash_strings(strings: pa.Array) -> np.ndarray:
    """64-bit hash of every string (stable over processes)."""
    if len(strings) == 0:
        return np.zeros(0, U64)
    return pd.util.hash_array(strings.to_numpy(zero_copy_only=False), categorize=False)


def words_of(texts: pa.Array, lower: bool = False):
    """Words ``[^\\x20\\x09-\\x0D]+`` of every text.

    Returns ``(offsets, codes, words)``: the words of text ``i`` are
    ``words[codes[offsets[i]:offsets[i + 1]]]``.  Null texts have no words.
    ``lower`` folds A-Z only, in the list of words (which can then repeat a word).
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.string()), ""))
    off = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(off[0], off[-1] - off[0])
    off = off - off[0]
    keep = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate(([0], np.cumsum(keep)))[off]
    coded = flat.filter(pa.array(keep)).dictionary_encode()
    words = pc.ascii_lower(coded.dictionary) if lower else coded.dictionary
    return offsets, coded.indices.to_numpy().astype(np.int64), words


def trim() -> None:
    """Give memory that earlier tasks of this worker process used back to the machine."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back is not None:
        give_back(0)


def text_slices(batch: pa.RecordBatch, column: str, chars: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Split a batch into runs of whole rows of about ``chars`` bytes of text, so
    that a task's working set does not follow the batch size."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(size) - size) // chars
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [batch.num_rows]))
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


# ---------------------------------------------------------------- bitmaps
def slot_bitmap(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """Bitmap of fixed size (``bits`` / 8 bytes) over a column of slots in [0, bits).

    Built by Spark's bitmap aggregate; the driver gets ``bits / 32768`` rows of
    4 KB at most, whatever the input size.  (Spark's buckets count slots from 1.)
    """
    slot = F.col(column) + 1
    rows = (df.select(slot.alias("s")).groupBy(F.bitmap_bucket_number("s").alias("k"))
              .agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("m")).collect())
    out = np.zeros(-(-bits // 32768) * 4096, np.uint8)
    for r in rows:
        at = (r["k"] - 1) * 4096
        out[at:at + 4096] = np.frombuffer(bytes(r["m"]), np.uint8)
    return out


def bitmap_slot(column: str, bits: int = 1 << 25):
    """Slot of an id in ``id_bitmap``."""
    return F.pmod(F.xxhash64(F.col(column)), F.lit(bits)).alias("slot")


def id_bitmap(df: DataFrame, column: str, bits: int = 1 << 25) -> np.ndarray:
    """Bitmap over the hashes of an id column.  A filter by it has false positives
    only, so an exact join always follows."""
    return slot_bitmap(df.select(bitmap_slot(column, bits)), "slot", bits)


def in_bitmap(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    return (bitmap[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


# ---------------------------------------------------------------- components
def _parents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(a, b)`` sorted, a > b: every a keeps its smallest b (``extra`` 0), its
    other b are tied to that one (``extra`` 1)."""
    last_a = last_b = low = None
    for batch in batches:
        a, b = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if len(a) == 0:
            continue
        new = np.ones(len(a), bool)
        new[1:] = a[1:] != a[:-1]
        again = np.zeros(len(a), bool)
        again[1:] = ~new[1:] & (b[1:] == b[:-1])
        new[0] = last_a is None or a[0] != last_a
        again[0] = not new[0] and b[0] == last_b
        start = np.maximum.accumulate(np.where(new, np.arange(len(a)), -1))
        least = b[np.maximum(start, 0)]
        if low is not None:
            least = np.where(start < 0, low, least)
        last_a, last_b, low = a[-1], b[-1], least[-1]
        more = ~new & ~again & (b != least)
        keep = new | more
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.where(new, a, b)[keep]), pa.array(least[keep]), pa.array(more[keep].astype(np.int32))], ["a", "b", "extra"])


def connected_components(edges: DataFrame, tag: str, rounds: int = 60) -> DataFrame:
    """``(node, comp)`` for every node of ``edges(a, b)``; comp = smallest node.

    Each round gathers a node's smaller neighbours (one shuffle, streamed in sorted
    order), keeps the smallest as its parent, ties the others to that one, and then
    replaces every edge's end by that end's parent (an equi-join, whose hot hubs the
    planner splits), so paths halve.  It ends when no edge moved: all point at roots.
    Every round is a table in the shared folder; the driver sees one number per round.
    """
    e = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
    for _ in range(rounds):
        tied = e.repartition("a").sortWithinPartitions("a", "b").mapInArrow(_parents, "a long, b long, extra int")
        parent = tied.where("extra = 0").select(F.col("a").alias("p"), F.col("b").alias("pp"))
        jumped = tied.join(parent, tied["b"] == parent["p"], "left").select(
            "a", F.coalesce("pp", "b").alias("b"), (F.col("p").isNotNull() | (F.col("extra") == 1)).alias("moved"))
        e = save(jumped, f"{tag}-cc")
        if e.where("moved").limit(1).count() == 0:
            star = e.select(F.col("a").alias("node"), F.col("b").alias("comp"))
            return star.unionByName(star.select(F.col("comp").alias("node"), "comp").distinct())
    raise RuntimeError("connected components did not settle")


def shared_buckets(rows: DataFrame) -> DataFrame:
    """``(bucket, hub, node)`` of the buckets that hold two or more nodes.

    ``rows(bucket, node)``; repeated rows are dropped, ``hub`` is the bucket's
    smallest node.  One shuffle by bucket; each partition is streamed in sorted
    order with one row of look-back and look-ahead, so a bucket of any size is
    never held in memory.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        # State: the last row seen (pending) and whether it was already joined by a neighbour.
        pend = None  # (bucket, node, hub, has_left)
        for batch in batches:
            b = batch.column(0).to_numpy()
            v = batch.column(1).to_numpy()
            if len(b) == 0:
                continue
            if pend is not None:
                b = np.concatenate(([pend[0]], b))
                v = np.concatenate(([pend[1]], v))
            fresh = np.ones(len(b), bool)
            fresh[1:] = (b[1:] != b[:-1]) | (v[1:] != v[:-1])
            b, v = b[fresh], v[fresh]
            first = np.ones(len(b), bool)
            first[1:] = b[1:] != b[:-1]
            start = np.maximum.accumulate(np.where(first, np.arange(len(b)), 0))
            hub = v[start]
            left = ~first
            if pend is not None:
                hub[start == 0] = pend[2]
                left[0] = pend[3]
            keep = left.copy()
            keep[:-1] |= ~first[1:]
            pend = (b[-1], v[-1], hub[-1], bool(left[-1]))
            k = np.flatnonzero(keep[:-1])
            if len(k):
                yield pa.RecordBatch.from_arrays([pa.array(b[k]), pa.array(hub[k]), pa.array(v[k])],
                                                 ["bucket", "hub", "node"])
        if pend is not None and pend[3]:
            yield pa.RecordBatch.from_arrays([pa.array([pend[0]], pa.int64()), pa.array([pend[2]], pa.int64()),
                                              pa.array([pend[1]], pa.int64())], ["bucket", "hub", "node"])

    spread = rows.select("bucket", "node").repartition("bucket").sortWithinPartitions("bucket", "node")
    return spread.mapInArrow(run, "bucket long, hub long, node long")


def popcounts(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of every pair of sketch rows (``uint64`` words)."""
    return np.bitwise_count(a[:, None, :] ^ b[None, :, :]).sum(-1, dtype=np.int64)


def sketch_rows(column: pa.Array, words: int = 0) -> np.ndarray:
    """Parity sketches -> ``(rows, words)`` array of uint64, folded to ``words`` (by default
    the shortest sketch's width): a sketch is a power of two times as wide, and the
    parity of a slot of the narrow one is that of all slots that share its low bits."""
    cells = [np.frombuffer(x, U64) for x in column.to_pylist()]
    if not cells:
        return np.zeros((0, max(words, 1)), U64)
    width = np.array([len(c) for c in cells])
    words = words or int(width.min())
    out = np.empty((len(cells), words), U64)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        out[rows] = np.bitwise_xor.reduce(np.stack([cells[i] for i in rows]).reshape(len(rows), w // words, words), axis=1)
    return out


def sketch_distances(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Differing bits of the pairs (a_i, b_i), at the narrower sketch's width."""
    width = pc.min_element_wise(pc.binary_length(a), pc.binary_length(b)).to_numpy(zero_copy_only=False) // 8
    out = np.zeros(len(width), np.int64)
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        take = pa.array(rows)
        out[rows] = np.bitwise_count(sketch_rows(a.take(take), int(w)) ^ sketch_rows(b.take(take), int(w))).sum(1, dtype=np.int64)
    return out


def resolve_links(buckets: DataFrame, nodes: DataFrame, admissible: Callable, verify: Callable[[DataFrame], DataFrame],
                  tag: str, block: int = 2048, first: int = 64) -> DataFrame:
    """Components ``(node, comp)`` of the links among nodes that share a bucket.

    ``buckets(bucket, hub, node)`` from ``shared_buckets``; ``nodes(node, size,
    sketch)``, sketches of any power of two of 64-bit words (a set's width may grow with
    its size).  ``admissible(size_a, size_b, differing_bits)`` is a *necessary*
    condition of a link (vectorised), ``verify(edges(a, b))`` keeps the true
    links.  Every linked pair must share a bucket.

    Pairs are not all listed.  First each node is checked against its buckets'
    hubs.  Then, as long as a bucket holds nodes of different components, the
    admissible pairs between two components are verified best first: ``first``, then
    64 times as many ... pairs per pair of components, until none is left unchecked.  Pairs
    inside a component need no check, so the result is exact.  Buckets of more
    than ``block`` nodes are dealt out as pairs of blocks.
    """
    buckets = save(buckets, f"{tag}-buckets")
    star = buckets.where("hub != node").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    na = nodes.select(F.col("node").alias("a"), F.col("size").alias("na"), F.col("sketch").alias("ka"))
    nb = nodes.select(F.col("node").alias("b"), F.col("size").alias("nb"), F.col("sketch").alias("kb"))

    def sift(batches):
        for batch in batches:
            if batch.num_rows == 0:
                continue
            bits = sketch_distances(batch.column("ka"), batch.column("kb"))
            ok = admissible(batch.column("na").to_numpy().astype(np.int64),
                            batch.column("nb").to_numpy().astype(np.int64), bits)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    star = star.join(nb, "b").join(na, "a").mapInArrow(sift, "a long, b long")
    star = save(star, f"{tag}-try")
    links = save(verify(star), f"{tag}-links")
    tried = star
    limit, comps = first, None
    while True:
        if comps is None:
            comps = save(connected_components(links, tag), f"{tag}-comps")
        seen = buckets.select("bucket", "node").join(comps, "node", "left").withColumn(
            "comp", F.coalesce("comp", "node"))
        open_ = seen.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"),
                                           F.count("*").alias("n"),
                                           F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("h"))
        # Buckets with the same members ask the same question: keep one of them.
        open_ = open_.where("lo != hi").groupBy("n", "h").agg(F.min("bucket").alias("bucket"))
        dealt = (seen.join(open_, "bucket")
                 .withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
                 .withColumn("mine", F.pmod(F.xxhash64("node", F.lit(7)), F.col("blocks")).cast("int"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .select("bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                         "mine", "node", "comp"))
        found = save(_cross_pairs(dealt.join(nodes, "node"), admissible, limit), f"{tag}-cross")
        more = bool(found.agg(F.max("more")).first()[0])  # pairs were left for a larger limit
        fresh = save(found.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), f"{tag}-try")
        right = save(verify(fresh), f"{tag}-links") if fresh.limit(1).count() else fresh
        if right.limit(1).count():
            links, tried = links.unionByName(right), tried.unionByName(fresh)
            comps = None
        if not more:  # every admissible pair between components was verified
            return comps if comps is not None else save(connected_components(links, tag), f"{tag}-comps")
        limit *= 64


def _cross_pairs(dealt: DataFrame, admissible: Callable, limit: int) -> DataFrame:
    """Admissible pairs between components, the ``limit`` best per pair of
    components and block pair; ``more`` is true where others were left."""
    def run(key, table):
        if table.num_rows > 512:  # small groups leave little behind, and there are very many
            trim()
        i, j = key[1].as_py(), key[2].as_py()
        table = table.sort_by([("node", "ascending")])
        mine = table.column("mine").to_numpy()
        node = table.column("node").to_numpy()
        _, comp = np.unique(table.column("comp").to_numpy(), return_inverse=True)
        size = table.column("size").to_numpy().astype(np.int64)
        bits = sketch_rows(table.column("sketch").combine_chunks())
        left, right = np.flatnonzero(mine == i), np.flatnonzero(mine == j)
        a_, b_, d_ = [], [], []
        step = max(1, (1 << 20) // max(1, len(right) * bits.shape[1]))
        for s in range(0, len(left), step):
            rows = left[s:s + step]
            d = popcounts(bits[rows], bits[right])
            ok = admissible(size[rows][:, None], size[right][None, :], d)
            ok &= comp[rows][:, None] != comp[right][None, :]
            if i == j:
                ok &= rows[:, None] < right[None, :]
            x, y = np.nonzero(ok)
            # Keep per pair of components the best ones so far (bounded by the components met).
            share = d[x, y] / (size[rows[x]] + size[right[y]])
            a_.append(rows[x]), b_.append(right[y]), d_.append(share)
            if sum(map(len, a_)) > 1 << 17:
                a, b, d, _ = _best(np.concatenate(a_), np.concatenate(b_), np.concatenate(d_), comp, limit + 1)
                a_, b_, d_ = [a], [b], [d]
        none = pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64()), "more": pa.array([], pa.bool_())})
        if not a_ or not sum(map(len, a_)):
            return none
        a, b, d, rank = _best(np.concatenate(a_), np.concatenate(b_), np.concatenate(d_), comp, limit + 1)
        more = bool((rank >= limit).any())
        k = rank < limit
        lo, hi = np.minimum(node[a[k]], node[b[k]]), np.maximum(node[a[k]], node[b[k]])
        return pa.table({"a": lo, "b": hi, "more": np.full(k.sum(), more)})

    return dealt.groupBy("bucket", "i", "j").applyInArrow(run, "a long, b long, more boolean")


def _best(a, b, d, comp, limit):
    """The ``limit`` pairs with the smallest share of differing bits per pair of components."""
    ca, cb = np.minimum(comp[a], comp[b]), np.maximum(comp[a], comp[b])
    order = np.lexsort((b, a, d, cb, ca))
    a, b, d, ca, cb = a[order], b[order], d[order], ca[order], cb[order]
    new = np.ones(len(a), bool)
    new[1:] = (ca[1:] != ca[:-1]) | (cb[1:] != cb[:-1])
    rank = np.arange(len(a)) - np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
    k = rank < limit
    return a[k], b[k], d[k], rank[k]


# ---------------------------------------------------------------- hub / member streams
def hub_member_stream(hubs: DataFrame, members: DataFrame, run: Callable, schema: str,
                      per_task: int = 512) -> DataFrame:
    """Meet every member row with its hub's payload, hot hubs split.

    ``hubs(hub, payload binary)``, ``members(hub, node, payload binary)``.  A hub
    with m members is dealt to ceil(m / per_task) salts; in each salt the hub's
    row sorts first, so a task holds one hub payload at a time.  ``run`` is the
    ``mapInArrow`` function over rows ``(hub, salt, node, payload)`` where the
    hub's own row has a null node.
    """
    n = members.groupBy("hub").agg(F.ceil(F.count("*") / per_task).cast("int").alias("salts"))
    left = hubs.join(n, "hub").select("hub", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                                      F.lit(None).cast("long").alias("node"), "payload")
    right = members.join(n, "hub").select("hub", F.pmod(F.xxhash64("node", F.lit(11)), F.col("salts")).cast("int").alias("salt"),
                                          "node", "payload")
    both = left.unionByName(right)
    return (both.repartition("hub", "salt").sortWithinPartitions("hub", "salt", F.col("node").asc_nulls_first())
            .mapInArrow(run, schema))
