"""N-gram Jaccard join by PartEnum signatures.

A document's set holds its distinct word n-grams (64-bit hashes).  Two sets link
when ``100 * intersection >= percent * union``.  Sizes are cut into bands so that
linked sets lie in the same or in neighbouring bands; a band fixes the largest
symmetric difference k a linked pair can have.  The hash domain is cut into
n1 first-level parts (k + 1 <= 2 * n1, so a linked pair differs by at most one
element in one of them), each part into three cells; the signature of a part is
every pair of its three cells.  Linked sets share one signature at least.

Every set emits its signatures for its own band and for the next one.  Sets that
share a signature are verified on the full sets, best first (see
``common.resolve_links``): the result is exact, and no bucket's pairs are listed
in full.

Defined cases: null, empty and blank texts have no set (n_shingles 0, their own
component); fewer words than n give one element, the whole sequence; equal sets
are one node; rows that share a doc_id each count and are returned; a row without doc_id
is returned with the component of its set's other rows (null if none has an id).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from contentflow.llm.common import (U64, bitmap_slot, free_name, hash_strings, hub_member_stream, id_bitmap, in_bitmap, mix64,
                                    resolve_links, save, shared_buckets, text_slices, trim, words_of)

SKETCH_BITS = 1024  # of the smallest sketch


def shingle_sets(texts: pa.Array, n: int, lower: bool = True) -> list[np.ndarray]:
    """Sorted distinct n-gram hashes of every text."""
    offsets, codes, words = words_of(texts, lower=lower)
    w = hash_strings(words)[codes]
    out = []
    odd = [U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F), U64(0x165667B19E3779F9),
           U64(0x27D4EB2F165667C5), U64(0x85EBCA77C2B2AE63)]
    mult = [odd[i % 5] + U64(2 * (i // 5)) for i in range(n)]
    grams = np.zeros(max(0, len(w) - n + 1), U64)
    for i in range(n):
        grams += mix64(w[i:len(w) - n + 1 + i] + mult[i]) * mult[i] if len(grams) else grams
    grams = mix64(grams)
    for a, b in zip(offsets[:-1], offsets[1:]):
        if b - a >= n:
            out.append(np.unique(grams[a:b - n + 1]))
        elif b > a:
            h = U64(b - a)
            for i in range(b - a):
                h = mix64(np.array([w[a + i] ^ h], U64))[0]
            out.append(np.array([h], U64))
        else:
            out.append(np.zeros(0, U64))
    return out


def set_key(s: np.ndarray) -> tuple[int, int]:
    """Two 64-bit keys of a set (sums of independent element hashes)."""
    a = mix64(s ^ U64(0x1234567890ABCDEF)).sum(dtype=U64)
    b = mix64(s + U64(0x5851F42D4C957F2D)).sum(dtype=U64)
    return int(a.astype(np.int64)), int(b.astype(np.int64))


def sketch_bits(size: int, percent: int) -> int:
    """Parities kept for a set: a power of two that grows with it.  Unrelated sets differ in
    about half of them, linked ones in 2 (100 - percent) / (100 + percent) of a size at
    most; six times half of that keeps the two apart however long the sets are."""
    return max(SKETCH_BITS, 1 << int(np.ceil(np.log2(max(1, 6 * size * (100 - percent) / (100 + percent))))))


def odd_sketch(s: np.ndarray, percent: int = 90) -> bytes:
    """Parities of slots: two sketches differ in no more bits than the sets in elements."""
    bits = sketch_bits(len(s), percent)
    slot = (mix64(s ^ U64(0xA5A5A5A5A5A5A5A5)) & U64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(slot, minlength=bits) & 1).astype(np.uint8)).tobytes()


def band_tops(percent: int, upto: int) -> np.ndarray:
    """Largest size of every band: u_{i+1} = floor(100 * (u_i + 1) / percent)."""
    tops = []
    top = 0
    while top < upto:
        top = max(top + 1, 100 * (top + 1) // percent)
        tops.append(top)
    tops.append(max(top + 1, 100 * (top + 1) // percent))
    tops.append(max(tops[-1] + 1, 100 * (tops[-1] + 1) // percent))
    return np.array(tops, np.int64)


def signatures(s: np.ndarray, percent: int, tops: np.ndarray) -> np.ndarray:
    """PartEnum signatures of one sorted set, for its band and the next."""
    band = int(np.searchsorted(tops, len(s)))
    prefix = np.concatenate((np.zeros(1, U64), np.cumsum(mix64(s ^ U64(0x3C6EF372FE94F82B)), dtype=U64)))
    out = []
    for instance in (band, band + 1):
        # |r| + |s| <= 2 * top, so the sets differ in k elements at most.
        k = int((100 - percent) * 2 * tops[instance] // (100 + percent))
        if k == 0:
            continue  # only equal sets link, and those are one node
        parts = (k + 2) // 2
        edges = (np.arange(1, 3 * parts, dtype=U64) * U64((1 << 32) // (3 * parts))) << U64(32)
        at = np.concatenate(([0], np.searchsorted(s, edges), [len(s)]))
        cell = (prefix[at[1:]] - prefix[at[:-1]]).reshape(-1, 3)
        seed = (np.arange(parts, dtype=U64) * U64(4) + U64(1)) * U64(0x9FB21C651E98DF25) + U64(instance * 0xD6E8FEB86659FD93 % (1 << 64))
        for which, (x, y) in enumerate(((0, 1), (0, 2), (1, 2))):
            out.append(mix64(mix64(cell[:, x] + seed) + cell[:, y] * U64(0x2545F4914F6CDD1D) + U64(which + 1)))
    return np.concatenate(out) if out else np.zeros(0, U64)


def _digests(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        for whole in batches:
            for batch in text_slices(whole, "text"):
                sets = shingle_sets(batch.column("text"), n)
                keys = [set_key(s) if len(s) else (None, None) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id"), batch.column("print"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
                    pa.array([odd_sketch(s, percent) if len(s) else None for s in sets], pa.binary())],
                    ["doc_id", "print", "n_shingles", "node", "check", "sketch"])
    return run


def _signature_rows(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        tops = band_tops(percent, 1 << 16)
        told: set[int] = set()  # nodes this task already emitted: copies cost one row set per task
        for whole in batches:
            for batch in text_slices(whole, "text"):
                sig, node = [], []
                for s in shingle_sets(batch.column("text"), n):
                    if len(s) == 0:
                        continue
                    key = set_key(s)[0]
                    if key in told:
                        continue
                    if len(told) >= 1 << 20:
                        told.clear()
                    told.add(key)
                    if len(s) > tops[-3]:
                        tops = band_tops(percent, len(s))
                    g = signatures(s, percent, tops)
                    sig.append(g)
                    node.append(np.full(len(g), key, np.int64))
                if sig:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(sig).view(np.int64)), pa.array(np.concatenate(node))], ["bucket", "node"])
    return run


def _set_rows(n: int, bitmap):
    """Sets of rows whose doc_id may be asked for; rows without one are always read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        bits = bitmap.value
        told: set[int] = set()
        for whole in batches:
            none = pc.is_null(whole.column("doc_id")).to_numpy(zero_copy_only=False)
            whole = whole.filter(pa.array(in_bitmap(bits, whole.column("slot").to_numpy()) | none))
            for batch in text_slices(whole, "text"):
                found = [(set_key(s)[0], s) for s in shingle_sets(batch.column("text"), n) if len(s)]
                if len(told) >= 1 << 20:
                    told.clear()
                fresh = [(k, s) for k, s in dict(found).items() if k not in told]
                told.update(k for k, _ in fresh)
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in fresh], pa.int64()), pa.array([s.tobytes() for _, s in fresh], pa.binary())],
                                                 ["node", "payload"])
    return run


def _intersections(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        hub, held = None, None
        for batch in batches:
            a, b = [], []
            for h, node, data in zip(batch.column("hub").to_pylist(), batch.column("node").to_pylist(),
                                     batch.column("payload")):
                s = np.frombuffer(data.as_buffer(), U64)
                if node is None:
                    hub, held = h, s.copy()
                elif hub == h:
                    lo, hi = (s, held) if len(s) <= len(held) else (held, s)
                    at = np.searchsorted(hi, lo)
                    at[at == len(hi)] = 0
                    both = int((hi[at] == lo).sum())
                    if 100 * both >= percent * (len(s) + len(held) - both):
                        a.append(h), b.append(node)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
    return run


def _components(docs: DataFrame, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, print, n_shingles, node)`` of every row and ``(node, rep, comp)`` of every
    set: rep its smallest doc_id (null if none has one), comp its component."""
    spark = docs.sparkSession
    digest = save(docs.mapInArrow(_digests(n, percent), "doc_id long, print string, n_shingles long, node long, check long, sketch binary"),
                  "ngram-digest")
    classes = save(digest.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("rep"), F.max("n_shingles").alias("size"), F.min_by("sketch", "check").alias("sketch"),
        (F.max("check") != F.min("check")).alias("clash")), "ngram-classes")
    if classes.where("clash").limit(1).count():
        raise ValueError("two different sets share a 64-bit key")
    nodes = classes.select("node", "size", "sketch")

    def admissible(na, nb, bits):
        return (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb)) & \
            (bits * (100 + percent) <= (100 - percent) * (na + nb))

    def verify(edges: DataFrame) -> DataFrame:
        need = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct().join(
            classes.select("node", "rep"), "node")
        bitmap = spark.sparkContext.broadcast(id_bitmap(need.where("rep is not null"), "rep"))
        read = docs if need.where("rep is null").limit(1).count() else docs.where("doc_id is not null")
        sets = read.select("doc_id", "text", bitmap_slot("doc_id")).mapInArrow(_set_rows(n, bitmap), "node long, payload binary")
        # By node: a set is met through any of its rows, with doc_id or without.
        sets = save(need.select("node").join(sets, "node").dropDuplicates(["node"]).select("node", "payload"), "ngram-sets")
        members = edges.join(sets.withColumnRenamed("node", "b"), "b").select(
            F.col("a").alias("hub"), F.col("b").alias("node"), "payload")
        hubs = sets.withColumnRenamed("node", "hub")
        return hub_member_stream(hubs, members, _intersections(percent), "a long, b long")

    rows = docs.select("text").mapInArrow(_signature_rows(n, percent), "bucket long, node long")
    comps = resolve_links(shared_buckets(rows), nodes, admissible, verify, "ngram")
    sets = classes.select("node", "rep").join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    return digest.select("doc_id", "print", "n_shingles", "node"), sets


def jaccard_components(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs(doc_id, text)``."""
    digest, sets = _components(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(None).cast("string").alias("print")), n, percent)
    # Smallest doc_id per component of nodes.
    lowest = sets.groupBy("comp").agg(F.min("rep").alias("low"))
    by_node = sets.join(lowest, "comp").select("node", F.col("low").alias("component_id"))
    return digest.select("doc_id", "n_shingles", "node").join(by_node, "node", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one_per_group(docs: DataFrame, n: int = 3, percent: int = 90) -> DataFrame:
    """One row of every component, all columns: that with the smallest doc_id (rows without
    one come last), of several the one whose text has the smallest MD5.

    Rows without a set (null, empty and blank texts) are no copies: they stay, of those that
    repeat a doc_id one.  Rows that share a doc_id but not a component all stay: a text
    of its own is never dropped for its number.
    """
    key, text_print, rank = (free_name(docs, x) for x in ("_doc", "_print", "_rank"))
    marked = docs.withColumn(key, F.col("doc_id").cast("long")).withColumn(text_print, F.md5(F.coalesce("text", F.lit(""))))
    digest, sets = _components(marked.select(F.col(key).alias("doc_id"), "text", F.col(text_print).alias("print")), n, percent)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "print")
    first = digest.where("node is not null").join(sets.select("node", "comp"), "node").groupBy("comp").agg(F.min(place).alias("w")).select("w.doc_id", "w.print")
    alone = digest.where("node is null").select("doc_id", "print").distinct()
    kept = first.unionByName(alone).distinct().select(F.col("doc_id").alias("_kept_doc"), F.col("print").alias("_kept_print"))
    rows = marked.join(kept, F.col(key).eqNullSafe(F.col("_kept_doc")) & (F.col(text_print) == F.col("_kept_print")), "left_semi")
    # Exact repeats of a kept row: one stays (of blank rows without doc_id, all).
    blank = ~F.coalesce(F.col("text"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    every = rows.where(blank & F.col(key).isNull())
    once = Window.partitionBy(key, F.when(blank, F.lit("")).otherwise(F.col(text_print))).orderBy(F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]))
    one = rows.where(~blank | F.col(key).isNotNull()).withColumn(rank, F.row_number().over(once)).where(F.col(rank) == 1)
    return one.select(*docs.columns).unionByName(every.select(*docs.columns))
