"""Line dedup by a segment-partition edit join.

Lines (the parts of a text between ``\\n``) that are not blank link when their edit
distance is at most ``min(max_edits, shorter length // chars_per_edit)``.  A line of
length l is cut into threshold + 1 segments; a line within the threshold keeps one
of them unchanged, at a place that the length difference bounds.  So every line
emits its segments (keyed by length, segment number and content) and, for each
length l it can be the longer partner of, the substrings that the position bounds
allow.  Lines that share a key are candidates; the parities of their character
pairs sift them, and the exact banded bit-parallel edit distance decides.

Links give classes of lines; of every class the first line (smallest doc_id, then
line number) stays, later ones go.

Defined cases: blank lines (only white space) are never dropped; a null text stays
null, an empty one empty; equal lines are one node, so repeated lines of a document
and repeated rows drop too (of rows that share doc_id and line number one stays, by
the hash of the text, and one of equal rows); rows without doc_id come last.  Rows that
share a doc_id, or have none, are judged each by itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentflow.llm.common import (U64, bitmap_slot, free_name, id_bitmap, in_bitmap, mix64, resolve_links, save,
                                    shared_buckets, trim)

BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
BASE_INV = pow(BASE, -1, 1 << 64)
SKETCH_WORDS = 4  # 256 bits


def threshold(length: int, max_edits: int, chars_per_edit: int) -> int:
    return min(max_edits, length // chars_per_edit)


def probe_places(length: int, longer: int, edits: int) -> list[tuple[int, int, int]]:
    """``(segment, start, size)`` of the substrings of a line of ``longer`` characters
    that can equal a segment of a line of ``length`` within ``edits``.

    Segment i (from 0) starts at p.  With i edits at most to its left, a match starts
    within i of p; with edits - i at most to its right, within edits - i of p plus the
    length difference.
    """
    delta = longer - length
    out = []
    for i, (p, size) in enumerate(segments(length, edits)):
        lo = max(0, p - i, p + delta - (edits - i))
        hi = min(longer - size, p + i, p + delta + (edits - i))
        out += [(i, s, size) for s in range(lo, hi + 1)]
    return out


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """``(start, size)`` of edits + 1 nearly equal segments, the longer ones last."""
    n = edits + 1
    size, extra = divmod(length, n)
    sizes = [size + (i >= n - extra) for i in range(n)]
    return [(sum(sizes[:i]), sizes[i]) for i in range(n)]


class Powers:
    """Powers of BASE and of its inverse, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, U64)

    def upto(self, n: int):
        if len(self.up) < n:
            m = max(n, 2 * len(self.up))
            for name, base in (("up", BASE), ("down", BASE_INV)):
                x = np.full(m, U64(base))
                x[0] = U64(1)
                setattr(self, name, np.cumprod(x, dtype=U64))
        return self.up, self.down


def line_keys(lines: list[str], max_edits: int, chars_per_edit: int, powers: Powers):
    """``(row, key)`` of all segment and probe keys of the lines."""
    data = "".join(lines).encode("utf-32-le", "surrogatepass")
    chars = np.frombuffer(data, np.uint32).astype(U64)
    length = np.array([len(x) for x in lines], np.int64)
    start = np.concatenate(([0], np.cumsum(length)))
    up, down = powers.upto(len(chars) + 1)
    # Hash of chars[s:e] = (P[e] - P[s]) * BASE**-s: the same wherever the substring stands.
    prefix = np.concatenate((np.zeros(1, U64), np.cumsum(mix64(chars) * up[:len(chars)], dtype=U64)))
    plans = [places(n, max_edits, chars_per_edit) for n in length.tolist()]
    rows = np.repeat(np.arange(len(lines)), [p.shape[1] for p in plans])
    at, size, seed = np.concatenate(plans, axis=1) if plans else np.zeros((3, 0), np.int64)
    a = start[rows] + at
    h = (prefix[a + size] - prefix[a]) * down[a]
    return rows, mix64(h + seed.view(U64)).view(np.int64)


@lru_cache(maxsize=1 << 15)
def places(n: int, max_edits: int, chars_per_edit: int) -> np.ndarray:
    """Rows ``start, size, seed`` of the keys that a line of ``n`` characters emits."""
    out = []
    for short in range(max(0, n - max_edits), n + 1):
        edits = threshold(short, max_edits, chars_per_edit)
        if edits == 0 or n - short > edits:
            continue
        out += [(short, i, s, z) for i, s, z in probe_places(short, n, edits)]
        if short == n:
            out += [(short, i, s, z) for i, (s, z) in enumerate(segments(n, edits))]
    out = [(s, z, mix(short * 64 + i + 1)) for short, i, s, z in dict.fromkeys(out)]
    return np.array(out, np.int64).reshape(-1, 3).T


def mix(x: int) -> int:
    return int(mix64(np.array([x], U64)).view(np.int64)[0])


def pair_sketch(line: str) -> bytes:
    """256 parities of the line's character pairs: an edit changes four at most."""
    c = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U64)
    if len(c) < 2:
        return bytes(8 * SKETCH_WORDS)
    h = mix64(c[:-1] * U64(0x100000001B3) + c[1:]) >> U64(56)
    bits = np.bincount(h.astype(np.int64), minlength=64 * SKETCH_WORDS) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


def banded_distances(left: list[str], right: list[str], limit: int) -> np.ndarray:
    """Edit distances, or ``limit + 1`` where larger (limit <= 30).

    Bit-parallel over a diagonal band of 2 * limit + 1 cells, one machine word per
    pair; all pairs advance together, one column a step.  The common start and end of
    a pair are cut off first.
    """
    a_, b_ = [], []
    for x, y in zip(left, right):
        if len(x) < len(y):
            x, y = y, x
        n = len(y)
        k = _common(x, y, n)
        x, y = x[k:], y[k:]
        k = _common(x[::-1], y[::-1], len(y))
        a_.append(x[:len(x) - k]), b_.append(y[:len(y) - k])
    n = len(a_)
    out = np.full(n, limit + 1, np.int64)
    la, lb = np.array([len(x) for x in a_], np.int64), np.array([len(x) for x in b_], np.int64)
    out[lb == 0] = np.minimum(la, limit + 1)[lb == 0]
    todo = np.flatnonzero((lb > 0) & (la - lb <= limit))
    todo = todo[np.argsort(lb[todo], kind="stable")]
    while len(todo):
        # Pairs of like length together; bounded matrix size.
        upto = max(1, int(np.searchsorted(lb[todo], max(64, 2 * lb[todo[0]]), "right")))
        upto = min(upto, max(1, (1 << 22) // int(lb[todo[upto - 1]] + limit)))
        now, todo = todo[:upto], todo[upto:]
        out[now] = _band([a_[i] for i in now], [b_[i] for i in now], limit)
    return out


def _common(x: str, y: str, n: int) -> int:
    """Length of the common start, by halving steps over slices."""
    lo, hi = 0, n
    while lo < hi:
        mid = (lo + hi + 1) // 2
        if x[lo:mid] == y[lo:mid]:
            lo = mid
        else:
            hi = mid - 1
    return lo


def _band(a: list[str], b: list[str], limit: int) -> np.ndarray:
    """Band walk of pairs with ``len(a) >= len(b) >= 1`` and close lengths.

    Bit 63 stands for the cell ``limit`` rows below the diagonal; the band moves down
    the diagonal until it meets a's last row, then the walk follows that row.
    """
    la, lb = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    wide = int(lb.max())
    A = np.zeros((len(a), wide + 2 * limit + 2), np.uint32)
    B = np.full((len(b), wide), 0xFFFFFFFF, np.uint32)
    A[:] = 0xFFFFFFFE
    for r, (x, y) in enumerate(zip(a, b)):
        A[r, limit:limit + len(x)] = np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32)[:wide + limit + 2]
        B[r, :len(y)] = np.frombuffer(y.encode("utf-32-le", "surrogatepass"), np.uint32)
    one = U64(1)
    vp = np.full(len(a), (((1 << (limit + 1)) - 1) << (63 - limit)) & ((1 << 64) - 1), U64)
    vn = np.zeros(len(a), U64)
    # The walk starts in the first column, ``limit`` rows down or in a's last row.
    dist = np.minimum(la, limit)
    row_bit = 62 - np.maximum(0, limit - la)
    for j in range(wide):
        live = j < lb
        match = np.zeros(len(a), U64)
        for k in range(2 * limit + 1):  # a's position j - limit + k is bit 63 - 2 * limit + k
            match |= (A[:, j + k] == B[:, j]).astype(U64) << U64(63 - 2 * limit + k)
        d0 = (((match & vp) + vp) ^ vp) | match | vn
        hp = vn | ~(d0 | vp)
        hn = d0 & vp
        down = j < la - limit
        dist += np.where(live & down, 1 - (d0 >> U64(63)).astype(np.int64), 0)
        along = live & ~down
        bit = np.maximum(row_bit, 0).astype(U64)
        step = ((hp >> bit) & one).astype(np.int64) - ((hn >> bit) & one).astype(np.int64)
        dist += np.where(along, step, 0)
        row_bit -= along
        vp = hn | ~((d0 >> one) | hp)
        vn = (d0 >> one) & hp
    return np.minimum(dist, limit + 1)


PART_PAIRS = 1 << 15  # keys per part, on average
MOST_PARTS = 1 << 22
BLOB_PAIRS = 64  # a row of the shuffle holds up to so many keys (1 KB)
HELD_PAIRS = 1 << 22  # a task sorts at most so many keys itself


def _blobs(keys: np.ndarray, nodes: np.ndarray, bits: int) -> pa.RecordBatch:
    """Rows ``(part, blob)``: keys by their top ``bits`` bits, a blob with ``key, node`` of up to
    BLOB_PAIRS keys of one part."""
    part = (keys.view(U64) >> U64(64 - bits)).astype(np.int32) if bits else np.zeros(len(keys), np.int32)
    order = np.argsort(part, kind="stable")
    part = part[order]
    pairs = np.stack((keys[order], nodes[order]), axis=1)
    at = np.arange(len(part))
    new = np.ones(len(part), bool)
    new[1:] = part[1:] != part[:-1]
    place = at - np.maximum.accumulate(np.where(new, at, 0))
    cut = np.flatnonzero(place % BLOB_PAIRS == 0)
    ends = np.append(cut, len(part)).astype(np.int32) * 16
    blob = pa.Array.from_buffers(pa.binary(), len(cut), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(pairs))])
    return pa.RecordBatch.from_arrays([pa.array(part[cut]), blob], ["part", "blob"])


def _key_rows(max_edits: int, chars_per_edit: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        powers = Powers()
        told: set[int] = set()
        keys, nodes, held = [], [], 0
        for batch in batches:
            ids, lines = batch.column("node").to_pylist(), batch.column("line").to_pylist()
            rows, text, size = [], [], 0
            for i, x in [*zip(ids, lines), (None, None)]:
                if i is None or size > 1 << 21:
                    if text:
                        r, k = line_keys(text, max_edits, chars_per_edit, powers)
                        keys.append(k), nodes.append(np.array(rows, np.int64)[r])
                        held += len(k)
                        if held > 1 << 20:
                            yield _blobs(np.concatenate(keys), np.concatenate(nodes), bits)
                            keys, nodes, held = [], [], 0
                    rows, text, size = [], [], 0
                if i is not None and i not in told:
                    if len(told) >= 1 << 18:
                        told.clear()
                    told.add(i)
                    rows.append(i), text.append(x)
                    size += len(x)
        if held:
            yield _blobs(np.concatenate(keys), np.concatenate(nodes), bits)
    return run


def _met(pairs: np.ndarray) -> pa.RecordBatch:
    """``(bucket, hub, node)`` of the keys in ``pairs(key, node)`` that two or more nodes have."""
    pairs = pairs[np.argsort(pairs[:, 0])]
    same = pairs[1:, 0] == pairs[:-1, 0]
    keep = np.zeros(len(pairs), bool)
    keep[1:] = same
    keep[:-1] |= same
    pairs = pairs[keep]
    pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
    b, v = pairs[:, 0], pairs[:, 1]
    fresh = np.ones(len(b), bool)
    fresh[1:] = (b[1:] != b[:-1]) | (v[1:] != v[:-1])
    b, v = b[fresh], v[fresh]
    first = np.ones(len(b), bool)
    first[1:] = b[1:] != b[:-1]
    start = np.flatnonzero(first)
    n = np.diff(np.append(start, len(b)))
    hub, k = np.repeat(v[start], n), np.repeat(n > 1, n)
    return pa.RecordBatch.from_arrays([pa.array(b[k]), pa.array(hub[k]), pa.array(v[k])], ["bucket", "hub", "node"])


def _met_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts in order -> ``(bucket, hub, node)``; the keys of a part too large to sort here
    come out as they are, with a null hub."""
    trim()

    def as_they_are(pairs: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.nulls(len(pairs), pa.int64()), pa.array(pairs[:, 1])],
                                          ["bucket", "hub", "node"])

    whole: list[np.ndarray] = []  # of parts that are complete
    open_: list[np.ndarray] = []  # of the part ``now``, which may go on
    now, large, n_whole, n_open = None, False, 0, 0
    for batch in batches:
        part = batch.column("part").to_numpy()
        if len(part) == 0:
            continue
        pairs = [np.frombuffer(x.as_buffer(), np.int64).reshape(-1, 2) for x in batch.column("blob")]
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        for a, z in zip(cuts[:-1], cuts[1:]):
            if part[a] != now:
                whole += open_
                now, large, n_whole, n_open, open_ = part[a], False, n_whole + n_open, 0, []
                if n_whole >= PART_PAIRS:
                    yield _met(np.concatenate(whole))
                    whole, n_whole = [], 0
            open_.append(np.concatenate(pairs[a:z]))
            n_open += len(open_[-1])
            if large or n_open > HELD_PAIRS:
                yield as_they_are(np.concatenate(open_))
                large, open_, n_open = True, [], 0
    if n_whole + n_open:
        yield _met(np.concatenate(whole + open_))


def shared_keys(lines: DataFrame, max_edits: int, chars_per_edit: int, distinct: int) -> DataFrame:
    """``(bucket, hub, node)`` of the keys that two or more of ``lines(node, line)`` emit.

    Keys travel packed, up to BLOB_PAIRS a row, dealt by their top bits into parts of about
    PART_PAIRS; a task sorts a part at a time.  Parts of more than HELD_PAIRS (a key
    that very many lines share) are unpacked and go through Spark's own sort."""
    emitted = distinct * max(1, places(200, max_edits, chars_per_edit).shape[1])
    bits = min(MOST_PARTS, max(1, emitted // PART_PAIRS)).bit_length()
    packed = lines.mapInArrow(_key_rows(max_edits, chars_per_edit, bits), "part int, blob binary")
    met = packed.repartition("part").sortWithinPartitions("part").mapInArrow(_met_rows, "bucket long, hub long, node long")
    met = save(met, "line-keys")
    done, rest = met.where("hub is not null"), met.where("hub is null")
    return done if rest.limit(1).count() == 0 else done.unionByName(save(shared_buckets(rest.select("bucket", "node")), "line-keys"))


def _sketch_rows(bitmap):
    def run(batches):
        for batch in batches:
            batch = batch.filter(pa.array(in_bitmap(bitmap.value, batch.column("slot").to_numpy())))
            lines = batch.column("line").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("node"), pa.array([len(x) for x in lines], pa.int64()),
                 pa.array([pair_sketch(x) for x in lines], pa.binary())], ["node", "size", "sketch"])
    return run


def line_classes(lines: DataFrame, max_edits: int = 2, chars_per_edit: int = 10, distinct: int | None = None) -> DataFrame:
    """``(node, comp)`` of the lines of ``lines(node, line)`` that link with others;
    ``node`` is ``xxhash64(line)``.  ``distinct``: about how many different lines there are."""
    spark = lines.sparkSession
    if distinct is None:
        distinct = lines.agg(F.approx_count_distinct("node")).first()[0]

    def some(bitmap_of: DataFrame):
        return lines.select("node", "line", bitmap_slot("node")), spark.sparkContext.broadcast(id_bitmap(bitmap_of, "node"))

    buckets = shared_keys(lines, max_edits, chars_per_edit, distinct)
    need = save(buckets.select("node").distinct(), "line-nodes")
    rows, bitmap = some(need)
    nodes = rows.mapInArrow(_sketch_rows(bitmap), "node long, size long, sketch binary").dropDuplicates(["node"])
    nodes = save(nodes.join(need, "node"), "line-sketches")

    def admissible(na, nb, bits):
        edits = np.minimum(max_edits, np.minimum(na, nb) // chars_per_edit)
        return (np.abs(na - nb) <= edits) & (bits <= 4 * edits)

    def verify(edges: DataFrame) -> DataFrame:
        ends = edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
        part, bits = some(ends)

        def pick(batches):
            for batch in batches:
                yield batch.filter(pa.array(in_bitmap(bits.value, batch.column("slot").to_numpy()))).select(["node", "line"])

        text = part.mapInArrow(pick, "node long, line string").dropDuplicates(["node"])
        text = save(text.join(ends, "node"), "line-texts")

        def check(batches):
            for batch in batches:
                for at in range(0, batch.num_rows, 4096):
                    b = batch.slice(at, 4096)
                    x, y = b.column("x").to_pylist(), b.column("y").to_pylist()
                    allowed = np.array([threshold(min(len(p), len(q)), max_edits, chars_per_edit) for p, q in zip(x, y)], np.int64)
                    ok = banded_distances(x, y, max_edits) <= allowed
                    yield b.select(["a", "b"]).filter(pa.array(ok & (allowed > 0)))

        both = edges.join(text.select(F.col("node").alias("a"), F.col("line").alias("x")), "a").join(
            text.select(F.col("node").alias("b"), F.col("line").alias("y")), "b")
        return both.select("a", "b", "x", "y").mapInArrow(check, "a long, b long")

    return resolve_links(buckets, nodes, admissible, verify, "line")


def split_lines(docs: DataFrame, row: Column) -> DataFrame:
    """``doc_id, row, text_key, line_no, line, node``; ``row`` is a number of its own for
    every row; node is null for blank lines."""
    return docs.where("text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), row.alias("row"), F.xxhash64("text").alias("text_key"),
        F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")).withColumn(
        "node", F.when(F.length(F.btrim("line", F.lit(" \t\n\x0b\f\r"))) > 0, F.xxhash64("line")))


def dedup_lines(docs: DataFrame, max_edits: int = 2, chars_per_edit: int = 10, row: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(lines, classes)``: the kept or dropped state of every line, ``doc_id, row,
    line_no, node, comp, kept``, and the classes of linked lines ``(node, comp)``.
    ``row`` tells rows with one doc_id, or none, apart: the column of that name, or a
    number given here (stable only once saved)."""
    # Saved once: texts are split and hashed in one pass, and all uses see the same row numbers.
    lines = save(split_lines(docs, F.monotonically_increasing_id() if row is None else F.col(row)), "line-places")
    other = F.xxhash64(F.lit("b"), "line")
    seen = lines.where("node is not null").groupBy("node").agg((F.max(other) != F.min(other)).alias("clash")).agg(
        F.count("*").alias("n"), F.max("clash").alias("clash")).first()
    if seen["clash"]:
        raise ValueError("two different lines share a 64-bit key")
    classes = save(line_classes(lines.where("node is not null").select("node", "line"), max_edits, chars_per_edit, seen["n"]),
                   "line-classes")
    placed = lines.drop("line").join(classes, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    # Ids that are null sort last: (false, id) < (true, null).
    place = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "line_no", "text_key", "row")
    first = placed.where("comp is not null").groupBy("comp").agg(F.min(place).alias("first"))
    out = placed.join(first, "comp", "left").withColumn(
        "kept", F.col("comp").isNull() | ((F.col("first.row") == F.col("row")) & (F.col("first.line_no") == F.col("line_no"))))
    return out.select("doc_id", "row", "line_no", "node", "comp", "kept"), classes


def line_report(docs: DataFrame, max_edits: int = 2, chars_per_edit: int = 10) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_blank, n_dropped, n_kept,
    kept_chars, classes`` (the smallest class of its dropped lines, null if none).

    Rows that share a doc_id are reported together.
    """
    lines, _ = dedup_lines(docs, max_edits, chars_per_edit)
    gone = ~F.col("kept")
    done = lines.groupBy("doc_id").agg(
        F.count("*").alias("n_lines"), F.count_if(F.col("node").isNull()).alias("n_blank"),
        F.count_if(gone).alias("n_dropped"), F.count_if(F.col("kept") & F.col("node").isNotNull()).alias("n_kept"),
        F.min(F.when(gone, F.col("comp"))).alias("first_dropped_class"))
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    zero = F.lit(0).cast("long")
    return ids.join(done, ids["doc_id"].eqNullSafe(done["doc_id"]), "left").select(
        ids["doc_id"], *[F.coalesce(c, zero).alias(c) for c in ("n_lines", "n_blank", "n_dropped", "n_kept")],
        "first_dropped_class")


def without_repeated_lines(docs: DataFrame, max_edits: int = 2, chars_per_edit: int = 10) -> DataFrame:
    """``docs`` with the dropped lines taken out of ``text``; other columns as they are."""
    row, lost = free_name(docs, "_row"), free_name(docs, "_gone")
    rows = save(docs.withColumn(row, F.monotonically_increasing_id()), "line-docs")
    lines, _ = dedup_lines(rows, max_edits, chars_per_edit, row)
    gone = lines.where(~F.col("kept")).groupBy(F.col("row").alias(row)).agg(F.collect_set("line_no").alias(lost))
    out = rows.join(gone, row, "left")
    text = F.when(F.col(lost).isNull(), F.col("text")).otherwise(F.array_join(F.filter(
        F.split("text", "\n", -1), lambda x, i: ~F.array_contains(lost, i)), "\n"))
    return out.withColumn("text", text).select(*docs.columns)
