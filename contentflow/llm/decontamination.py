"""Benchmark decontamination by spaced-seed hashing.

Words are compared lower-cased and without punctuation around them.  Fixed masks over
10 neighbouring words ignore two positions each; a window's hash leaves those words out,
so a changed word does not hide a passage.  The windows of all benchmark items are hashed;
documents' windows that pass a bitmap of those hashes (of fixed size, whatever the
benchmark's size; false hits only) are joined with them.  A hit fixes an alignment of
document and item; along it, the best run of equal words with substitutions (a
different word costs two equal ones) is measured on the words themselves.

A document is contaminated by an item if that run has ``min_equal`` equal words (or all
words of a shorter item) and at least ``identity`` of its words are equal.  With
``every_run`` (the query and the pipeline) also if any other run along the alignment does,
or, for an item of 10 to 19 words, if at least ``identity`` of the item's words are in
place.  An alignment needs a hit: changes that touch every window of an item under every
mask hide it.

Defined cases: null and empty texts match nothing; items of fewer than ``min_item``
words are not searched (they are common phrases), items shorter than a mask are searched
as a whole, without substitutions; rows that share a doc_id are judged each by its own
text; rows without doc_id are reported with a null doc_id; items with the same item_id
count as one item each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentflow.llm.common import (free_name, U64, bitmap_slot, hash_strings, id_bitmap, in_bitmap, mix64, save, slot_bitmap,
                                    text_slices, words_of)

MASKS = ("1110111011", "1101101111", "1011110111", "1111011101")
SPAN = 10
SHORT = 20  # items of fewer words are also judged as a whole
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~«»“”„’‘…–—¿¡"
BITS = 1 << 25


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, hashes)`` of the normalised words; words that are only punctuation go."""
    offsets, codes, words = words_of(texts)
    words = pc.utf8_trim(pc.utf8_lower(words), characters=PUNCTUATION)
    h = hash_strings(words)
    full = pc.greater(pc.binary_length(words), 0).to_numpy(zero_copy_only=False)
    keep = full[codes] if len(codes) else np.zeros(0, bool)
    return np.concatenate(([0], np.cumsum(keep)))[offsets], h[codes[keep]] if len(codes) else np.zeros(0, U64)


def masks_for(lengths: set[int], min_item: int) -> list[str]:
    """The fixed masks, and a mask without gaps for each length of a short item."""
    return [*MASKS, *("1" * n for n in sorted(lengths) if min_item <= n < SPAN)]


def seeds(words: np.ndarray, mask: str) -> np.ndarray:
    """Hash of every window of ``len(mask)`` words under the mask."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.full(n, U64(int(mask, 2) + (len(mask) << 20)))
    for j, c in enumerate(mask):
        if c == "1":
            out += words[j:j + n] * U64((0x9E3779B97F4A7C15 * (2 * j + 1) | 1) % (1 << 64))
    return mix64(out)


def seed_slot(h: np.ndarray) -> np.ndarray:
    return (h >> U64(64 - 25)).astype(np.int64)


def best_run(equal: np.ndarray) -> tuple[int, int, int]:
    """``(start, length, equal words)`` of the run with the highest score (equal: 1,
    different: -2), from running sums."""
    score = np.concatenate(([0], np.cumsum(np.where(equal, 1, -2))))
    low = np.minimum.accumulate(score)
    end = int(np.argmax(score - low))
    start = int(np.flatnonzero(score[:end + 1] == low[end])[-1])
    return start, end - start, int(equal[start:end].sum())


def any_run(equal: np.ndarray, min_equal: int, identity: float) -> tuple[int, int, int] | None:
    """``(start, length, equal words)`` of the run with the most equal words among all with
    ``min_equal`` or more that are ``identity`` of its words; None if there is none."""
    same = np.concatenate(([0], np.cumsum(equal)))
    score = same - identity * np.arange(len(same))
    low = np.minimum.accumulate(score)
    # The longest run up to each end starts where the running minimum first lets it.
    start = np.searchsorted(-low, -(score + 1e-9), "left")
    held = same - same[start]
    if held.max() < max(1, min_equal):
        return None
    # Without unequal words around it; the shortest, then the first of those with the most.
    best = []
    for end in np.flatnonzero(held == held.max()):
        at = start[end] + np.flatnonzero(equal[start[end]:end])
        best.append((int(at[-1] - at[0] + 1), int(at[0])))
    size, first = min(best)
    return first, size, int(held.max())


def accepted(equal: np.ndarray, n_item: int, min_equal: int, identity: float, every_run: bool) -> tuple[int, int, int] | None:
    """The run on which an alignment is accepted: the best one if that has enough equal words;
    with ``every_run`` else any, or, for a short item, the item's words in place if ``identity``
    of them are equal."""
    start, n, same = best_run(equal)
    if same >= min(min_equal, n_item) and same >= identity * n:
        return start, n, same
    if every_run and n_item >= SPAN:
        if n_item < SHORT and equal.sum() >= identity * n_item - 1e-9:
            at = np.flatnonzero(equal)
            return int(at[0]), int(at[-1] - at[0] + 1), len(at)
        if n_item >= min_equal:
            return any_run(equal, min_equal, identity)
    return None


def _item_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in text_slices(whole, "text"):
            off, h = word_hashes(batch.column("text"))
            cells = [h[a:b].astype("<u8").tobytes() for a, b in zip(off[:-1], off[1:])]
            yield pa.RecordBatch.from_arrays([batch.column("item"), batch.column("item_id"), pa.array(np.diff(off)),
                                              pa.array(cells, pa.binary())], ["item", "item_id", "n", "words"])


def _item_seeds(masks: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, cell in zip(batch.column("item").to_pylist(), batch.column("words").to_pylist()):
                w = np.frombuffer(cell, "<u8").astype(U64)
                for mask in masks:
                    if len(mask) == SPAN or len(mask) == len(w):
                        h = seeds(w, mask)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(h.view(np.int64)), pa.array(np.full(len(h), item, np.int64)),
                             pa.array(np.arange(len(h))), pa.array(seed_slot(h))], ["seed", "item", "at", "slot"])
    return run


def _doc_hits(masks: list[str], bitmap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for whole in batches:
            for batch in text_slices(whole, "text"):
                off, w = word_hashes(batch.column("text"))
                row = batch.column("row").to_numpy()
                for mask in masks:
                    h = seeds(w, mask)
                    k = np.flatnonzero(in_bitmap(bits, seed_slot(h)))
                    doc = np.searchsorted(off, k, "right") - 1
                    inside = k + len(mask) <= off[doc + 1]  # not over the end of its text
                    k, doc = k[inside], doc[inside]
                    if len(k):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(h[k].view(np.int64)), pa.array(row[doc]), pa.array(k - off[doc])], ["seed", "row", "place"])
    return run


def _doc_words(bitmap):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            whole = whole.filter(pa.array(in_bitmap(bitmap.value, whole.column("slot").to_numpy())))
            for batch in text_slices(whole, "text"):
                off, h = word_hashes(batch.column("text"))
                cells = [h[a:b].astype("<u8").tobytes() for a, b in zip(off[:-1], off[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(cells, pa.binary())], ["row", "doc_words"])
    return run


def _verify(min_equal: int, identity: float, every_run: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "item", "doc_start", "item_start", "n_words", "n_equal"]
        for batch in batches:
            out = []
            for r in range(batch.num_rows):
                doc = np.frombuffer(batch.column("doc_words")[r].as_buffer(), "<u8")
                item = np.frombuffer(batch.column("words")[r].as_buffer(), "<u8")
                best = None
                for shift in batch.column("shifts")[r].as_py():  # document place - item place
                    a, b = max(0, -shift), min(len(item), len(doc) - shift)
                    hit = accepted(item[a:b] == doc[a + shift:b + shift], len(item), min_equal, identity, every_run) if b > a else None
                    if hit:
                        start, n, same = hit
                        found = (same, -n, -(a + start + shift), a + start)
                        best = max(best, found) if best else found
                if best:
                    out.append((batch.column("row")[r].as_py(), batch.column("item")[r].as_py(), -best[2], best[3], -best[1], best[0]))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)
    return run


def contamination(docs: DataFrame, benchmark: DataFrame, min_equal: int = 13, identity: float = 0.8, min_item: int = 5,
                  every_run: bool = False) -> DataFrame:
    """``row, doc_id, item_id, doc_start, item_start, n_words, n_equal``: a row per
    document text and item that contaminates it, with the longest run; places count
    normalised words.  ``row`` is ``xxhash64(doc_id, text)``."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("text is not null").withColumn(
        "row", F.xxhash64("doc_id", "text"))
    items = benchmark.select(F.xxhash64("item_id", "text").alias("item"), F.col("item_id").cast("long").alias("item_id"), "text").where(
        "text is not null").dropDuplicates(["item"])
    items = save(items.mapInArrow(_item_rows, "item long, item_id long, n long, words binary")
                 .where(F.col("n") >= min_item), "decon-items")
    short = {r["n"] for r in items.where(F.col("n") < SPAN).select("n").distinct().collect()}  # SPAN values at most
    masks = masks_for(short, min_item)
    keys = save(items.mapInArrow(_item_seeds(masks), "seed long, item long, at long, slot long"), "decon-seeds")
    bits = slot_bitmap(keys.select("slot"), "slot", BITS)
    hits = docs.select("row", "text").mapInArrow(_doc_hits(masks, spark.sparkContext.broadcast(bits)), "seed long, row long, place long")
    shifts = hits.join(keys.select("seed", "item", "at"), "seed").select(
        "row", "item", (F.col("place") - F.col("at")).alias("shift")).distinct()
    shifts = save(shifts, "decon-shifts")
    # Alignments of one text and item: no more than both have words.
    pairs = shifts.groupBy("row", "item").agg(F.collect_list("shift").alias("shifts"))
    ids = shifts.select("row").distinct()
    need = spark.sparkContext.broadcast(id_bitmap(ids, "row"))
    words = docs.select("row", "text", bitmap_slot("row")).mapInArrow(_doc_words(need), "row long, doc_words binary").join(
        ids, "row").dropDuplicates(["row"])
    checked = pairs.join(words, "row").join(items.select("item", "words"), "item").select("row", "item", "shifts", "doc_words", "words")
    found = checked.mapInArrow(_verify(min_equal, identity, every_run), "row long, item long, doc_start long, item_start long, n_words long, n_equal long")
    found = save(found, "decon-found")
    named = found.join(items.select("item", "item_id"), "item")
    rows = docs.select("row", "doc_id").join(found.select("row").distinct(), "row").distinct()
    return named.join(rows, "row").select("row", "doc_id", "item_id", "doc_start", "item_start", "n_words", "n_equal")


def contaminated_documents(docs: DataFrame, benchmark: DataFrame, **rule) -> DataFrame:
    """``doc_id, item_id, doc_start, item_start, n_words, n_equal``."""
    return contamination(docs, benchmark, **rule).drop("row")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **rule) -> DataFrame:
    """``docs`` without the contaminated rows, all columns."""
    bad = contamination(docs, benchmark, **rule).select("row").distinct()
    key = free_name(docs, "_row")
    keyed = docs.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), "text"))
    return keyed.join(bad.withColumnRenamed("row", key), key, "left_anti").select(*docs.columns)
