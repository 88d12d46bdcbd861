"""Token output: ids in ascending doc_id order, coded by static range ANS.

The file format is a folder of Parquet tables, so that Spark commits and reads it
like any other table:

* ``table``: one row, the shared frequency table: every id's frequency, scaled so
  that all add up to 2**PRECISION (ids that occur get 1 at least);
* ``blocks``: one row per block: ``file, block, first`` (ids before it), ``n_ids``,
  the documents' pieces in it (``docs``, ``parts``, ``sizes``, and ``rows``, each row's
  place among equal doc_ids), ``lanes``, ``data``, ``every``/``states``/``places``
  (checkpoints) and ``crc`` (of the block's ids).

A block codes its ids on ``LANES`` interleaved coders that share one byte stream and
no state with other blocks.  Ids i, i + LANES, ... belong to lane i, so a step codes
LANES ids at once in numpy.  Every ``every`` steps the states and the place in the
stream are kept, so a reader can start at any checkpoint: ``decode_block`` takes the
range of ids that is wanted.  A block's checksum is compared on reading.

Documents longer than a block run over several blocks; a document's crc is joined
from its pieces' crcs.

Defined cases: a null or empty text is one end id; rows without doc_id come first;
rows that share a doc_id stand by text; an empty table gives an empty folder of
blocks and a frequency table without ids.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contentflow.llm.common import save, scratch, text_slices, trim
from contentflow.llm.tokens import encoder, release

PRECISION = 20
LANES = 1024
BLOCK = 1 << 18
EVERY = 64  # steps between checkpoints
LOW = 1 << 31  # states live in [2**31, 2**63), refilled by 32 bits
U64 = np.uint64


def scaled_frequencies(counts: np.ndarray, precision: int = PRECISION) -> np.ndarray:
    """Integer frequencies that add up to 2**precision; 1 at least where counts > 0.

    Every id gets its floor share of what is left after one each; the rest goes to
    the most frequent id.
    """
    total = 1 << precision
    used = counts > 0
    n = int(used.sum())
    if n == 0:
        return np.zeros(len(counts), np.int64)
    if n > total:
        raise ValueError("more ids than the table has slots")
    share = counts / counts.sum() * (total - n)
    freq = np.where(used, 1 + np.floor(share).astype(np.int64), 0)
    freq[int(np.argmax(counts))] += total - int(freq.sum())
    return freq


class Coder:
    """Encoder and decoder of one frequency table."""

    def __init__(self, freq: np.ndarray, precision: int = PRECISION):
        self.precision = precision
        self.freq = freq.astype(U64)
        self.base = np.concatenate((np.zeros(1, U64), np.cumsum(self.freq, dtype=U64)))[:-1]
        self.slots = np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64))

    def encode_block(self, ids: np.ndarray, lanes: int = LANES, every: int = EVERY):
        """``(data, states, places)``; states and places of step 0, every, 2 * every, ...

        Codes from the last step to the first, so that reading runs forward.
        """
        n = len(ids)
        steps = -(-n // lanes)
        shift, low = U64(self.precision), U64(32)
        state = np.full(lanes, LOW, U64)
        words, marks = [], []
        count = 0
        for t in range(steps - 1, -1, -1):
            part = ids[t * lanes:(t + 1) * lanes]
            f, c, x = self.freq[part], self.base[part], state[:len(part)]
            # A state at or over f * 2**(63 - precision) gives 32 bits away first.
            full = x >= f << (U64(63) - shift)
            if full.any():
                out = (x[full] & U64(0xFFFFFFFF)).astype(np.uint32)
                words.append(out[::-1])
                count += len(out)
                x = np.where(full, x >> low, x)
            q = x // f
            state[:len(part)] = (q << shift) + (x - q * f) + c
            if t % every == 0:
                marks.append((state.copy(), count))
        data = np.concatenate(words)[::-1] if words else np.zeros(0, np.uint32)
        marks.reverse()
        states = np.stack([s for s, _ in marks]) if marks else np.zeros((0, lanes), U64)
        places = np.array([count - p for _, p in marks], np.int64)
        return np.ascontiguousarray(data).astype("<u4").tobytes(), states, places

    def decode_block(self, data: bytes, states: np.ndarray, places: np.ndarray, n: int, start: int = 0,
                     stop: int | None = None, lanes: int = LANES, every: int = EVERY) -> np.ndarray:
        """Ids ``start:stop`` of a block of ``n`` ids, read from the nearest checkpoint."""
        stop = n if stop is None else min(stop, n)
        if start >= stop:
            return np.zeros(0, np.uint32)
        words = np.frombuffer(data, "<u4").astype(U64)
        mark = start // (lanes * every)
        state, at = states[mark].copy(), int(places[mark])
        mask, shift = U64((1 << self.precision) - 1), U64(self.precision)
        first = mark * every
        out = []
        for t in range(first, -(-stop // lanes)):
            m = min(lanes, n - t * lanes)
            x = state[:m]
            slot = x & mask
            ids = self.slots[slot.astype(np.int64)]
            x = self.freq[ids] * (x >> shift) + slot - self.base[ids]
            need = np.flatnonzero(x < U64(LOW))
            if len(need):
                x[need] = (x[need] << U64(32)) | words[at:at + len(need)]
                at += len(need)
            state[:m] = x
            out.append(ids)
        return np.concatenate(out)[start - first * lanes:stop - first * lanes]


def crc_of(ids: np.ndarray, crc: int = 0) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes(), crc)


def crc_join(first: int, second: int, length: int) -> int:
    """crc32 of two byte strings one after the other; ``length`` bytes in the second.

    Shifting a crc over zero bytes is linear over GF(2): square the one-byte matrix.
    """
    def times(matrix, vector):
        out, i = 0, 0
        while vector:
            if vector & 1:
                out ^= matrix[i]
            vector >>= 1
            i += 1
        return out

    step = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit
    for _ in range(3):
        step = [times(step, v) for v in step]
    while length:
        if length & 1:
            first = times(step, first)
        step = [times(step, v) for v in step]
        length >>= 1
    return first ^ second


def _encode_texts(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        for whole in batches:
            for batch in text_slices(whole, "text", 1 << 20):
                offsets, ids = words.encode(batch.column("text"), end_id)
                raw = ids.astype("<u2" if ids.dtype == np.uint16 else "<u4").tobytes()
                w = ids.dtype.itemsize
                cells = [raw[a * w:b * w] for a, b in zip(offsets[:-1], offsets[1:])]
                out = pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(cells, pa.binary()), pa.array(np.diff(offsets))], ["doc_id", "ids", "n"])
                del offsets, ids, raw, cells
                trim()
                yield out
    return run


def _histogram(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            ids = np.frombuffer(b"".join(batch.column("ids").to_pylist()), f"<u{width}")
            seen = np.bincount(ids, minlength=len(total))
            seen[:len(total)] += total
            total = seen
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(total[k], pa.int64())], ["id", "n"])
    return run


def _write_blocks(freq, width: int, block: int, lanes: int, every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        coder = Coder(freq.value)
        names = ["file", "block", "first", "n_ids", "docs", "rows", "parts", "sizes", "crc", "data", "states", "places"]
        file, number, first = None, 0, 0
        ids, docs, rows, parts, sizes, held = [], [], [], [], [], 0

        def flush():
            nonlocal ids, docs, rows, parts, sizes, held, number, first
            all_ids = np.concatenate(ids)
            data, states, places = coder.encode_block(all_ids, lanes, every)
            out = pa.RecordBatch.from_arrays([
                pa.array([file], pa.int32()), pa.array([number], pa.int32()), pa.array([first], pa.int64()),
                pa.array([held], pa.int64()), pa.array([docs], pa.list_(pa.int64())), pa.array([rows], pa.list_(pa.int64())),
                pa.array([parts], pa.list_(pa.int32())), pa.array([sizes], pa.list_(pa.int64())),
                pa.array([crc_of(all_ids)], pa.int64()), pa.array([data], pa.binary()),
                pa.array([states.astype("<u8").tobytes()], pa.binary()), pa.array([places.tolist()], pa.list_(pa.int64()))], names)
            number, first = number + 1, first + held
            ids, docs, rows, parts, sizes, held = [], [], [], [], [], 0
            return out

        last, row = None, 0
        for batch in batches:
            for f, start, doc, cell in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(),
                                           batch.column("doc_id").to_pylist(), batch.column("ids")):
                if f != file:
                    if held:
                        yield flush()
                    file, number, first, last, row = f, 0, start, None, -1
                row = row + 1 if (doc == last and row >= 0) else 0
                last = doc
                data = np.frombuffer(cell.as_buffer(), f"<u{width}")
                at, part = 0, 0
                while at < len(data):
                    take = min(len(data) - at, block - held)
                    ids.append(data[at:at + take].astype(np.int64))
                    docs.append(doc), rows.append(row), parts.append(part), sizes.append(take)
                    held += take
                    at += take
                    part += 1
                    if held == block:
                        yield flush()
        if held:
            yield flush()
    return run


BLOCKS = ("file int, block int, first long, n_ids long, docs array<long>, rows array<long>, parts array<int>, "
          "sizes array<long>, crc long, data binary, states binary, places array<long>")


def write_tokens(docs: DataFrame, out: str, vocabulary: str, end_id: int = 2, per_file: int = 1 << 23,
                 block: int = BLOCK, lanes: int = LANES, every: int = EVERY) -> None:
    """Write the ids of all ``docs(doc_id, text)`` as the file format into ``out``.

    ``per_file``: about so many ids go to one file (a range of doc_ids).
    """
    spark = docs.sparkSession
    probe = encoder(vocabulary)
    if end_id >= probe.vocab:
        raise ValueError("end_id is not an id of the vocabulary")
    width = np.dtype(probe.type).itemsize
    kept = save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _encode_texts(vocabulary, end_id), "doc_id long, ids binary, n long"), "token-ids")
    # Shared frequencies: one row per id of the vocabulary at most.
    counts = np.zeros(probe.vocab, np.int64)
    for r in kept.select("ids").mapInArrow(_histogram(width), "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[r["id"]] = r["n"]
    table = scaled_frequencies(counts)
    spark.createDataFrame([(PRECISION, lanes, every, width, end_id, table.tolist())],
                          "precision int, lanes int, every int, width int, end_id int, freq array<long>").coalesce(1).write.parquet(f"{out}/table")
    # Files are ranges of doc_id with about per_file ids, cut at approximate quantiles.
    total = kept.agg(F.sum("n")).first()[0] or 0
    n_files = max(1, -(-total // per_file))
    cuts = kept.agg(F.approx_percentile("doc_id", [i / n_files for i in range(1, n_files)], 10000)).first()[0] if n_files > 1 else []
    cuts = sorted(set(cuts or []))
    file = F.lit(0)
    if cuts:
        edges = F.array(*[F.lit(c).cast("long") for c in cuts])
        file = F.coalesce(F.size(F.filter(edges, lambda c: c < F.col("doc_id"))), F.lit(0))
    dealt = kept.withColumn("file", file.cast("int"))
    sizes = dealt.groupBy("file").agg(F.sum("n").alias("n")).collect()  # one row per file
    starts, at = {}, 0
    for r in sorted(sizes, key=lambda r: r["file"]):
        starts[r["file"]] = at
        at += r["n"]
    begin = spark.createDataFrame([(k, v) for k, v in starts.items()], "file int, start long")
    freq = spark.sparkContext.broadcast(table)
    ordered = (dealt.join(F.broadcast(begin), "file").select("file", "start", "doc_id", "ids")
               .repartition(max(1, len(starts)), "file")
               .sortWithinPartitions("file", F.col("doc_id").asc_nulls_first(), "ids"))
    ordered.mapInArrow(_write_blocks(freq, width, block, lanes, every), BLOCKS).write.parquet(f"{out}/blocks")


def read_tokens(spark: SparkSession, out: str) -> DataFrame:
    """Pieces ``doc_id, row, part, start, n, crc`` decoded from the files of ``out``;
    one per document and block.  A block whose checksum differs raises."""
    head = spark.read.parquet(f"{out}/table").first()
    freq = spark.sparkContext.broadcast(np.array(head["freq"], np.int64))
    precision, lanes, every = head["precision"], head["lanes"], head["every"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        coder = Coder(freq.value, precision)
        for batch in batches:
            for r in range(batch.num_rows):
                n = batch.column("n_ids")[r].as_py()
                states = np.frombuffer(batch.column("states")[r].as_py(), "<u8").reshape(-1, lanes).astype(U64)
                ids = coder.decode_block(batch.column("data")[r].as_py(), states, batch.column("places")[r].values.to_numpy(),
                                         n, lanes=lanes, every=every)
                if crc_of(ids) != batch.column("crc")[r].as_py():
                    raise ValueError("a block does not match its checksum")
                sizes = batch.column("sizes")[r].values.to_numpy()
                ends = np.cumsum(sizes)
                raw = ids.astype("<u4").tobytes()
                crcs = [zlib.crc32(raw[4 * (e - s):4 * e]) for s, e in zip(sizes.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([
                    batch.column("docs")[r].values, batch.column("file").take(pa.array([r] * len(sizes))),
                    batch.column("rows")[r].values, batch.column("parts")[r].values,
                    pa.array(batch.column("first")[r].as_py() + ends - sizes), pa.array(sizes), pa.array(crcs, pa.int64())],
                    ["doc_id", "file", "row", "part", "start", "n", "crc"])

    return spark.read.schema(BLOCKS).parquet(f"{out}/blocks").mapInArrow(
        run, "doc_id long, file int, row long, part int, start long, n long, crc long")


def documents_of(pieces: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the pieces.

    Only documents that run over several blocks have more than one piece; they are
    joined by (doc_id, row), the rest stays where it is.
    """
    key = ["doc_id", "file", "row"]
    # A document's pieces: one per BLOCK ids, a few numbers each.
    agg = pieces.groupBy(*key).agg(F.min("start").alias("start"), F.sum("n").alias("n_tokens"), F.min("crc").alias("crc"),
                                   F.when(F.count("*") > 1, F.sort_array(F.collect_list(F.struct("part", "n", "crc")))).alias("parts"))

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = batch.column("crc").to_numpy(zero_copy_only=False).astype(np.int64)
            parts = batch.column("parts")
            for i in np.flatnonzero(parts.is_valid().to_numpy(zero_copy_only=False)):
                first, *rest = parts[int(i)].as_py()
                crc[i] = first["crc"]
                for p in rest:
                    crc[i] = crc_join(int(crc[i]), p["crc"], 4 * p["n"])
            yield pa.RecordBatch.from_arrays([*batch.select(["doc_id", "start", "n_tokens"]).columns, pa.array(crc)],
                                             ["doc_id", "start", "n_tokens", "ids_crc32"])

    return agg.select("doc_id", "start", "n_tokens", "crc", "parts").mapInArrow(
        joined, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_digests(docs: DataFrame, vocabulary: str, end_id: int = 2) -> DataFrame:
    """Write all documents, read the files back, and return a row per document."""
    out = scratch(docs.sparkSession, "tokens")
    write_tokens(docs, out, vocabulary, end_id)
    return documents_of(read_tokens(docs.sparkSession, out))
