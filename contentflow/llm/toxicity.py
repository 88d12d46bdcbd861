"""Toxicity: a bidirectional gated recurrent network with attention pooling.

A word's input is its embedding (words frequent in the training rows; others share
one) and the scaled sum of its character trigrams' embeddings.  Two gated recurrent
layers read a window of words, one from each end; attention weighs their states, the pooled
state gives the window's logit.  A text is cut into overlapping windows of ``WINDOW`` words
that start every ``STRIDE`` words (the last one ends with the text), all of them are
scored, and the text's score is that of its most toxic window.

Trained in numpy by one task on a bounded sample: ``Settings.toxic_rows`` and
``clean_rows`` labelled rows at most, of texts up to ``Settings.max_chars``, drawn by a
hash of doc_id from the rows that are not held out; the driver gets the weights only.  A document's label is that of its windows' maximum, so
the steps train the windows that score highest.  Scoring covers every text in full.

Defined cases: null, empty and blank texts have no word that could be toxic and score 0; rows without label are scored only; rows that repeat a doc_id are scored each; a
doc_id with two labels counts as toxic; without both classes among the training rows
every score is the share of toxic ones (0 without rows).
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contentflow.llm.common import U64, hash_strings, mix64, save, text_slices, trim, words_of

WINDOW, STRIDE = 32, 24
TRIGRAMS = 8192  # buckets


@dataclass(frozen=True)
class Settings:
    toxic_rows: int = 700
    clean_rows: int = 2200
    max_chars: int = 20000
    vocabulary: int = 2000
    word_dim: int = 8
    char_dim: int = 12
    hidden: int = 12
    attention: int = 8
    rounds: int = 7
    passes: int = 2
    steps: int = 16
    batch: int = 256
    rate: float = 0.01
    char_scale: float = 0.02
    decay: float = 0.2
    others: int = 4
    trust_after: int = 2
    doubt: float = 0.25
    seed: int = 7


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def trigrams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(offsets, buckets)`` of every word's character trigrams, with word borders."""
    text = "".join(f"\x02{w}\x03" for w in words.to_pylist())
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(U64)
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 2
    ends = np.cumsum(size)
    h = mix64(chars[:-2] * U64(0x9E3779B1) * U64(0x85EBCA77) + chars[1:-1] * U64(0xC2B2AE3D27D4EB4F) + chars[2:] * U64(0x165667B19E3779F9)) if len(chars) > 2 else np.zeros(0, U64)
    # A word of n characters has n trigrams; those over two words go.
    inside = np.ones(len(h), bool)
    for back in (1, 2):
        inside[(ends[:-1] - back)] = False
    return np.concatenate(([0], np.cumsum(size - 2))), (h[inside] >> U64(51)).astype(np.int64)


class Inputs:
    """Distinct words of some texts and the windows over them."""

    def __init__(self, texts: pa.Array, known: dict[int, int]):
        offsets, codes, words = words_of(texts)
        words = pc.utf8_lower(words)
        self.n_words = len(words)
        self.tri_off, self.tri = trigrams(words)
        hashes = hash_strings(words)
        self.hashes = hashes
        self.ids = np.array([known.get(int(h), 0) for h in hashes], np.int64) if known else np.zeros(len(words), np.int64)
        self.offsets, self.codes = offsets, codes
        # Windows: starts every STRIDE words, the last one ends with the text; an empty text has one empty window.
        n = np.diff(offsets)
        count = 1 + np.maximum(0, -(-(n - WINDOW) // STRIDE))
        self.doc = np.repeat(np.arange(len(n)), count)
        k = np.arange(len(self.doc)) - np.repeat(np.cumsum(count) - count, count)
        start = np.minimum(k * STRIDE, np.maximum(0, n[self.doc] - WINDOW))
        self.start = offsets[:-1][self.doc] + start
        self.size = np.minimum(WINDOW, n[self.doc] - start)

    def windows(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(word numbers, mask)`` of windows; the number ``n_words`` stands for no word."""
        t = np.arange(WINDOW)
        mask = t < self.size[which][:, None]
        at = np.where(mask, self.start[which][:, None] + t, 0)
        return np.where(mask, self.codes[at] if len(self.codes) else 0, self.n_words), mask


class Network:
    """Weights and the forward and backward passes, all arrays in ``p``."""

    def __init__(self, s: Settings, vocabulary: int, rng: np.random.Generator):
        d, h, a = s.word_dim + s.char_dim, s.hidden, s.attention

        def draw(*shape):
            return (rng.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)

        self.p = {"words": draw(vocabulary + 1, s.word_dim) * 5, "chars": (rng.normal(size=(TRIGRAMS, s.char_dim)) * s.char_scale).astype(np.float32),
                  "att": draw(2 * h, a), "att_b": np.zeros(a, np.float32), "att_v": draw(a, 1)[:, 0], "out": draw(2 * h, 1)[:, 0],
                  "bias": np.zeros(1, np.float32)}
        for side in "fb":
            self.p |= {f"in_{side}": draw(d, 3 * h), f"in_b_{side}": np.zeros(3 * h, np.float32), f"rec_{side}": draw(h, 3 * h)}
        self.hidden, self.word_dim = h, s.word_dim

    def word_inputs(self, x: Inputs) -> np.ndarray:
        """Input vector of every distinct word, and a zero row for no word."""
        sums = np.zeros((x.n_words, self.p["chars"].shape[1]), np.float32)
        n = np.diff(x.tri_off)
        if len(x.tri):
            sums = np.add.reduceat(self.p["chars"][x.tri], x.tri_off[:-1], axis=0)  # every word has a trigram
            sums /= np.sqrt(n)[:, None].astype(np.float32)
        out = np.concatenate((self.p["words"][x.ids], sums), axis=1) if x.n_words else np.zeros((0, self.word_dim + sums.shape[1]), np.float32)
        return np.concatenate((out, np.zeros((1, out.shape[1]), np.float32)))

    def _read(self, g: np.ndarray, words: np.ndarray, side: str, keep: bool):
        """States of one direction, in reading order; ``g`` are projected inputs per word."""
        h = self.hidden
        rec = self.p[f"rec_{side}"]
        order = range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1)
        state = np.zeros((len(words), h), np.float32)
        states = np.empty((WINDOW, len(words), h), np.float32)
        tape = []
        for t in order:
            x = g[words[:, t]]
            r = state @ rec
            zr = sigmoid(x[:, :2 * h] + r[:, :2 * h])
            z, gate = zr[:, :h], zr[:, h:]
            new = np.tanh(x[:, 2 * h:] + gate * r[:, 2 * h:])
            if keep:
                tape.append((t, state, z, gate, new, r[:, 2 * h:]))
            state = new + z * (state - new)
            states[t] = state
        return states, tape

    def forward(self, inputs: np.ndarray, words: np.ndarray, mask: np.ndarray, keep: bool = False, projected=None):
        """Logits of windows."""
        both, tapes = [], []
        for side in "fb":
            g = projected[side] if projected else inputs @ self.p[f"in_{side}"] + self.p[f"in_b_{side}"]
            states, tape = self._read(g, words, side, keep)
            both.append(states), tapes.append(tape)
        s = np.concatenate(both, axis=2)  # time, window, 2h
        a = np.tanh(s @ self.p["att"] + self.p["att_b"])
        e = a @ self.p["att_v"]
        e = np.where(mask.T, e, -np.inf)
        top = np.where(mask.any(axis=1), e.max(axis=0), 0)
        w = np.exp(e - top)
        w = w / np.maximum(w.sum(axis=0), 1e-9)
        pooled = np.einsum("tn,tnh->nh", w, s)
        logit = pooled @ self.p["out"] + self.p["bias"][0]
        return (logit, (s, a, w, pooled, tapes)) if keep else logit

    def project(self, inputs: np.ndarray) -> dict:
        return {side: inputs @ self.p[f"in_{side}"] + self.p[f"in_b_{side}"] for side in "fb"}

    def gradients(self, x: Inputs, inputs: np.ndarray, words: np.ndarray, mask: np.ndarray, target: np.ndarray, weight: np.ndarray):
        """Loss (weighted cross-entropy) and its gradients."""
        logit, (s, a, w, pooled, tapes) = self.forward(inputs, words, mask, keep=True)
        prob = sigmoid(logit)
        total = weight.sum()
        loss = float((weight * (np.logaddexp(0, logit) - target * logit)).sum() / total)
        d_logit = (weight * (prob - target) / total).astype(np.float32)
        g = {"out": pooled.T @ d_logit, "bias": np.array([d_logit.sum()], np.float32)}
        d_pooled = d_logit[:, None] * self.p["out"]
        d_s = w[:, :, None] * d_pooled
        d_w = np.einsum("tnh,nh->tn", s, d_pooled)
        d_e = w * (d_w - (w * d_w).sum(axis=0))
        g["att_v"] = np.einsum("tna,tn->a", a, d_e)
        d_a = d_e[:, :, None] * self.p["att_v"] * (1 - a * a)
        g["att"] = np.einsum("tnh,tna->ha", s, d_a)
        g["att_b"] = d_a.sum(axis=(0, 1))
        d_s += d_a @ self.p["att"].T
        h = self.hidden
        d_inputs = np.zeros_like(inputs)
        for k, side in enumerate("fb"):
            rec, d_states = self.p[f"rec_{side}"], d_s[:, :, k * h:(k + 1) * h]
            d_rec, carry = np.zeros_like(rec), np.zeros((len(words), h), np.float32)
            d_g = np.zeros((len(inputs), 3 * h), np.float32)
            for t, before, z, gate, new, r_new in reversed(tapes[k]):
                d = d_states[t] + carry
                d_new = d * (1 - z) * (1 - new * new)
                d_z = d * (before - new) * z * (1 - z)
                d_gate = d_new * r_new * gate * (1 - gate)
                d_r = np.concatenate((d_z, d_gate, d_new * gate), axis=1)
                d_rec += before.T @ d_r
                carry = d * z + d_r @ rec.T
                np.add.at(d_g, words[:, t], np.concatenate((d_z, d_gate, d_new), axis=1))
            g[f"rec_{side}"] = d_rec
            g[f"in_{side}"] = inputs.T @ d_g
            g[f"in_b_{side}"] = d_g.sum(axis=0)
            d_inputs += d_g @ self.p[f"in_{side}"].T
        d_inputs = d_inputs[:-1]  # the row for no word stays zero
        g["words"] = np.zeros_like(self.p["words"])
        np.add.at(g["words"], x.ids, d_inputs[:, :self.word_dim])
        n = np.diff(x.tri_off)
        g["chars"] = np.zeros_like(self.p["chars"])
        touched = np.abs(d_inputs).sum(axis=1) > 0
        rows = np.repeat(np.arange(x.n_words), n)
        k = touched[rows]
        np.add.at(g["chars"], x.tri[k], (d_inputs[:, self.word_dim:] / np.sqrt(n)[:, None])[rows[k]].astype(np.float32))
        return loss, g

    def scores(self, x: Inputs, chunk: int = 2048) -> np.ndarray:
        """Logit of every text: the largest of all its windows."""
        projected = self.project(self.word_inputs(x))
        logits = np.empty(len(x.doc), np.float32)
        for a in range(0, len(x.doc), chunk):
            words, mask = x.windows(np.arange(a, min(a + chunk, len(x.doc))))
            logits[a:a + chunk] = self.forward(None, words, mask, projected=projected)
        self.window_logits = logits
        first = np.flatnonzero(np.concatenate(([True], x.doc[1:] != x.doc[:-1]))) if len(x.doc) else np.zeros(0, int)
        return np.maximum.reduceat(logits, first) if len(first) else np.zeros(0, np.float32)


@dataclass
class Model:
    """What the tasks need: weights, known words, or a constant score."""

    net: Network | None
    known: dict[int, int]
    constant: float = 0.0

    def score(self, texts: pa.Array) -> np.ndarray:
        if self.net is None:
            return np.full(len(texts), self.constant)
        x = Inputs(texts, self.known)
        return np.where(np.diff(x.offsets) > 0, sigmoid(self.net.scores(x).astype(np.float64)), 0.0)


def fit(texts: list[str], labels: list[int], s: Settings = Settings()) -> Model:
    """Train on texts and 0/1 labels."""
    y = np.array(labels, np.float32)
    if len(y) == 0 or y.min() == y.max():
        return Model(None, {}, float(y.mean()) if len(y) else 0.0)
    rng = np.random.default_rng(s.seed)
    x = Inputs(pa.array(texts, pa.string()), {})
    # Frequent words of the sample get an embedding of their own.
    doc_of = np.repeat(np.arange(len(texts)), np.diff(x.offsets))
    pairs = np.unique(doc_of * np.int64(x.n_words) + x.codes)
    freq = np.bincount(pairs % max(1, x.n_words), minlength=x.n_words)
    top = np.argsort(-freq, kind="stable")[:s.vocabulary]
    top = top[freq[top] >= 5]
    known = {int(x.hashes[w]): k + 1 for k, w in enumerate(top)}
    x.ids = np.array([known.get(int(h), 0) for h in x.hashes], np.int64)
    net = Network(s, len(top), rng)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}
    step = 0
    first = np.flatnonzero(np.concatenate(([True], x.doc[1:] != x.doc[:-1])))
    count = np.diff(np.append(first, len(x.doc)))
    balance = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    trusted = np.ones(len(texts), bool)
    for turn in range(s.rounds):
        if turn == 0:  # some windows of every text
            pick = np.unique(np.concatenate([first + (rng.random(len(first)) * count).astype(int) for _ in range(4)]))
        else:  # the highest window, for clean texts a random one too
            net.scores(x)
            order = np.lexsort((-net.window_logits, x.doc))
            best = order[first]
            if turn >= s.trust_after:
                # Labels can be wrong: texts that the network, before it could learn them by
                # heart, holds to be of the other class take no part in this round.
                top = sigmoid(net.window_logits[best])
                trusted = np.where(y == 1, top >= s.doubt, top <= 1 - s.doubt)
            best = best[trusted]
            more = [(first + (rng.random(len(first)) * count).astype(int))[trusted & (y == 0)] for _ in range(s.others)]
            pick = np.unique(np.concatenate([best, *more]))
        rate = s.rate * (1 if turn < s.rounds * 2 // 3 else 0.3)
        # Small samples are gone through more often, for ``steps`` updates a round at least.
        batches = -(-len(pick) // s.batch)
        for _ in range(max(s.passes if turn else 1, -(-s.steps // max(1, batches)))):
            rng.shuffle(pick)
            for a in range(0, len(pick), s.batch):
                which = pick[a:a + s.batch]
                words, mask = x.windows(which)
                # Only the batch's own words take part.
                used, local = np.unique(words, return_inverse=True)
                part = _part(x, used[used < x.n_words])
                local = local.reshape(words.shape)  # the number for no word, if used, comes last
                _, g = net.gradients(part, net.word_inputs(part), local, mask, y[x.doc[which]], balance[x.doc[which]])
                step += 1
                norm = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
                scale = min(1.0, 1.0 / (norm + 1e-9))
                for k, v in g.items():
                    m, q = moments[k]
                    v = v * scale
                    m += 0.1 * (v - m)
                    q += 0.01 * (v * v - q)
                    if k in ("words", "chars"):  # what few windows ask for fades
                        net.p[k] *= 1 - rate * s.decay
                    net.p[k] -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(q / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return Model(net, known)


def _part(x: Inputs, used: np.ndarray) -> Inputs:
    """The distinct words ``used`` of ``x`` as inputs of their own."""
    part = Inputs.__new__(Inputs)
    n = np.diff(x.tri_off)[used]
    part.n_words = len(used)
    part.tri_off = np.concatenate(([0], np.cumsum(n)))
    part.tri = x.tri[np.repeat(x.tri_off[:-1][used] - part.tri_off[:-1], n) + np.arange(part.tri_off[-1])]
    part.ids = x.ids[used]
    return part


def held_out(doc_id) -> F.Column:
    """crc32 of the id's text modulo 5 is 0; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> Model:
    """Fit on a bounded hash sample of the labelled rows that are not held out.

    One task gets ``toxic_rows + clean_rows`` ids and texts of up to ``max_chars``, the
    driver the weights.
    """
    known = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(
        ~held_out("doc_id"))
    rank = F.xxhash64("doc_id", F.lit(s.seed))
    ids = [known.where(F.col("toxic") == t).orderBy(rank, "doc_id").limit(n) for t, n in ((1, s.toxic_rows), (0, s.clean_rows))]
    drawn = ids[0].unionByName(ids[1]).withColumnRenamed("doc_id", "_id").withColumnRenamed("toxic", "_toxic")
    # toxic_rows + clean_rows rows at most: bounded by the settings.
    rows = (docs.select(F.col("doc_id").alias("_doc"), F.col("text").alias("_text")).where(F.length("_text") <= s.max_chars)
            .join(F.broadcast(drawn), F.col("_doc") == F.col("_id")).dropDuplicates(["_id"])
            .select("_id", "_text", "_toxic"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim()
        got = sorted((r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))), key=lambda r: r[0])
        model = fit([r[1] for r in got], [r[2] for r in got], s)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])
        del got, model
        trim()

    # Saved first: the sample is read by many tasks, only the training is one.
    fitted = save(rows, "toxicity-sample").repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(fitted["model"]) if fitted else fit([], [], s)


def scored(docs: DataFrame, model: Model, column: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in text_slices(whole, "text", 1 << 20):
                yield batch.append_column(column, pa.array(shared.value.score(batch.column("text")), pa.float64()))

    schema = docs.select("*", F.lit(0.0).alias(column)).schema
    return docs.mapInArrow(run, schema)


def toxicity_report(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = train(docs, labels, s)
    out = scored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), model)
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                      F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``docs`` without the rows that score 0.5 or more, all columns."""
    model = train(docs, labels, s)
    name = "_toxicity"
    while name in docs.columns:
        name += "_"
    return scored(docs, model, name).where(F.col(name) < 0.5).select(*docs.columns)
