"""op7: gradients by finite differences, held-out accuracy, whole texts."""

import os
import zlib

import numpy as np
import pyarrow as pa

from contentflow.llm import toxicity
from contentflow.llm.queries import QUERIES
from contentflow.llm.toxicity import (Inputs, Model, Network, Settings, fit, toxicity_report, trigrams, without_toxic)

SF = "/root/testdata/sf0.1"
SMALL = Settings(rounds=5, vocabulary=50)


def test_trigrams():
    off, ids = trigrams(pa.array(["ab", "x", "abc"]))
    assert off.tolist() == [0, 2, 3, 6]
    assert ids[0] == ids[3] and len(ids) == 6


def test_gradients():
    s = Settings(word_dim=3, char_dim=3, hidden=4, attention=3)
    rng = np.random.default_rng(0)
    net = Network(s, 5, rng)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = Inputs(pa.array(["a b c d a", "bad word here", "", "q " * 70]), {})
    x.ids = np.arange(x.n_words) % 6
    words, mask = x.windows(np.arange(len(x.doc)))
    y, w = np.array([0., 1, 0, 1, 1, 0])[:len(x.doc)], np.ones(len(x.doc))
    _, g = net.gradients(x, net.word_inputs(x), words, mask, y, w)

    def loss():
        z = net.forward(net.word_inputs(x), words, mask)
        return float((np.logaddexp(0, z) - y * z).mean())

    for k, v in net.p.items():
        flat = v.reshape(-1)
        spots = np.flatnonzero(np.abs(g[k].reshape(-1)) > 1e-5)[:6]
        for i in spots:
            old = flat[i]
            flat[i] = old + 1e-4
            up = loss()
            flat[i] = old - 1e-4
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-4 - g[k].reshape(-1)[i]) < 2e-3 * max(1, abs(g[k].reshape(-1)[i])), k


def test_windows_cover_every_word():
    for n in (0, 1, 31, 32, 33, 56, 57, 500):
        x = Inputs(pa.array([" ".join(f"w{i}" for i in range(n))]), {})
        words, mask = x.windows(np.arange(len(x.doc)))
        assert set(words[mask]) == set(range(n)) and len(x.doc) >= 1


def test_held_out_accuracy(spark):
    rows = QUERIES["op7_toxicity"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert len(rows) == docs.count()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
    held = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    pos = [p for p, y in held if y == 1]
    neg = [p for p, y in held if y == 0]
    # These labels are partly noise (some toxic rows hold no toxic word): 86 of 97 and 13 of 728 were measured.
    assert len(pos) > 20 and np.mean(pos) >= 0.8 and np.mean(neg) <= 0.03


def small_texts(n=60):
    """Clean texts of common words; every second one with a toxic word put in."""
    rng = np.random.default_rng(3)
    words = np.array("fine words here and there are many good things to say about it".split())
    out = []
    for i in range(n):
        w = list(rng.choice(words, 12))
        if i % 2:
            w[int(rng.integers(12))] = "zzbadzz" + "abcdef"[i % 6]
        out.append(" ".join(w))
    return out


def test_edges(spark):
    texts = small_texts()
    rows = [(i, t, None) for i, t in enumerate(texts)] \
        + [(200, None, 1), (201, "", 1), (202, "fine words here " * 2000 + "zzbadzzq " + "fine words here " * 900, 1), (None, texts[0], 1), (203, texts[0], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (1000, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in toxicity_report(df, labels, SMALL).collect()}
    assert got[202] == 1 and got[203] == 0 and got[None] == 0 and len(got) == 65
    assert sum(got[i] == i % 2 for i in range(60)) >= 58 and got[200] == got[201] == 0
    kept = without_toxic(df, labels, SMALL)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, p in got.items() if p == 0}
    none = labels.where("toxic = 0")
    assert {r["score"] for r in toxicity_report(df, none, SMALL).collect()} == {0.0}
    assert toxicity_report(df.limit(0), labels, SMALL).collect() == []
    assert fit([], []).score(pa.array(["x"])).tolist() == [0.0]


def test_reruns_agree():
    texts = ["good text", "nasty zzz text"] * 20
    a, b = (fit(texts, [0, 1] * 20, SMALL).score(pa.array(texts)) for _ in range(2))
    assert np.array_equal(a, b)


def test_training_leaves_the_driver(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "fit", lambda texts, labels, s: Model(None, {}, 1 / os.getpid()))
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    assert toxicity.train(docs, labels, SMALL).constant not in (0, 1 / os.getpid())
