"""op4 and op10: ids against the library, exact round trips, counts against lists."""

import os
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from contentflow.llm import token_output
from contentflow.llm.length_histogram import answers, quantile_lengths, token_counts
from contentflow.llm.queries import QUERIES
from contentflow.llm.token_output import (Coder, crc_join, crc_of, documents_of, read_tokens, scaled_frequencies,
                                          write_tokens)
from contentflow.llm.tokens import WordEncoder, encoder, release, vocabulary_path

SF = "/root/testdata/sf0.01"
ODD = [None, "", " \n", "a", "don't WON'T x's", "<|endoftext|>a <|startoftext|>", "Ä́ é ́x", "a b c d",
       "\x1c\x1d a\x85b", "naïve ΣΑΣ İ 1234 ½", "\U0001F600\U0001F600x", "x" * 5000, "日本語 テスト", "\x00 ﻿"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


def reference(library, text):
    return library.encode(text or "", add_special_tokens=False).ids + [2]


def test_words_encode_like_whole_texts(spark, library):
    import pyarrow as pa
    texts = ODD + [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    enc = WordEncoder(vocabulary_path(), cache=3000)
    for a in range(0, len(texts), 50):
        off, ids = enc.encode(pa.array(texts[a:a + 50]), 2)
        for i, t in enumerate(texts[a:a + 50]):
            assert ids[off[i]:off[i + 1]].tolist() == reference(library, t)


def test_random_unicode_encodes_like_the_library(library):
    """Short forms of letters, marks and punctuation of many blocks, İ with a tail among them."""
    import random

    import pyarrow as pa
    rnd = random.Random(9)
    pool = [chr(c) for c in [*range(0x20, 0x250), *range(0x300, 0x310), *range(0x370, 0x450), 0x1E9E, 0x2126, 0x212A, 0xFB01, 0x1F600, 0x4E2D, 0xAC00, 0x0E01]]
    texts = ["İ?", "xİ:.", "İİ!", "xi\u0307."]
    texts += ["".join(rnd.choice(rnd.choice((pool, ".,;:!?", "İıŞßǅ", "abc "))) for _ in range(rnd.randint(1, 7))) for _ in range(40000)]
    enc = WordEncoder(vocabulary_path(), cache=20000)
    for a in range(0, len(texts), 2000):
        part = texts[a:a + 2000]
        off, ids = enc.encode(pa.array(part), 2)
        want = [e.ids + [2] for e in library.encode_batch(part, add_special_tokens=False)]
        assert [ids[x:y].tolist() for x, y in zip(off[:-1], off[1:])] == want


def test_tails_of_all_ascii_punctuation_encode_like_the_library(library):
    """Stems of every size around the exact keys' 15 bytes, Latin ends, and the marks themselves inside words."""
    import random
    rnd = random.Random(5)
    marks = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
    stems = ["", "Don't", "x-y", "a\u0300", "\u0130", "\u00d7", "\u00f7", "\u00c0", "\u024f", "\u0250", "\u0131", "\u65e5\u672c", "7", "\u00b2", "\x00", "a\x00"]
    stems += ["Ab\u00e9cd" * 9][:1] + [("wordsOfText" * 3)[:k] for k in range(1, 33)]
    texts = ["a<|startoftext|>b<|endoftext|>", "<|STARTOFTEXT|>!", "x<|", "a< |startoftext|>", "\u00e9<|startoftext|>!!", "q|>&& <| z#"]
    texts += [" ".join(rnd.choice(stems) + "".join(rnd.choices(marks, k=rnd.randint(0, 4))) + rnd.choice(("", "", "s", "re"))
                       for _ in range(rnd.randint(1, 5))) for _ in range(30000)]
    enc = WordEncoder(vocabulary_path(), cache=20000)
    for a in range(0, len(texts), 2000):
        part = texts[a:a + 2000]
        want = [e.ids for e in library.encode_batch(part, add_special_tokens=False)]
        for end in ([2], []):
            off, ids = enc.encode(pa.array(part), *end)
            assert [ids[x:y].tolist() for x, y in zip(off[:-1], off[1:])] == [w + end for w in want]


def test_words_with_punctuation_cost_no_input_each(library):
    """A stem is encoded once whatever follows it, and other forms go many to one input of the library."""
    class Spy:
        inputs = words = 0

        def encode_batch_fast(self, texts, **options):
            self.inputs += len(texts)
            self.words += sum(t.count("word") for t in texts)
            return library.encode_batch_fast(texts, **options)

    enc = WordEncoder(vocabulary_path())
    enc.tokenizer = Spy()
    letters = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    texts = [" ".join(w + tail for w in letters for tail in ("", "&&&", "***", ",###", ".")), " ".join(f"{w}-{w[::-1]}" for w in letters)]
    off, ids = enc.encode(pa.array(texts), 2)
    assert [ids[x:y].tolist() for x, y in zip(off[:-1], off[1:])] == [reference(library, t) for t in texts]
    assert enc.tokenizer.words == 800 and enc.tokenizer.inputs <= 3


def test_coder_round_trip_and_checkpoints():
    rng = np.random.default_rng(0)
    counts = np.zeros(500, np.int64)
    ids = np.minimum(rng.geometric(0.03, 5000), 499)
    counts += np.bincount(ids, minlength=500)
    coder = Coder(scaled_frequencies(counts))
    assert coder.freq.sum() == 1 << 20
    for n in (0, 1, 31, 32, 33, 4999, 5000):
        data, states, places = coder.encode_block(ids[:n], lanes=32, every=8)
        assert np.array_equal(coder.decode_block(data, states, places, n, lanes=32, every=8), ids[:n])
        for a, b in ((0, 1), (100, 900), (256, 257), (4990, 5000)):
            assert np.array_equal(coder.decode_block(data, states, places, n, a, b, lanes=32, every=8), ids[:n][a:b])
    entropy = -(counts[ids] / 5000 * 0 + np.log2(counts[ids] / 5000)).sum() / 8
    data, _, _ = coder.encode_block(ids, lanes=32, every=8)
    assert len(data) < entropy * 1.02 + 32 * 8
    one = Coder(scaled_frequencies(np.array([0, 0, 7])))
    data, states, places = one.encode_block(np.full(100, 2), lanes=8, every=4)
    assert one.decode_block(data, states, places, 100, lanes=8, every=4).tolist() == [2] * 100


def test_crc_join():
    a, b = bytes(range(200)) * 3, b"xyz" * 1000
    for x, y in ((a, b), (b"", a), (a, b"")):
        assert crc_join(zlib.crc32(x), zlib.crc32(y), len(y)) == zlib.crc32(x + y)


def expected(library, rows):
    out, at = [], 0
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = reference(library, text)
        out.append((doc, at, len(ids), crc_of(np.array(ids))))
        at += len(ids)
    return out


def test_query_on_whole_table(spark, library):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = [tuple(r)[:4] for r in QUERIES["op4_token_output"](spark, SF).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert sorted(got) == expected(library, rows)


def test_many_files_and_split_documents(spark, library, tmp_path):
    rows = [(i * 3 % 41, t) for i, t in enumerate(ODD)] + [(100 + i, "word " * i) for i in range(0, 300, 7)] + [(None, "x y")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    write_tokens(df, f"{tmp_path}/t", vocabulary_path(), per_file=500, block=256, lanes=16, every=4)
    pieces = read_tokens(spark, f"{tmp_path}/t")
    assert pieces.select("file").distinct().count() > 3 and pieces.where("part > 1").count() > 0
    got = [tuple(r) for r in documents_of(pieces).collect()]
    assert sorted(got, key=lambda r: r[1]) == expected(library, rows)


def test_broken_block_is_noticed(spark, tmp_path):
    df = spark.createDataFrame([(1, "some words here"), (2, "and more")], "doc_id long, text string")
    write_tokens(df, f"{tmp_path}/t", vocabulary_path())
    blocks = spark.read.parquet(f"{tmp_path}/t/blocks").selectExpr(
        "file", "block", "first", "n_ids", "docs", "rows", "parts", "sizes", "crc + 1 as crc", "data", "states", "places")
    blocks.write.parquet(f"{tmp_path}/u/blocks")
    spark.read.parquet(f"{tmp_path}/t/table").write.parquet(f"{tmp_path}/u/table")
    with pytest.raises(Exception, match="checksum"):
        read_tokens(spark, f"{tmp_path}/u").collect()


def test_repeated_ids_and_empty_table(spark, library):
    from contentflow.llm.token_output import token_digests
    df = spark.createDataFrame([(5, "same"), (5, "same"), (5, "other"), (4, None)], "doc_id long, text string")
    got = token_digests(df, vocabulary_path()).collect()
    assert sorted(r["start"] for r in got)[0] == 0 and len(got) == 4
    assert sum(r["n_tokens"] for r in got) == sum(len(reference(library, t)) for t in ("same", "same", "other", ""))
    assert token_digests(df.limit(0), vocabulary_path()).collect() == []


def test_counts_against_lists(spark, library):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    n = [len(reference(library, t)) - 1 for t in texts]
    rows = QUERIES["op10_token_counts"](spark, SF)
    got = {r["context_limit"]: r for r in rows.collect()}
    assert set(got) == set(n)
    for limit, r in list(got.items())[::17]:
        assert (r["docs_within"], r["docs_over"], r["tokens_total"], r["tokens_truncated"]) == (
            sum(x <= limit for x in n), sum(x > limit for x in n), sum(n), sum(min(x, limit) for x in n))
    rows = rows.cache()
    for r in answers(rows, [0, 1, 77, 512, 2048, 10**9]).collect():
        limit = r["context_limit"]
        assert (r["docs_within"], r["docs_over"], r["tokens_total"], r["tokens_truncated"]) == (
            sum(x <= limit for x in n), sum(x > limit for x in n), sum(n), sum(min(x, limit) for x in n))
    s = sorted(n)
    for r in quantile_lengths(rows, [0.01, 0.5, 0.99, 1.0]).collect():
        assert r["length"] == s[max(0, int(np.ceil(round(r["share"] * len(s), 9))) - 1)]


def test_counts_of_odd_and_empty(spark, library):
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(ODD)], "doc_id long, text string, length int")
    n = [len(reference(library, t)) - 1 for t in ODD]
    got = {r["context_limit"]: r["n_docs"] for r in token_counts(df, vocabulary_path()).collect()}
    assert got == {x: n.count(x) for x in set(n)}
    assert token_counts(df.limit(0), vocabulary_path()).collect() == []


def test_encoder_starts_no_threads_of_its_own(monkeypatch):
    monkeypatch.delenv("TOKENIZERS_PARALLELISM", raising=False)
    release()
    encoder(vocabulary_path())
    assert os.environ["TOKENIZERS_PARALLELISM"] == "false"


def test_memory_is_given_back_after_every_slice(monkeypatch):
    calls = []
    monkeypatch.setattr(token_output, "trim", lambda: calls.append(1))
    texts = ["some plain words " * 20000] * 6  # 340 KB each
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(6)), "text": texts})
    out = list(token_output._encode_texts(vocabulary_path(), 2)(iter([batch])))
    assert sum(b.num_rows for b in out) == 6 and len(calls) == len(out) >= 2
