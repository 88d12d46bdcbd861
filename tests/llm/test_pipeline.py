"""The pipeline's stages against brute-force versions, each on its own input."""

import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from contentflow.llm import queries as Q
from contentflow.llm.token_output import crc_of
from contentflow.llm.tokens import vocabulary_path

sys.path.insert(0, __file__.rsplit("/", 1)[0])
import test_decontamination as D  # noqa: E402
import test_mixing as X  # noqa: E402
import test_ngram_jaccard as J  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def made(spark):
    """Every stage's input and result, as the check tool runs them."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in P.STAGES:
        result = P.save(stage(spark, docs, SF), f"test-{name}")
        out[name] = ([tuple(r) for r in docs.select("doc_id", "text", "source").collect()], result)
        if name != "token_output":
            assert result.schema.simpleString() == docs.schema.simpleString()
        docs = result
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "source").collect()]


def test_names_and_oracle():
    assert [n for n, _ in P.STAGES] == ["toxicity", "ngram_jaccard", "decontamination", "mixing", "token_output"]
    assert P.ORACLE_SQL is None


def test_toxicity(spark, made):
    """The stage keeps exactly what the operator predicts as 0, and nearly all clean rows;
    how well it predicts is tested on held-out rows in test_toxicity.py."""
    before, after = made["toxicity"]
    kept = {r[0] for r in rows_of(after)}
    report = Q.QUERIES["op7_toxicity"](spark, SF).collect()
    assert kept == {r["doc_id"] for r in report if r["predicted"] == 0} and len(rows_of(after)) == len(kept) < len(before)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert np.mean([r[0] in kept for r in before if labels.get(r[0]) == 0]) > 0.95


def test_ngram_jaccard(made):
    before, after = made["ngram_jaccard"]
    original, J.shingles.__defaults__ = J.shingles.__defaults__, (5,)
    try:
        want = J.brute([r[:2] for r in before], percent=80)
    finally:
        J.shingles.__defaults__ = original
    assert sorted(r[0] for r in rows_of(after)) == sorted(i for i, (_, c) in want.items() if i == c)


def test_decontamination(spark, made):
    before, after = made["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {d for d, _ in D.brute([r[:2] for r in before], items)}
    assert bad and sorted(rows_of(after)) == sorted(r for r in before if r[0] not in bad)


def test_mixing(made):
    before, after = made["mixing"]
    sizes = Counter()
    for _, text, source in before:
        sizes[source] += X.n_words(text)
    want, taken = X.reshared(sizes), Counter()
    for _, text, source in rows_of(after):
        taken[source] += X.n_words(text)
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)


def test_token_output(made):
    before, after = made["token_output"]
    library = Tokenizer.from_file(vocabulary_path())
    got = sorted(tuple(r) for r in after.select("doc_id", "n_tokens", "ids_crc32").collect())
    want = []
    for d, text, _ in before:
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((d, len(ids), crc_of(np.array(ids))))
    assert got == sorted(want)
    ends = after.agg(F.sum("n_tokens"), F.max(F.col("start") + F.col("n_tokens"))).first()
    assert ends[0] == ends[1]
