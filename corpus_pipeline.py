"""From raw documents to token files: five stages over whole tables.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``; its result is written
as Parquet into the shared folder and read again as the next one's ``docs``.  All stages
but the last return the columns of ``documents``.

1. ``toxicity``: documents that the trained network scores 0.5 or more go.
2. ``ngram_jaccard``: of every group of near copies (five-word shingles, similarity
   0.8 or more, linked directly or through others) the smallest doc_id stays.
3. ``decontamination``: documents that hold a benchmark passage go.
4. ``mixing``: sources are mixed to target weights; documents repeat or go.
5. ``token_output``: what is left is encoded, written and read back; one row per
   document of the mix.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contentflow.llm import decontamination, mixing, ngram_jaccard, token_output, toxicity
from contentflow.llm.common import save
from contentflow.llm.tokens import vocabulary_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_jaccard.keep_one_per_group(docs, n=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), every_run=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs, weights=(5, 2, 1), max_epochs=3)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_output.token_digests(docs, vocabulary_path("word_bpe_49k.json"), end_id=2)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]

# The network, the signatures and the token coder have no SQL form; tests/llm/test_pipeline.py
# compares every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
