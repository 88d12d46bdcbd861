"""The registered queries of this folder: ``opN_<name>`` and ``pipeline``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contentflow.llm import (chat_format, cover_tree, decontamination, graph_search, length_histogram, licenses, line_dedup, merkle, mixing,
                             ngram_jaccard, prefix_trie, token_output, toxicity)
from contentflow.llm.tokens import vocabulary_path


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.cosine_links(_read(spark, sf_dir, "embeddings"), cosine=0.98)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_read(spark, sf_dir, "documents"), max_edits=2, chars_per_edit=10)


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(_read(spark, sf_dir, "documents"), weights=(5, 2, 1), max_epochs=3).drop("source", "h")


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_digests(_read(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"), end_id=2)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated_documents(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), every_run=True)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    # The contract's own conversation, whose texts look like control strings.
    odd = "\\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], turns.schema)
    return chat_format.chat_report(turns.unionByName(more), vocabulary_path("word_bpe_49k.json"), budget=1024, history=256)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.jaccard_components(_read(spark, sf_dir, "documents"), n=3, percent=90)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_findings(_read(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram.token_counts(_read(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_read(spark, sf_dir, "conversations"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified_manifest(_read(spark, sf_dir, "documents"))


def op13_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_search.nearest(_read(spark, sf_dir, "embeddings"), every=50, k=5)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_cover_tree, op2_line_dedup, op3_mixing, op4_token_output, op5_decontamination,
                            op6_chat_format, op7_toxicity, op8_ngram_jaccard, op9_licenses, op10_token_counts, op11_prefix_trie, op12_merkle_manifest, op13_graph_search)
}
ORACLE_SQL: dict[str, str] = {"op3_mixing": mixing.ORACLE}
