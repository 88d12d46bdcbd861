"""Exact token counts for every context limit, from one length histogram.

Documents are aggregated by their encoded length; over the distinct lengths, running
sums answer, for any limit L: how many documents fit, how many tokens all have, how
many remain when each is cut at L, and which length a quantile has.

The histogram has one row per distinct length (bounded by the longest document, not
by the number of documents); its running sums are windows over that table.

Defined cases: null and empty texts have length 0; an empty table gives an empty
histogram; quantiles are the smallest length that covers the share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contentflow.llm.common import save, text_slices
from contentflow.llm.tokens import encoder


def encoded_lengths(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Map-side histogram rows ``length, n`` of whole texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(vocabulary)
        for whole in batches:
            for batch in text_slices(whole, "text", 2 << 20):
                offsets, _ = words.encode(batch.column("text"))
                size, n = np.unique(np.diff(offsets), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(size.astype(np.int64)), pa.array(n.astype(np.int64))], ["length", "n"])

    return docs.select("text").mapInArrow(run, "length long, n long")


def length_histogram(docs: DataFrame, vocabulary: str) -> DataFrame:
    return encoded_lengths(docs, vocabulary).groupBy("length").agg(F.sum("n").alias("n_docs"))


def context_limits(histogram: DataFrame) -> DataFrame:
    """A row per distinct length L of ``histogram(length, n_docs)``, as context limit:

    ``context_limit, n_docs`` (of that length), ``docs_within`` (length <= L),
    ``docs_over``, ``tokens_within``, ``tokens_total``, ``tokens_truncated`` (sum of
    min(length, L)), ``tokens_lost``, ``quantile`` (docs_within / all documents).
    """
    up = Window.orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    h = histogram.withColumn("tokens", F.col("length") * F.col("n_docs"))
    s = h.select(F.col("length").alias("context_limit"), "n_docs", F.sum("n_docs").over(up).alias("docs_within"),
                 F.coalesce(F.sum("n_docs").over(down), F.lit(0)).cast("long").alias("docs_over"),
                 F.sum("tokens").over(up).alias("tokens_within"),
                 F.coalesce(F.sum("tokens").over(down), F.lit(0)).cast("long").alias("over"))
    kept = F.col("tokens_within") + F.col("context_limit") * F.col("docs_over")
    total = F.col("tokens_within") + F.col("over")
    return s.select("context_limit", "n_docs", "docs_within", "docs_over", "tokens_within", total.alias("tokens_total"),
                    kept.alias("tokens_truncated"), (total - kept).alias("tokens_lost"),
                    (F.col("docs_within") / (F.col("docs_within") + F.col("docs_over"))).alias("quantile"))


def answers(limits: DataFrame, context_limits: list[int]) -> DataFrame:
    """Totals for arbitrary limits, looked up in ``context_limits``' rows.

    A limit between two lengths keeps what its floor length keeps, plus the
    difference for every longer document.
    """
    spark = limits.sparkSession
    asked = spark.createDataFrame([(int(x),) for x in dict.fromkeys(context_limits)], "asked long")
    floor = (limits.join(F.broadcast(asked), F.col("context_limit") <= F.col("asked")).groupBy("asked")
             .agg(F.max_by(F.struct("context_limit", "docs_within", "docs_over", "tokens_truncated", "tokens_total"), "context_limit").alias("r")))
    total = limits.agg(F.max("tokens_total").alias("t"), F.max(F.col("docs_within") + F.col("docs_over")).alias("d"))
    out = asked.join(floor, "asked", "left").join(F.broadcast(total))
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("asked").alias("context_limit"), F.coalesce("r.docs_within", zero).alias("docs_within"),
        F.coalesce("r.docs_over", "d", zero).alias("docs_over"), F.coalesce("t", zero).alias("tokens_total"),
        F.coalesce(F.col("r.tokens_truncated") + (F.col("asked") - F.col("r.context_limit")) * F.col("r.docs_over"),
                   F.col("asked") * F.col("d"), zero).alias("tokens_truncated"))


def quantile_lengths(limits: DataFrame, shares: list[float]) -> DataFrame:
    """Smallest length that covers each share of the documents: ``share, length``."""
    asked = limits.sparkSession.createDataFrame([(float(x),) for x in dict.fromkeys(shares)], "share double")
    return limits.join(F.broadcast(asked), F.col("quantile") >= F.col("share")).groupBy("share").agg(
        F.min("context_limit").alias("length"))


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    return context_limits(save(length_histogram(docs, vocabulary), "length-histogram"))
