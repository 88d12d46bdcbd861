"""Structured Streaming twins of the batch jobs (STM-01, STM-22, STM-24,
SNK-03, SNK-05); alerts with state and timers are in ``stateful``.

Each job reads a file stream, applies the same operators as the batch path
(they are plain DataFrame transformations), and writes to a sink whose
checkpoint lives under the session's shared ``spark.checkpoint.dir``.
``run_available`` drives a query with ``Trigger.AvailableNow`` and returns
the sink's contents, which is how the registered queries run them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import budget as BU
from ..operators import logs as L
from ..operators import timeseries as TS
from ..session import ensure_checkpoint_dir


def scratch(spark: SparkSession, tag: str) -> str:
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{tag}-{uuid.uuid4().hex}"


def file_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """Parquet file stream of ``{sf_dir}/{name}*.parquet`` (a glob: a bare file
    path is not a valid stream source).  The schema is taken from the table."""
    schema = spark.read.parquet(f"{sf_dir}/{name}.parquet").schema
    r = spark.readStream.schema(schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(f"{sf_dir}/{name}*.parquet")


def run_available(df: DataFrame, *, mode: str = "append", partition_by=None, tag: str = "stream",
                  path: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """Run a streaming DataFrame to completion over the data available now
    and return what the sink holds.

    * ``append``: finalized rows appended as Parquet (optionally partitioned).
    * ``update``: each micro-batch emits the changed aggregate rows; they are
      written to the partition ``_epoch=<batch id>`` (dynamic overwrite, so a
      replayed batch replaces its own output) and the result keeps, per
      ``keys``, the row of the newest epoch.  With a watermark the streaming
      state of closed windows is evicted, unlike ``complete`` mode.
    * ``complete``: the whole result rewritten each micro-batch."""
    spark = df.sparkSession
    out = path or scratch(spark, tag)
    ckpt = scratch(spark, tag + "-ckpt")
    w = df.writeStream.option("checkpointLocation", ckpt).trigger(availableNow=True)
    if mode == "complete":
        def sink(batch: DataFrame, _epoch: int):
            batch.write.mode("overwrite").parquet(out)
        q = w.outputMode("complete").foreachBatch(sink).start()
    elif mode == "update":
        if not keys:
            raise ValueError("update mode needs the result keys")

        def sink(batch: DataFrame, epoch: int):
            (batch.withColumn("_epoch", F.lit(epoch)).write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("_epoch").parquet(out))
        q = w.outputMode("update").foreachBatch(sink).start()
    else:
        if partition_by:
            w = w.partitionBy(*partition_by)
        q = w.outputMode("append").format("parquet").option("path", out).start()
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    if mode == "update":
        return latest_by_key(spark.read.parquet(out), keys, "_epoch")
    return spark.read.parquet(out)


def latest_by_key(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Per key, the row with the highest ``version`` (partial aggregation;
    a key has at most one row per micro-batch that touched it)."""
    rest = [c for c in df.columns if c not in keys and c != version]
    return (df.groupBy(*keys)
            .agg(F.max_by(F.struct(*rest), F.col(version)).alias("_r"))
            .select(*keys, *[F.col("_r")[c].alias(c) for c in rest]))


def logs_stream(spark: SparkSession, sf_dir: str, bind) -> DataFrame:
    """Events file stream mapped to log rows by ``bind`` (a row-wise binding)."""
    return bind(file_stream(spark, sf_dir, "events"))


def failures_stream(logs: DataFrame, jobs: list[str], *, as_of, delay: str = "1 day") -> DataFrame:
    """STM-24: streaming weekly failures.  Week windows start on Monday
    (``startTime='4 days'``: the epoch is a Thursday); the watermark bounds
    the state for late rows."""
    recent = (logs.withWatermark("ts", delay)
              .where(L.recent("ts", as_of=as_of) & L.job_name_col(logs).isin(list(jobs))
                     & L.severity_at_least("severity", "ERROR"))
              .select("ts", "severity", L.job_name_col(logs).alias("job_name")))
    w = F.window("ts", "7 days", startTime="4 days")
    return (recent.groupBy(w.alias("_w"), "job_name")
            .agg(F.count(F.lit(1)).alias("n_failures"),
                 F.count_if(F.col("severity") == "ERROR").alias("n_error"),
                 F.count_if(F.col("severity") == "CRITICAL").alias("n_critical"),
                 F.count_if(F.col("severity").isin("ALERT", "EMERGENCY")).alias("n_alert_emergency"),
                 F.min("ts").alias("first_failure"), F.max("ts").alias("last_failure"))
            .select(F.col("_w.start").alias("period"), "job_name", "n_failures", "n_error",
                    "n_critical", "n_alert_emergency", "first_failure", "last_failure"))


def job_errors_stream(logs: DataFrame, *, period: str = "60 seconds", delay: str = "10 minutes") -> DataFrame:
    """STM-01 streaming: error counter per (period, job, severity).  Run it in update
    mode with the keys (period_start, job_name, severity): open windows are there, too,
    and the state of a window goes when the watermark passes it."""
    return TS.job_error_counter(logs.withWatermark("ts", delay), period)


def budget_decisions_stream(messages: DataFrame, *, delay: str) -> DataFrame:
    """STM-22 streaming: at-least-once messages deduplicated on ``message_id``
    within the watermark, then decided.  ``delay`` is how late a repeated delivery
    can be: the ids of that span are the state, a later repeat decides again."""
    dedup = messages.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["message_id"])
    return BU.budget_decision(dedup, dedupe_key=None)


def routed_logs_stream(logs: DataFrame, jobs: list[str]) -> DataFrame:
    """SNK-05 streaming: routed log rows with their ``log_date`` partition."""
    return L.route_logs(logs, jobs)


def append_by_batch(stream: DataFrame, path: str, keys: list[str], checkpoint: str, *,
                    partition_by=None):
    """SNK-03: append each micro-batch as soon as it completes, skipping keys
    already present (idempotent on replay).  Empty batches write nothing."""
    from ..sources.io import append

    def sink(batch: DataFrame, _epoch: int):
        if not batch.isEmpty():
            append(batch, path, keys, partition_by=partition_by)

    return (stream.writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(sink).trigger(availableNow=True).start())


def append_by_chapter(stream: DataFrame, name: str, checkpoint: str, *,
                      keys: tuple[str, ...] = ("chapter_number", "page_number")):
    """SNK-03 in the target signature: each finished micro-batch (a chapter's
    pages as they land) is appended to the table at ``name``, idempotently on
    ``keys``."""
    return append_by_batch(stream, name, list(keys), checkpoint)
