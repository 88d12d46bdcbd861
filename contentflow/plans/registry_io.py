"""Registered queries that exercise sources, sinks and streaming jobs.

Each writes what Spark derives from the benchmark tables into a fresh folder
under the shared checkpoint directory, then reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import alerts as AL
from ..operators import logs as L
from ..sources import io as IO
from ..streaming import jobs as S
from ..streaming import stateful as ST
from . import bindings as B
from .registry import out, query
from .registry_ops import SLOW

SHARD_WEEK = ("2024-01-08", "2024-01-14")


@query("src_sharded_logs")
def q_sharded_logs(spark, sf):
    """SNK-05 + SRC-05/07: route logs into day partitions, read the folder
    back, prune to one week of partitions, count per day and job."""
    path = S.scratch(spark, "routed-logs")
    L.write_routed_logs(B.logs(spark, sf), path, B.TEST_JOBS)
    week = IO.read_sharded_logs(spark, f"{path}/log_date=*/*.parquet", tuple(f"log_date={d}" for d in SHARD_WEEK))
    day = F.to_date(F.substring("shard", len("log_date=") + 1, 10)).alias("log_date")
    return out(week.groupBy(day, "job_name")
               .agg(F.count(F.lit(1)).alias("n_rows")))


@query("src_manifest")
def q_manifest(spark, sf):
    """SNK-01 + SRC-02 + PRJ-01: chapters written as manifests (one per batch
    of 100 chapter numbers), read back and flattened to chapter rows."""
    path = S.scratch(spark, "manifest")
    ch = B.chapters(spark, sf).withColumn("batch", F.floor(F.col("chapter_number") / 100)) \
        .withColumn("scraped_at", F.lit("2024-01-31T00:00:00+00:00"))
    IO.write_manifests(ch, path, batch="batch")
    rows = IO.read_manifest(spark, path)
    from ..operators.frontier import format_manifest_chapters
    return out(format_manifest_chapters(rows))


@query("stream_failures")
def q_stream_failures(spark, sf):
    logs = S.logs_stream(spark, sf, B.logs_from_events)
    res = S.run_available(S.failures_stream(logs, B.TEST_JOBS, as_of=B.AS_OF), mode="update",
                          keys=["period", "job_name"], tag="stream-failures")
    return out(res)


@query("stream_job_errors")
def q_stream_job_errors(spark, sf):
    logs = S.logs_stream(spark, sf, B.logs_from_events)
    res = S.run_available(S.job_errors_stream(logs), mode="update", tag="stream-job-errors",
                          keys=["period_start", "period_end", "job_name", "severity"])
    return out(res)


@query("stream_budget_decisions")
def q_stream_budget(spark, sf):
    msgs = B.budget_messages_from_events(S.file_stream(spark, sf, "events"))
    return out(S.run_available(S.budget_decisions_stream(msgs, delay="1 hour"), tag="stream-budget"))


@query("stream_route_logs")
def q_stream_route_logs(spark, sf):
    logs = S.logs_stream(spark, sf, B.logs_from_events)
    res = S.run_available(S.routed_logs_stream(logs, B.TEST_JOBS), partition_by=["log_date"],
                          tag="stream-routed")
    return out(res.groupBy("log_date", F.col("resource.labels.job_name").alias("job_name"))
               .agg(F.count(F.lit(1)).alias("n_rows")))


def _epochs(spark, stream, schema, tag):
    return ST.run_epochs(stream, S.scratch(spark, tag), S.scratch(spark, tag + "-ckpt"), schema)


@query("stream_incidents")
def q_stream_incidents(spark, sf):
    """Failed executions feed incidents kept as state, closed by a timer; the open ones
    are included.  A 1-hour auto-close gives incidents that close inside the test month."""
    failed = B.executions_from_events(S.file_stream(spark, sf, "events")).where("result = 'failed'")
    firings = ST.firing_rows(failed, F.col("job_name"))
    found = ST.settled(_epochs(spark, ST.incident_stream(firings, close=3600), ST.INCIDENT, "stream-incidents"), "key", "opened_at")
    # Open: the newest firing of all jobs has not passed the close time.
    now = found.select(F.max("last_firing")).scalar()
    return out(found.select(F.col("key").alias("job_name"), "opened_at", "last_firing", "closed_at", F.col("n_events").alias("n_failures"),
                            (F.col("closed_at") > now).alias("is_open")))


@query("stream_incidents_any")
def q_stream_incidents_any(spark, sf):
    """Two conditions combined by OR feed one incident per job: failed, or slow."""
    ex = B.executions_from_events(S.file_stream(spark, sf, "events"))
    firings = AL.any_of(ST.firing_rows(ex.where("result = 'failed'"), F.col("job_name")).drop("condition"),
                        ST.firing_rows(ex.where(F.col("execution_time") > SLOW), F.col("job_name")).drop("condition"))
    found = ST.settled(_epochs(spark, ST.incident_stream(firings, close=3600), ST.INCIDENT, "stream-incidents-any"), "key", "opened_at")
    return out(found.select(F.col("key").alias("job_name"), "opened_at", "last_firing", "closed_at", "n_events", "n_conditions"))


@query("stream_downtime")
def q_stream_downtime(spark, sf):
    """The rows of ``alert_downtime`` from a stateful stream with timers."""
    checks = B.uptime_from_events(S.file_stream(spark, sf, "events"))
    sink = _epochs(spark, ST.downtime_stream(checks), ST.DOWNTIME, "stream-downtime")
    return out(ST.settled(sink, "host", "run_start").drop("is_open"))
