"""Log filters and failure roll-ups (FLT-01..03, FLT-05, AGG-03..05, SNK-05).

Plan shape for ``failures``: scan -> (pushed) filters -> partial hash
aggregate per task -> shuffle on (period, job) -> final aggregate -> small
sort.  Only three job keys exist, so a job may carry a third of all rows;
the partial aggregate collapses each task's rows to at most
(#periods x #jobs) before anything is shuffled, so the hot key never reaches
a single reducer as raw rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import SEVERITY_LEVELS


def severities_at_least(min_severity: str = "ERROR", *, literal: bool = False) -> list[str]:
    """Levels kept by ``severity >= min``.

    Default: ordinal scale.  ``literal=True`` reproduces a plain string
    comparison (which keeps INFO/NOTICE/WARNING and drops CRITICAL/ALERT/EMERGENCY
    for ``ERROR``)."""
    if literal:
        return [s for s in SEVERITY_LEVELS if s >= min_severity]
    return SEVERITY_LEVELS[SEVERITY_LEVELS.index(min_severity):]


def severity_at_least(col: str | Column = "severity", min_severity: str = "ERROR", *,
                      literal: bool = False) -> Column:
    """FLT-01 as an ``IN`` list, which Parquet predicate pushdown understands
    (a rank lookup via a map literal would not push down)."""
    c = F.col(col) if isinstance(col, str) else col
    if literal:
        return c >= F.lit(min_severity)
    return c.isin(severities_at_least(min_severity))


def _ts_lit(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(as_of).cast("timestamp")


def recent(ts: str | Column, *, as_of, months: int = 3) -> Column:
    """FLT-03: ``ts >= as_of - INTERVAL months MONTH`` (month arithmetic clamps)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return c >= (_ts_lit(as_of) - F.make_interval(F.lit(0), F.lit(months)))


def job_name_col(df: DataFrame) -> Column:
    """Nested ``resource.labels.job_name`` when present, else a flat ``job_name``."""
    if "resource" in df.columns:
        return F.col("resource.labels.job_name")
    return F.col("job_name")


def failures(logs: DataFrame, jobs: list[str], *, as_of, months: int = 3,
             grain: str = "WEEK", min_severity: str | None = "ERROR",
             literal: bool = False, ts: str = "ts") -> DataFrame:
    """AGG-03 (week), AGG-04 (``grain='DAY'``), AGG-05 (``min_severity=None``).

    Output: period, job_name, n_failures, n_error, n_critical,
    n_alert_emergency, first_failure, last_failure; ordered by period desc,
    n_failures desc, job_name."""
    cond = recent(ts, as_of=as_of, months=months) & job_name_col(logs).isin(list(jobs))
    if min_severity is not None:
        cond = cond & severity_at_least("severity", min_severity, literal=literal)
    recent_logs = logs.where(cond).select(
        F.col(ts).alias("ts"), F.col("severity"), job_name_col(logs).alias("job_name"))
    out = (recent_logs
           .groupBy(F.date_trunc(grain, "ts").alias("period"), "job_name")
           .agg(F.count(F.lit(1)).alias("n_failures"),
                F.count_if(F.col("severity") == "ERROR").alias("n_error"),
                F.count_if(F.col("severity") == "CRITICAL").alias("n_critical"),
                F.count_if(F.col("severity").isin("ALERT", "EMERGENCY")).alias("n_alert_emergency"),
                F.min("ts").alias("first_failure"),
                F.max("ts").alias("last_failure")))
    return out.orderBy(F.col("period").desc(), F.col("n_failures").desc(), F.col("job_name"))


def route_logs(logs: DataFrame, jobs: list[str], resource_type: str = "cloud_run_job") -> DataFrame:
    """SNK-05 filter: ``resource.type = t AND job IN (...)``, plus the day column
    used to partition the routed table."""
    return (logs.where((F.col("resource.type") == resource_type) & job_name_col(logs).isin(list(jobs)))
            .withColumn("log_date", F.to_date("ts")))


def write_routed_logs(logs: DataFrame, path: str, jobs: list[str]) -> None:
    """Append routed logs into day-partitioned Parquet (batch twin of the log sink)."""
    route_logs(logs, jobs).write.mode("append").partitionBy("log_date").parquet(path)


def payload_matches(pattern: str, jobs: list[str] | None = None,
                    resource_type: str = "cloud_run_job") -> Column:
    """FLT-05: ``textPayload =~ p OR jsonPayload.message =~ p`` (case-sensitive,
    no whitespace folding), NULL payloads count as no match."""
    msg = F.get_json_object(F.col("json_payload"), "$.message")
    cond = (F.coalesce(F.col("text_payload").rlike(pattern), F.lit(False))
            | F.coalesce(msg.rlike(pattern), F.lit(False)))
    cond = cond & (F.col("resource.type") == resource_type)
    if jobs is not None:
        cond = cond & F.col("resource.labels.job_name").isin(list(jobs))
    return cond
