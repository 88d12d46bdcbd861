"""Audit-log routing and queries, billing cost reports, retention and storage
tiering (SNK-06..08, AUD-01..04, SRT-05, FLT-06, AGG-11/12, SRC-06/07)."""

from __future__ import annotations

import re
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import AUDIT_LOG_NAME_REGEX, AUDIT_SERVICES, TIER_RULES


def _day(as_of) -> F.Column:
    return F.lit(as_of).cast("date")


# --------------------------------------------------------------------------
# Audit
# --------------------------------------------------------------------------

def route_audit(df: DataFrame, services=tuple(AUDIT_SERVICES),
                name_regex: str = AUDIT_LOG_NAME_REGEX) -> DataFrame:
    """SNK-06: data-access audit entries of the listed services."""
    return df.where(F.col("payload.service").isin(list(services))
                    & F.coalesce(F.col("log_name").rlike(name_regex), F.lit(False)))


def _audit_cols(df: DataFrame, fields: list[str]) -> DataFrame:
    names = {"principal": "principal", "service": "service", "method": "method", "resource": "resource"}
    return df.select("ts", *[F.col(f"payload.{f}").alias(names[f]) for f in fields])


def audit_latest(df: DataFrame, *, as_of, k: int = 100) -> DataFrame:
    """AUD-01 / SRT-05: the newest ``k`` entries ingested on day ``as_of``.
    The day filter is on the ingest partition column (partition pruning)."""
    today = df.where(F.col("ingest_date") == _day(as_of))
    cols = ["principal", "service", "method", "resource"]
    # Equal times: by the other columns, so that the cut at k is always the same.
    return _audit_cols(today, cols).orderBy(F.col("ts").desc(), *[F.col(c).asc_nulls_first() for c in cols]).limit(k)


def audit_access(df: DataFrame, *, resource_like: str | None = None, method_like: str | None = None,
                 service: str | None = None, method: str | None = None,
                 fields=("principal",)) -> DataFrame:
    """AUD-02..04 / FLT-06: LIKE filters on resource / method, equality on
    service / method; newest first."""
    cond = F.lit(True)
    if resource_like is not None:
        cond = cond & F.col("payload.resource").like(resource_like)
    if method_like is not None:
        cond = cond & F.col("payload.method").like(method_like)
    if service is not None:
        cond = cond & (F.col("payload.service") == service)
    if method is not None:
        cond = cond & (F.col("payload.method") == method)
    return _audit_cols(df.where(cond), list(fields)).orderBy(F.col("ts").desc())


def retain(df: DataFrame, ts: str, days: int, *, as_of) -> DataFrame:
    """SNK-07: rows younger than ``days`` at ``as_of``."""
    return df.where(F.col(ts) >= (F.lit(as_of).cast("timestamp") - F.make_interval(
        F.lit(0), F.lit(0), F.lit(0), F.lit(days))))


def expire_partitions(spark, path: str, days: int, *, as_of, column: str = "ingest_date") -> list[str]:
    """SNK-07 as the store does it: delete the day partitions ``column=yyyy-mm-dd`` under
    ``path`` that are ``days`` old or older at ``as_of``.  Only folder names are listed.
    Returns the days deleted."""
    cut = (date.fromisoformat(str(as_of)[:10]) - timedelta(days=days)).isoformat()
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = []
    for entry in fs.listStatus(root):
        key, _, day = entry.getPath().getName().partition("=")
        if key == column and re.fullmatch(r"\d{4}-\d\d-\d\d", day) and day < cut:
            fs.delete(entry.getPath(), True)
            gone.append(day)
    return sorted(gone)


def tier_report(objects: DataFrame, *, as_of, created: str = "created_at", size: str = "size_bytes",
                rules=tuple(TIER_RULES)) -> DataFrame:
    """SNK-08: storage class by age (oldest rule first, default STANDARD),
    counted and sized per class."""
    age = F.datediff(_day(as_of), F.col(created).cast("date"))
    tier = F.lit("STANDARD")
    for min_age, name in sorted(rules):
        tier = F.when(age >= min_age, F.lit(name)).otherwise(tier)
    return (objects.groupBy(tier.alias("storage_class"))
            .agg(F.count(F.lit(1)).alias("n_objects"), F.sum(size).alias("total_bytes")))


# --------------------------------------------------------------------------
# Billing
# --------------------------------------------------------------------------

def cost_by_service(df: DataFrame, *, lo: str | None = None, hi: str | None = None,
                    as_of=None, days: int | None = None, k: int | None = None,
                    literal: bool = False) -> DataFrame:
    """AGG-11 / AGG-12: total cost per (service description, currency),
    highest first.

    ``lo``/``hi`` (yyyymmdd): a usage-date range, or with ``literal=True`` the
    raw shard-suffix string range.  ``as_of``/``days``: the last ``days``
    ingest days (partition column).  ``k``: top-k.  ``literal=True`` also
    groups by the whole service struct, as a GROUP BY on the alias resolves.
    Money is summed as DECIMAL, so the result does not depend on order."""
    cond = F.lit(True)
    if lo is not None and hi is not None:
        if literal:
            cond = cond & F.col("suffix").between(lo, hi)
        else:
            # Range on the timestamp itself (pushed down to the scan), not on
            # a formatted string.
            start = F.to_timestamp(F.lit(lo), "yyyyMMdd")
            stop = F.to_timestamp(F.lit(hi), "yyyyMMdd") + F.expr("INTERVAL 1 DAY")
            cond = cond & (F.col("usage_ts") >= start) & (F.col("usage_ts") < stop)
    if as_of is not None and days is not None:
        cond = cond & (F.col("ingest_date") >= F.date_sub(_day(as_of), days))
    key = F.col("service") if literal else F.col("service.description")
    agg = (df.where(cond).groupBy(key.alias("_svc"), "currency")
           .agg(F.sum(F.col("cost").cast("decimal(18,2)")).cast("double").alias("total_cost")))
    svc = F.col("_svc.description") if literal else F.col("_svc")
    out = agg.select(svc.alias("service_name"), "total_cost", "currency") \
        .orderBy(F.col("total_cost").desc(), "service_name", "currency")
    return out.limit(k) if k else out
