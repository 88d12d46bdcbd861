"""Registered queries for the operational side: log counters, time-series
widgets, alerts, budget, audit and billing."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import alerts as AL
from ..operators import audit as AU
from ..operators import budget as BU
from ..operators import timeseries as TS
from ..sources import tables as TB
from ..streaming.jobs import scratch
from . import bindings as B
from .registry import out, query

# Audit "today" and the billing windows are pinned to days present in the data.
AUDIT_DAY = "2024-01-30"
BILLING_AS_OF = "2001-11-04"
TIER_AS_OF = "2001-11-30"
SPEND_BUDGET = 50000.0
MENTION_PATTERN = "purchase"
MENTION_JOB = "job-1"
OCR_JOB = "job-1"
SLOW = 95.0


def _r9(df, col="value"):
    return df.withColumn(col, F.round(F.col(col), 9))


# ------------------------------------------------------------------ counters
@query("ts_job_errors")
def q_job_errors(spark, sf):
    return out(TS.job_error_counter(B.logs(spark, sf), "60 seconds"))


@query("ts_phrase_mentions")
def q_phrase_mentions(spark, sf):
    return out(TS.phrase_counter(B.logs(spark, sf), MENTION_PATTERN, MENTION_JOB, label_path="$.k"))


# ------------------------------------------------------------------ widgets
@query("w_exec_success")
def q_exec_success(spark, sf):
    return out(TS.executions_rate(B.executions(spark, sf), "succeeded", "60 seconds"))


@query("w_exec_failed")
def q_exec_failed(spark, sf):
    return out(TS.executions_rate(B.executions(spark, sf), "failed", "60 seconds"))


@query("w_error_rate")
def q_error_rate(spark, sf):
    return out(TS.error_rate(B.logs(spark, sf), "60 seconds"))


@query("w_uptime")
def q_uptime(spark, sf):
    return out(_r9(TS.uptime_fraction(B.uptime(spark, sf), "60 seconds")))


@query("w_total_24h")
def q_total_24h(spark, sf):
    return out(TS.executions_total(B.executions(spark, sf), "1 day"))


@query("w_success_24h")
def q_success_24h(spark, sf):
    return out(TS.success_counts(B.executions(spark, sf), "1 day"))


@query("w_success_7d")
def q_success_7d(spark, sf):
    return out(TS.success_counts(B.executions(spark, sf), "7 days"))


@query("w_duration")
def q_duration(spark, sf):
    return out(_r9(TS.duration_mean(B.executions(spark, sf), "60 seconds")))


@query("w_duration_1h")
def q_duration_1h(spark, sf):
    return out(_r9(TS.duration_mean(B.executions(spark, sf), "1 hour")))


@query("w_mentions_rate")
def q_mentions_rate(spark, sf):
    c = TS.phrase_counter(B.logs(spark, sf), MENTION_PATTERN, MENTION_JOB, label_path="$.k")
    return out(c.withColumn("value", F.col("value") / F.lit(60.0)))


@query("w_mentions_7d")
def q_mentions_7d(spark, sf):
    return out(TS.phrase_counter(B.logs(spark, sf), MENTION_PATTERN, MENTION_JOB, label_path="$.k",
                                 period="7 days"))


@query("w_job_results_7d")
def q_job_results_7d(spark, sf):
    return out(TS.results_by_job(B.executions(spark, sf), "7 days"))


@query("w_ocr_errors_7d")
def q_ocr_errors_7d(spark, sf):
    logs = B.logs(spark, sf).where(F.col("resource.labels.job_name") == OCR_JOB)
    c = TS.job_error_counter(logs, "7 days")
    return out(TS.reduce_series(c, ["job_name"], "sum"))


@query("w_success_vs_failed")
def q_success_vs_failed(spark, sf):
    return out(TS.success_vs_failed(B.executions(spark, sf), "1 hour"))


# ------------------------------------------------------------------ alerts
@query("alert_job_failure")
def q_alert_job_failure(spark, sf):
    return out(AL.job_failure_firings(B.executions(spark, sf)))


@query("alert_downtime")
def q_alert_downtime(spark, sf):
    return out(AL.downtime(B.uptime(spark, sf)))


@query("alert_incidents")
def q_alert_incidents(spark, sf):
    f = AL.job_failure_firings(B.executions(spark, sf))
    return out(AL.incidents(f, ["job_name"], auto_close="24 hours"))


@query("alert_incidents_1h")
def q_alert_incidents_1h(spark, sf):
    f = AL.job_failure_firings(B.executions(spark, sf))
    return out(AL.incidents(f, ["job_name"], auto_close="1 hour"))


@query("alert_incidents_any")
def q_alert_incidents_any(spark, sf):
    """One policy, two conditions combined by OR: failed or slow executions."""
    return out(AL.policy_incidents(AL.slow_or_failed(B.executions(spark, sf), limit=SLOW), ["job_name"], auto_close="1 hour"))


# ------------------------------------------------------------------ budget
@query("src_budget_messages")
def q_budget_messages(spark, sf):
    m = BU.decode_budget_messages(B.budget_messages(spark, sf))
    return out(m.select("message_id", "cost_amount", "budget_amount"))


@query("budget_decision")
def q_budget_decision(spark, sf):
    return out(BU.budget_decision(B.budget_messages(spark, sf)))


@query("budget_thresholds")
def q_budget_thresholds(spark, sf):
    ev = B.table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("cost"), "event_id")
    return out(BU.budget_crossings(ev, amount=SPEND_BUDGET, tiebreak="event_id"))


# ------------------------------------------------------------------ audit
@query("audit_today")
def q_audit_today(spark, sf):
    return out(AU.audit_latest(B.audit_log(spark, sf), as_of=AUDIT_DAY, k=100))


@query("audit_secret_access")
def q_audit_secret(spark, sf):
    return out(AU.audit_access(B.audit_log(spark, sf), resource_like="%gemini-api-key%"))


@query("audit_table_writes")
def q_audit_writes(spark, sf):
    return out(AU.audit_access(B.audit_log(spark, sf), resource_like="%tables/speakers%",
                               method_like="%insert%", fields=("principal", "method")))


@query("audit_downloads")
def q_audit_downloads(spark, sf):
    return out(AU.audit_access(B.audit_log(spark, sf), service="storage.googleapis.com",
                               method="storage.objects.get", fields=("principal", "resource")))


@query("snk_route_audit")
def q_route_audit(spark, sf):
    r = AU.route_audit(B.audit_log(spark, sf))
    return out(r.select("ts", "log_name", F.col("payload.principal").alias("principal"),
                        F.col("payload.service").alias("service")))


@query("snk_retention")
def q_retention(spark, sf):
    """SNK-07 on a table written by day: old days are dropped, the cut-off day rewritten."""
    path = scratch(spark, "retention")
    name = f"retention_{uuid.uuid4().hex[:12]}.audit"
    spark.sql(f"CREATE DATABASE {name.split('.')[0]} LOCATION '{path}'")
    TB.write_managed(B.audit_log(spark, sf).select("ts", "log_name", "ingest_date"), name, "ingest_date")
    TB.retain_table(spark, name, f"{path}-staged", "ts", 7, as_of=B.AS_OF)
    return out(spark.table(name).groupBy("ingest_date").agg(F.count(F.lit(1)).alias("n_rows")))


@query("snk_tier_report")
def q_tier_report(spark, sf):
    li = B.table(spark, sf, "lineitem")
    objects = li.select(F.col("l_shipdate").alias("created_at"),
                        (F.col("l_quantity") * 1000).cast("long").alias("size_bytes"))
    return out(AU.tier_report(objects, as_of=TIER_AS_OF))


# ------------------------------------------------------------------ billing
@query("agg_cost_by_service")
def q_cost_by_service(spark, sf):
    return out(AU.cost_by_service(B.billing(spark, sf), lo="19960101", hi="19961231"))


@query("agg_cost_by_service_literal")
def q_cost_by_service_literal(spark, sf):
    return out(AU.cost_by_service(B.billing(spark, sf), lo="19960101", hi="19961231", literal=True))


@query("agg_cost_last30_top10")
def q_cost_last30(spark, sf):
    return out(AU.cost_by_service(B.billing(spark, sf), as_of=BILLING_AS_OF, days=30, k=10))


# ------------------------------------------------------------------ alignment details
@query("align_next_older")
def q_align_next_older(spark, sf):
    up = B.uptime(spark, sf).select("ts", "host", "region", F.col("check_passed").alias("value"))
    a = TS.align(up, ["host", "region"], "next_older", "60 seconds")
    return out(TS.carry_forward(a, ["host", "region"], "60 seconds"))


@query("reduce_count_false")
def q_reduce_count_false(spark, sf):
    up = B.uptime(spark, sf).select("ts", "host", "region", F.col("check_passed").alias("value"))
    filled = TS.carry_forward(TS.align(up, ["host", "region"], "next_older", "60 seconds"),
                              ["host", "region"], "60 seconds")
    return out(TS.reduce_series(filled.where(F.col("value").isNotNull()), ["host"], "count_false"))


@query("alert_downtime_literal")
def q_alert_downtime_literal(spark, sf):
    return out(AL.downtime(B.uptime(spark, sf), literal=True))
