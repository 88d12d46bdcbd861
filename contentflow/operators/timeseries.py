"""Metric time series: per-series alignment, cross-series reduction and the
dashboard widgets built from them (STM-01..18, STM-25).

``align`` is one tumbling-window aggregate per (period, series); ``reduce_series``
is a second aggregate over the aligned rows.  Both are hash aggregates with
partial aggregation, so a series (or job) holding a third of all samples is
collapsed inside each task before the shuffle.  Alignment windows are
``F.window`` windows, usable unchanged on streaming DataFrames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .logs import severity_at_least


def period_seconds(period: str) -> int:
    n, unit = period.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600,
            "hours": 3600, "day": 86400, "days": 86400}[unit.lower()]
    return int(n) * mult


def _window(ts: str, period: str) -> Column:
    # Windows of whole days start on a Monday boundary when the period is a
    # multiple of 7 days (the epoch is a Thursday); shorter ones are epoch-aligned.
    secs = period_seconds(period)
    if secs % (7 * 86400) == 0:
        return F.window(F.col(ts), period, startTime="4 days")
    return F.window(F.col(ts), period)


def align(df: DataFrame, series: list[str], how: str, period: str, *, value: str = "value",
          ts: str = "ts") -> DataFrame:
    """Per-series aligner over tumbling ``period`` windows.

    how: ``sum`` | ``rate`` (sum / period seconds) | ``mean`` | ``count`` |
    ``fraction_true`` | ``next_older`` (latest sample of the window, of equal times
    the largest value; use ``carry_forward`` to fill windows without samples).
    Output: period_start, period_end, *series, value."""
    v = F.col(value)
    agg = {
        "sum": F.sum(v),
        "rate": F.sum(v) / F.lit(float(period_seconds(period))),
        "mean": F.avg(v),
        "count": F.count(v),
        "fraction_true": F.avg(v.cast("double")),
        "next_older": F.max(F.struct(F.col(ts).alias("t"), v.alias("v")))["v"],
    }[how]
    w = _window(ts, period)
    return (df.groupBy(w.alias("_w"), *series).agg(agg.alias("value"))
            .select(F.col("_w.start").alias("period_start"), F.col("_w.end").alias("period_end"),
                    *series, "value"))


# A series is scanned in segments of one day; a block holds the summaries of so many.
SEGMENT = 86400
BLOCK = 512


def segment(ts: str = "period_start") -> Column:
    return F.floor(F.unix_timestamp(ts) / SEGMENT)


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner equi-join in which null keys meet; the right keys go."""
    other = right.select(*[F.col(k).alias("_r" + k) if k in keys else F.col(k) for k in right.columns])
    cond = [left[k].eqNullSafe(other["_r" + k]) for k in keys]
    return left.join(other, cond).drop(*["_r" + k for k in keys])


def _around(summary: DataFrame, series: list[str]) -> DataFrame:
    """What a segment needs from the others of its series: ``_carry`` (last value before
    it), ``_next`` (first period after it) and ``_hi`` (the series' last period).

    Segments are scanned per block, blocks as one short array per series (a block is 512
    days), so no window runs over a series."""
    blocked = summary.withColumn("_blk", F.floor(F.col("_seg") / BLOCK))
    w = Window.partitionBy(*series, "_blk").orderBy("_seg")
    inside = blocked.withColumns({
        "_before": F.last("_val", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)),
        "_after": F.lead("_first").over(w)})
    blocks = blocked.groupBy(*series, "_blk").agg(
        F.min("_first").alias("first"), F.max("_last").alias("last"),
        F.max(F.when(F.col("_val").isNotNull(), F.struct("_seg", F.col("_val").alias("v")))).alias("v"))
    every = blocks.groupBy(*series).agg(F.sort_array(F.collect_list(F.struct("_blk", "first", "last", "v"))).alias("_b"))
    each = every.select(*series, "_b", F.explode("_b").alias("_x"))
    older = F.filter("_b", lambda y: (y["_blk"] < F.col("_x._blk")) & y["v"].isNotNull())
    newer = F.filter("_b", lambda y: y["_blk"] > F.col("_x._blk"))
    edge = each.select(*series, F.col("_x._blk").alias("_blk"), F.get(older, F.size(older) - 1)["v"]["v"].alias("_older"),
                       F.get(newer, F.lit(0))["first"].alias("_newer"), F.array_max(F.transform("_b", lambda y: y["last"])).alias("_hi"))
    return join_null_safe(inside, edge, [*series, "_blk"]).select(
        *series, "_seg", F.coalesce("_before", "_older").alias("_carry"), F.coalesce("_after", "_newer").alias("_next"), "_hi")


def carry_forward(aligned: DataFrame, series: list[str], period: str, *,
                  start=None, end=None) -> DataFrame:
    """NEXT_OLDER completion: one row per series and period between the
    series' first period (or ``start``) and its last (or ``end``); periods
    without a sample take the latest earlier value.

    A segmented scan: windows run inside (series, day) only; a summary per (series, day)
    carries the last value over the days' ends.  Each aligned row is then repeated up to
    the period before the next one, a day of periods at a time."""
    secs = period_seconds(period)
    step = F.expr(f"INTERVAL {secs} SECONDS")
    rows = aligned.select(*series, "period_start", "value", segment().alias("_seg"))
    known = F.when(F.col("value").isNotNull(), F.struct("period_start", "value"))
    summary = rows.groupBy(*series, "_seg").agg(F.min("period_start").alias("_first"), F.max("period_start").alias("_last"),
                                               F.max(known)["value"].alias("_val"))
    day = Window.partitionBy(*series, "_seg").orderBy("period_start")
    local = join_null_safe(rows, _around(summary, series), [*series, "_seg"])
    hi = F.col("_hi") if end is None else F.lit(end).cast("timestamp")
    placed = local.select(
        *series, "period_start", F.coalesce(F.coalesce(F.lead("period_start").over(day), F.col("_next")) - step, hi).alias("_to"),
        F.coalesce(F.last("value", ignorenulls=True).over(day.rowsBetween(Window.unboundedPreceding, 0)), F.col("_carry")).alias("value"))
    if start is not None:
        # Periods before the first sample have no value yet.
        lo = F.lit(start).cast("timestamp")
        lead_in = aligned.groupBy(*series).agg(F.min("period_start").alias("_f")).where(F.col("_f") > lo).select(
            *series, lo.alias("period_start"), (F.col("_f") - step).alias("_to"),
            F.lit(None).cast(aligned.schema["value"].dataType).alias("value"))
        placed = placed.unionByName(lead_in)
    begin, stop = F.unix_timestamp("period_start"), F.unix_timestamp("_to")
    days = placed.where(F.col("_to") >= F.col("period_start")).withColumn(
        "_d", F.explode(F.sequence(F.floor(begin / SEGMENT), F.floor(stop / SEGMENT))))
    first = F.ceil(F.greatest(F.lit(0), F.col("_d") * SEGMENT - begin) / secs)
    last = F.floor((F.least((F.col("_d") + 1) * SEGMENT - 1, stop) - begin) / secs)
    filled = days.where(first <= last).select(*series, "value", "period_start", F.explode(F.sequence(first, last)).alias("_k")).select(
        *series, (F.col("period_start") + F.make_dt_interval(secs=F.col("_k") * secs)).alias("period_start"), "value")
    if start is not None:
        filled = filled.where(F.col("period_start") >= F.lit(start).cast("timestamp"))
    return filled.select(*series, "period_start", (F.col("period_start") + step).alias("period_end"), "value")


def reduce_series(aligned: DataFrame, by: list[str], how: str) -> DataFrame:
    """Cross-series reducer per period: ``sum`` | ``mean`` (mean of the aligned
    values, not of raw samples) | ``count_false`` | ``count``."""
    v = F.col("value")
    agg = {"sum": F.sum(v), "mean": F.avg(v), "count": F.count(v),
           "count_false": F.count_if(~v)}[how]
    return (aligned.groupBy("period_start", "period_end", *by).agg(agg.alias("value")))


# Name of the cross-series reducer in the target API.
reduce = reduce_series


# --------------------------------------------------------------------------
# Log-based counters
# --------------------------------------------------------------------------

def count_metric(df: DataFrame, predicate: Column, labels: list[str] | dict[str, Column],
                 period: str = "60 seconds", *, ts: str = "ts") -> DataFrame:
    """Log-based counter (DELTA, INT64): rows matching ``predicate`` counted
    per ``period`` and label values.  ``labels`` are column names or
    ``{name: extractor}`` Columns (e.g. a JSON path)."""
    lab = ({k: F.col(k) for k in labels} if not isinstance(labels, dict) else dict(labels))
    src = df.where(predicate).select(F.col(ts).alias("ts"), *[c.alias(k) for k, c in lab.items()],
                                     F.lit(1).alias("value"))
    return align(src, list(lab), "sum", period)


def job_error_counter(logs: DataFrame, period: str = "60 seconds",
                      resource_type: str = "cloud_run_job") -> DataFrame:
    """STM-01: logs with severity >= ERROR (ordinal) counted per period,
    labelled (job_name, severity)."""
    src = (logs.where((F.col("resource.type") == resource_type) & severity_at_least("severity", "ERROR"))
           .select("ts", F.col("resource.labels.job_name").alias("job_name"), "severity",
                   F.lit(1).alias("value")))
    return align(src, ["job_name", "severity"], "sum", period)


def phrase_counter(logs: DataFrame, pattern: str, job: str, *, label_path: str = "$.chapter_number",
                   period: str = "60 seconds", resource_type: str = "cloud_run_job") -> DataFrame:
    """STM-02: logs of ``job`` whose text payload or JSON ``message`` matches
    ``pattern`` (case-sensitive), counted per period and extracted label."""
    from .logs import payload_matches
    src = (logs.where(payload_matches(pattern, [job], resource_type))
           .select("ts", F.get_json_object("json_payload", label_path).alias("label"),
                   F.lit(1).alias("value")))
    return align(src, ["label"], "sum", period)


# --------------------------------------------------------------------------
# Widgets over executions (ts, job_name, result, execution_time)
# --------------------------------------------------------------------------

def _ones(df: DataFrame, cond: Column | None = None) -> DataFrame:
    src = df if cond is None else df.where(cond)
    return src.select("ts", "job_name", "result", F.lit(1).alias("value"))


def executions_rate(executions: DataFrame, result: str, period: str = "60 seconds") -> DataFrame:
    """STM-09: executions per second by job for one result."""
    # One result: the aligned series are the reduced ones.
    return align(_ones(executions, F.col("result") == result), ["job_name"], "rate", period)


def error_rate(logs: DataFrame, period: str = "60 seconds") -> DataFrame:
    """STM-10: error logs per second by (job, severity)."""
    c = job_error_counter(logs, period)
    return c.withColumn("value", F.col("value") / F.lit(float(period_seconds(period))))


# FIXED VALUES: availability levels drawn on the uptime chart.
UPTIME_LEVELS = [0.95, 0.99]


def uptime_fraction(uptime: DataFrame, period: str = "60 seconds") -> DataFrame:
    """STM-11: share of passed checks per period: fraction-true per (host,
    region) series, then the mean over series; ``level`` against 0.95 / 0.99."""
    a = align(uptime.select("ts", "host", "region", F.col("check_passed").alias("value")),
              ["host", "region"], "fraction_true", period)
    r = reduce_series(a, [], "mean")
    lo, hi = UPTIME_LEVELS
    return r.withColumn("level", F.when(F.col("value") >= hi, "ok")
                        .when(F.col("value") >= lo, "degraded").otherwise("low"))


def executions_total(executions: DataFrame, period: str = "1 day") -> DataFrame:
    """STM-12: total executions per period."""
    return reduce_series(align(_ones(executions), ["job_name", "result"], "sum", period), [], "sum")


def success_counts(executions: DataFrame, period: str = "1 day") -> DataFrame:
    """STM-13: the "success rate" tiles count successes; the true ratio is
    added as ``success_ratio``."""
    ones = executions.select("ts", F.lit(1).alias("value"),
                             (F.col("result") == "succeeded").cast("int").alias("ok"))
    w = _window("ts", period)
    return (ones.groupBy(w.alias("_w"))
            .agg(F.sum("ok").alias("succeeded"), F.count(F.lit(1)).alias("total"))
            .select(F.col("_w.start").alias("period_start"), F.col("_w.end").alias("period_end"),
                    "succeeded", "total",
                    (F.col("succeeded") / F.col("total")).alias("success_ratio")))


def success_rate(executions: DataFrame, period: str = "1 day") -> DataFrame:
    """STM-13 in the target signature: succeeded count, total and ratio per period."""
    return success_counts(executions, period)


def duration_mean(executions: DataFrame, period: str = "60 seconds") -> DataFrame:
    """STM-14: mean execution time by job (mean per series, then mean)."""
    return align(executions.select("ts", "job_name", F.col("execution_time").alias("value")),
                 ["job_name"], "mean", period)


def results_by_job(executions: DataFrame, period: str = "7 days") -> DataFrame:
    """STM-16: executions per job and result per period."""
    return align(_ones(executions), ["job_name", "result"], "sum", period)


# FIXED VALUES: execution results.
RESULTS = ["succeeded", "failed"]


def success_vs_failed(executions: DataFrame, period: str = "1 hour") -> DataFrame:
    """STM-18: per period and job, succeeded and failed side by side (pivot
    on an explicit value list, so no extra pass to find the values)."""
    w = _window("ts", period)
    p = (executions.groupBy(w.alias("_w"), "job_name").pivot("result", RESULTS)
         .agg(F.count(F.lit(1))))
    return p.select(F.col("_w.start").alias("period_start"), F.col("_w.end").alias("period_end"),
                    "job_name", *[F.coalesce(F.col(r), F.lit(0)).alias(r) for r in RESULTS])
