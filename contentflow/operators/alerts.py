"""Alert conditions and incidents (STM-19..21).

Conditions are evaluated on aligned series (one row per series and period),
so the per-series windows used for "held for N seconds" and for incident
sessions run over periods or firings, never over raw samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .timeseries import BLOCK, SEGMENT, align, carry_forward, executions_rate, period_seconds, reduce_series


def threshold(series: DataFrame, op: str, value: float) -> DataFrame:
    """Rows of an aligned/reduced series where ``value <op> threshold``."""
    v = F.col("value")
    cond = {"GT": v > value, "GE": v >= value, "LT": v < value, "LE": v <= value}[op]
    return series.where(cond)


def job_failure_firings(executions: DataFrame, period: str = "60 seconds") -> DataFrame:
    """STM-19: failed-execution rate > 0 in a period (held 0 s) -> one firing
    per (job, period)."""
    return threshold(executions_rate(executions, "failed", period), "GT", 0.0) \
        .select("job_name", "period_start", "period_end", F.col("value").alias("rate"))


def _joined(runs: DataFrame, cell: list[str]) -> DataFrame:
    """Runs ``_a.._b`` of periods that follow each other without a gap, inside a cell."""
    w = Window.partitionBy(*cell).orderBy("_a")
    new = F.coalesce((F.lag("_b").over(w) + 1 < F.col("_a")).cast("int"), F.lit(1))
    marked = runs.withColumn("_new", new).withColumn("_g", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return marked.groupBy(*cell, "_g").agg(F.min("_a").alias("_a"), F.max("_b").alias("_b")).drop("_g")


def sustained(cond_rows: DataFrame, key: list[str], period: str, hold: str) -> DataFrame:
    """Runs of consecutive periods where a condition is true (one input row per
    true period), kept when the run lasts at least ``hold``.

    Runs are merged in steps: inside (key, day), then inside (key, block of days), then
    the few that touch a block's edge as one short array per key.  A run that reaches no
    edge is complete at its step; no window runs over a key.

    Output: *key, run_start, run_end (end of last period), n_periods, fired_at
    (start + hold)."""
    secs = period_seconds(period)
    need = period_seconds(hold)
    day = max(1, SEGMENT // secs)
    idx = F.floor(F.unix_timestamp("period_start") / secs)
    off = F.unix_timestamp("period_start") % secs  # same for all periods of one grid
    done = None
    runs = cond_rows.where(F.col("period_start").isNotNull()).select(*key, off.alias("_off"), idx.alias("_a"), idx.alias("_b")).distinct()
    for width in (day, day * BLOCK):
        cell = F.floor(F.col("_a") / width)
        runs = _joined(runs.withColumn("_cell", cell), [*key, "_off", "_cell"])
        at_edge = (F.col("_a") % width == 0) | ((F.col("_b") + 1) % width == 0)
        whole = runs.where(~at_edge).drop("_cell")
        done = whole if done is None else done.unionByName(whole)
        runs = runs.where(at_edge).drop("_cell")
    edge = runs.groupBy(*key, "_off").agg(F.sort_array(F.collect_list(F.struct("_a", "_b"))).alias("_r"))
    none = F.array().cast("array<struct<_a:bigint,_b:bigint>>")

    def join_next(out: Column, r: Column) -> Column:
        last = F.get(out, F.size(out) - 1)
        longer = F.concat(F.slice(out, F.lit(1), F.size(out) - 1), F.array(F.struct(last["_a"].alias("_a"), r["_b"].alias("_b"))))
        return F.when(F.coalesce(last["_b"] + 1 == r["_a"], F.lit(False)), longer).otherwise(F.concat(out, F.array(r)))

    merged = edge.select(*key, "_off", F.explode(F.aggregate("_r", none, join_next)).alias("_m")).select(*key, "_off", "_m._a", "_m._b")
    n = F.col("_b") - F.col("_a") + 1
    start = F.timestamp_seconds(F.col("_a") * secs + F.col("_off"))
    runs = done.unionByName(merged).where(n * secs >= need).select(*key, start.alias("run_start"), n.alias("n_periods"))
    return runs.select(*key, "run_start", (F.col("run_start") + F.make_dt_interval(secs=F.col("n_periods") * secs)).alias("run_end"),
                       "n_periods", (F.col("run_start") + F.expr(f"INTERVAL {need} SECONDS")).alias("fired_at"))


def downtime(uptime: DataFrame, *, period: str = "60 seconds", hold: str = "300 seconds",
             literal: bool = False) -> DataFrame:
    """STM-20: per host, latest check per (host, region) series each minute
    carried forward (NEXT_OLDER), count of failing series per host (COUNT_FALSE);
    fires when at least one series fails for ``hold``.  ``literal=True`` keeps
    the configured comparison (count_false < 1, i.e. while healthy)."""
    a = align(uptime.select("ts", "host", "region", F.col("check_passed").alias("value")),
              ["host", "region"], "next_older", period)
    filled = carry_forward(a, ["host", "region"], period)
    per_host = reduce_series(filled.where(F.col("value").isNotNull()), ["host"], "count_false")
    cond = (F.col("value") < 1) if literal else (F.col("value") >= 1)
    return sustained(per_host.where(cond), ["host"], period, hold)


def incidents(firings: DataFrame, key: list[str], *, ts: str = "period_start",
              auto_close: str = "24 hours") -> DataFrame:
    """STM-21: an incident opens at a firing and stays open while firings keep
    coming; it auto-closes ``auto_close`` after the last one (a firing that
    arrives exactly at the close instant still extends it).  Implemented with
    ``session_window`` (gap = auto_close), which also works on streams."""
    s = F.session_window(F.col(ts), auto_close)
    return (firings.groupBy(*key, s.alias("_s"))
            .agg(F.count(F.lit(1)).alias("n_firings"), F.max(ts).alias("last_firing"))
            .select(*key, F.col("_s.start").alias("opened_at"), "last_firing",
                    F.col("_s.end").alias("closed_at"), "n_firings"))


def any_of(*conditions: DataFrame) -> DataFrame:
    """Policy combiner OR: union of the firings of several conditions
    (same columns), tagged by condition index."""
    out = None
    for i, c in enumerate(conditions):
        c = c.withColumn("condition", F.lit(i))
        out = c if out is None else out.unionByName(c)
    return out


def policy_incidents(conditions: list[DataFrame], key: list[str], *, auto_close: str = "24 hours") -> DataFrame:
    """STM-21 with several conditions: firings ``*key, period_start, value`` (events in the
    period) of any condition open and extend one incident per key."""
    s = F.session_window(F.col("period_start"), auto_close)
    return (any_of(*conditions).groupBy(*key, s.alias("_s"))
            .agg(F.max("period_start").alias("last_firing"), F.sum("value").cast("long").alias("n_events"),
                 F.bit_count(F.bit_or(F.expr("shiftleft(1L, condition)"))).alias("n_conditions"))
            .select(*key, F.col("_s.start").alias("opened_at"), "last_firing",
                    F.col("_s.end").alias("closed_at"), "n_events", "n_conditions"))


def slow_or_failed(executions: DataFrame, *, limit: float, period: str = "60 seconds") -> list[DataFrame]:
    """Conditions of the job policy: executions that failed, executions over ``limit`` seconds."""
    def counted(rows: DataFrame) -> DataFrame:
        counts = align(rows.select("ts", "job_name", F.lit(1).alias("value")), ["job_name"], "sum", period)
        return threshold(counts, "GT", 0).select("job_name", "period_start", "value")
    return [counted(executions.where("result = 'failed'")), counted(executions.where(F.col("execution_time") > limit))]
