"""NEXT_OLDER and sustained conditions as segmented scans (STM-07, STM-20)."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from contentflow.operators import alerts as AL
from contentflow.operators import timeseries as TS

T0 = datetime(2024, 1, 1)


def fill(rows, secs):
    """Plain NEXT_OLDER per series."""
    out = []
    for k in {r[0] for r in rows}:
        mine = dict((t, v) for s, t, v in rows if s == k)
        t, value = min(mine), None
        while t <= max(mine):
            if mine.get(t) is not None:
                value = mine[t]
            out.append((k, t, t + timedelta(seconds=secs), value))
            t += timedelta(seconds=secs)
    return sorted(out, key=str)


def carried(spark, rows, secs):
    df = spark.createDataFrame(rows, "k string, period_start timestamp, value int")
    got = TS.carry_forward(df, ["k"], f"{secs} seconds")
    return sorted(((r["k"], r["period_start"], r["period_end"], r["value"]) for r in got.collect()), key=str)


def test_one_series_holds_all_rows(spark):
    rnd = random.Random(1)
    at = sorted(rnd.sample(range(9 * 1440), 900))
    rows = [("s", T0 + timedelta(minutes=m), None if rnd.random() < 0.2 else m % 9) for m in at]
    assert carried(spark, rows, 60) == fill(rows, 60)


def test_gaps_over_days_and_blocks_and_odd_periods(spark):
    rnd = random.Random(2)
    rows = []
    for k in ("a", "b", None):  # 3,600 s periods over four years: several blocks of 512 days
        for d in sorted(rnd.sample(range(1500 * 24), 60)):
            rows.append((k, T0 + timedelta(hours=d), None if rnd.random() < 0.3 else d % 5))
    rows.append(("one", T0, None))
    assert carried(spark, rows, 3600) == fill(rows, 3600)
    odd = [("o", T0 + timedelta(seconds=420 * i), i) for i in sorted(rnd.sample(range(2000), 50))]
    assert carried(spark, odd, 420) == fill(odd, 420)


def test_start_and_end(spark):
    rows = [("a", T0 + timedelta(minutes=5), 1), ("a", T0 + timedelta(minutes=9), 2)]
    df = spark.createDataFrame(rows, "k string, period_start timestamp, value int")
    got = TS.carry_forward(df, ["k"], "60 seconds", start=T0 + timedelta(minutes=3), end=T0 + timedelta(minutes=11)).orderBy("period_start").collect()
    assert [r["value"] for r in got] == [None, None, 1, 1, 1, 1, 2, 2, 2]
    late = TS.carry_forward(df, ["k"], "60 seconds", start=T0 + timedelta(minutes=7)).orderBy("period_start").collect()
    assert [(r["period_start"].minute, r["value"]) for r in late] == [(7, 1), (8, 1), (9, 2)]


def islands(rows, secs, need):
    out = []
    for k in {r[0] for r in rows}:
        run = []
        for t in sorted({t for s, t in rows if s == k}) + [None]:
            if run and (t is None or t - run[-1] != timedelta(seconds=secs)):
                if len(run) * secs >= need:
                    out.append((k, run[0], run[-1] + timedelta(seconds=secs), len(run), run[0] + timedelta(seconds=need)))
                run = []
            if t is not None:
                run.append(t)
    return sorted(out, key=str)


def held(spark, rows, secs, need):
    df = spark.createDataFrame(rows, "k string, period_start timestamp")
    got = AL.sustained(df, ["k"], f"{secs} seconds", f"{need} seconds")
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_a_run_over_midnight_and_over_days_is_one(spark):
    start = datetime(2024, 1, 1, 23, 57)
    rows = [("h", start + timedelta(minutes=m)) for m in range(10)]
    assert held(spark, rows, 60, 300) == [("h", start, start + timedelta(minutes=10), 10, start + timedelta(minutes=5))]
    rows = [("h", start + timedelta(hours=m)) for m in range(24 * 1300)]  # over two edges of blocks
    assert held(spark, rows, 3600, 7200) == islands(rows, 3600, 7200)


def test_random_runs_match_islands(spark):
    rnd = random.Random(5)
    rows = []
    for k in ("a", "b", None):
        t = 0
        for _ in range(120):
            t += rnd.choice([1, 2, 30, 24, 24 * 200])
            for _ in range(rnd.choice([1, 2, 5, 24, 60])):
                rows.append((k, T0 + timedelta(hours=t)))
                t += 1
    assert held(spark, rows + rows[:50], 3600, 7200) == islands(rows, 3600, 7200)
    assert held(spark, rows[:0] or [("x", T0)], 3600, 7200) == []


def test_no_window_by_host_alone(spark):
    rows = [("h", T0 + timedelta(minutes=m)) for m in range(10)]
    plan = AL.sustained(spark.createDataFrame(rows, "k string, period_start timestamp"), ["k"], "60 seconds", "300 seconds")
    windows = [x for x in plan._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in x]
    assert windows and all("_cell" in x.split("], [")[-2] for x in windows)


def test_policy_combines_conditions_by_or(spark):
    rows = [(T0 + timedelta(minutes=m), "j", r, x) for m, r, x in
            [(0, "failed", 1.0), (40, "ok", 99.0), (90, "failed", 99.0), (200, "ok", 99.0), (201, "ok", 1.0)]]
    ex = spark.createDataFrame(rows, "ts timestamp, job_name string, result string, execution_time double")
    got = AL.policy_incidents(AL.slow_or_failed(ex, limit=95.0), ["job_name"], auto_close="1 hour").orderBy("opened_at").collect()
    assert [(r["opened_at"].hour * 60 + r["opened_at"].minute, r["n_events"], r["n_conditions"]) for r in got] == [(0, 4, 2), (200, 1, 1)]
    assert sorted(r["condition"] for r in AL.any_of(*AL.slow_or_failed(ex, limit=95.0)).collect()) == [0, 0, 1, 1, 1]
