"""Alerts as stateful streams: equal to the batch operators, timers, restarts."""

import random
import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from contentflow.operators import alerts as AL
from contentflow.session import ensure_checkpoint_dir
from contentflow.streaming import stateful as ST

T0 = datetime(2024, 1, 1, 23, 40)
UPTIME = "ts timestamp, host string, region string, check_passed boolean"


def folder(spark, tag):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def land(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def downtime(spark, path, out, ckpt):
    return ST.run_epochs(ST.downtime_stream(stream(spark, path, UPTIME)), out, ckpt, ST.DOWNTIME)


def test_spans_join_in_any_order():
    rnd = random.Random(1)
    for _ in range(100):
        points = [rnd.randrange(60) for _ in range(25)]
        spans = []
        for p in points:
            ST.add_span(spans, p, p, 3, 1, [p % 4])
        want = []
        for p in sorted(points):
            if want and p - want[-1][1] <= 3:
                want[-1][1], want[-1][2], want[-1][3] = p, want[-1][2] + 1, want[-1][3] | {p % 4}
            else:
                want.append([p, p, 1, {p % 4}])
        assert [[a, b, n, set(c)] for a, b, n, c in spans] == want


def test_downtime_equals_batch_over_many_files(spark):
    rnd = random.Random(7)
    rows = []
    for m in range(150):
        for host in ("a", "b", None):
            for region in ("x", "y", None):
                if rnd.random() < 0.6:  # gaps: the value before holds
                    down = (m // 13 + (host == "b")) % 4 == 0 and region != "y" or rnd.random() < 0.05
                    for _ in range(rnd.randint(1, 2)):
                        rows.append((T0 + timedelta(minutes=m, seconds=rnd.randrange(60)), host, region, None if rnd.random() < 0.04 else not down))
    rows.sort(key=lambda r: r[0])
    src, out, ckpt = (folder(spark, t) for t in ("up", "down", "ck"))
    for i in range(0, len(rows), 200):
        part = rows[i:i + 200]
        rnd.shuffle(part)
        land(spark, part, UPTIME, src)
    exp = AL.downtime(spark.createDataFrame(rows, UPTIME))
    got = ST.settled(downtime(spark, src, out, ckpt), "host", "run_start").drop("is_open").select(exp.columns)
    assert exp.count() > 5 and sorted(map(str, got.collect())) == sorted(map(str, exp.collect()))


def test_fires_while_down_and_only_once_after_a_restart(spark):
    src, out, ckpt = (folder(spark, t) for t in ("up", "down", "ck"))
    check = lambda m, ok: (T0 + timedelta(minutes=m), "h", "r", ok)
    land(spark, [check(m, m < 2) for m in range(25)], UPTIME, src)
    first = downtime(spark, src, out, ckpt).cache()
    fired = first.where("kind = 'fired'").collect()
    assert [(r["run_start"], r["fired_at"]) for r in fired] == [(T0 + timedelta(minutes=2), T0 + timedelta(minutes=7))]
    assert [r["is_open"] for r in ST.settled(first, "host", "run_start").collect()] == [True]
    land(spark, [check(m, m >= 30) for m in range(25, 60)], UPTIME, src)
    again = downtime(spark, src, out, ckpt)
    assert again.where("kind = 'fired'").count() == 1
    rows = ST.settled(again, "host", "run_start").collect()
    assert [(r["run_start"], r["run_end"], r["n_periods"], r["is_open"]) for r in rows] == [
        (T0 + timedelta(minutes=2), T0 + timedelta(minutes=30), 28, False)]
    assert downtime(spark, src, out, ckpt).count() == again.count()  # nothing new, nothing written


def test_a_short_outage_does_not_fire(spark):
    src, out, ckpt = (folder(spark, t) for t in ("up", "down", "ck"))
    land(spark, [(T0 + timedelta(minutes=m), "h", "r", not 5 <= m < 9) for m in range(40)], UPTIME, src)
    got = downtime(spark, src, out, ckpt)
    assert got.where("kind <> 'open' OR run_start IS NOT NULL").count() == 0


EXEC = "ts timestamp, job_name string, result string"


def test_incidents_of_two_conditions_close_by_timer(spark):
    rnd = random.Random(3)
    rows = sorted((T0 + timedelta(minutes=rnd.randrange(3000)), rnd.choice(["a", "b"]), rnd.choice(["failed", "failed", "slow", "ok"])) for _ in range(160))
    src, out, ckpt = (folder(spark, t) for t in ("ex", "inc", "ck"))
    for i in range(0, len(rows), 50):
        land(spark, rows[i:i + 50], EXEC, src)
    ex = stream(spark, src, EXEC)
    firings = ST.firing_rows(ex.where("result = 'failed'"), F.col("job_name"), condition=0).unionByName(
        ST.firing_rows(ex.where("result = 'slow'"), F.col("job_name"), condition=1))
    sink = ST.run_epochs(ST.incident_stream(firings, close=3600), out, ckpt, ST.INCIDENT)
    want = []
    for job in "ab":
        for ts, name, result in rows:
            if name == job and result != "ok":
                if want and want[-1][0] == job and ts - want[-1][2] <= timedelta(hours=1):
                    want[-1][2], want[-1][3] = ts, want[-1][3] + 1
                    want[-1][4].add(result)
                else:
                    want.append([job, ts, ts, 1, {result}])
    got = ST.settled(sink, "key", "opened_at").orderBy("key", "opened_at").collect()
    assert [(r["key"], r["opened_at"], r["last_firing"], r["n_events"], r["n_conditions"]) for r in got] == [
        (j, a, b, n, len(c)) for j, a, b, n, c in want]
    assert 0 < sum(r["is_open"] for r in got) <= 4
    # Every closed incident was written once.
    assert sink.where("kind = 'final'").count() == sum(not r["is_open"] for r in got)
