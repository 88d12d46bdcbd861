"""Alerts as stateful streams (STM-20, STM-21): event-time timers, state only for what
is open.

``downtime_stream`` keeps, per host, the newest check of every region and the runs of
failing minutes that can still change; ``incident_stream`` keeps, per key, the incidents
that can still be extended.  Both write rows of three kinds:

* ``final``: a run or incident that no later row can change (written once);
* ``open``: those that can, as of the emission ``seq`` of their key (each emission
  replaces the key's earlier open rows; one without any is a row without start);
* ``fired`` (downtime): the alert itself, once per outage, by a timer while it lasts.

``settled`` reads the sink: final rows, and the newest open ones of every key.  Rows are
combined per minute inside the tasks before they are dealt by key, so a host or job with
most rows is a few rows per batch and minute.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def add_span(spans: list[list], first: int, last: int, gap: int, *more) -> None:
    """Put [first, last] into the sorted spans; spans at most ``gap`` apart become one.
    ``more`` are merge functions' inputs: further fields are added up or united."""
    joined = [first, last, *more]
    keep = []
    for s in spans:
        if s[1] + gap < joined[0] or joined[1] + gap < s[0]:
            keep.append(s)
        else:
            joined = [min(s[0], joined[0]), max(s[1], joined[1]), *(a + b if isinstance(a, int) else sorted(set(a) | set(b))
                                                                       for a, b in zip(s[2:], joined[2:]))]
    spans[:] = sorted([*keep, joined])


# ---------------------------------------------------------------- downtime
def advance(seen: dict, runs: list[list[int]], minute: int, checks: dict) -> None:
    """One minute of checks (region -> passed or None): the newest value of a region
    holds until its next check (NEXT_OLDER), so a failing one covers the minutes between."""
    for region, passed in checks.items():
        before, old = seen.get(region, (None, None))
        passed = old if passed is None else passed
        if old is False and minute > before + 1:
            add_span(runs, before + 1, minute - 1, 1)
        if passed is False:
            add_span(runs, minute, minute, 1)
        seen[region] = (minute, passed)


def by_minute(waiting: list[tuple]) -> list[tuple[int, dict]]:
    """Checks of whole minutes in order; of a region's checks in a minute the latest counts."""
    minutes: dict = {}
    for minute, region, at, passed in waiting:
        best = minutes.setdefault(minute, {})
        rank = (at, passed is not None, bool(passed))
        if region not in best or rank > best[region][0]:
            best[region] = (rank, passed)
    return [(m, {r: p for r, (_, p) in sorted(minutes[m].items())}) for m in sorted(minutes)]


DOWNTIME = ("host string, kind string, seq long, run_start timestamp, run_end timestamp, n_periods long, fired_at timestamp")


class Downtime(StatefulProcessor):
    """Per host: ``seen`` (region -> minute, passed), ``wait`` (checks of minutes that the
    watermark has not passed), ``runs`` (failing minutes that can still grow or join),
    ``alarm`` (since when some region fails, and whether that was reported)."""

    def __init__(self, periods: int, seconds: int):
        self.periods, self.seconds = periods, seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.seen = handle.getMapState("seen", "region string", "minute long, passed boolean")
        self.wait = handle.getListState("wait", "minute long, region string, at long, passed boolean")
        self.runs = handle.getListState("runs", "first long, last long")
        self.alarm = handle.getValueState("alarm", "since long, fired boolean")
        self.seq = handle.getValueState("seq", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        more = [(r["minute"], r["region"], r["at"], r["passed"]) for r in rows]
        yield from self._step(key[0], more, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._step(key[0], [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def _step(self, host, more: list[tuple], watermark: int) -> Iterator[Row]:
        ms = self.seconds * 1000
        past = watermark // ms  # minutes before this one are complete
        waiting = [tuple(w) for w in self.wait.get()] + more if self.wait.exists() else more
        seen = {k[0]: tuple(v) for k, v in self.seen.iterator()} if self.seen.exists() else {}
        runs = [list(r) for r in self.runs.get()] if self.runs.exists() else []
        since, fired = self.alarm.get() if self.alarm.exists() else (None, False)
        out = []
        for minute, checks in by_minute([w for w in waiting if w[0] < past]):
            if since is not None and not fired and minute - since >= self.periods:
                out.append(self._fire(host, since))
                fired = True
            advance(seen, runs, minute, checks)
            bad = any(p is False for _, p in seen.values())
            since, fired = ((minute, False) if since is None else (since, fired)) if bad else (None, False)
        if since is not None and not fired:
            if past >= since + self.periods:
                out.append(self._fire(host, since))
                fired = True
            else:
                self.handle.registerTimer((since + self.periods) * ms)
        waiting = [w for w in waiting if w[0] >= past]
        if waiting:
            self.handle.registerTimer((min(w[0] for w in waiting) + 1) * ms)
        # Later rows add minutes from here on, next to a run's end at the earliest.
        low = min([past, *(m + 1 for m, p in seen.values() if p is False)])
        done = [r for r in runs if r[1] + 1 < low]
        runs = [r for r in runs if r[1] + 1 >= low]
        self._keep(seen, waiting, runs, since, fired)
        n = (self.seq.get()[0] if self.seq.exists() else 0) + 1
        self.seq.update((n,))
        ahead, open_ = dict(seen), [list(r) for r in runs]
        for minute, checks in by_minute(waiting):
            advance(ahead, open_, minute, checks)
        rows = [(r, "final") for r in done] + [(r, "open") for r in open_]
        out += [self._row(host, kind, n, r) for r, kind in rows if r[1] - r[0] + 1 >= self.periods]
        if not any(r["kind"] == "open" for r in out):
            out.append(Row(host=host, kind="open", seq=n, run_start=None, run_end=None, n_periods=None, fired_at=None))
        yield from out

    def _keep(self, seen, waiting, runs, since, fired) -> None:
        for region, value in seen.items():
            self.seen.updateValue((region,), value)
        for state, values in ((self.wait, waiting), (self.runs, [tuple(r) for r in runs])):
            if values:
                state.put(values)
            else:
                state.clear()
        if since is None:
            self.alarm.clear()
        else:
            self.alarm.update((since, fired))

    def _time(self, minute: int):
        return pd.Timestamp(minute * self.seconds, unit="s", tz="UTC").to_pydatetime()

    def _row(self, host, kind, n, run) -> Row:
        return Row(host=host, kind=kind, seq=n, run_start=self._time(run[0]), run_end=self._time(run[1] + 1),
                   n_periods=run[1] - run[0] + 1, fired_at=self._time(run[0] + self.periods))

    def _fire(self, host, since) -> Row:
        return Row(host=host, kind="fired", seq=0, run_start=self._time(since), run_end=None, n_periods=None,
                   fired_at=self._time(since + self.periods))


def _combine(keys: list[str], how: str):
    """Rows of one minute become one inside a batch of a task: the sum of ``n``, or the
    row with the largest (at, passed)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if how == "sum":
                yield b.groupby(keys, dropna=False, sort=False, as_index=False)["n"].sum()
            else:
                b = b.assign(_known=b["passed"].notna(), _good=b["passed"].eq(True))
                yield b.sort_values(["at", "_known", "_good"]).drop_duplicates(keys, keep="last").drop(columns=["_known", "_good"])
    return run


def downtime_stream(uptime: DataFrame, *, period: int = 60, hold: int = 300, delay: str = "10 minutes") -> DataFrame:
    """STM-20 streaming over ``uptime(ts, host, region, check_passed)``: the newest check
    of each (host, region) is carried forward, a host is down while a region's fails.

    Per host, not per region, because one failing region is enough and runs of several
    join; a host without rows holds one small row per region.  A check later than
    ``delay`` is dropped.  A region that never reports again after a failing check keeps
    the runs after it open (they may still join)."""
    minute = F.floor(F.unix_timestamp("ts") / period)
    slim = uptime.where("ts IS NOT NULL").select(
        "host", F.coalesce(F.concat(F.lit("="), "region"), F.lit("-")).alias("region"), minute.alias("minute"),
        F.unix_micros("ts").alias("at"), F.col("check_passed").alias("passed"))
    kinds = "host string, region string, minute long, at long, passed boolean"
    timed = slim.mapInPandas(_combine(["host", "region", "minute"], "last"), kinds).withColumn(
        "ts", F.timestamp_micros("at")).withWatermark("ts", delay)
    return timed.groupBy("host").transformWithState(Downtime(-(-hold // period), period), DOWNTIME, "Update", "EventTime")


# ---------------------------------------------------------------- incidents
INCIDENT = "key string, kind string, seq long, opened_at timestamp, last_firing timestamp, closed_at timestamp, n_events long, n_conditions int"


class Incidents(StatefulProcessor):
    """Per key the incidents that can still be extended; closed by a timer ``close``
    microseconds after the last firing (a firing at that very moment extends it)."""

    def __init__(self, close: int):
        self.after = close

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("open", "first long, last long, n long, conditions array<int>")
        self.seq = handle.getValueState("seq", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        yield from self._step(key[0], rows, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._step(key[0], [], timerValues.getCurrentWatermarkInMs())

    def close(self) -> None:
        pass

    def _step(self, key, rows, watermark: int) -> Iterator[Row]:
        spans = [[a, b, n, list(c)] for a, b, n, c in self.held.get()] if self.held.exists() else []
        for r in rows:
            add_span(spans, r["at"], r["at"], self.after, r["n"], [r["condition"]])
        gone = [s for s in spans if s[1] + self.after < watermark * 1000]
        spans = [s for s in spans if s[1] + self.after >= watermark * 1000]
        if spans:
            self.held.put([tuple(s) for s in spans])
            for s in spans:
                self.handle.registerTimer((s[1] + self.after) // 1000 + 1)
        else:
            self.held.clear()
        n = (self.seq.get()[0] if self.seq.exists() else 0) + 1
        self.seq.update((n,))
        for kind, some in (("final", gone), ("open", spans or [[None, None, None, []]])):
            for a, b, count, conditions in some:
                yield Row(key=key, kind=kind, seq=n, opened_at=_at(a), last_firing=_at(b), closed_at=_at(None if b is None else b + self.after),
                          n_events=count, n_conditions=len(conditions))


def _at(micros: int | None):
    return None if micros is None else pd.Timestamp(micros, unit="us", tz="UTC").to_pydatetime()


def firing_rows(rows: DataFrame, key: Column, ts: str = "ts", *, condition: int = 0, period: int = 60) -> DataFrame:
    """Rows that satisfy a condition as its firings: ``key, at, n, condition`` per minute
    (combined per batch of a task; ``at`` in microseconds)."""
    minute = F.floor(F.unix_timestamp(ts) / period) * (period * 1_000_000)
    slim = rows.where(F.col(ts).isNotNull()).select(key.alias("key"), minute.alias("at"), F.lit(condition).alias("condition"), F.lit(1).cast("long").alias("n"))
    return slim.mapInPandas(_combine(["key", "at", "condition"], "sum"), "key string, at long, condition int, n long")


def incident_stream(firings: DataFrame, *, close: int = 86400, delay: str = "10 minutes") -> DataFrame:
    """STM-21 streaming: incidents over ``firings(key, at, n, condition)``, the union of the
    firings of one or several conditions (a policy's conditions are combined by OR)."""
    timed = firings.withColumn("ts", F.timestamp_micros("at")).withWatermark("ts", delay)
    return timed.groupBy("key").transformWithState(Incidents(close * 1_000_000), INCIDENT, "Update", "EventTime")


# ---------------------------------------------------------------- sink
def run_epochs(stream: DataFrame, path: str, checkpoint: str, schema: str) -> DataFrame:
    """Run over what is available now; every micro-batch replaces its own ``_epoch`` (a
    replay adds nothing).  Called again with the same folders it goes on where it ended."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)

    def sink(batch: DataFrame, epoch: int) -> None:
        (batch.withColumn("_epoch", F.lit(epoch)).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("_epoch").parquet(path))

    q = (stream.writeStream.option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True)
         .foreachBatch(sink).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return read_epochs(spark, path, schema)


def read_epochs(spark: SparkSession, path: str, schema: str) -> DataFrame:
    empty = spark.createDataFrame([], schema + ", _epoch int")
    empty.write.mode("append").partitionBy("_epoch").parquet(path)  # a stream without rows has no folder yet
    return spark.read.schema(empty.schema).parquet(path).drop("_epoch")


def settled(sink: DataFrame, key: str, start: str) -> DataFrame:
    """Final rows and the newest open rows of every key, with ``is_open``."""
    newest = sink.where("kind = 'open'").groupBy(F.col(key).alias("_k")).agg(F.max("seq").alias("_n"))
    now = sink.where("kind = 'open'").join(newest, F.col(key).eqNullSafe(F.col("_k")) & (F.col("seq") == F.col("_n"))).select(sink.columns)
    return sink.where("kind = 'final'").unionByName(now.where(F.col(start).isNotNull())).withColumn(
        "is_open", F.col("kind") == "open").drop("kind", "seq")
