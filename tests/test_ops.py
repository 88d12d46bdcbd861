from datetime import datetime, timedelta

from pyspark.sql import functions as F

from contentflow.operators import alerts as AL
from contentflow.operators import audit as AU
from contentflow.operators import budget as BU


def test_budget_decisions(spark):
    msgs = [(1, '{"costAmount":60,"budgetAmount":50}'), (2, '{"costAmount":50,"budgetAmount":50}'),
            (3, '{"costAmount":49.99,"budgetAmount":50}'), (4, '{"costAmount":10,"budgetAmount":0}'),
            (5, '{"costAmount":10}'), (5, '{"costAmount":10}')]
    df = spark.createDataFrame(msgs, "message_id long, body string") \
        .select("message_id", F.base64(F.encode("body", "UTF-8")).alias("data"))
    got = {r.message_id: r.decision for r in BU.budget_decision(df).collect()}
    assert got == {1: "BREACH", 2: "BREACH", 3: "OK", 4: "SKIP", 5: "SKIP"}


def test_budget_crossings_two_level_prefix(spark):
    t0 = datetime(2024, 3, 1)
    rows = [(t0 + timedelta(minutes=17 * i), 10.0, i) for i in range(20)]
    df = spark.createDataFrame(rows, "ts timestamp, cost double, id long")
    got = {r.threshold: r.crossed_at for r in
           BU.budget_crossings(df, amount=100.0, tiebreak="id").collect()}
    assert got == {0.5: rows[4][0], 0.9: rows[8][0], 1.0: rows[9][0]}


def _uptime(spark, bad_minutes):
    t0 = datetime(2024, 1, 1)
    rows = [(t0 + timedelta(minutes=m, seconds=5), "h", "r", m not in bad_minutes) for m in range(30)]
    return spark.createDataFrame(rows, "ts timestamp, host string, region string, check_passed boolean")


def test_downtime_needs_five_minutes(spark):
    assert AL.downtime(_uptime(spark, set(range(10, 14)))).count() == 0
    r = AL.downtime(_uptime(spark, set(range(10, 16)))).collect()
    assert len(r) == 1 and r[0].n_periods == 6 and r[0].fired_at == datetime(2024, 1, 1, 0, 15)
    assert AL.downtime(_uptime(spark, set())).count() == 0
    assert AL.downtime(_uptime(spark, set()), literal=True).count() == 1


def test_incidents_auto_close(spark):
    t0 = datetime(2024, 1, 1)
    f = spark.createDataFrame([("j", t0), ("j", t0 + timedelta(hours=23)), ("j", t0 + timedelta(hours=48))],
                              "job_name string, period_start timestamp")
    inc = AL.incidents(f, ["job_name"]).orderBy("opened_at").collect()
    assert [(r.opened_at, r.n_firings) for r in inc] == [(t0, 2), (t0 + timedelta(hours=48), 1)]
    assert inc[0].closed_at == t0 + timedelta(hours=47)


def test_cost_grouping_default_vs_literal(spark):
    df = spark.createDataFrame([(("a", "Svc"), 1.0, "EUR", datetime(2024, 5, 1), "20240501"),
                                (("b", "Svc"), 2.0, "EUR", datetime(2024, 5, 2), "20240502")],
                               "service struct<id:string,description:string>, cost double, currency string,"
                               " usage_ts timestamp, suffix string")
    assert AU.cost_by_service(df).count() == 1
    assert AU.cost_by_service(df).first().total_cost == 3.0
    assert AU.cost_by_service(df, literal=True).count() == 2


def test_tier_report(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1), 1), (datetime(2024, 3, 1), 2), (datetime(2024, 3, 25), 3)],
                               "created_at timestamp, size_bytes long")
    got = {r.storage_class: r.n_objects for r in AU.tier_report(df, as_of="2024-04-01").collect()}
    assert got == {"COLDLINE": 1, "NEARLINE": 1, "STANDARD": 1}
