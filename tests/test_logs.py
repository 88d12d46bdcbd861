from datetime import datetime

from pyspark.sql import functions as F

from contentflow.operators import logs as L
from contentflow.schemas import SEVERITY_LEVELS


def _logs(spark, rows):
    df = spark.createDataFrame(rows, "ts timestamp, severity string, job_name string")
    return df.select("ts", "severity", F.struct(F.lit("cloud_run_job").alias("type"),
                                                F.struct("job_name").alias("labels")).alias("resource"),
                     F.lit(None).cast("string").alias("text_payload"),
                     F.lit(None).cast("string").alias("json_payload"))


def test_severity_ordinal_and_literal(spark):
    rows = [(datetime(2024, 1, 2, 10), s, "j") for s in SEVERITY_LEVELS]
    df = _logs(spark, rows)
    kept = {r.severity for r in df.where(L.severity_at_least("severity", "ERROR")).collect()}
    assert kept == {"ERROR", "CRITICAL", "ALERT", "EMERGENCY"}
    lit = {r.severity for r in df.where(L.severity_at_least("severity", "ERROR", literal=True)).collect()}
    assert lit == {"INFO", "NOTICE", "WARNING", "ERROR"}


def test_week_starts_monday(spark):
    df = _logs(spark, [(datetime(2024, 1, 7, 23), "ERROR", "j"), (datetime(2024, 1, 8, 0), "ERROR", "j")])
    out = L.failures(df, ["j"], as_of="2024-01-31 00:00:00").orderBy("period").collect()
    assert [r.period for r in out] == [datetime(2024, 1, 1), datetime(2024, 1, 8)]
    assert [r.n_failures for r in out] == [1, 1]


def test_month_back_clamps(spark):
    df = spark.createDataFrame([(datetime(2024, 2, 28, 23),), (datetime(2024, 2, 29, 0),)], "ts timestamp")
    kept = df.where(L.recent("ts", as_of="2024-05-31 00:00:00", months=3)).collect()
    assert [r.ts for r in kept] == [datetime(2024, 2, 29, 0)]


def test_failure_counts_and_job_filter(spark):
    rows = [(datetime(2024, 1, 3), "ERROR", "a"), (datetime(2024, 1, 3), "CRITICAL", "a"),
            (datetime(2024, 1, 4), "ALERT", "a"), (datetime(2024, 1, 4), "EMERGENCY", "a"),
            (datetime(2024, 1, 4), "WARNING", "a"), (datetime(2024, 1, 4), "ERROR", "other")]
    r = L.failures(_logs(spark, rows), ["a"], as_of="2024-01-31 00:00:00").collect()
    assert len(r) == 1
    assert (r[0].n_failures, r[0].n_error, r[0].n_critical, r[0].n_alert_emergency) == (4, 1, 1, 2)
    assert r[0].first_failure == datetime(2024, 1, 3) and r[0].last_failure == datetime(2024, 1, 4)
