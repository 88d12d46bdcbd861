"""Target-API entry points agree with the operators they wrap."""

import uuid

from pyspark.sql import functions as F

from contentflow.operators import frontier as FR
from contentflow.operators import logs as L
from contentflow.operators import timeseries as TS
from contentflow.plans import bindings as B
from contentflow.session import ensure_checkpoint_dir
from contentflow.sources import io as IO
from contentflow.streaming import jobs as S

from table_dirs import SF_SMALL


def _scratch(spark, tag):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_count_metric_is_the_error_counter(spark):
    logs = B.logs(spark, SF_SMALL)
    pred = (F.col("resource.type") == "cloud_run_job") & L.severity_at_least("severity", "ERROR")
    got = TS.count_metric(logs, pred, {"job_name": F.col("resource.labels.job_name"),
                                       "severity": F.col("severity")})
    assert _same(got, TS.job_error_counter(logs))


def test_reduce_and_success_rate_names(spark):
    ex = B.executions(spark, SF_SMALL)
    a = TS.align(ex.select("ts", "job_name", F.col("execution_time").alias("value")),
                 ["job_name"], "mean", "1 hour")
    assert _same(TS.reduce(a, [], "mean"), TS.reduce_series(a, [], "mean"))
    r = TS.success_rate(ex, "1 day")
    tot = r.agg(F.sum("succeeded").alias("s"), F.sum("total").alias("t")).first()
    assert tot.t == ex.count() and tot.s == ex.where("result = 'succeeded'").count()


def test_lazy_images_rows(spark):
    pages = B.image_pages(spark, SF_SMALL)
    got = FR.lazy_images(pages)
    n_lines = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").where("l_linenumber % 3 <> 0").count()
    assert got.count() == n_lines
    assert got.where(~F.col("src").contains("scans")).count() == 0


def test_write_manifest_header_and_batches(spark):
    path = _scratch(spark, "manifest-api")
    ch = B.chapters(spark, SF_SMALL).withColumn("scraped_at", F.lit("2024-01-31T00:00:00+00:00"))
    total = ch.agg(F.count_distinct("chapter_number"))
    IO.write_manifest(ch, path, {"scraped_at": "2024-01-31T00:00:00+00:00",
                                 "total_chapters_available": total})
    docs = spark.read.json(path)
    n = ch.count()
    assert docs.where(F.col("total_chapters_available") != n).count() == 0
    assert IO.read_manifest(spark, path).count() == n


def test_read_sharded_logs_prunes_by_shard_name(spark):
    path = _scratch(spark, "routed")
    L.write_routed_logs(B.logs(spark, SF_SMALL), path, B.TEST_JOBS)
    allrows = IO.read_sharded_logs(spark, f"{path}/log_date=*/*.parquet")
    week = IO.read_sharded_logs(spark, f"{path}/log_date=*/*.parquet",
                                ("log_date=2024-01-01", "log_date=2024-01-07"))
    assert "job_name" in week.columns and 0 < week.count() < allrows.count()
    assert week.where(~F.col("shard").between("log_date=2024-01-01", "log_date=2024-01-07")).count() == 0


def test_append_by_chapter_is_idempotent(spark):
    path = _scratch(spark, "dialogues-append")
    for _ in range(2):
        stream = S.file_stream(spark, SF_SMALL, "conversations").selectExpr(
            "conv_id AS chapter_number", "turn + 1 AS page_number", "text AS extracted_text")
        S.append_by_chapter(stream, path, _scratch(spark, "ck")).awaitTermination()
    assert spark.read.parquet(path).count() == spark.read.parquet(f"{SF_SMALL}/conversations.parquet").count()
