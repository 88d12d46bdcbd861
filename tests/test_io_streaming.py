import uuid

from contentflow.plans import bindings as B
from contentflow.operators import logs as L
from contentflow.schemas import SPEAKERS
from contentflow.session import ensure_checkpoint_dir
from contentflow.sources import io as IO
from contentflow.streaming import jobs as S

from table_dirs import SF_SMALL


def _scratch(spark, tag):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def test_optional_table_missing_is_empty(spark):
    df = IO.optional_table(spark, _scratch(spark, "missing"), SPEAKERS)
    assert df.count() == 0 and df.schema == SPEAKERS


def test_append_twice_adds_nothing(spark):
    path = _scratch(spark, "append")
    df = B.chapters(spark, SF_SMALL)
    IO.append(df, path, keys=["chapter_number"])
    IO.append(df, path, keys=["chapter_number"])
    assert spark.read.parquet(path).count() == df.count()


def test_manifest_round_trip(spark):
    from pyspark.sql import functions as F
    path = _scratch(spark, "manifest")
    ch = B.chapters(spark, SF_SMALL).withColumn("batch", F.floor(F.col("chapter_number") / 50)) \
        .withColumn("scraped_at", F.lit("2024-01-31T00:00:00+00:00"))
    IO.write_manifests(ch, path, batch="batch")
    back = IO.read_manifest(spark, path)
    assert back.count() == ch.count()
    assert back.where("chapter_number = '7'").first().image_count == \
        ch.where("chapter_number = 7").first().image_count


def test_stream_equals_batch(spark):
    logs = S.logs_stream(spark, SF_SMALL, B.logs_from_events)
    streamed = S.run_available(S.failures_stream(logs, B.TEST_JOBS, as_of=B.AS_OF), mode="complete")
    batch = L.failures(B.logs(spark, SF_SMALL), B.TEST_JOBS, as_of=B.AS_OF)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_stream_update_mode_over_many_batches(spark):
    """Four time-ordered event files, one per micro-batch: week windows are
    updated by several batches; the newest epoch per (period, job) must equal
    the batch roll-up."""
    src = _scratch(spark, "events-split")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    # One file per week range, written one after the other: the file stream
    # takes files in modification order, so no row arrives behind the watermark.
    bounds = ["2023-01-01", "2024-01-08", "2024-01-15", "2024-01-22", "2025-01-01"]
    for lo, hi in zip(bounds, bounds[1:]):
        ev.where((ev.ts >= lo) & (ev.ts < hi)).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    logs = B.logs_from_events(stream)
    out_path = _scratch(spark, "upd")
    streamed = S.run_available(S.failures_stream(logs, B.TEST_JOBS, as_of=B.AS_OF), mode="update",
                               keys=["period", "job_name"], path=out_path)
    assert spark.read.parquet(out_path).select("_epoch").distinct().count() > 1
    batch = L.failures(B.logs(spark, SF_SMALL), B.TEST_JOBS, as_of=B.AS_OF)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


def test_incremental_chapter_append(spark):
    path = _scratch(spark, "by-batch")
    for _ in range(2):
        stream = S.file_stream(spark, SF_SMALL, "documents").selectExpr("doc_id AS chapter_number", "n_chars")
        q = S.append_by_batch(stream, path, ["chapter_number"], _scratch(spark, "ck"))
        q.awaitTermination()
    assert spark.read.parquet(path).count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()


def test_create_if_absent_and_snapshot(spark):
    from contentflow.operators.analytics import snapshot
    from contentflow.schemas import DIALOGUES
    name = "dialogues_" + uuid.uuid4().hex[:8]
    path = _scratch(spark, "tbl")
    IO.create_if_absent(spark, name, DIALOGUES, path)
    IO.create_if_absent(spark, name, DIALOGUES, path)  # second call is a no-op
    t = spark.table(name)
    assert [f.name for f in t.schema.fields] == [f.name for f in DIALOGUES.fields] and t.count() == 0
    snap = snapshot(B.chapters(spark, SF_SMALL))
    assert snap.is_cached and snap.count() == snap.count()
    snap.unpersist()
    spark.sql(f"DROP TABLE {name}")
