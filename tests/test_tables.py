"""Tables that are appended to again: layouts, replays, drifting shards, retention."""

import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contentflow.plans import bindings as B
from contentflow.session import ensure_checkpoint_dir
from contentflow.sources import io as IO
from contentflow.sources import tables as TB

from table_dirs import SF_SMALL


def _path(spark, tag):
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def _name(tag):
    return f"{tag}_{uuid.uuid4().hex[:12]}"


def test_append_reads_the_table_where_it_lies(spark):
    name, path = _name("t"), _path(spark, "bucketed")
    df = spark.range(1000).selectExpr("id as k", "id % 7 as v")
    TB.append_batch(df, name, path, ["k"], "one", buckets=4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    plan = TB.new_rows(df, name, ["k"], "two", 4)._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("SortMergeJoin"):].splitlines()
    scan = next(i for i, x in enumerate(join) if "FileScan" in x and name in x)
    # Between the join and the table's scan: no exchange.
    side = [x for x in join[:scan] if "Exchange" in x]
    assert len(side) == plan.count("Exchange") - plan[plan.index(join[scan]):].count("Exchange")
    assert "Bucketed: true" in join[scan] and all("REPARTITION_BY_NUM" in x or "ENSURE_REQUIREMENTS" in x for x in side)
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == old


def test_a_repeated_or_killed_batch_adds_and_loses_nothing(spark):
    name, path = _name("t"), _path(spark, "bucketed")
    one = spark.createDataFrame([(1, "a"), (1, "b"), (None, "n"), (2, "c")], "k long, v string")
    two = spark.createDataFrame([(2, "other"), (3, "d"), (None, "m")], "k long, v string")
    TB.append_batch(one, name, path, ["k"], "one", buckets=2)
    TB.append_batch(two, name, path, ["k"], "two", buckets=2)
    want = sorted(map(str, spark.table(name).collect()))
    assert spark.table(name).count() == 4 and spark.table(name).where("k = 3").count() == 1
    # Killed while it wrote: part of the batch's partition is missing.
    spark.sql(f"ALTER TABLE {name} DROP PARTITION (_batch = 'two')")
    spark.table(name).limit(0).drop("_batch").write.mode("overwrite").parquet(f"{path}/_batch=two")
    for batch, rows in (("two", two), ("one", one)):
        TB.append_batch(rows, name, path, ["k"], batch, buckets=2)
    assert sorted(map(str, spark.table(name).collect())) == want
    # A session that has not seen the table attaches it again.
    spark.sql(f"DROP TABLE {name}")
    TB.append_batch(two, name, path, ["k"], "two", buckets=2)
    assert sorted(map(str, spark.table(name).collect())) == want


def test_good_and_bad_rows_appear_together_and_once(spark):
    src, path, ckpt = _path(spark, "src"), _path(spark, "out"), _path(spark, "ckpt")
    kinds = {"rows": T._parse_datatype_string("k bigint, v string"), "bad": T._parse_datatype_string("raw string, v string, reason string")}
    k = F.col("raw").try_cast("long")
    rules, parse = {"no_number": k.isNotNull(), "no_text": F.length("v") > 0}, {"k": k, "v": F.col("v")}

    def run(checkpoint):
        stream = spark.readStream.schema("raw string, v string").option("maxFilesPerTrigger", 1).parquet(src)
        TB.append_checked(stream, path, rules, parse, checkpoint).awaitTermination()
        rows, bad = TB.read_checked(spark, path, kinds, ["k"])
        return sorted(map(tuple, rows.collect())), sorted(map(str, map(tuple, bad.collect())))

    spark.createDataFrame([("1", "a"), ("x", "b"), ("2", None), (None, "c")], "raw string, v string").coalesce(1).write.mode("append").parquet(src)
    first = run(ckpt)
    assert first == ([(1, "a")], sorted(map(str, [("x", "b", "no_number"), ("2", None, "no_text"), (None, "c", "no_number")])))
    spark.createDataFrame([("1", "later"), ("3", "d")], "raw string, v string").coalesce(1).write.mode("append").parquet(src)
    assert run(ckpt) == ([(1, "a"), (3, "d")], first[1])
    assert run(_path(spark, "ckpt")) == ([(1, "a"), (3, "d")], first[1])  # everything replayed
    # An epoch without its mark is not seen.
    spark.createDataFrame([(9, "half")], "k bigint, v string").withColumn("_epoch", F.lit(77)).write.mode("append").partitionBy("_epoch").parquet(f"{path}/rows")
    rows, _ = TB.read_checked(spark, path, kinds, ["k"])
    assert rows.where("k = 9").count() == 0


def test_one_per_key_is_always_the_same_row(spark):
    rows = [(i % 5, i, f"v{i}") for i in range(200)]
    want = None
    for parts in (1, 3, 7):
        got = sorted(map(tuple, IO.one_per_key(spark.createDataFrame(rows, "k long, a long, b string").repartition(parts, "a"), ["k"]).collect()))
        assert want is None or got == want
        want = got
    assert len(want) == 5


def test_drifting_shards_give_all_rows_and_columns(spark):
    path = _path(spark, "drift")
    spark.sql("SELECT 1 AS a").write.parquet(f"{path}/s1")
    spark.sql("SELECT 2 AS a, 'x' AS b").write.parquet(f"{path}/s2")
    merged = IO.read_sharded(spark, f"{path}/*/*.parquet")
    assert sorted(map(tuple, merged.collect())) == [(1, None, "s1"), (2, "x", "s2")]
    spark.sql("SELECT 3L AS a, named_struct('p', 1, 'q', array(1)) AS c, current_date() AS d").write.parquet(f"{path}/s3")
    spark.sql("SELECT 4.5D AS a, named_struct('q', array(2L), 'r', 'z') AS c, 'text' AS d").write.parquet(f"{path}/s4")
    got = IO.read_sharded(spark, f"{path}/*/*.parquet").orderBy("shard")
    assert [f.dataType.simpleString() for f in got.schema.fields] == ["double", "string", "struct<p:int,q:array<bigint>,r:string>", "string", "string"]
    rows = got.collect()
    assert [r["a"] for r in rows] == [1.0, 2.0, 3.0, 4.5] and rows[3]["c"] == (None, [2], "z") and rows[2]["c"] == (1, [1], None)
    assert IO.read_sharded(spark, f"{path}/*/*.parquet", between=("s1", "s2")).columns == ["a", "b", "shard"]
    assert IO.read_sharded(spark, f"{path}/none*/*.parquet").count() == 0


@pytest.mark.parametrize("pair,want", [(("int", "bigint"), "bigint"), (("float", "bigint"), "double"), (("smallint", "float"), "float"), (("int", "string"), "string"),
                                       (("decimal(5,2)", "decimal(4,3)"), "decimal(6,3)"), (("date", "timestamp"), "timestamp")])
def test_widened_types(spark, pair, want):
    a, b = (T._parse_datatype_string(x) for x in pair)
    assert IO.widened(a, b).simpleString() == IO.widened(b, a).simpleString() == want


def test_retention_touches_the_cut_off_day_only(spark):
    db, path = _name("db"), _path(spark, "db")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{path}'")
    df = spark.range(24 * 10).select((F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600)).alias("ts")).withColumn("ingest_date", F.to_date("ts"))
    TB.write_managed(df, f"{db}.log", "ingest_date")
    files = {r[0]: r[1] for r in spark.table(f"{db}.log").select("ingest_date", F.input_file_name()).distinct().collect()}
    gone = TB.retain_table(spark, f"{db}.log", _path(spark, "staged"), "ts", 4, as_of="2024-01-10 12:00:00")
    assert gone == [f"2024-01-0{d}" for d in range(1, 6)] == sorted(set(map(str, files)) - set(TB.partition_days(spark, f"{db}.log")))
    left = spark.table(f"{db}.log")
    assert left.count() == 12 + 4 * 24 and left.agg(F.min("ts")).first()[0].isoformat() == "2024-01-06T12:00:00"
    after = {r[0]: r[1] for r in left.select("ingest_date", F.input_file_name()).distinct().collect()}
    assert sorted(str(d) for d in after if after[d] != files[d]) == ["2024-01-06"]
    assert TB.retain_table(spark, f"{db}.log", _path(spark, "staged"), "ts", 4, as_of="2024-01-11") == ["2024-01-06"]


def test_partitions_are_pruned(spark):
    path = _path(spark, "days")
    TB.write_partitioned(B.audit_log(spark, SF_SMALL), path, "ingest_date")
    log = spark.read.parquet(path)
    recent = IO.recent_ingest(log, as_of=B.AS_OF, days=7)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters: ["):].split("]")[0]
    assert "ingest_date" in filters and ">=" in filters
    read = {r[0] for r in recent.select(F.regexp_extract(F.input_file_name(), "ingest_date=([0-9-]+)", 1)).distinct().collect()}
    days = {r[0] for r in log.select(F.col("ingest_date").cast("string")).distinct().collect()}
    assert 0 < len(read) < len(days) and min(read) >= "2024-01-2"
    busy = TB.in_days_of(log, recent.where("payload.method = 'AccessSecretVersion'"), "ingest_date")
    assert "dynamicpruning" in busy._jdf.queryExecution().executedPlan().toString()
    span = IO.shard_between(log.withColumnRenamed("ingest_date", "suffix"), "2024-01-03", "2024-01-05", "suffix")
    text = span._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in text
