"""Range slices over a composite order (WIN-01, running totals)."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from contentflow.operators import analytics as A


def test_one_key_and_one_order_value_are_spread(spark):
    """A key, and an order value in it, that hold all rows are still many slices."""
    df = spark.range(4000).selectExpr("'k' as k", "7 as n", "id as v").repartition(6)
    cut, _ = A._sliced(df, ["k"], ["n"], 8)
    sizes = [r["count"] for r in cut.groupBy("_s").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1500
    idx = A.dense_index(df, ["n"], partition=["k"], slices=8)
    assert sorted(r["_i"] for r in idx.collect()) == list(range(4000))


def test_planning_starts_no_job(spark):
    df = spark.range(100).selectExpr("id as n", "id as v")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    A.centered_mean(df, ["n"], "v", 5, block=16)
    A.running_sum(df, ["n"], "v")
    assert not tracker.getJobIdsForGroup("planning")


def test_nulls_ties_and_repeats_match_plain_windows(spark):
    rows = [(None if i % 11 == 0 else "a" if i % 3 else "b", None if i % 7 == 0 else i % 5, i % 13) for i in range(600)]
    df = spark.createDataFrame(rows, "k string, n int, v int")
    total = A.running_sum(df, ["n", "v"], "v", "cum", partition=["k"], slices=16)
    # Repeated rows share their last total.
    got = total.groupBy("k", "n", "v").agg(F.max("cum").alias("cum"))
    w = Window.partitionBy("k").orderBy("n", "v")
    exp = df.withColumn("cum", F.sum("v").over(w)).groupBy("k", "n", "v").agg(F.max("cum").alias("cum"))
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    idx = A.dense_index(df, ["n"], partition=["k"], slices=16)
    places = idx.groupBy("k").agg(F.sort_array(F.collect_list("_i")).alias("p")).collect()
    assert all(list(r["p"]) == list(range(len(r["p"]))) for r in places)
    assert A.dense_index(df.limit(0), ["n"]).count() == 0
