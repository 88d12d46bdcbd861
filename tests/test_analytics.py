import random

import pandas as pd
from pyspark.sql import functions as F

from contentflow.operators import analytics as A
from contentflow.schemas import arcs_frame


def test_rolling_matches_pandas_edges(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(100)], "n long, x double")
    got = {r.n: r.rolling_mean for r in A.centered_mean(df, ["n"], "x", 50, block=64).collect()}
    exp = pd.Series([float(i) for i in range(100)]).rolling(50, center=True).mean()
    for i in range(100):
        e = exp[i]
        assert (got[i] is None) if pd.isna(e) else abs(got[i] - e) < 1e-9
    assert got[25] == 24.5 and got[24] is None and got[75] is not None and got[76] is None


def test_rolling_null_inside_frame(spark):
    rows = [(i, None if i == 40 else float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "n long, x double")
    got = {r.n: r.rolling_mean for r in A.centered_mean(df, ["n"], "x", 50, block=50).collect()}
    assert got[30] is None and got[64] is None and got[66] is not None


def test_rolling_halo_equals_plain_window_random(spark):
    rnd = random.Random(7)
    for n, block, size in [(5, 7, 300), (50, 64, 1000), (4, 4, 97)]:
        rows = [(i, rnd.choice([None, float(rnd.randint(0, 50))]) if rnd.random() < 0.05
                 else float(rnd.randint(0, 50))) for i in range(size)]
        df = spark.createDataFrame(rows, "n long, x double").repartition(5)
        halo = A.centered_mean(df, ["n"], "x", n, block=block)
        plain = A.centered_mean(df, ["n"], "x", n, plain=True)
        assert halo.exceptAll(plain).count() == 0 and plain.exceptAll(halo).count() == 0


def test_rolling_halo_per_key_with_hot_key(spark):
    rnd = random.Random(11)
    # Key "hot" holds most rows; keys must not leak into each other's frames.
    rows = [("hot" if rnd.random() < 0.7 else rnd.choice(["a", "b", None]), i, float(rnd.randint(0, 9)))
            for i in range(600)]
    df = spark.createDataFrame(rows, "k string, n long, x double").repartition(3)
    halo = A.centered_mean(df, ["n"], "x", 10, partition=["k"], block=16)
    plain = A.centered_mean(df, ["n"], "x", 10, partition=["k"], plain=True)
    assert halo.exceptAll(plain).count() == 0 and plain.exceptAll(halo).count() == 0


def test_bucket_half_even_and_ties(spark):
    rows = [(1, 17), (2, 17.5), (100, 17.25), (150, 17.25), (250, 17.35), (260, 17.35),
            (320, 17.4)]
    df = spark.createDataFrame([(a, float(b)) for a, b in rows], "chapter_number long, image_count double")
    out = {r.bucket: (r.mean, r.is_max, r.label) for r in A.bucket_mean(df).collect()}
    assert out[100] == (17.2, False, "100–199")
    assert out[200][0] == 17.4 and out[200][1] and out[300][1]
    assert out[0][0] == 17.2


def test_interval_counts(spark):
    df = spark.createDataFrame([(100,), (101,), (1173,), (100,)], "chapter_number long")
    dim = arcs_frame(spark, extra=[("Beyond", 5000, 6000, "None")])
    got = {r.name: r.n_chapters for r in A.interval_counts(df, dim).collect()}
    assert got["East Blue"] == 2 and got["Arabasta"] == 1 and got["Beyond"] == 0 and got["Egghead"] == 0
    d = {r.name: r.n_chapters for r in A.interval_counts(df, dim, distinct=True).collect()}
    assert d["East Blue"] == 1


def test_mention_split(spark):
    df = spark.createDataFrame([(True, True), (False, True), (None, True), (False, False)],
                               "luffy_says_it boolean, about_luffy boolean")
    got = {r.category: r.n for r in A.mention_split(df).collect()}
    assert got == {"says": 1, "about_only": 1, "other": 2}
    k = A.mention_kpis(df).first()
    assert (k.total, k.n_says, k.n_about) == (4, 1, 3)


def test_top_k_ties_prefer_lower_key(spark):
    rows = [(i, 10) for i in range(1, 13)] + [(20, 50)]
    df = spark.createDataFrame(rows, "chapter_number long, image_count long")
    top = A.top_k(df, k=10).orderBy("position").collect()
    assert [r.chapter_number for r in top][-1] == 20
    assert sorted(r.chapter_number for r in top)[:9] == list(range(1, 10))
    assert top[0].weight == 0.5 and top[-1].label == "Chapitre 20"


def test_distinct_examples_keep_first(spark):
    df = spark.createDataFrame([(2, 1, "b", True), (1, 2, "a", True), (1, 1, "a", True), (1, 3, "c", False)],
                               "chapter_number long, page_number long, phrase string, luffy_says_it boolean")
    assert [(r.chapter_number, r.phrase) for r in A.distinct_examples(df).collect()] == [(1, "a"), (2, "b")]


def test_running_sum_matches_window_with_hot_key(spark):
    from pyspark.sql import Window
    rnd = random.Random(3)
    rows = [("hot" if rnd.random() < 0.8 else rnd.choice(["a", "b"]), i, rnd.randint(0, 9)) for i in range(800)]
    df = spark.createDataFrame(rows, "k string, n long, v long").repartition(4)
    got = A.running_sum(df, ["n"], "v", "cum", partition=["k"])
    w = Window.partitionBy("k").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.withColumn("cum", F.sum("v").over(w))
    assert got.exceptAll(exp).count() == 0 and exp.exceptAll(got).count() == 0
    glob = A.running_sum(df, ["n"], "v", "cum")
    assert glob.agg(F.max("cum")).first()[0] == sum(r[2] for r in rows)


def _chapters_pandas():
    from table_dirs import SF_ORACLE
    d = pd.read_parquet(f"{SF_ORACLE}/documents.parquet", columns=["doc_id", "n_chars"])
    return d.rename(columns={"doc_id": "chapter_number", "n_chars": "image_count"}) \
        .sort_values("chapter_number").reset_index(drop=True)


def test_table_rolling_bucket_top10_match_pandas(spark):
    """WIN-01, AGG-06, SRT-04 over the whole sf0.01 chapters table against the
    pandas expressions the dashboard uses (pandas is the reference's engine)."""
    from table_dirs import SF_ORACLE
    from contentflow.plans import bindings as B
    pdf = _chapters_pandas()
    ch = B.chapters(spark, SF_ORACLE)

    exp_roll = pdf.image_count.rolling(50, center=True).mean()
    got_roll = {r.chapter_number: r.rolling_mean for r in
                A.centered_mean(ch.select("chapter_number", "image_count"), ["chapter_number"],
                                "image_count", 50, block=128).collect()}
    for n, e in zip(pdf.chapter_number, exp_roll):
        g = got_roll[n]
        assert (g is None and pd.isna(e)) or abs(g - e) < 1e-9, (n, g, e)

    b = pdf.assign(bucket=(pdf.chapter_number // 100) * 100)
    exp_b = b.groupby("bucket").image_count.mean().round(1)
    got_b = {r.bucket: (r.mean, r.is_max) for r in A.bucket_mean(ch).collect()}
    assert set(got_b) == set(exp_b.index)
    for k, v in exp_b.items():
        assert got_b[k][0] == v and got_b[k][1] == (v == exp_b.max()), (k, got_b[k], v)

    exp_top = pdf.nlargest(10, "image_count").sort_values("image_count")
    got_top = A.top_k(ch, "image_count", "chapter_number", 10).orderBy("position").collect()
    assert [r.image_count for r in got_top] == list(exp_top.image_count)
    assert {r.chapter_number for r in got_top} == set(exp_top.chapter_number)
