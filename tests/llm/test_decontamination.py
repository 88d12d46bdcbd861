"""op5 against a comparison of every alignment."""

import random

import numpy as np

from contentflow.llm.decontamination import PUNCTUATION, any_run, contaminated_documents, without_contaminated
from contentflow.llm.queries import QUERIES
from corpus_pipeline import drop_contaminated

SF = "/root/testdata/sf0.01"


def norm(text):
    out = [w.lower().strip(PUNCTUATION) for w in (text or "").split()]
    return [w for w in out if w]


def best(equal):
    run, top = 0, (0, 0, 0)
    start = 0
    for i, e in enumerate(equal):
        if run <= 0:
            run, start = 0, i
        run += 1 if e else -2
        if run > top[0]:
            top = (run, start, i + 1)
    return sum(equal[top[1]:top[2]]), top[2] - top[1]


def brute(docs, items, min_equal=13, identity=0.8):
    """Every alignment on which three words in a row (or a whole short item) agree."""
    out = set()
    by = {}
    words = {i: norm(t) for i, t in items}
    for i, w in words.items():
        if len(w) >= 5:
            for k in range(len(w) - 2):
                by.setdefault(tuple(w[k:k + 3]), []).append((i, k))
    for d, text in docs:
        x = norm(text)
        tried = set()
        for p in range(len(x) - 2):
            for i, k in by.get(tuple(x[p:p + 3]), ()):
                if (i, p - k) in tried:
                    continue
                tried.add((i, p - k))
                w, s = words[i], p - k
                a, b = max(0, -s), min(len(w), len(x) - s)
                same, n = best([w[j] == x[j + s] for j in range(a, b)])
                if same >= min(min_equal, len(w)) and same >= identity * n and (len(w) >= 10 or same == n == len(w)):
                    out.add((d, i))
    return out


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = brute(docs, items)
    assert len(want) > 5
    assert {(r["doc_id"], r["item_id"]) for r in QUERIES["op5_decontamination"](spark, SF).collect()} == want


def test_planted(spark):
    rng = random.Random(4)
    pool = [f"w{i}" for i in range(3000)]
    say = lambda n: [rng.choice(pool) for _ in range(n)]
    items = [(i, " ".join(say(n))) for i, n in enumerate((4, 5, 8, 12, 14, 20, 60))] + [(90, None), (91, ""), (92, "?! -")]
    docs = [(-1, None), (-2, ""), (-3, "."), (None, " ".join(say(40)) + " " + items[5][1])]
    hit = set()
    for d in range(60):
        i = rng.randrange(1, 7)
        w = items[i][1].split()
        for k in range(len(w)):
            if len(w) >= 14 and rng.random() < 0.04:
                w[k] = "zz"
        docs.append((d, " ".join(say(rng.randrange(90)) + [x.upper() + "," for x in w] + say(9))))
        hit.add((d, i))
    docs.append((70, " ".join(items[6][1].split()[20:32])))  # 12 words only
    docs.append((71, items[0][1]))  # a common phrase
    docs += [(72, "other text"), (72, items[4][1])]
    df = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, row int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated_documents(df, bench).collect()}
    want = brute([(d, t) for d, t in docs if d is not None], items)
    assert got - {(None, 5)} == want and (None, 5) in got and len(want) > 50
    kept = without_contaminated(df, bench)
    assert kept.columns == df.columns
    bad = {d for d, _ in want}
    left = sorted(str(r["doc_id"]) + str(r["text"]) for r in kept.collect())
    assert left == sorted(str(d) + str(t) for d, t in docs if (d not in bad and d is not None) or t == "other text")


def test_any_run_against_all_runs():
    rng = np.random.default_rng(5)
    for _ in range(400):
        equal = rng.random(rng.integers(1, 40)) < rng.choice([0.5, 0.75, 0.9])
        runs = [(int(equal[i:j].sum()), i - j, -i) for i in range(len(equal)) for j in range(i + 1, len(equal) + 1)
                if equal[i:j].sum() >= 8 and equal[i:j].sum() >= 0.8 * (j - i) - 1e-9]
        want = max(runs, default=None)
        assert any_run(equal, 8, 0.8) == (want and (-want[2], -want[1], want[0]))


def test_changed_short_items_and_a_verbatim_part(spark, tmp_path):
    rng = random.Random(11)
    say = lambda n, c: [f"{c}{rng.randrange(10 ** 6)}" for _ in range(n)]
    items = {n: say(n, "i") for n in (10, 11, 12, 13, 14, 16, 19, 100)}
    docs, hit = [], set()

    def put(doc, n, changed, found=True):
        w = ["zz" if k in changed else x for k, x in enumerate(items[n])]
        docs.append((doc, " ".join([*say(20, "d"), *w, *say(20, "d")])))
        if found:
            hit.add((doc, n))

    put(1, 10, {3}), put(2, 11, {0}), put(3, 12, {11}), put(4, 13, {5}), put(5, 14, {3, 10})
    put(6, 16, {2, 13}), put(7, 19, {4, 9, 16}), put(8, 13, {0, 1, 12}, False), put(9, 10, {3, 7, 9}, False)
    put(10, 100, {k for k in range(15, 95) if k % 4 == 3} | set(range(95, 100)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    assert {(r["doc_id"], r["item_id"]) for r in QUERIES["op5_decontamination"](spark, str(tmp_path)).collect()} == hit
    assert [r["doc_id"] for r in drop_contaminated(spark, df, str(tmp_path)).orderBy("doc_id").collect()] == [8, 9]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    assert contaminated_documents(docs, some.withColumnRenamed("doc_id", "item_id")).collect() == []
    assert contaminated_documents(some, bench).collect() == [] and without_contaminated(some, bench).count() == 1
