"""op11 against a trie built turn by turn, on the driver's table and on planted cases."""

import hashlib
import random
import zlib
from collections import defaultdict

from contentflow.llm import prefix_trie as PT
from contentflow.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in turns.items()}
    nodes = defaultdict(list)
    ends = defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        path = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(path) + 1):
            nodes[path[:d]].append(c)
        ends[path].append(c)
    kids = defaultdict(int)
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in nodes.items():
        v = (len(m) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += v
    return {(m[0], len(p)): (nodes[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p],
                             hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in nodes.items()}


def got(df):
    rows = df.collect()
    out = {(r["conv_id"], r["depth"]): (r["parent_conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"], r["ends_sha256"])
           for r in rows}
    assert len(out) == len(rows)
    return out


def test_whole_table(spark):
    d = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(QUERIES["op11_prefix_trie"](spark, d)) == brute(rows)


def planted():
    rnd = random.Random(4)
    rows = []
    for c in range(0, 340):
        if c in (100, 203):
            continue
        shape = rnd.random()
        if shape < 0.3:  # few words: many shared beginnings
            texts = [rnd.choice("ab") * rnd.randint(0, 2) for _ in range(rnd.randint(1, 9))]
        elif shape < 0.5:  # copies of one long conversation, cut at several places
            texts = [f"same {i}" for i in range(rnd.choice((8, 11, 12, 16, 23)))]
        elif shape < 0.6:
            texts = ["x"]
        else:
            texts = [f"same {i}" for i in range(rnd.randint(0, 9))] + [f"own {c % 7} {i}" for i in range(rnd.randint(1, 14))]
        rows += [(c, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]
    rows += [(7, None, "user", "early"), (7, 3, "user", "tie b"), (7, 3, "user", "tie a"), (7, 3, "user", "tie a")]
    rows += [(8, 1, None, None), (9, 0, None, "n"), (9, 0, "", "n"), (None, 1, "user", "nobody"), (-7, 0, "user", "minus"), (-7, 1, "user", "é\U0001F600" * 400),
             (-107, 0, "user", "minus"), (-100, 0, "user", "minus"), (500, 0, "user", "x"), (501, 0, "user", "x" * 70000)]
    rnd.shuffle(rows)
    return rows


def test_planted_in_small_layers_and_containers(spark):
    rows = planted()
    df = spark.createDataFrame(rows, SCHEMA)
    exp = brute(rows)
    assert got(PT.prefix_trie(df, layer=4, container=30)) == exp
    assert got(PT.prefix_trie(df)) == exp


def test_one_conversation_holds_a_third(spark):
    """Its turns are numbered in several slices and its layers are rows of their own."""
    rows = [(0, i, "user", f"t{i % 50}") for i in range(600)] + [(c, i, "user", f"t{i}") for c in range(1, 240) for i in range(5)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(PT.prefix_trie(df, layer=16, container=200)) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert PT.prefix_trie(df).collect() == []
    rows = planted()[:60]
    more = spark.createDataFrame([r + (1, 2, "k", "p", 5, 6, 7, 8) for r in rows],
                                 SCHEMA + ", n int, at int, key string, path string, conv int, _s int, _tie int, place int")
    assert got(PT.prefix_trie(more)) == brute(rows)
