"""Merkle manifest of a dataset, with proofs by octopus multiproof.

A leaf is the SHA-256 of a row's fields.  The leaves of a language, ascending by
doc_id, form a tree of runs of two; the subroots of the languages form the top tree.

1. *Build.* Leaves get their place per tree (``dense_index``: a hot language is many
   slices).  Blocks of ``2 ** height`` places are folded each in one task; the blocks'
   top nodes are the leaves of the next tier, until one node is left per tree.
2. *Multiproof.* The leaves asked for are grouped by ranges of places.  For each group
   ``missing_nodes`` walks up from all its places at once: a sibling that neither is
   asked for nor can be derived is missing.  The union of these coordinates is fetched
   from the nodes by one join for the whole group, not per leaf.
3. *Expand.* With leaves and fetched nodes the group derives its shared interior nodes
   up to the root, reads each leaf's own proof off them, and folds tampered leaves.

Defined cases: null fields enter as ``-``; leaves with equal doc_id are ordered by their
digest (repeated rows are leaves of their own), those without doc_id come first and are
not tampered with; a null language is a tree of its own and comes first; a lone leaf is
its tree's subroot, and the only subroot is the root; an empty table gives no row; texts
of any length are hashed where they are read; further columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentflow.llm.common import save
from contentflow.operators.analytics import dense_index

TOP = ""  # the top tree's key; the trees of languages have keys "-" and "=" + language


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(c: Column) -> Column:
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaves(docs: DataFrame) -> DataFrame:
    """``tree, place, doc_id, leaf, tampered`` (the leaf with n_chars + 1 where 7 divides
    the crc32 of the doc_id, else null)."""
    n = F.col("n_chars").cast("decimal(20,0)")
    def leaf(chars: Column) -> Column:
        return F.sha2(F.concat(field(F.col("doc_id")), field(F.col("source")), field(F.col("lang")), field(chars), field(F.col("text"))), 256)
    odd = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    rows = docs.select(F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("-")).alias("tree"), F.col("doc_id").cast("long").alias("doc_id"),
                       leaf(n).alias("leaf"), F.when(odd, leaf(n + 1)).alias("tampered"))
    return dense_index(save(rows, "merkle-leaves"), ["doc_id", "leaf"], "place", partition=["tree"]).select(
        "tree", F.col("place").cast("long").alias("place"), "doc_id", "leaf", "tampered")


# ---------------------------------------------------------------- build
NODE = "tree string, level int, place long, node string"


def _fold_blocks(height: int, base: int):
    """Nodes above one block of ``2 ** height`` places of level ``base``."""
    def run(key, table):
        table = table.sort_by("place")
        tree, block = key[0].as_py(), key[1].as_py()
        now = table.column("node").to_pylist()
        # Only the first block of a tree can be the whole tree, if it is not full.
        whole = block == 0 and len(now) < 1 << height
        out = []
        for level in range(1, height + 1):
            if whole and len(now) == 1:
                break
            now = [digest(*now[i:i + 2]) for i in range(0, len(now), 2)]
            first = block << (height - level)
            out += [(tree, base + level, first + i, x) for i, x in enumerate(now)]
        cols = zip(*out) if out else ([], [], [], [])
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.string())
        return pa.table([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=["tree", "level", "place", "node"])
    return run


def build(ground: DataFrame, height: int, tag: str) -> DataFrame:
    """All nodes ``tree, level, place, node`` over ``ground(tree, place, node)``.

    Each tier groups 2 ** ``height`` nodes at most; the number of tiers is the logarithm
    of the largest tree to that base."""
    nodes = save(ground.select("tree", F.lit(0).alias("level"), "place", "node"), f"{tag}-0")
    base, tier = 0, nodes
    while True:
        block = F.shiftright("place", height).alias("block")
        fresh = save(tier.select("tree", block, "place", "node").groupBy("tree", "block").applyInArrow(_fold_blocks(height, base), NODE),
                     f"{tag}-{base + height}")
        nodes = nodes.unionByName(fresh)
        base += height
        tier = fresh.where(F.col("level") == base)
        if tier.where("place > 0").limit(1).count() == 0:
            return nodes


def tops(nodes: DataFrame) -> DataFrame:
    """``tree, size, top, subroot``: leaves, highest level and root of every tree."""
    return nodes.groupBy("tree").agg(F.count_if(F.col("level") == 0).alias("size"), F.max("level").alias("top"),
                                     F.max_by("node", "level").alias("subroot"))


def manifest(ground: DataFrame, height: int) -> tuple[DataFrame, DataFrame]:
    """Nodes of all trees and of the top tree (key ``TOP``), and a row per tree:
    ``tree, size, top, subroot, rank, trees, summit`` (rank: its place in the top tree,
    which has ``trees`` leaves and its root at level ``summit``)."""
    below = build(ground, height, "merkle-nodes")
    trees = save(dense_index(tops(below), ["tree"], "rank").withColumn("rank", F.col("rank").cast("long")), "merkle-trees")
    above = build(trees.select(F.lit(TOP).alias("tree"), F.col("rank").alias("place"), F.col("subroot").alias("node")), height, "merkle-top")
    top = tops(above)
    trees = trees.withColumns({"trees": top.select("size").scalar(), "summit": top.select("top").scalar()})
    return below.unionByName(above), save(trees, "merkle-roots")


# ---------------------------------------------------------------- multiproof
def missing_nodes(places: np.ndarray, size: int) -> list[tuple[int, int]]:
    """Coordinates ``(level, place)`` that the proofs of all ``places`` need together and
    that cannot be derived from those leaves, in a tree of ``size`` leaves."""
    out, level, known = [], 0, np.unique(places)
    while size > 1:
        mate = known ^ 1
        mate = mate[mate < size]  # the last run can hold one node
        need = mate[~np.isin(mate, known, assume_unique=True)]
        out += [(level, int(p)) for p in need]
        known, size, level = np.unique(known >> 1), (size + 1) >> 1, level + 1
    return out


def derive(places: np.ndarray, nodes: list[str], size: int, fetched: dict[tuple[int, int], str]) -> list[dict[int, str]]:
    """Per level, the nodes known from the leaves at ``places`` and what was fetched."""
    now = dict(zip(places.tolist(), nodes))
    levels = []
    level = 0
    while True:
        whole = dict(now)
        for p in now:
            if p ^ 1 < size and p ^ 1 not in now:
                whole[p ^ 1] = fetched[level, p ^ 1]
        levels.append(whole)
        if size == 1:
            return levels
        now = {p: digest(*(whole[x] for x in (2 * p, 2 * p + 1) if x < size)) for p in {q >> 1 for q in now}}
        size, level = (size + 1) >> 1, level + 1


def proof(place: int, size: int, levels: list[dict[int, str]]) -> list[tuple[str, bool] | None]:
    """Per level, the sibling and whether it stands left; None in a run of one."""
    out, level = [], 0
    while size > 1:
        mate = place ^ 1
        out.append((levels[level][mate], mate < place) if mate < size else None)
        place, size, level = place >> 1, (size + 1) >> 1, level + 1
    return out


def fold(node: str, siblings: list[tuple[str, bool] | None]) -> str:
    for s in siblings:
        node = digest(node) if s is None else digest(s[0], node) if s[1] else digest(node, s[0])
    return node


REQUEST = "tree string, part long, of string, level int, place long"
KEPT = ["size", "rank", "trees", "subroot"]


def _requests(batches):
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            me = r["tree"], r["part"]
            out += [(*me, r["tree"], level, p) for level, p in missing_nodes(np.array(r["places"], np.int64), r["size"])]
            out += [(*me, TOP, level, p) for level, p in missing_nodes(np.array([r["rank"]], np.int64), r["trees"])]
            out.append((*me, TOP, r["summit"], 0))
        if out:
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["tree", "part", "of", "level", "place"])


PROVEN = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _expand(key, rows, facts):
    tree = key[0].as_py()
    fact = facts.slice(0, 1).to_pylist()[0]
    got = {(f["of"], f["level"], f["at"]): f["node"] for f in fact["fetched"]}
    size, rank, trees = fact["size"], fact["rank"], fact["trees"]
    root = got[TOP, fact["summit"], 0]
    place = rows.column("place").to_numpy()
    leaf, told = rows.column("leaf").to_pylist(), rows.column("tampered").to_pylist()
    levels = derive(place, leaf, size, {k[1:]: v for k, v in got.items() if k[0] == tree})
    subroot = levels[-1][0]
    above = derive(np.array([rank]), [subroot], trees, {k[1:]: v for k, v in got.items() if k[0] == TOP})
    upper = proof(rank, trees, above)
    shas, folded = [], []
    for p, t in zip(place.tolist(), told):
        mine = proof(p, size, levels) + upper
        shas.append(digest(*(s[0] for s in mine if s is not None)))
        # An untampered leaf folds to what its group derived from leaves and fetched nodes.
        folded.append(above[-1][0] if t is None else fold(t, mine))
    n = rows.num_rows
    return pa.table([rows.column("doc_id"), rows.column("leaf"), pa.array([fact["subroot"]] * n, pa.string()), pa.array([root] * n, pa.string()),
                     pa.array(shas, pa.string()), pa.array(folded, pa.string()), pa.array([f == root for f in folded], pa.bool_())],
                    names=[c.split()[0] for c in PROVEN.split(", ")])


def prove(asked: DataFrame, nodes: DataFrame, trees: DataFrame, per_group: int = 1 << 12) -> DataFrame:
    """A row per leaf of ``asked(tree, place, doc_id, leaf, tampered)``.

    A group holds the asked-for leaves of ``per_group`` consecutive places at most."""
    asked = asked.withColumn("part", F.floor(F.col("place") / per_group))
    groups = asked.groupBy("tree", "part").agg(F.collect_list("place").alias("places")).join(
        trees.select("tree", "size", "rank", "trees", "summit"), "tree")
    wanted = groups.select("tree", "part", "places", "size", "rank", "trees", "summit").mapInArrow(_requests, REQUEST)
    fetched = wanted.join(nodes.select(F.col("tree").alias("of"), "level", "place", "node"), ["of", "level", "place"]).groupBy("tree", "part").agg(
        F.collect_list(F.struct("of", "level", F.col("place").alias("at"), "node")).alias("fetched"))
    facts = fetched.join(trees.select("tree", *KEPT, "summit"), "tree")
    return asked.groupBy("tree", "part").cogroup(facts.groupBy("tree", "part")).applyInArrow(_expand, PROVEN)


def verified_manifest(docs: DataFrame, height: int = 12, per_group: int = 1 << 12) -> DataFrame:
    """Leaf, subroot, root and proof of every row, and whether the row as it now stands
    (tampered with or not) folds to the root."""
    ground = save(leaves(docs), "merkle-ground")
    nodes, trees = manifest(ground.select("tree", "place", F.col("leaf").alias("node")), height)
    return prove(ground, nodes, trees, per_group)
