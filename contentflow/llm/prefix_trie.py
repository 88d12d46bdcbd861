"""Conversation prefix trie: burst tries over shards.

Every conversation is a string of turn ids (128 bits of role and text); the trie of
these strings has a node for every distinct prefix.

1. Turns are numbered per conversation (``dense_index``: a hot conversation is many
   slices), conversations are rebuilt, and each is cut into *suffixes* of at most
   ``layer`` turns.  A suffix's head is the place in the trie it hangs from: the sum of
   position-tagged hashes of the suffixes before it.  So all layers of a long
   conversation are worked on at once, and copies of a suffix collapse to one row.
2. The suffixes below one head are a container.  A container of more than ``container``
   turns is burst by its next turn id: its place becomes a trie head, its suffixes go,
   one turn shorter, to the containers of their next turn.  Rounds end when no container
   is too large, after ``layer`` rounds at most.
3. The remaining containers are dealt out by key, sorted, and swept: a suffix's common
   prefix with the one before it tells which nodes are new (numpy over whole containers,
   a bounded number of turns at a time).
4. What hangs below a layer's end is added to the nodes above it: a node's smallest
   conversation owns it, the owned nodes of a conversation are one stretch of its turns,
   so sums below a layer are sums over conversations of what they own further down
   (running sums per conversation, no walk up the trie).

Defined cases: turns are ordered by turn (null first), then role and text (of texts over 256
bytes the first 64 characters, then their md5); null role or text is empty; repeated turns count as often as they stand; rows without conv_id are no
conversation and are left out; ``c % 100`` takes the sign of c; conversations without
turns after rebuilding are members of the root; an empty table has no node; columns other
than conv_id, turn, role and text are not read; texts of any length enter by their hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contentflow.llm.common import save
from contentflow.operators.analytics import dense_index, running_sum

ID = 16  # bytes of a turn id
NO_MEMBERS = hashlib.sha256(b"").hexdigest()


def turn_id(role: Column, text: Column) -> Column:
    return F.unhex(F.md5(F.concat_ws(":", F.octet_length(role).cast("string"), role, text)))


# ---------------------------------------------------------------- rebuilt conversations
def numbered_turns(turns: DataFrame) -> DataFrame:
    """``conv, place (from 1), id, chars``: whole texts are read, ids go on."""
    clean = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("at"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))
    # Texts take part in the order of turns with one number only; a hash stands for long ones.
    slim = clean.select("conv", "at", "role", F.when(F.octet_length("text") <= 256, F.col("text")).otherwise(
        F.concat(F.substring("text", 1, 64), F.md5("text"))).alias("like"),
        turn_id(F.col("role"), F.col("text")).alias("id"), F.char_length("text").alias("chars"))
    placed = dense_index(slim, ["at", "role", "like"], "place", partition=["conv"])
    return placed.select("conv", (F.col("place") + 1).cast("long").alias("place"), "id", "chars")


def rebuilt(numbered: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are those of their group's first conversation.

    ``h`` = crc32 of the decimal conv_id mod ``most``: the first ``h`` turns come from
    conversation ``conv - conv % group`` (fewer if it has fewer), then the own ones after
    the first ``h``.  Returns ``(conv, depth, id, chars)`` and ``(conv, n)``, n = turns.
    """
    head = numbered.where((F.col("place") < most) & (F.col("conv") % group == 0)).groupBy(F.col("conv").alias("base")).agg(
        F.sort_array(F.collect_list(F.struct("place", "id", "chars"))).alias("first"))
    convs = numbered.groupBy("conv").agg(F.count(F.lit(1)).alias("own")).withColumns({
        "base": F.col("conv") - F.col("conv") % group, "h": F.crc32(F.col("conv").cast("string")) % most})
    info = convs.join(head, "base", "left").select(
        "conv", "h", "own", F.slice(F.coalesce("first", F.array().cast(head.schema["first"].dataType)), F.lit(1), F.col("h").cast("int")).alias("first"))
    info = info.withColumn("lent", F.size("first"))
    lent = info.select("conv", F.explode("first").alias("t")).select(
        "conv", F.col("t.place").alias("depth"), "t.id", "t.chars")
    shift = info.select("conv", "h", "lent")
    own = numbered.join(shift, "conv").where("place > h").select(
        "conv", (F.col("place") - F.col("h") + F.col("lent")).alias("depth"), "id", "chars")
    length = info.select("conv", (F.col("lent") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n"))
    return lent.unionByName(own), length


def suffixes(turns: DataFrame, length: DataFrame, layer: int) -> DataFrame:
    """``conv, k, head, ids, chars, n, last``: turns ``k * layer + 1 ..`` of a conversation.

    Each conversation has layers 0 to n div ``layer``, so that one that ends at a layer's
    end stands below that end, too, with an empty suffix.  ``last``: characters of the
    turn before the suffix.
    """
    cut = turns.groupBy("conv", F.floor((F.col("depth") - 1) / layer).alias("k")).agg(
        F.sort_array(F.collect_list(F.struct("depth", "id", "chars"))).alias("t"))
    full = cut.select("conv", "k", F.col("t.id").alias("id"), F.col("t.chars").alias("chars"))
    none = length.where(F.col("n") % layer == 0).select("conv", F.floor(F.col("n") / layer).alias("k"), F.array().cast("array<binary>").alias("id"),
                                                        F.array().cast("array<int>").alias("chars"))
    every = full.unionByName(none).select("conv", "k", F.array_join(F.transform("id", F.hex), "").alias("hex"), "chars").select(
        "conv", "k", F.unhex("hex").alias("ids"), "chars", F.size("chars").alias("n"))
    # Position-tagged 96-bit hashes: their sum over a conversation's layers names the prefix.
    tagged = every.withColumn("tag", _wide(F.md5(F.concat(F.concat(F.col("k").cast("string"), F.lit(":")).cast("binary"), F.col("ids")))))
    deep = length.where(F.col("n") >= layer).select("conv")
    long_ = tagged.join(deep, "conv", "left_semi")
    summed = running_sum(long_, ["k"], "tag", "upto", partition=["conv"])
    below = summed.select("conv", "k", "ids", "chars", "n", (F.col("upto") - F.col("tag")).cast("decimal(38,0)").alias("head"),
                          F.when(F.col("n") > 0, F.element_at("chars", -1)).alias("end"))
    ends = below.where(F.col("n") == layer).select("conv", (F.col("k") + 1).alias("k"), F.col("end").alias("last"))
    below = below.drop("end").join(ends, ["conv", "k"], "left")
    short = tagged.join(deep, "conv", "left_anti").select("conv", "k", "ids", "chars", "n", F.lit(0).cast("decimal(38,0)").alias("head"),
                                                          F.lit(None).cast("int").alias("last"))
    return short.unionByName(below).withColumn("last", F.coalesce("last", F.lit(0)))


def _wide(digest: Column) -> Column:
    """24 hex digits of a digest as a whole number (two parts: ``conv`` takes 64 bits)."""
    hi = F.conv(F.substring(digest, 1, 12), 16, 10).cast("decimal(15,0)")
    lo = F.conv(F.substring(digest, 13, 12), 16, 10).cast("decimal(15,0)")
    return (hi * F.lit(1 << 48).cast("decimal(15,0)") + lo).cast("decimal(30,0)")


# ---------------------------------------------------------------- containers
def _step(key: Column, at: Column) -> Column:
    """Key of the container below ``key`` that the turn id after ``at`` leads to."""
    return F.unhex(F.md5(F.concat(key, F.substring("ids", at * ID + 1, ID))))


def burst(rows: DataFrame, container: int, tag: str) -> tuple[DataFrame, DataFrame]:
    """Containers of at most ``container`` turns, and what passes the heads above them.

    ``rows(k, head, ids, n, conv, cnt, ...)``.  Returns the rows with ``key`` (container),
    ``at`` (turns above the container) and ``path`` (keys of the heads above it), and the
    rows that pass each head: ``key, at, path, nxt`` (key below; null where the suffix
    ends at the head) with the row's columns.
    """
    open_ = rows.withColumns({"key": F.unhex(F.md5(F.concat_ws(":", F.col("k").cast("string"), F.col("head").cast("string")))),
                              "at": F.lit(0), "path": F.array().cast("array<binary>")})
    calm, heads = [], []
    while True:
        large = save(open_.groupBy("key").agg(F.sum(F.col("n") - F.col("at") + 1).alias("turns"), F.count(F.lit(1)).alias("c"))
                     .where((F.col("turns") > container) & (F.col("c") > 1)).select("key", F.lit(True).alias("big")), f"{tag}-large")
        if large.limit(1).count() == 0:
            calm.append(open_)
            break
        marked = save(open_.join(large, "key", "left"), f"{tag}-burst")
        calm.append(marked.where("big IS NULL").drop("big"))
        through = marked.where("big").drop("big")
        through = through.withColumn("nxt", F.when(F.col("n") > F.col("at"), _step(F.col("key"), F.col("at"))))
        heads.append(through)
        open_ = through.where("nxt IS NOT NULL").withColumns({
            "path": F.concat("path", F.array("key")), "at": F.col("at") + 1, "key": F.col("nxt")}).drop("nxt")
    out = calm[0]
    for more in calm[1:]:
        out = out.unionByName(more)
    above = heads[0] if heads else calm[0].limit(0).withColumn("nxt", F.col("key"))
    for more in heads[1:]:
        above = above.unionByName(more)
    return out, above


NODE = ("key binary, path array<binary>, k long, at int, level int, conv long, parent long, n_convs long, n_children long, "
        "chars long, leaves long, saved long, ending binary, owners array<long>")


def sweep(layer: int, batch_turns: int):
    """``mapInArrow`` over rows sorted by (key, ids): the nodes of whole containers."""
    kinds = {"binary": pa.binary(), "array<binary>": pa.list_(pa.binary()), "array<long>": pa.list_(pa.int64()), "long": pa.int64(),
             "int": pa.int32()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in NODE.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, turns = [], 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(batch)
            turns += size(batch)
            if turns >= batch_turns:
                table = pa.Table.from_batches(held).combine_chunks()
                key = table.column("key").combine_chunks()
                same = _equal_to_last(key)
                whole = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
                if whole:
                    yield from nodes(table.slice(0, whole)).to_batches()
                rest = table.slice(whole)
                held = rest.to_batches()
                turns = size(rest)
        if held:
            yield from nodes(pa.Table.from_batches(held).combine_chunks()).to_batches()

    def size(t) -> int:
        return t.num_rows + (pc.sum(t.column("n")).as_py() or 0)

    def nodes(t: pa.Table) -> pa.Table:
        m = t.num_rows
        key = t.column("key").combine_chunks()
        raw = np.frombuffer(b"".join(key.to_pylist()), np.uint64).reshape(m, 2)
        fresh = np.ones(m, bool)
        fresh[1:] = (raw[1:] != raw[:-1]).any(1)
        at = t.column("at").to_numpy().astype(np.int64)
        n = t.column("n").to_numpy().astype(np.int64) - at
        cnt, conv = t.column("cnt").to_numpy(), t.column("conv").to_numpy()
        last = t.column("last").to_numpy().astype(np.int64)
        # Turn ids below the container, row after row; start[i] is row i's first.
        start = np.concatenate(([0], np.cumsum(n)))
        ids = np.frombuffer(b"".join(x[a * ID:] for x, a in zip(t.column("ids").to_pylist(), at)), np.uint64).reshape(-1, 2)
        lists = t.column("chars").combine_chunks()
        chars = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), np.int64)
        off = np.concatenate(([0], np.cumsum(n + at)))
        # Common prefix with the row before, in the same container.
        lcp = np.full(m, -1)
        both = np.where(fresh, 0, np.minimum(n, np.concatenate(([0], n[:-1]))))
        lcp[~fresh] = 0
        go = np.flatnonzero(both > 0)
        depth = 0
        while len(go):
            go = go[(ids[start[go] + depth] == ids[start[go - 1] + depth]).all(1)]
            depth += 1
            lcp[go] = depth
            go = go[both[go] > depth]
        # Level by level downwards: members, owner, parent, children.
        levels = []
        rows = np.arange(m)
        owner = []  # per level, the owner of the node that each row passes
        above = np.zeros(m, np.int64)  # the node of the level above, of every row
        level = 0
        while len(rows):
            new = lcp[rows] < level
            first = np.flatnonzero(new)
            mine = np.cumsum(new) - 1
            lead = rows[first]
            own = np.minimum.reduceat(conv[rows], first)
            level_chars = last[lead] if level == 0 else chars[off[lead] + at[lead] + level - 1]
            if level == 0:
                inner = at[lead] > 0
                level_chars = np.where(inner, chars[np.where(inner, off[lead] + at[lead] - 1, 0)] if len(chars) else 0, level_chars)
            ends = np.full(len(first), -1)
            stop = n[rows] == level
            ends[mine[stop]] = rows[stop]
            levels.append({"lead": lead, "own": own, "up": above[lead], "members": np.add.reduceat(cnt[rows], first),
                           "chars": level_chars, "ends": ends, "children": np.zeros(len(first), np.int64)})
            above[rows] = mine
            owner.append(own[np.minimum(above, len(own) - 1)])
            rows = rows[~stop]
            level += 1
        for below, up in zip(levels[1:], levels[:-1]):
            np.add.at(up["children"], below["up"], 1)
        # Upwards: sums of the subtrees, without what hangs below the layer's end.
        for depth in range(len(levels) - 1, -1, -1):
            x = levels[depth]
            bottom = at[x["lead"]] + depth == layer
            x["saved"] = np.where(bottom, 0, (x["members"] - 1) * x["chars"])
            x["leaves"] = ((x["children"] == 0) & ~bottom).astype(np.int64)
            if depth + 1 < len(levels):
                below = levels[depth + 1]
                np.add.at(x["saved"], below["up"], below["saved"])
                np.add.at(x["leaves"], below["up"], below["leaves"])
        parts = []
        for depth, x in enumerate(levels):
            lead, some = pa.array(x["lead"]), len(x["lead"])
            root = depth == 0
            parent = pa.nulls(some, pa.int64()) if root else pa.array(levels[depth - 1]["own"][x["up"]])
            ends = pa.array(x["ends"], mask=x["ends"] < 0)
            # The end of a full suffix names the owners of the nodes above it in its container.
            bottom = at[x["lead"]] + depth == layer
            above = np.stack([o[x["lead"]] for o in owner[:depth]], axis=1) if depth else np.zeros((some, 0), np.int64)
            owners = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(bottom * depth))), pa.int32()), pa.array(above[bottom].ravel()))
            owners = pc.if_else(pa.array(bottom), owners, pa.scalar(None, owners.type))
            parts.append(pa.table([
                t.column("key").take(lead) if root else pa.nulls(some, pa.binary()),
                t.column("path").take(lead) if root or bottom.any() else pa.nulls(some, schema.field("path").type),
                t.column("k").take(lead), t.column("at").take(lead),
                pa.array((at[x["lead"]] + depth).astype(np.int32)), pa.array(x["own"]), parent, pa.array(x["members"]),
                pa.array(x["children"]), pa.array(x["chars"]), pa.array(x["leaves"]), pa.array(x["saved"]),
                t.column("ending").combine_chunks().take(ends), owners], names=schema.names).cast(schema))
        return pa.concat_tables(parts)

    return run


def _equal_to_last(key: pa.Array) -> np.ndarray:
    values = key.to_pylist()
    return np.array([v == values[-1] for v in values])


def layer_nodes(rows: DataFrame, container: int, layer: int, tag: str) -> tuple[DataFrame, DataFrame]:
    """All nodes of all layers, and what the ends of full suffixes hang from.

    Nodes: ``k, level, conv, parent, n_convs, n_children, chars, leaves, saved, ending``;
    a layer's root (level 0) has no parent here, of its end (level ``layer``) only conv
    and parent count; sums leave out what is below the layer.  Ends: ``ending`` (the full
    suffix), ``k``, ``level`` and ``conv`` of each node above it in its layer."""
    calm, above = burst(rows, container, tag)
    cols = ["key", "path", "k", "at", "ids", "chars", "n", "last", "cnt", "conv", "ending"]
    swept = save(calm.select(*cols).repartition("key").sortWithinPartitions("key", "ids")
                 .mapInArrow(sweep(layer, container), NODE), f"{tag}-nodes")
    # Heads: members from the rows that pass them, sums from what lies below them.
    passing = above.select("key", "path", "k", "at", "nxt", "cnt", "conv", "n", "ending",
                           F.when(F.col("at") > 0, F.get("chars", F.col("at") - 1)).otherwise(F.col("last")).alias("chars"))
    by_next = passing.groupBy("key", "nxt").agg(F.sum("cnt").alias("cnt"), F.min("conv").alias("conv"), F.first("path").alias("path"), F.first("k").alias("k"),
                                                F.first("at").alias("at"), F.first("chars").alias("chars"),
                                                F.max(F.when(F.col("nxt").isNull(), F.col("ending"))).alias("ending"))
    head = by_next.groupBy("key").agg(F.sum("cnt").alias("n_convs"), F.min("conv").alias("conv"), F.count("nxt").alias("n_children"),
                                      F.first("path").alias("path"), F.first("k").alias("k"), F.first("at").alias("at"),
                                      F.first("chars").cast("long").alias("chars"), F.max("ending").alias("ending"))
    head = save(head, f"{tag}-heads")
    here = (F.col("n_convs") - 1) * F.col("chars")
    roots = swept.where("level = at")
    below = roots.select(F.explode("path").alias("key"), "leaves", "saved").unionByName(
        head.select(F.explode(F.concat("path", F.array("key"))).alias("key"), F.lit(0).cast("long").alias("leaves"), here.alias("saved")))
    sums = below.groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    heads = head.join(sums, "key").select("path", "k", F.col("at").alias("level"), "conv", "n_convs", "n_children", "chars", "leaves", "saved", "ending")
    # A container's root, and a head, has the last head of its path as parent.
    tops = roots.select(*heads.columns).unionByName(heads)
    up = head.select(F.col("key").alias("up"), F.col("conv").alias("parent"))
    inner = tops.where("size(path) > 0").withColumn("up", F.element_at("path", -1)).join(up, "up").drop("up", "path")
    first = tops.where("size(path) = 0").drop("path").withColumn("parent", F.lit(None).cast("long"))
    nodes = swept.where("level > at").select(*inner.columns).unionByName(inner).unionByName(first.select(*inner.columns))
    full = swept.where(F.col("level") == layer)
    ends = full.select("ending", "k", "at", F.posexplode("owners").alias("j", "conv")).select(
        "ending", "k", (F.col("at") + F.col("j")).alias("level"), "conv")
    over = full.select("ending", F.explode("path").alias("key")).join(head.select("key", "k", F.col("at").alias("level"), "conv"), "key")
    return nodes, ends.unionByName(over.select(*ends.columns))


# ---------------------------------------------------------------- digests of members
def member_digests(members: DataFrame, per_chunk: int = 1 << 14) -> DataFrame:
    """``(ending, ends_sha256)``: SHA-256 of the ascending conv_ids, joined by commas.

    Ids are joined to texts of one id range first, so the task that digests a hot group
    in order reads a row per ``per_chunk`` ids at most."""
    chunk = members.groupBy("ending", F.floor(F.col("conv") / per_chunk).alias("c")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda x: x.cast("string")), ",").alias("part"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = sha = None
        for batch in batches:
            keys, out = [], []
            for e, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if e != key:
                    if key is not None:
                        keys.append(key), out.append(sha.hexdigest())
                    key, sha = e, hashlib.sha256(part.encode())
                else:
                    sha.update(b"," + part.encode())
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out)], ["ending", "ends_sha256"])
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([sha.hexdigest()])], ["ending", "ends_sha256"])

    ordered = chunk.repartition("ending").sortWithinPartitions("ending", "c").select("ending", "part")
    return ordered.mapInArrow(run, "ending binary, ends_sha256 string")


# ---------------------------------------------------------------- the trie
def prefix_trie(turns: DataFrame, layer: int = 64, container: int = 1 << 16) -> DataFrame:
    """A row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``."""
    numbered = save(numbered_turns(turns), "trie-turns")
    each, length = rebuilt(numbered)
    group = F.unhex(F.md5(F.concat(F.concat_ws(":", F.col("k").cast("string"), F.col("head").cast("string"), F.lit("")).cast("binary"), F.col("ids"))))
    parts = save(suffixes(each, length, layer).withColumn("ending", group), "trie-suffixes")
    # Copies of a suffix below one head are one row.
    rows = parts.groupBy("ending").agg(
        F.count(F.lit(1)).alias("cnt"), F.min("conv").alias("conv"), F.first("k").alias("k"), F.first("head").alias("head"), F.first("ids").alias("ids"),
        F.first("chars").alias("chars"), F.first("n").alias("n"), F.first("last").alias("last"))
    rows = save(rows, "trie-rows")
    nodes, ends = layer_nodes(rows, container, layer, "trie")
    depth = (F.col("k") * layer + F.col("level")).alias("depth")
    inside = nodes.where(F.col("level") < layer)
    # What conversations own in the layers below the first, summed for the layers above.
    owned = inside.where("k > 0").groupBy("conv", "k").agg(
        F.sum((F.col("n_convs") - 1) * F.col("chars")).alias("saved"), F.sum((F.col("n_children") == 0).cast("long")).alias("leaves"))
    deep = parts.where("k > 0").select("conv", "k").join(owned, ["conv", "k"], "left").na.fill(0, ["saved", "leaves"]).withColumn("rank", -F.col("k"))
    total = running_sum(save(deep, "trie-owned"), ["rank"], ["saved", "leaves"], ["all_saved", "all_leaves"], partition=["conv"])
    hang = parts.where(F.col("n") == layer).select("conv", (F.col("k") + 1).alias("k"), "ending").join(total, ["conv", "k"]).groupBy("ending").agg(
        F.sum("all_saved").alias("saved"), F.sum("all_leaves").alias("leaves"))
    none = {"parent": F.lit(None).cast("long"), "n_convs": F.lit(None).cast("long"), "n_children": F.lit(None).cast("long"), "ending": F.lit(None).cast("binary")}
    hung = ends.join(hang, "ending").drop("ending").groupBy("conv", depth).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves")).withColumns(none)
    # A layer's root is the node at the end of the layer above: the parent is known there.
    last = nodes.where(F.col("level") == layer).select("conv", depth, "parent").withColumns(
        {k: v for k, v in none.items() if k != "parent"} | {"saved": F.lit(0).cast("long"), "leaves": F.lit(0).cast("long")})
    cols = ["conv", "depth", "parent", "n_convs", "n_children", "leaves", "saved", "ending"]
    every = inside.select("conv", depth, *cols[2:]).unionByName(hung.select(*cols)).unionByName(last.select(*cols)).groupBy("conv", "depth").agg(
        F.max("parent").alias("parent"), F.max("n_convs").alias("n_convs"), F.max("n_children").alias("n_children"), F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("saved"), F.max("ending").alias("ending"))
    every = save(every, "trie-every")
    digests = member_digests(parts.where(F.col("n") < layer).select("ending", "conv"))
    ended = every.where("ending IS NOT NULL").join(digests, "ending", "left").select(*cols, "ends_sha256")
    done = ended.unionByName(every.where("ending IS NULL").select(*cols).withColumn("ends_sha256", F.lit(None).cast("string")))
    return done.select(F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children",
                       F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_MEMBERS)).alias("ends_sha256"))
