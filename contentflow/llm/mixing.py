"""Mixing sources to target weights by capped water-filling.

Each source's target is its weight's share of the total size, at most ``max_epochs``
times its own size; what a capped source cannot take goes to the others by weight,
until none is above its cap.  Sorted by cap / weight the capped sources come first,
so the level is found with running sums over the table of sources.

A source whose target is w whole epochs and a rest takes every document w times and,
in a seeded order, further documents until the rest is used up: each of them once
more, the last one in part.  So a source's taken words are its target, rounded.  The
seeded order is that of ``md5(seed | doc_id)``; the place of a document in it is found by
descending through prefixes of the hash, so that no source is sorted as a whole.

Defined cases: null texts have size 0 and are taken 0 times; a null source is a source of
its own, ranked last; without any words all targets are 0; rows without doc_id are
ordered by their text; rows that repeat a doc_id each count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contentflow.llm.common import save, free_name

WORD = r"[^\x20\x09-\x0D]+"
DIGITS = 3  # hex digits of the hash per descent: 4096 groups


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """``source, source_size, target`` of ``sizes(source, size)``.

    One row per source; the windows run over that table.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.row_number().over(order) - 1
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                (rank % len(weights) + 1).cast("int")))
    per = per.withColumn("cap", (F.col("source_size") * max_epochs).cast("double"))
    everything = Window.partitionBy(F.lit(0))
    before = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1)
    per = per.withColumn("left_size", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    per = per.withColumn("left_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    per = per.withColumn("level", F.col("left_size") / F.col("left_weight"))
    per = per.withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
    # The level of the first source that is not capped holds for all of them.
    level = F.min_by(F.when(~F.col("capped"), F.col("level")),
                     F.when(~F.col("capped"), F.col("cap") / F.col("weight"))).over(everything)
    target = F.when(F.col("capped"), F.col("cap")).otherwise(level * F.col("weight"))
    return per.select("source", "source_size", target.alias("target"))


def mix_plan(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_epochs: int = 3, seed: str = "mix-1") -> DataFrame:
    """``doc_id, size, source_size, target, taken, source, h`` for every row of ``docs``.

    ``taken`` words: ``taken div size`` whole repetitions and ``taken % size`` words of
    a further one.
    """
    key = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))).cast("binary"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = save(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "source", size.alias("size"), key.alias("h")), "mix-sizes")
    per = source_targets(sized.select("source", "size"), weights, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    per = per.withColumn("epochs", epochs.cast("long")).withColumn(
        "extra", F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"))
    per = save(per, "mix-targets")

    # Descend: in which group of hash prefixes is a source's rest used up?
    cut = per.select("source", F.lit("").alias("prefix"), F.col("extra").alias("rest"))
    inside = sized
    for depth in (1, 2):
        group = F.substring("h", 1, DIGITS * depth)
        sums = inside.groupBy("source", group.alias("prefix")).agg(F.sum("size").alias("words"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("prefix").rowsBetween(Window.unboundedPreceding, 0))
        found = sums.withColumn("upto", upto).join(cut.select(F.col("source").alias("s"), "rest"), F.col("source").eqNullSafe(F.col("s")))
        # The first group with which the rest is reached, and what is left when it begins.
        found = (found.where("upto >= rest").groupBy("source").agg(F.min(F.struct("prefix", (F.col("rest") - F.col("upto") + F.col("words")).alias("rest"))).alias("m"))
                 .select("source", "m.*"))
        cut = save(found, "mix-cut")
        inside = (sized.withColumn("prefix", group).join(cut.withColumnRenamed("source", "s"),
                  F.col("source").eqNullSafe(F.col("s")) & (prefix_of(depth) == cut["prefix"]), "left_semi").drop("prefix"))
    # Inside the last group (all hashes with the same 6 digits) documents are few.
    last = cut.select(F.col("source").alias("s"), F.col("prefix").alias("edge"), F.col("rest").alias("edge_rest"))
    place = Window.partitionBy("source").orderBy("h", "size", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    near = inside.withColumn("before", F.coalesce(F.sum("size").over(place), F.lit(0)))
    head = F.substring("h", 1, 2 * DIGITS)
    far = sized.join(last, F.col("source").eqNullSafe(F.col("s")), "left").where(F.col("edge").isNull() | (head != F.col("edge")))
    far = far.select("doc_id", "source", "size", "h", F.when(head < F.col("edge"), F.col("size")).otherwise(F.lit(0)).alias("part"))
    near = near.join(last, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "size", "h",
        F.greatest(F.lit(0), F.least(F.col("size"), F.col("edge_rest") - F.col("before"))).alias("part"))
    all_ = far.unionByName(near)
    t = per.select(F.col("source").alias("s"), "source_size", "target", "epochs")
    return all_.join(t, F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "size", F.col("source_size").cast("long").alias("source_size"), "target",
        (F.col("epochs") * F.col("size") + F.col("part")).cast("long").alias("taken"), "source", "h")


def prefix_of(depth: int):
    return F.substring("h", 1, DIGITS * depth)


def mix_documents(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), max_epochs: int = 3, seed: str = "mix-1") -> DataFrame:
    """``docs`` as the mix takes them: whole repetitions as repeated rows, a part as the
    document's first words joined by single spaces (``n_chars``, where there, follows)."""
    plan = mix_plan(docs, weights, max_epochs, seed)
    # Rows with the same id (or text) and size have one key; the plan's rows for it are dealt in order.
    key = F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col("doc_id").cast("string"), F.col("text"), F.lit(""))).cast("binary"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    h, n_words, place, nth, part, taken = (free_name(docs, x) for x in ("_h", "_size", "_src", "_n", "_part", "_taken"))
    order = Window.partitionBy(h, n_words, place)
    src = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    mine = docs.withColumn(h, key).withColumn(n_words, size).withColumn(place, src).withColumn(
        nth, F.row_number().over(order.orderBy("text")))
    plan = plan.select(F.col("h").alias(h), F.col("size").alias(n_words), src.alias(place), F.col("taken").alias(taken)).withColumn(
        nth, F.row_number().over(order.orderBy(taken)))
    both = mine.join(plan, [h, n_words, place, nth]).where(F.col(taken) > 0)
    whole = F.floor(F.col(taken) / F.col(n_words)).cast("int")
    rest = (F.col(taken) % F.col(n_words)).cast("int")
    copies = F.concat(F.array_repeat(F.lit(0), whole), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    out = both.withColumn(part, F.explode(copies))
    words = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)), F.lit(1), F.col(part)), " ")
    out = out.withColumn("text", F.when(F.col(part) > 0, words).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(part) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix-1|' || coalesce(doc_id::VARCHAR, text, '')) AS h
  FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
         (source_size * 3)::DOUBLE AS cap
  FROM p),
l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0.0))::DOUBLE
            / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0)) AS level
  FROM w WINDOW b AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT arg_min(level, cap / weight) AS level FROM l WHERE NOT cap <= level * weight),
t AS (
  SELECT l.source, l.source_size, CASE WHEN cap <= l.level * weight THEN cap ELSE f.level * weight END AS target
  FROM l LEFT JOIN f ON true),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
c AS (
  SELECT d.*, e.source_size, e.target, e.epochs, round(e.target - e.epochs * e.source_size)::BIGINT AS extra,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, size, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, extra - before)))::BIGINT AS taken FROM c
"""
