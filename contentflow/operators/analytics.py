"""Reports over ``chapters`` and ``speakers`` (AGG-02, AGG-06..09, JN-04,
WIN-01..03, SRT-04, SRT-06, PRJ-02, SNK-09).

Scale notes
-----------
* Aggregates are partial inside each map task (hash aggregates; ``min`` over a struct,
  as in the keep-first dedupe, plans as a sort aggregate).
* Interval counts come from running totals at the interval ends: one plan for any
  number of intervals, no nested loop, no broadcast.
* "Whole-frame" values (the maximum bucket mean, the watermark) are scalar
  subqueries (``DataFrame.scalar()``), evaluated once and inlined as literals,
  never a cross join.
* The centred rolling mean over one global order uses a blocked halo plan:
  each block holds ``block`` home rows plus the rows its frame needs from the
  neighbouring blocks, so no task ever sees more than ``block + n`` rows.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import (bucket_floor, bucket_label, chap_label, chapter_label,
                              pages_label, range_label, round_half_even)

def snapshot(df: DataFrame) -> DataFrame:
    """SNK-09: cache a frame shared by several reports (memory, spill to disk).
    Call ``unpersist()`` when done."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)


# --------------------------------------------------------------------------
# KPIs and explorer
# --------------------------------------------------------------------------

def kpis(chapters: DataFrame, value: str = "image_count", *, distinct: str | None = None) -> DataFrame:
    """AGG-02: row count, mean and sum of ``value`` (NULLs skipped).  ``distinct``: a key
    column of which each value counts once (T13), with its smallest ``value``."""
    if distinct:
        chapters = chapters.groupBy(distinct).agg(F.min(value).alias(value))
    return chapters.agg(F.count(F.lit(1)).alias("n_chapters"),
                        F.avg(value).alias("mean_pages"),
                        F.sum(value).alias("total_pages"))


def explore(chapters: DataFrame, lo: int = 1, hi: int = 100) -> DataFrame:
    """PRJ-02: closed range on chapter number, three renamed columns."""
    return (chapters.where(F.col("chapter_number").between(int(lo), int(hi)))
            .select(F.col("chapter_number").alias("chapter"),
                    F.col("image_count").alias("pages"),
                    F.col("scraped_at").alias("retrieved_at")))


# --------------------------------------------------------------------------
# WIN-01 centred rolling mean
# --------------------------------------------------------------------------

def _frame(n: int) -> tuple[int, int]:
    back = n // 2
    return back, n - 1 - back


def centered_mean(df: DataFrame, order: list[str], value: str, n: int = 50, *,
                  partition: list[str] | None = None, block: int = 4096,
                  out: str = "rolling_mean", plain: bool = False) -> DataFrame:
    """pandas ``rolling(n, center=True).mean()`` over ``order`` (within each
    ``partition`` key): NULL unless all ``n`` values of the frame are present
    (edges included).

    Default plan (skew-safe): rows are numbered densely per key, cut into
    blocks of ``block`` consecutive rows, and each row is also copied to the
    neighbouring block whose frame needs it (the halo).  The window then runs
    per (key, block): no task holds more than ``block + n`` rows, however hot
    a key is.  ``plain=True`` uses one window partition per key instead."""
    back, fwd = _frame(n)
    part = list(partition or [])
    if plain:
        w = Window.partitionBy(*part).orderBy(*order).rowsBetween(-back, fwd)
        return df.withColumn(out, F.when(F.count(value).over(w) == n, F.avg(value).over(w)))
    if block < n:
        raise ValueError("block must be at least the window length")
    indexed = dense_index(df, order, "_i", partition=part)
    i = F.col("_i")
    home = F.floor(i / block)
    needed_by = F.array_distinct(F.array(home, F.floor((i + back) / block),
                                         F.floor(F.greatest(i - fwd, F.lit(0)) / block)))
    halo = indexed.select("*", home.alias("_home"), F.explode(needed_by).alias("_blk"))
    w = Window.partitionBy(*part, "_blk").orderBy("_i").rowsBetween(-back, fwd)
    res = halo.withColumn(out, F.when(F.count(value).over(w) == n, F.avg(value).over(w)))
    return res.where(F.col("_blk") == F.col("_home")).drop("_blk", "_home", "_i")


SAMPLES_PER_SLICE = 16
MAX_SLICES = 1024


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, (T.MapType, T.VariantType)):
        return False
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    return all(_hashable(f.dataType) for f in kind.fields) if isinstance(kind, T.StructType) else True


def _sliced(df: DataFrame, part: list[str], order: list[str], slices: int | None) -> tuple[DataFrame, list[Column]]:
    """``df`` with the number ``_s`` of its range slice, and the order inside a slice.

    The slices cut the whole composite order (``part``, ``order``, then a hash of the
    row), so neither a key nor an order value that holds most rows stays in one.  The
    edges come from the rows with the smallest hashes (a fixed number of them): a
    scalar subquery that runs with the query, always gives the same edges for the same
    rows, and is searched by halving."""
    slices = slices or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    slices = min(slices, MAX_SLICES)
    row = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if _hashable(f.dataType)])
    keyed = df.withColumn("_tie", row)
    place = F.struct(*part, *order, "_tie")
    drawn = keyed.select(place.alias("p")).orderBy(F.xxhash64(F.lit(17), "p._tie"), "p._tie").limit(slices * SAMPLES_PER_SLICE)
    ends = drawn.agg(F.sort_array(F.collect_list("p")).alias("e")).select(F.transform(
        F.sequence(F.lit(1), F.lit(slices - 1)),
        lambda i: F.get("e", F.floor(i * F.size("e") / F.lit(slices)).cast("int"))).alias("x"))
    steps = [1 << i for i in reversed(range((slices - 1).bit_length()))]
    found = F.aggregate(F.array(*[F.lit(x) for x in steps]), F.lit(0), lambda at, step: at + F.when(
        F.coalesce(F.get("_edges", at + step - 1) <= place, F.lit(False)), step).otherwise(0))
    cut = keyed.withColumn("_edges", ends.scalar()).withColumn("_s", found).drop("_edges")
    return cut, [*[F.col(c) for c in order], F.col("_tie")]


def _same(df: DataFrame, other: DataFrame, cols: list[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & df[c].eqNullSafe(other["_o" + c])
    return cond


def dense_index(df: DataFrame, order: list[str], name: str = "_i", *,
                partition: list[str] | None = None, slices: int | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (per ``partition`` key) without a
    window over a whole key or a whole order value.

    Rows are cut into range slices of the composite order; the counts of (key, slice)
    give each slice's offset, and a window numbers the rows inside a (key, slice).
    Rows with equal order are numbered by a hash of the row (equal rows share a slice)."""
    part = list(partition or [])
    cut, inner = _sliced(df, part, order, slices)
    counts = cut.groupBy("_s", *part).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*part).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(c).alias("_o" + c) for c in ["_s", *part]],
                            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inside = F.row_number().over(Window.partitionBy("_s", *part).orderBy(*inner)) - 1
    numbered = cut.withColumn("_in", inside)
    return (numbered.join(offsets, _same(numbered, offsets, ["_s", *part]))
            .withColumn(name, F.col("_off") + F.col("_in"))
            .drop("_s", "_tie", "_in", "_off", *["_o" + c for c in ["_s", *part]]))


def running_sum(df: DataFrame, order: list[str], value: str | list[str], name: str | list[str] = "_cum", *,
                partition: list[str] | None = None, slices: int | None = None) -> DataFrame:
    """Running total of ``value`` along ``order`` (per ``partition`` key), inclusive of
    the current row; sliced like ``dense_index``.  ``order`` should be a total order.
    Lists of values and names give several totals in one pass."""
    part = list(partition or [])
    values, names = ([value], [name]) if isinstance(value, str) else (value, name)
    cut, inner = _sliced(df, part, order, slices)
    totals = cut.groupBy("_s", *part).agg(*[F.sum(v).alias(f"_tot{i}") for i, v in enumerate(values)])
    before = Window.partitionBy(*part).orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*[F.col(c).alias("_o" + c) for c in ["_s", *part]], *[
        F.coalesce(F.sum(f"_tot{i}").over(before), F.lit(0).cast(totals.schema[f"_tot{i}"].dataType)).alias(f"_off{i}") for i in range(len(values))])
    sofar = Window.partitionBy("_s", *part).orderBy(*inner).rowsBetween(Window.unboundedPreceding, 0)
    summed = cut.withColumns({f"_local{i}": F.sum(v).over(sofar) for i, v in enumerate(values)})
    each = [(n, f"_off{i}", f"_local{i}") for i, n in enumerate(names)]
    return (summed.join(offsets, _same(summed, offsets, ["_s", *part]))
            .withColumns({n: F.col(off) + F.coalesce(local, F.lit(0)) for n, off, local in each})
            .drop("_s", "_tie", *[c for _, off, local in each for c in (off, local)], *["_o" + c for c in ["_s", *part]]))


# --------------------------------------------------------------------------
# JN-04 interval counts
# --------------------------------------------------------------------------

def interval_counts(df: DataFrame, intervals: DataFrame, key: str = "chapter_number", *,
                    distinct: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``key`` lies in each closed interval [lo, hi]; every
    interval is kept (0 when empty), names may repeat.  ``intervals``: name, lo, hi, family.

    The data side is reduced to one row per key value.  Keys and interval ends are put
    into one order; an interval's count is the running total at its upper end less the
    one before its lower end."""
    per_key = df.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("double").alias("_at"))
    per_key = per_key.agg((F.lit(1) if distinct else F.count(F.lit(1))).cast("long").alias("_n"))
    ident = ["name", "family", "lo", "hi"]
    named = intervals.groupBy(*ident).agg(F.count(F.lit(1)).cast("int").alias("_copies"))
    # At one place: a lower end comes before the key, an upper end after it.
    ends = named.select(*ident, "_copies", F.explode(F.array(
        F.struct(F.col("lo").cast("double").alias("_at"), F.lit(0).alias("_kind")),
        F.struct(F.col("hi").cast("double").alias("_at"), F.lit(2).alias("_kind")))).alias("_e"))
    ends = ends.select(*ident, "_copies", "_e.*", F.lit(0).cast("long").alias("_n"))
    keys = per_key.select("_at", F.lit(1).alias("_kind"), "_n")
    line = keys.unionByName(ends, allowMissingColumns=True)
    cum = running_sum(line, ["_at", "_kind", *ident], "_n", "_cum").where("_kind <> 1")
    counted = cum.groupBy(*ident, "_copies").agg(F.sum(F.when(F.col("_kind") == 2, F.col("_cum")).otherwise(-F.col("_cum"))).alias("_c"))
    n = F.greatest(F.col("_c"), F.lit(0)).cast("long")  # lo > hi holds nothing
    return (counted.select(*ident, n.alias("_cnt"), F.explode(F.array_repeat(F.lit(0), F.col("_copies"))).alias("_x"))
            .select("name", "family", "lo", "hi", range_label(F.col("lo"), F.col("hi")).alias("label"),
                    F.col("_cnt").alias("n_chapters"), chap_label(F.col("_cnt")).alias("text")))


# --------------------------------------------------------------------------
# AGG-06 / WIN-02 bucket means
# --------------------------------------------------------------------------

def bucket_mean(df: DataFrame, key: str = "chapter_number", value: str = "image_count",
                width: int = 100) -> DataFrame:
    """Mean of ``value`` per ``floor(key/width)*width`` bucket, rounded to one
    decimal half-to-even; ``is_max`` flags every bucket equal to the maximum."""
    agg = (df.where(F.col(key).isNotNull())
           .groupBy(bucket_floor(F.col(key), width).alias("bucket"))
           .agg(round_half_even(F.avg(value), 1).alias("mean")))
    top = agg.select(F.max("mean")).scalar()
    return agg.select("bucket", bucket_label(F.col("bucket"), width).alias("label"), "mean",
                      F.coalesce(F.col("mean") == top, F.lit(False)).alias("is_max")) \
        .orderBy("bucket")


# --------------------------------------------------------------------------
# SRT-04 / WIN-03 top-k
# --------------------------------------------------------------------------

def top_k(df: DataFrame, value: str = "image_count", key: str = "chapter_number",
          k: int = 10) -> DataFrame:
    """The ``k`` largest ``value`` (ties: smaller key first), then shown in
    ascending order with a 0-based display position and weight 0.5+0.05*i.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top k, only k rows per task reach the final merge."""
    top = df.where(F.col(value).isNotNull()).orderBy(F.col(value).desc(), F.col(key).asc()).limit(k)
    # At most k rows: a single-partition window is bounded by k.
    pos = F.row_number().over(Window.orderBy(F.col(value).asc(), F.col(key).asc())) - 1
    return top.select(F.col(key), F.col(value), pos.alias("position")).select(
        key, value, "position",
        F.round(F.lit(0.5) + F.lit(0.05) * F.col("position"), 2).alias("weight"),
        chapter_label(F.col(key)).alias("label"),
        pages_label(F.col(value)).alias("text"))


# --------------------------------------------------------------------------
# Mention reports
# --------------------------------------------------------------------------

def count_by(df: DataFrame, key: str = "chapter_number", name: str = "occurrences") -> DataFrame:
    """AGG-07: rows per key (NULL key dropped), key order."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias(name)).orderBy(key))


def mention_kpis(df: DataFrame, says: str = "luffy_says_it", about: str = "about_luffy") -> DataFrame:
    """AGG-08: total, says, about (overlapping counts; NULL is not true)."""
    return df.agg(F.count(F.lit(1)).alias("total"),
                  F.count_if(F.col(says)).alias("n_says"),
                  F.count_if(F.col(about)).alias("n_about"))


# FIXED VALUES: display labels of the three-way split, in chart order.
SPLIT_LABELS = ["Luffy le dit", "Quelqu'un parle de Luffy", "Autre contexte"]


def mention_split(df: DataFrame, says: str = "luffy_says_it", about: str = "about_luffy") -> DataFrame:
    """AGG-09: exclusive says / about-and-not-says / rest, as three rows."""
    one = df.agg(F.count(F.lit(1)).alias("t"),
                 F.count_if(F.col(says)).alias("s"),
                 F.count_if(F.col(about) & ~F.col(says)).alias("a"))
    return one.select(F.inline(F.array(
        F.struct(F.lit(0).alias("slot"), F.lit("says").alias("category"),
                 F.lit(SPLIT_LABELS[0]).alias("label"), F.col("s").alias("n")),
        F.struct(F.lit(1).alias("slot"), F.lit("about_only").alias("category"),
                 F.lit(SPLIT_LABELS[1]).alias("label"), F.col("a").alias("n")),
        F.struct(F.lit(2).alias("slot"), F.lit("other").alias("category"),
                 F.lit(SPLIT_LABELS[2]).alias("label"),
                 (F.col("t") - F.col("s") - F.col("a")).alias("n")))))


def distinct_examples(df: DataFrame, keys=("chapter_number", "phrase"), flag: str = "luffy_says_it",
                      order=("chapter_number", "page_number"), k: int = 10) -> DataFrame:
    """SRT-06 / SET-02: rows where ``flag`` is true, distinct on ``keys`` keeping
    the first occurrence in ``order``, first ``k``.  The keep-first is a
    partial-aggregating ``min(struct(order))``, not a window."""
    keys, order = list(keys), list(order)
    first = (df.where(F.coalesce(F.col(flag), F.lit(False)))
             .groupBy(*keys).agg(F.min(F.struct(*order)).alias("_o")))
    return (first.orderBy(*[F.col("_o")[c] for c in order], *keys).limit(k)
            .select(*keys))
