"""Budget notifications and threshold crossings (SRC-08, SCL-12/14,
STM-22, STM-23, WIN-05)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.jsonx import is_object
from ..functions.text import safe_ratio
from ..schemas import BUDGET_THRESHOLDS, MONTHLY_BUDGET_AMOUNT


def _decoded(df: DataFrame, data: str) -> DataFrame:
    """Amounts and the reason why a message cannot be read (NULL if it can).

    A missing amount is 0; a null one, or one that is not a number, is unreadable."""
    body = F.try_to_binary(F.col(data), F.lit("base64"))
    v = F.try_parse_json(F.try_validate_utf8(body.cast("string")))
    # The parsed value comes out of a generator, so it is parsed once per row.
    parsed = df.select("*", F.explode(F.array(v)).alias("_v"))

    def amount(name):
        return F.try_variant_get(F.col("_v"), f"$.{name}", "double")

    def present(name):
        return F.variant_get(F.col("_v"), f"$.{name}", "variant").isNotNull()

    reason = F.when(F.col("_v").isNull(), F.lit("undecodable")).when(~is_object(F.col("_v")), F.lit("not_object"))
    for name in ("costAmount", "budgetAmount"):
        reason = reason.when(present(name) & amount(name).isNull(), F.lit("bad_" + name))
    return parsed.select(*df.columns, F.coalesce(amount("costAmount"), F.lit(0.0)).alias("cost_amount"),
                         F.coalesce(amount("budgetAmount"), F.lit(0.0)).alias("budget_amount"),
                         reason.alias("reason"))


def decode_budget_messages(df: DataFrame, data: str = "data") -> DataFrame:
    """SRC-08: ``data`` is base64 of a JSON object (no nested "message"
    level); missing amounts read as 0.  Unreadable messages are left to
    ``budget_quarantine``."""
    return _decoded(df, data).where(F.col("reason").isNull()).drop("reason")


def budget_quarantine(df: DataFrame, data: str = "data") -> DataFrame:
    """The messages that cannot be read, as they came, with the ``reason``:
    ``undecodable`` (base64, UTF-8 or JSON), ``not_object``, ``bad_costAmount``,
    ``bad_budgetAmount`` (null or not a number).  They take no decision."""
    return _decoded(df, data).where(F.col("reason").isNotNull()).select(*df.columns, "reason")


def budget_decision(messages: DataFrame, *, dedupe_key: str | None = "message_id") -> DataFrame:
    """STM-22: budget 0 -> SKIP; ratio < 1 -> OK; otherwise BREACH.  Messages
    are delivered at least once, so they are deduplicated on ``dedupe_key``.
    Emits decisions only (the billing detachment itself is not performed)."""
    m = decode_budget_messages(messages)
    if dedupe_key:
        m = m.dropDuplicates([dedupe_key])
    ratio = safe_ratio(F.col("cost_amount"), F.col("budget_amount"))
    decision = (F.when(F.col("budget_amount") == 0, F.lit("SKIP"))
                .when(ratio < 1.0, F.lit("OK")).otherwise(F.lit("BREACH")))
    return m.select(*[c for c in messages.columns if c != "data"], "cost_amount", "budget_amount",
                    F.when(F.col("budget_amount") != 0, ratio).alias("ratio"),
                    decision.alias("decision"))


def budget_crossings(spend: DataFrame, *, amount: float = MONTHLY_BUDGET_AMOUNT,
                     thresholds=tuple(BUDGET_THRESHOLDS), ts: str = "ts", cost: str = "cost",
                     tiebreak: str | None = None) -> DataFrame:
    """STM-23 / WIN-05: first instant in each calendar month at which the
    month-to-date spend reaches ``t * amount`` (CURRENT_SPEND basis).

    Decimal sums per (month, minute) come first; their running total tells in which
    minutes a target can be reached (it can inside a minute, if what is spent before it
    plus the minute's positive amounts reach it, up to the first minute that ends at or
    over it).  Only the rows of those minutes are ordered.  Spend is summed as DECIMAL,
    so the result does not depend on summation order."""
    rows = spend.select(F.date_trunc("MONTH", F.col(ts)).alias("month"), F.date_trunc("MINUTE", F.col(ts)).alias("_m"),
                        F.col(ts).alias("ts"), (F.col(tiebreak) if tiebreak else F.lit(0)).alias("_tb"),
                        F.col(cost).cast("decimal(18,2)").alias("cost")).where(F.col(ts).isNotNull())
    zero = F.lit(0).cast("decimal(38,2)")
    per = rows.groupBy("month", "_m").agg(F.coalesce(F.sum("cost"), zero).cast("decimal(38,2)").alias("_sum"),
                                          F.coalesce(F.sum(F.greatest("cost", F.lit(0).cast("decimal(18,2)"))), zero)
                                          .cast("decimal(38,2)").alias("_up"))
    # A month has 44,640 minutes at most.
    upto = Window.partitionBy("month").orderBy("_m").rowsBetween(Window.unboundedPreceding, 0)
    per = per.withColumn("_end", F.sum("_sum").over(upto).cast("decimal(38,2)")).withColumn(
        "_start", (F.col("_end") - F.col("_sum")).cast("decimal(38,2)"))
    targets = [(float(t), float(t) * float(amount)) for t in thresholds]
    goal = [F.lit(tgt).cast("decimal(38,2)") for _, tgt in targets]
    earlier = Window.partitionBy("month").orderBy("_m").rowsBetween(Window.unboundedPreceding, -1)
    can = F.lit(False)
    for g in goal:
        passed = F.coalesce(F.max(F.col("_end") >= g).over(earlier), F.lit(False))
        can = can | (~passed & (F.col("_start") + F.col("_up") >= g))
    minutes = per.withColumn("_can", can).where("_can").select(F.col("month").alias("_mo"), F.col("_m").alias("_mi"), "_start")
    near = rows.join(minutes, (F.col("_m") == F.col("_mi")) & (F.col("month") == F.col("_mo")))
    inside = Window.partitionBy("month", "_m").orderBy("ts", "_tb").rowsBetween(Window.unboundedPreceding, 0)
    cum = near.withColumn("cum", F.col("_start") + F.sum("cost").over(inside))
    firsts = cum.groupBy("month").agg(*[
        F.min(F.when(F.col("cum") >= g, F.col("ts"))).alias(f"_c{i}") for i, g in enumerate(goal)])
    pairs = F.array(*[F.struct(F.lit(t).alias("threshold"), F.lit(tgt).alias("target_amount"),
                               F.col(f"_c{i}").alias("crossed_at"))
                      for i, (t, tgt) in enumerate(targets)])
    return (firsts.select("month", F.inline(pairs))
            .where(F.col("crossed_at").isNotNull()))
