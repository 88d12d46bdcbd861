"""Phrase mentions: worklist, response parsing and a rule tagger
(FLT-04, JN-03, SRT-07, SCL-17, PIP-05..07).

All steps are row-wise expressions plus one anti-join; the response parser
works on VARIANT values so that "key missing" and "key is null" stay distinct.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.jsonx import get_or_default, is_array, is_object, lenient_json
from ..functions.text import WS_CLASS, collapse_ws, render_template, strip_ws
from ..schemas import ALIASES, MENTION_DEFAULTS, MENTION_REQUEST_TEMPLATE, PHRASE, SAYS_CUES
from .frontier import chapter_key, difference, identity


def with_phrase(df: DataFrame, phrase: str = PHRASE, text: str = "extracted_text") -> DataFrame:
    """FLT-04: rows whose whitespace-folded, lower-cased text contains
    ``phrase`` (so matches span line breaks).  NULL text never matches."""
    return df.where(F.coalesce(collapse_ws(F.col(text)).contains(phrase.lower()), F.lit(False)))


def request_text(chapter: str | Column = "chapter_number", page="page_number", text="extracted_text",
                 phrase: str = PHRASE):
    """SCL-17: one request text per page: the fixed request template filled
    with (chapter, page, OCR text, phrase)."""
    return render_template(MENTION_REQUEST_TEMPLATE, chapter=F.col(chapter) if isinstance(chapter, str) else chapter, page=F.col(page),
                           text=F.col(text), phrase=phrase)


def mention_worklist(dialogues: DataFrame, speakers: DataFrame, phrase: str = PHRASE) -> DataFrame:
    """PIP-05: pages with the phrase that have no ``speakers`` row yet
    (null-safe key match), ordered by (chapter, page), with their request."""
    pages = with_phrase(dialogues.select("chapter_number", "page_number", "extracted_text"), phrase)
    todo = difference(pages, speakers.select("chapter_number", "page_number"),
                      ["chapter_number", "page_number"], null_safe=True)
    return (todo.select("chapter_number", "page_number", "extracted_text",
                        request_text(phrase=phrase).alias("request"))
            .orderBy("chapter_number", "page_number"))


def mentions_from_responses(df: DataFrame, raw: str = "raw", *, literal: bool = False,
                            says: str = "luffy_says_it", about: str = "about_luffy", position: bool = False):
    """PIP-06: response text -> ``speakers`` rows, plus a quarantine frame.

    A page is quarantined when its text is not JSON even after removing code
    fences, when the top level is not an object, or when ``mentions`` is
    present but not an array.  A missing ``mentions`` means no mention.  Each
    array element that is an object becomes a row (missing keys take the
    defaults, explicit nulls stay NULL); other elements are quarantined.
    ``literal=True`` also drops the objects after the first bad element of a
    page, as an exception in the middle of the loop would.  ``says`` / ``about`` name the
    flags; ``position`` adds ``pos``, the element's place in its page's array."""
    keys = [*identity(df), "page_number"]
    # The parsed value is emitted by a (one-element) generator: filters on it
    # cannot be pushed below a Generate, so the optimizer cannot re-inline the
    # parse into each predicate and the text is parsed exactly once per row.
    parsed = df.select(*keys, F.col(raw).alias("raw"),
                       F.explode(F.array(lenient_json(F.col(raw)))).alias("_v"))
    mentions = F.variant_get(F.col("_v"), "$.mentions", "variant")
    page_reason = (F.when(F.col("_v").isNull(), F.lit("unparseable"))
                   .when(~is_object(F.col("_v")), F.lit("not_object"))
                   .when(mentions.isNull(), F.lit(None))
                   .when(~is_array(F.col("_v"), "$.mentions"), F.lit("mentions_not_array")))
    parsed = parsed.select("*", page_reason.alias("_reason"), mentions.alias("_m"))

    elems = (parsed.where(F.col("_reason").isNull() & F.col("_m").isNotNull())
             .select(*keys, "raw", F.posexplode(F.try_variant_get(F.col("_m"), "$", "array<variant>"))
                     .alias("pos", "_e")))
    elems = elems.withColumn("_ok", is_object(F.col("_e")))
    if literal:
        # Per page: bounded by the mentions of one response.
        first_bad = F.min(F.when(~F.col("_ok"), F.col("pos"))).over(Window.partitionBy(*keys))
        elems = elems.withColumn("_ok", F.col("_ok") & (first_bad.isNull() | (F.col("pos") < first_bad)))

    e = F.col("_e")
    rows = elems.where("_ok").select(
        *keys,
        get_or_default(e, "speaker", "string", MENTION_DEFAULTS["speaker"]).alias("speaker"),
        get_or_default(e, "phrase", "string", MENTION_DEFAULTS["phrase"]).alias("phrase"),
        get_or_default(e, says, "boolean", MENTION_DEFAULTS["luffy_says_it"]).alias(says),
        get_or_default(e, about, "boolean", MENTION_DEFAULTS["about_luffy"]).alias(about),
        *(["pos"] if position else []))

    bad_pages = parsed.where(F.col("_reason").isNotNull()).select(
        *keys, "raw", F.col("_reason").alias("reason"), F.lit(None).cast("int").alias("pos"))
    bad_elems = elems.where(~F.col("_ok")).select(
        *keys, "raw", F.lit("bad_mention").alias("reason"), F.col("pos"))
    return rows, bad_pages.unionByName(bad_elems)


# Private-use stand-ins for the sentence stops inside an alias.
HIDE = {ord("."): 0xE000, ord("!"): 0xE001, ord("?"): 0xE002}


def _alias_pattern(aliases) -> str:
    alts = "|".join(a.replace(".", "\\.") for a in aliases)
    return "(^|[^\\p{L}\\p{N}])(" + alts + ")($|[^\\p{L}\\p{N}])"


def mentions_by_rules(dialogues: DataFrame, phrase: str = PHRASE, cues=tuple(SAYS_CUES),
                      aliases=tuple(ALIASES), text: str = "extracted_text", subject: str = "Luffy") -> DataFrame:
    """PIP-07: deterministic stand-in for the mention classifier.  Text is split
    into sentences on ``.``, ``!`` and ``?`` (not inside an alias); every sentence containing the
    phrase (whitespace-folded, case-insensitive) is a mention.  ``says`` when a
    first-person cue occurs (the speaker is then ``subject``); ``about`` when an alias
    occurs and no cue does.
    This is a rule tagger, not equivalent to a language model."""
    # Stops inside an alias ("D.") do not end a sentence: they are kept out of the split.
    kept = F.col(text)
    for a in sorted({a for a in aliases if re.search("[.!?]", a)}, key=lambda a: (-len(a), a)):
        kept = F.replace(kept, F.lit(a), F.lit(a.translate(HIDE)))
    sent = dialogues.select("chapter_number", "page_number",
                            F.posexplode(F.split(kept, "[.!?]+")).alias("sidx", "s"))
    sent = sent.withColumn("s", F.translate("s", "".join(map(chr, HIDE.values())), "".join(map(chr, HIDE))))
    folded = strip_ws(F.regexp_replace(F.col("s"), F.lit(WS_CLASS + "+"), F.lit(" ")))
    sent = sent.select("chapter_number", "page_number", "sidx", folded.alias("phrase"))
    low = F.lower(F.col("phrase"))
    cue_re = "(" + "|".join(c.lower() for c in cues) + ")"
    says = low.rlike(cue_re)
    alias_hit = F.col("phrase").rlike(_alias_pattern(aliases))
    return (sent.where(low.contains(phrase.lower()))
            .select("chapter_number", "page_number", "sidx",
                    F.when(says, F.lit(subject)).otherwise(F.lit(MENTION_DEFAULTS["speaker"])).alias("speaker"),
                    "phrase",
                    says.alias("luffy_says_it"),
                    (alias_hit & ~says).alias("about_luffy")))


def page_ledger(responses: DataFrame, raw: str = "raw") -> DataFrame:
    """T8 ledger: one status row per analysed page, so that pages with zero
    mentions are not re-analysed and failed pages are retried.

    status: ``failed`` (unparseable / not an object / mentions not an array),
    ``partial`` (some mention elements malformed), ``mentions`` (at least one
    mention), ``no_mention`` (parsed, nothing found).  Row-wise: the mention
    array is inspected with higher-order functions, no explode or shuffle."""
    keys = [*identity(responses), "page_number"]
    v = F.col("_v")
    parsed = responses.select(*keys, F.explode(F.array(lenient_json(F.col(raw)))).alias("_v"))
    arr = F.coalesce(F.try_variant_get(v, "$.mentions", "array<variant>"),
                     F.array().cast("array<variant>"))
    n_ok = F.size(F.filter(arr, lambda e: is_object(e)))
    n_bad = F.size(F.filter(arr, lambda e: ~is_object(e)))
    failed = (v.isNull() | ~is_object(v)
              | (F.variant_get(v, "$.mentions", "variant").isNotNull() & ~is_array(v, "$.mentions")))
    status = (F.when(failed, F.lit("failed")).when(n_bad > 0, F.lit("partial"))
              .when(n_ok > 0, F.lit("mentions")).otherwise(F.lit("no_mention")))
    return parsed.select(*keys, status.alias("status"),
                         F.when(failed, F.lit(0)).otherwise(n_ok).cast("long").alias("n_mentions"),
                         F.when(failed, F.lit(0)).otherwise(n_bad).cast("long").alias("n_bad"))


def mention_worklist_from_ledger(dialogues: DataFrame, ledger: DataFrame,
                                 phrase: str = PHRASE) -> DataFrame:
    """PIP-05 with the ledger: pages with the phrase whose last analysis is
    not final (never analysed, failed or partial)."""
    done = ledger.where(F.col("status").isin("mentions", "no_mention")).select(chapter_key(ledger).alias("_key"), "page_number")
    pages = with_phrase(dialogues.select(*identity(dialogues), "page_number", "extracted_text"), phrase)
    todo = difference(pages.withColumn("_key", chapter_key(pages)), done, ["_key", "page_number"])
    return (todo.select(*identity(dialogues), "page_number", "extracted_text",
                        request_text(F.coalesce("_key", F.lit("")), phrase=phrase).alias("request"))
            .orderBy("chapter_number", *identity(dialogues)[1:], "page_number"))
