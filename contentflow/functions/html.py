"""Attribute extraction from landed HTML, as Catalyst regex expressions.

The crawler only ever reads two things from a page: the ``href`` of ``<a>``
tags and the ``data-src`` of ``<img>`` tags, in document order.  Both are
linear regex scans over one column, so they run per row inside the scan stage
(no Python parser, no shuffle).  Text inside ``<script>``, ``<style>`` and
comments is removed first, as an HTML parser would not see tags there.
"""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Scripts, styles and comments up to their first end; possessive, so runs of text are
# taken in one step and an unclosed one costs no backtracking.
NON_MARKUP = (r"(?is)<(?:script\b(?:[^<]++|<(?!/script\s*+>))*+</script\s*+>"
              r"|style\b(?:[^<]++|<(?!/style\s*+>))*+</style\s*+>|!--(?:[^-]++|-(?!->))*+-->)")

# A value in double quotes, in single quotes, or bare.
VALUE = r"""(?>"[^"]*+"|'[^']*+'|[^\s>]++)"""

# A character reference: &#38; &#x26; &amp;
REFERENCE = "&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


def tag_pattern(tag: str) -> str:
    """A whole start tag, its attribute text in group 1.  ``>`` inside a quoted value does
    not end it; quotes only count after ``=``; ``<a-b>`` is not ``<a>``.  The loops are
    possessive, so a text without the end of a tag costs no backtracking."""
    return (r"(?is)<" + tag + r"""(?=[\s/>])((?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+)|["'])*+)>""")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def attribute_pattern(attr: str) -> str:
    """One attribute (name, then optionally ``=`` and a value), whose value is group 1 if
    its name is ``attr``; empty for any other.  Matched from end to end of a tag, so a name
    inside another attribute's value is never at the start of a match."""
    return rf"""(?is){attr}\s*+=\s*+({VALUE})|[^\s=>"'/]++(?:\s*+=\s*+{VALUE})?+"""


def strip_non_markup(html) -> Column:
    return F.regexp_replace(_c(html), F.lit(NON_MARKUP), F.lit(""))


def _named() -> Column:
    """The standard library's table of named references, as a map literal."""
    pairs = [(k[:-1], v) for k, v in html5.items() if k.endswith(";")]
    return F.map_from_arrays(F.array(*[F.lit(k) for k, _ in pairs]), F.array(*[F.lit(v) for _, v in pairs]))


def _code_point(hex_text: Column) -> Column:
    return F.decode(F.unhex(F.lpad(hex_text, 8, "0")), "UTF-32")


def decode_reference(r: Column) -> Column:
    """Character of the text between ``&`` and ``;``; unknown ones stay as they are."""
    number = F.when(r.rlike("^#[xX]"), r.substr(F.lit(3), F.lit(6))).otherwise(
        F.conv(r.substr(F.lit(2), F.lit(7)), 10, 16))
    known = F.when(r.startswith("#"), _code_point(number)).otherwise(F.try_element_at(_named(), r))
    return F.coalesce(known, F.concat(F.lit("&"), r, F.lit(";")))


def unescape_entities(c) -> Column:
    """Decode numeric and named character references, each once."""
    c = _c(c)
    texts = F.split(c, F.lit(REFERENCE), F.lit(-1))
    refs = F.regexp_extract_all(c, F.lit(REFERENCE), F.lit(1))
    whole = F.array_join(F.zip_with(texts, F.transform(refs, decode_reference),
                                    lambda t, r: F.concat(t, F.coalesce(r, F.lit("")))), "")
    return F.when(c.contains("&"), whole).otherwise(c)


def attr_values(html, tag: str, attr: str) -> Column:
    """Array of ``attr`` values of every ``<tag>`` that has it, document order.

    Tags are taken whole, then read attribute by attribute, so a name inside another
    attribute's value is not one; of a repeated attribute the last counts."""
    tags = F.regexp_extract_all(strip_non_markup(html), F.lit(tag_pattern(tag)), F.lit(1))

    def last_value(t):
        mine = F.filter(F.regexp_extract_all(t, F.lit(attribute_pattern(attr)), F.lit(1)), lambda v: v != "")
        return F.try_element_at(mine, F.lit(-1))

    def bare(v):
        first = F.when(v.startswith('"') | v.startswith("'"), F.lit(2)).otherwise(F.lit(1))
        last = F.when(v.endswith('"') | v.endswith("'"), F.length(v) - 1).otherwise(F.length(v))
        return F.substr(v, first, last - first + 1)

    # Most tags of other kinds are gone here; those without the attribute give NULL.
    raw = F.filter(F.transform(F.filter(tags, lambda t: F.lower(t).contains(attr)), last_value), lambda v: v.isNotNull())
    return F.transform(raw, lambda v: unescape_entities(bare(v)))


def anchor_hrefs(html) -> Column:
    """HTM-01: ``<a href>`` values in document order."""
    return attr_values(html, "a", "href")


def lazy_image_srcs(html, needles=("scans", "jpg", "png")) -> Column:
    """HTM-04: ``<img data-src>`` values containing any needle (case-sensitive);
    order and duplicates kept."""
    vals = attr_values(html, "img", "data-src")

    def keep(v):
        cond = F.lit(False)
        for n in needles:
            cond = cond | v.contains(n)
        return cond

    return F.filter(vals, keep)


def link_number_text(href, sep: str = "chapitre-", end: str = "-vf") -> Column:
    """HTM-03: text between the first and second ``sep``, cut at the first ``end``
    (both case-sensitive).  NULL when ``sep`` does not occur."""
    part = F.try_element_at(F.split(_c(href), F.lit(_quote(sep))), F.lit(2))
    return F.split(part, F.lit(_quote(end))).getItem(0)


def _quote(s: str) -> str:
    # split() takes a regex; literal separators are quoted.
    return "\\Q" + s + "\\E"
