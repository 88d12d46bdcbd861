"""String, number and label helpers: pure ``Column -> Column`` expressions.

All of them compile to built-in Catalyst expressions, so they stay inside
whole-stage code generation; none needs a Python UDF.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace class used for folding.  Java's ``\s`` also matches the vertical
# tab, the warehouse's RE2 ``\s`` does not, so the class is spelled out.
WS_CLASS = "[\\t\\n\\f\\r ]"

# Plain decimal numbers as accepted by the crawler's float() check, without
# the spellings Spark and Python disagree on (``12d``, ``1_000``, nan, inf).
PLAIN_DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def collapse_ws(c) -> Column:
    """Whitespace runs to one space, then lower case (SCL-01)."""
    return F.lower(F.regexp_replace(_c(c), F.lit(WS_CLASS + "+"), F.lit(" ")))


# The characters Python's ``str.strip()`` removes: derived from
# ``str.isspace`` over all code points (tab..CR, U+001C..U+001F, space, NEL,
# NBSP, the Unicode space separators, U+2028/2029, ...), not listed by hand.
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())


def strip_ws(c) -> Column:
    """Strip leading/trailing whitespace exactly as Python's ``str.strip()``
    (SCL-02), newlines included: the built-in ``trim`` with the
    ``PY_WHITESPACE`` character set (plain SQL ``trim`` removes only spaces;
    Java's ``(?U)\\s`` would miss U+001C..U+001F)."""
    return F.trim(_c(c), F.lit(PY_WHITESPACE))


def is_float_text(c) -> Column:
    """True when the text is a plain decimal number (SCL-03)."""
    return F.coalesce(_c(c).rlike(PLAIN_DECIMAL), F.lit(False))


def float_value(c) -> Column:
    """Decimal value of a number text, NULL when not a plain decimal."""
    c = _c(c)
    return F.when(is_float_text(c), F.trim(c).try_cast("double"))


def trunc_long(c) -> Column:
    """Truncate toward zero, like Python ``int(float(x))`` (SCL-04); NULL for a
    value outside the BIGINT range (and for nan, inf)."""
    return _c(c).cast("double").try_cast("long")


def trunc_double(c) -> Column:
    """Truncate toward zero without leaving DOUBLE: any magnitude, for comparisons."""
    c = _c(c).cast("double")
    return F.when(F.abs(c) >= F.lit(2.0 ** 53), c).otherwise(F.signum(c) * F.floor(F.abs(c)).cast("double"))


def image_ext(url) -> Column:
    return F.when(F.lower(_c(url)).contains("jpg"), F.lit("jpg")).otherwise(F.lit("png"))


def zero_pad(n, width: int = 3) -> Column:
    """``'%0{width}d' % n``: left-pad with zeros, never truncate (``lpad``
    alone would cut 1234 to 123).  Negative numbers go through
    ``format_string``; the common case stays a cheap concat."""
    n = _c(n).cast("long")
    s = n.cast("string")
    return (F.when(n < 0, F.format_string(f"%0{width}d", n))
            .when(F.length(s) < width, F.lpad(s, width, "0"))
            .otherwise(s))


def object_path(chapter, page, url, label=None) -> Column:
    """``chapitre-{n}/page-{p:03d}.{ext}`` (SCL-05); the page number is padded
    to three digits, never truncated.  ``label`` stands for a chapter without number."""
    name = _c(chapter).cast("long").cast("string")
    return F.concat(F.lit("chapitre-"), name if label is None else F.coalesce(name, _c(label)),
                    F.lit("/page-"), zero_pad(page, 3), F.lit("."), image_ext(url))


def mime_type(url) -> Column:
    """``image/{ext}`` (SCL-06)."""
    return F.concat(F.lit("image/"), image_ext(url))


def iso_utc(ts) -> Column:
    """UTC ISO-8601 text with offset, as ``datetime.isoformat()`` prints it
    (SCL-07): the fraction is omitted when the microseconds are zero."""
    ts = _c(ts)
    return F.when(F.date_format(ts, "SSSSSS") == F.lit("000000"),
                  F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")) \
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))


def bucket_floor(n, width: int = 100) -> Column:
    """``floor(n / width) * width`` (SCL-09); floor, not SQL ``div`` (which truncates)."""
    return (F.floor(_c(n) / F.lit(width)) * F.lit(width)).cast("long")


def range_label(lo, hi) -> Column:
    """``lo–hi`` with an en dash."""
    return F.concat(_c(lo).cast("string"), F.lit("–"), _c(hi).cast("string"))


def bucket_label(bucket, width: int = 100) -> Column:
    return range_label(bucket, _c(bucket) + F.lit(width - 1))


def round_half_even(x, digits: int = 1) -> Column:
    """pandas ``.round(d)`` semantics (half to even on the scaled value)."""
    scale = float(10 ** digits)
    return F.rint(_c(x) * F.lit(scale)) / F.lit(scale)


def chapter_label(n) -> Column:
    return F.concat(F.lit("Chapitre "), _c(n).cast("string"))


def pages_label(n) -> Column:
    return F.concat(_c(n).cast("string"), F.lit(" pages"))


def chap_label(n) -> Column:
    return F.concat(_c(n).cast("string"), F.lit(" chap."))


def thousands(n) -> Column:
    """``{:,}`` for integers."""
    return F.format_number(_c(n).cast("long"), 0)


def decode_base64_text(c) -> Column:
    """base64 -> UTF-8 text (SCL-12)."""
    return F.unbase64(_c(c)).cast("string")


def safe_ratio(num, den) -> Column:
    """num / den, NULL when den is 0 (SCL-14); ANSI division would raise."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def _split(a: Column):
    """Veltkamp split of a double into two halves of 26 significant bits."""
    c = a * F.lit(134217729.0)  # 2^27 + 1
    hi = c - (c - a)
    return hi, a - hi


LIMB = 10 ** 9  # decimal limbs: limb * 2^29 + carry stays within a long


def whole_double_text(a) -> Column:
    """All decimal digits of a double that is a whole number of at least 2^53.

    The hexadecimal form gives the value as ``head * 2^twos``; head is held in limbs
    of nine decimal digits, the lowest first, that are multiplied by up to 2^29 at a time."""
    written = F.format_string("%a", _c(a))
    fraction = F.regexp_extract(written, r"\.([0-9a-f]+)p", 1)
    head = F.conv(F.concat(F.lit("1"), fraction), 16, 10).try_cast("long")
    twos = F.regexp_extract(written, r"p([0-9]+)$", 1).try_cast("int") - F.length(fraction) * 4

    def div(x: Column, y) -> Column:
        return F.call_function("div", x, F.lit(y))

    def times(limbs: Column, factor: Column) -> Column:
        def one(s: Column, limb: Column) -> Column:
            v = limb * factor + s["carry"]
            return F.struct(div(v, LIMB).alias("carry"), F.concat(s["done"], F.array(v % F.lit(LIMB))).alias("done"))

        start = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("done"))
        return F.aggregate(limbs, start, one, lambda s: F.concat(s["done"], F.array(s["carry"])))

    factors = F.concat(F.array_repeat(F.lit(1 << 29).cast("long"), div(twos, 29).cast("int")),
                       F.array(F.pow(F.lit(2.0), twos % F.lit(29)).cast("long")))
    limbs = F.aggregate(factors, F.array(head % F.lit(LIMB), div(head, LIMB)), times)
    return F.ltrim(F.array_join(F.transform(F.reverse(limbs), lambda v: F.lpad(v.cast("string"), 9, "0")), ""), F.lit("0"))


def fixed_text(x, digits: int = 1) -> Column:
    """Python ``'%.{digits}f' % x`` (SCL-13), for every double.

    Python rounds the exact binary value half-to-even (0.15 -> '0.1',
    1234.25 -> '1234.2'); Java's formatter, and so ``format_string``, rounds
    the shortest decimal half-up ('0.2', '1234.3').  The whole part and the
    fraction are taken apart (exactly); the scaled fraction is an exact sum
    ``p + e`` of two doubles (error-free product), rounded as ``rint(p)`` plus a
    correction that only matters at exact half-integers.  A double from 2^53 on
    has no fraction: its digits are written out."""
    if not 0 <= digits <= 7:
        raise ValueError("digits must be within 0..7")
    x = _c(x).cast("double")
    a = F.abs(x)
    zeros = F.lit("." + "0" * digits if digits else "")
    if digits == 0:
        text = F.floor(F.rint(a)).cast("string")
    else:
        scale = 10 ** digits  # < 2^26, so it is its own upper half in the split
        whole = F.floor(a)
        part = a - whole.cast("double")
        p = part * F.lit(float(scale))
        hi, lo = _split(part)
        e = (hi * F.lit(float(scale)) - p) + lo * F.lit(float(scale))
        n0 = F.rint(p)
        r = p - n0
        # e is far below 1: it breaks the tie where p sits on a half-integer.
        up = (F.abs(r) == F.lit(0.5)) & (F.signum(e) == F.signum(r))
        n = F.floor(n0) + up.cast("long") * F.signum(r).cast("long")
        text = F.concat((whole + (n == F.lit(scale)).cast("long")).cast("string"), F.lit("."),
                        F.lpad((n % F.lit(scale)).cast("string"), digits, "0"))
    # The sign comes from x, so a negative value that rounds to zero keeps it (-0.0, too).
    sign = (F.when((x < 0) | F.when(x == 0, x.cast("string").startswith("-")).otherwise(F.lit(False)), F.lit("-"))
            .otherwise(F.lit("")))
    return (F.when(F.isnan(x), F.lit("nan"))
            .when(a == F.lit(float("inf")), F.concat(sign, F.lit("inf")))
            .when(a >= F.lit(2.0 ** 53), F.concat(sign, whole_double_text(a), zeros))
            .otherwise(F.concat(sign, text)))


def percent_text(x, digits: int = 2) -> Column:
    """Python ``'{:.2%}'``: the double is multiplied by 100 first, then
    formatted like ``fixed_text``."""
    return F.concat(fixed_text(_c(x).cast("double") * F.lit(100.0), digits), F.lit("%"))


def render_template(template: str, **values) -> Column:
    """Fill ``{name}`` placeholders of a fixed text with columns: a ``concat``
    of literal pieces and column values (no format specifiers to escape)."""
    parts = []
    for piece in re.split(r"(\{[a-z_]+\})", template):
        if re.fullmatch(r"\{[a-z_]+\}", piece):
            v = values[piece[1:-1]]
            parts.append((v if isinstance(v, Column) else F.lit(v)).cast("string"))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)
