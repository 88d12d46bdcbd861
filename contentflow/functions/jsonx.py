"""JSON helpers for landed service responses (VARIANT-based).

VARIANT keeps the difference between a missing key (SQL NULL from
``variant_get``) and an explicit JSON ``null`` (a variant null), which the
``dict.get(key, default)`` semantics of the pipeline depend on.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_ws


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unfence(raw) -> Column:
    """Remove every ```json and ``` marker, then strip."""
    c = F.replace(_c(raw), F.lit("```json"), F.lit(""))
    c = F.replace(c, F.lit("```"), F.lit(""))
    return strip_ws(c)


def lenient_json(raw) -> Column:
    """SCL-10: parse as-is; when that fails, parse the unfenced text; NULL if both fail."""
    return F.coalesce(F.try_parse_json(strip_ws(raw)), F.try_parse_json(unfence(raw)))


def json_kind(v) -> Column:
    """Top-level kind of a variant: OBJECT, ARRAY, NULL, STRING, ... (upper case)."""
    return F.upper(F.regexp_extract(F.schema_of_variant(_c(v)), "^([A-Za-z]+)", 1))


def is_object(v, path: str = "$") -> Column:
    """True when the value at ``path`` is a JSON object (cheap cast test; no
    schema inference)."""
    return F.try_variant_get(_c(v), path, "map<string,variant>").isNotNull()


def is_array(v, path: str = "$") -> Column:
    return F.try_variant_get(_c(v), path, "array<variant>").isNotNull()


def get_or_default(v, key: str, type_: str, default) -> Column:
    """SCL-11: default only when ``key`` is missing; an explicit null stays NULL."""
    present = F.variant_get(_c(v), "$." + key, "variant").isNotNull()
    value = F.try_variant_get(_c(v), "$." + key, type_)
    return F.when(present, value).otherwise(F.lit(default).cast(type_))


def first_annotation_text(response) -> Column:
    """SCL-15: OCR response -> text.  A non-empty error message gives '';
    otherwise the first annotation's description, stripped; none gives ''."""
    v = F.try_parse_json(_c(response))
    err = F.try_variant_get(v, "$.error.message", "string")
    first = F.try_variant_get(v, "$.text_annotations[0].description", "string")
    return (F.when(F.coalesce(F.length(err), F.lit(0)) > 0, F.lit(""))
            .otherwise(F.coalesce(strip_ws(first), F.lit(""))))
