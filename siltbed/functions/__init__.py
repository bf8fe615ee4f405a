"""Column-to-column helpers; all of them stay inside whole-stage codegen."""

from siltbed.functions.dates import calendar_parts, safe_date, year_or_date
from siltbed.functions.keys import natural_key, surrogate_key
from siltbed.functions.mapping import first_match, lookup_map
from siltbed.functions.numeric import clip, nan_to_null, safe_double, safe_ratio, zero_to_null
from siltbed.functions.text import (
    canonical_unit,
    lower_trim,
    normalise_text,
    parse_price,
    snake_case,
    strip_unit_suffix,
    url_category,
)

__all__ = [
    "calendar_parts",
    "canonical_unit",
    "clip",
    "first_match",
    "lookup_map",
    "lower_trim",
    "nan_to_null",
    "natural_key",
    "normalise_text",
    "parse_price",
    "safe_date",
    "safe_double",
    "safe_ratio",
    "snake_case",
    "strip_unit_suffix",
    "surrogate_key",
    "url_category",
    "year_or_date",
    "zero_to_null",
]
