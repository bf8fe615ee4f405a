"""String clean-up: names, free text, prices, units and URLs."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def snake_case(name: str) -> str:
    """Column name in snake_case: every run of non-word characters becomes one underscore."""
    return re.sub(r"(?:\W|_)+", "_", name.strip().lower()).strip("_")


def lower_trim(c: Column) -> Column:
    return F.lower(F.trim(c))


def normalise_text(c: Column) -> Column:
    """Collapse whitespace runs to one space, trim, lower-case."""
    return lower_trim(F.regexp_replace(c, r"\s+", " "))


def strip_unit_suffix(c: Column, unit: str) -> Column:
    """Remove a unit marker in any letter case, so ``"1731nm"`` becomes ``"1731"``."""
    return F.trim(F.regexp_replace(c, "(?i)" + re.escape(unit), ""))


def parse_price(c: Column) -> Column:
    """Price text to FLOAT; NULL when nothing numeric is left."""
    digits = F.regexp_replace(c, r"[^0-9.\-]", "")
    return F.nullif(digits, F.lit("")).try_cast("float")


def canonical_unit(c: Column, variants: Mapping[str, str]) -> Column:
    """Known spellings to their canonical unit; unknown ones are only trimmed, blanks are NULL."""
    text = F.nullif(F.trim(c), F.lit(""))
    known = F.create_map(*[F.lit(x) for pair in variants.items() for x in pair])
    return F.coalesce(F.try_element_at(known, F.lower(text)), text)


def url_category(url: Column, default: str = "general") -> Column:
    """Last path segment of a URL, or ``default`` when the path is empty.

    The path is cut out by the generic URI pattern, which accepts any string, so odd
    URLs never fail the job.
    """
    path = F.regexp_extract(url, r"^(?:[^:/?#]+:)?(?://[^/?#]*)?([^?#]*)", 1)
    last = F.regexp_extract(path, r"([^/]*)/*$", 1)
    return F.coalesce(F.nullif(last, F.lit("")), F.lit(default))
