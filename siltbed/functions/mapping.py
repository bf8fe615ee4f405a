"""Small fixed mappings as expressions, so no join is needed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltbed.functions.text import lower_trim


def first_match(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Value of the first rule whose text occurs in the upper-cased input, else the input."""
    upper = F.upper(c)
    return F.coalesce(*[F.when(F.contains(upper, F.lit(p)), F.lit(v)) for p, v in rules], c)


def lookup_map(c: Column, mapping: Mapping[str, str]) -> Column:
    """Case-insensitive lookup with lower-case results; unmatched input gives NULL."""
    entries = [F.lit(x.lower()) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*entries), lower_trim(c))
