"""Surrogate keys computed from the natural key.

A key is a function of the row's own values: the same in every run, after a lost
executor, and in a dimension and every fact that refers to it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELD_SEPARATOR = "\x1f"
NULL_MARKER = "\\N"


def natural_key(*cols: Column) -> Column:
    """Unambiguous text form of one or more natural-key columns."""
    return F.concat_ws(
        FIELD_SEPARATOR, *[F.coalesce(c.cast("string"), F.lit(NULL_MARKER)) for c in cols]
    )


def surrogate_key(*cols: Column, wide: bool = False) -> Column:
    """60-bit BIGINT digest of the natural key.

    Take ``wide=True`` (the whole digest as text) for dimensions beyond about 10^8
    members, where 60 bits no longer rule out collisions.
    """
    digest = F.md5(natural_key(*cols))
    if wide:
        return digest
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
