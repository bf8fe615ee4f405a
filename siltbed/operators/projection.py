"""Renames, declared casts and fixed-order projections."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from siltbed.errors import SchemaConflictError
from siltbed.functions import lower_trim, snake_case

# Type names a declared schema may use.
CAST_TYPES = {"string": "string", "double": "double", "long": "bigint"}


def standardise_names(df: DataFrame) -> DataFrame:
    """All columns in snake_case, in one projection."""
    names = [snake_case(c) for c in df.columns]
    clashes = sorted(n for n, k in Counter(names).items() if k > 1)
    if clashes:
        raise SchemaConflictError(f"columns collide after renaming: {clashes}")
    return df.toDF(*names)


def schema_gaps(df: DataFrame, schema: Mapping[str, str]) -> dict[str, list[str]]:
    """What ``safe_cast`` leaves alone: absent columns, undeclared ones and unknown types."""
    return {
        "missing": [c for c in schema if c not in df.columns],
        "undeclared": [c for c in df.columns if c not in schema],
        "unknown_type": [c for c, t in schema.items() if t not in CAST_TYPES],
    }


def safe_cast(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Apply a declared schema leniently: unparseable values become NULL."""
    return df.withColumns(
        {
            c: F.col(c).try_cast(CAST_TYPES[t])
            for c, t in schema.items()
            if c in df.columns and t in CAST_TYPES
        }
    )


def normalise_strings(df: DataFrame) -> DataFrame:
    """Lower-case and trim every string column."""
    strings = [f.name for f in df.schema if isinstance(f.dataType, StringType)]
    return df.withColumns({c: lower_trim(F.col(c)) for c in strings})


def with_missing(df: DataFrame, columns: Iterable[str], type_name: str = "double") -> DataFrame:
    """Add absent columns as typed NULLs."""
    return df.withColumns(
        {c: F.lit(None).cast(type_name) for c in columns if c not in df.columns}
    )


def select_once(df: DataFrame, columns: Iterable[str | Column]) -> DataFrame:
    """Project in the given order, keeping the first of repeated names."""
    return df.select(*dict.fromkeys(columns))
