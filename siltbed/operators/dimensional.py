"""Dimensions with computed keys, fan-out-free lookups and enrichment joins.

No join carries a broadcast hint: Spark broadcasts a dimension when its measured size is
under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merges, where adaptive
execution splits the hot keys of the left (fact) side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegralType

from siltbed.functions import calendar_parts, surrogate_key, year_or_date


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by name; absent columns become NULL."""
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_members(sources: Sequence[tuple[DataFrame, str]], name: str) -> DataFrame:
    """Distinct non-NULL values of one column from each source."""
    frames = [df.select(F.col(c).alias(name)) for df, c in sources]
    return union_all(frames).dropna(subset=[name]).distinct()


def with_key(
    members: DataFrame,
    key: str,
    natural: Sequence[str],
    attributes: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Members of a dimension with key first, natural columns, then derived attributes."""
    return members.select(
        surrogate_key(*[F.col(c) for c in natural]).alias(key),
        *natural,
        *[c.alias(n) for n, c in (attributes or {}).items()],
    )


def distinct_dimension(df: DataFrame, key: str, natural: Mapping[str, str]) -> DataFrame:
    """Dimension over the distinct combinations of ``{source column: name}``.

    The first column identifies a member and must be present; the others may be NULL.
    """
    names = list(natural.values())
    members = (
        df.select(*[F.col(c).alias(n) for c, n in natural.items()])
        .dropna(subset=names[:1])
        .distinct()
    )
    return with_key(members, key, names)


def as_date(df: DataFrame, column: str) -> Column:
    """A year or date column as a date; typed columns skip the detour over text."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, DateType):
        return c
    if isinstance(kind, IntegralType):
        return F.when(c.between(1000, 9999), F.make_date(c.cast("int"), F.lit(1), F.lit(1)))
    return year_or_date(c)


def date_dimension(
    years: Sequence[tuple[DataFrame, str]], dates: Sequence[tuple[DataFrame, str]]
) -> DataFrame:
    """Calendar of every year (its first day) and date that occurs in the sources.

    Only the distinct values of each source are converted.
    """
    members = [
        df.select(c).distinct().select(as_date(df, c).alias("full_date")) for df, c in (*years, *dates)
    ]
    calendar = union_all(members).dropna(subset=["full_date"]).distinct()
    return with_key(calendar, "date_key", ["full_date"], calendar_parts("full_date"))


def lookup_key(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, str],
    key: str,
    unique: bool = True,
    null_safe: bool = False,
) -> DataFrame:
    """Add ``key`` from ``dim`` by the natural columns ``{fact column: dim column}``.

    ``unique=False`` reduces the dimension to its smallest key per natural key first, so
    facts never fan out. ``null_safe`` lets NULL match NULL.
    """
    names = {d: f"_dim_{i}" for i, d in enumerate(on.values())}
    side = dim.select(*[F.col(d).alias(n) for d, n in names.items()], F.col(key))
    if not unique:
        side = side.groupBy(*names.values()).agg(F.min(key).alias(key))

    def same(fact_column: str, dim_column: str) -> Column:
        left, right = F.col(fact_column), F.col(names[dim_column])
        return left.eqNullSafe(right) if null_safe else left == right

    return fact.join(side, [same(f, d) for f, d in on.items()], "left").drop(*names.values())


def enrich(
    base: DataFrame,
    other: DataFrame,
    on: Sequence[tuple[Column, Column]],
    columns: Sequence[str],
    unique: bool = True,
) -> DataFrame:
    """Left join on computed natural keys, taking only ``columns`` from the other side.

    ``unique=False`` leaves the other side one row per key first, the largest by its columns,
    so the base keeps its grain.
    """
    staged = base.withColumns({f"_l{i}": left for i, (left, _) in enumerate(on)})
    side = other.select(*[right.alias(f"_r{i}") for i, (_, right) in enumerate(on)], *columns)
    if not unique:
        keys = [f"_r{i}" for i in range(len(on))]
        side = side.groupBy(*keys).agg(F.max(F.struct(*columns)).alias("_row")).select(*keys, "_row.*")
    helpers = [f"_{s}{i}" for s in "lr" for i in range(len(on))]
    match = [F.col(f"_l{i}") == F.col(f"_r{i}") for i in range(len(on))]
    return staged.join(side, match, "left").drop(*helpers)


def outer_enrich(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join USING ``on``, written so that a hot key can be split.

    Adaptive execution cannot split a full outer join. A left join plus the unmatched right
    rows gives the same rows; the second part reads only the key columns of the left side,
    and those combine map-side.
    """
    matched = left.join(right, list(on), "left")
    unmatched = right.join(left.select(*on).distinct(), list(on), "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def conform(
    members: DataFrame, name: str, canonical: Column, key: str, code: str, spelled_out: bool = False
) -> DataFrame:
    """One member per canonical code: several spellings of one entity share a key.

    The smallest spelling names the member, so the dimension is the same in every run.
    ``spelled_out`` prefers spellings that are not the code itself.
    """
    smallest = F.min(name)
    if spelled_out:
        smallest = F.coalesce(F.min(F.when(F.col(name) != F.col(code), F.col(name))), smallest)
    by_code = members.select(canonical.alias(code), name).groupBy(code).agg(smallest.alias(name))
    return by_code.select(surrogate_key(F.col(code)).alias(key), name, code)
