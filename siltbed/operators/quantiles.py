"""Exact medians and percentiles without gathering a group.

The built-in exact percentile keeps every distinct value of a group in one place, which is
fine for groups of bounded size. For larger ones a mergeable sketch of bounded size brackets
the wanted rank; passes over the table count what lies below each bracket and at its ends
and sketch again what lies strictly inside, until no bracket holds more than a fixed number
of values; a last pass collects these, combined per value. No step keeps a share of a group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from siltbed.functions import safe_double
from siltbed.sources.session import staged

#: Values of a group that one task may hold for the built-in percentile.
SMALL = 200_000
#: Values that a bracket may hold for the last pass.
MOST_INSIDE = 1_000_000
#: Steps of the grid of fractions by which a bracket is narrowed.
GRID = 1000


def exact_medians(
    df: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = (),
    accuracy: int = 10000,
    small: int = SMALL,
    most_inside: int = MOST_INSIDE,
) -> DataFrame:
    """Interpolated median per column, one row per key (one row in all without keys).

    NULL is a key like any other; a group without values has a NULL median. Group sizes are
    counted first, so the call runs jobs: stage a table that is dear to compute.
    """
    return _exact(df, [(c, 0.5, c) for c in columns], keys, accuracy, True, small, most_inside)


def exact_percentiles(
    df: DataFrame,
    columns: Sequence[str],
    fractions: Sequence[float],
    keys: Sequence[str] = (),
    accuracy: int = 10000,
    small: int = SMALL,
    most_inside: int = MOST_INSIDE,
) -> DataFrame:
    """Discrete percentiles (an existing value each) in ``<column>_p<percent>``."""
    targets = [(c, p, f"{c}_p{p * 100:g}") for c in columns for p in fractions]
    return _exact(df, targets, keys, accuracy, False, small, most_inside)


def _built_in(values: DataFrame, targets: Sequence[tuple[str, float, str]], keys: Sequence[str], interpolate: bool) -> DataFrame:
    """One aggregate for groups of bounded size; what a column's fractions share is kept once."""
    spots: dict[str, list[tuple[float, str]]] = {}
    for c, p, name in targets:
        spots.setdefault(c, []).append((p, name))

    def of(c: str) -> Column:
        if interpolate:
            return F.percentile(f"_v_{c}", [p for p, _ in spots[c]])
        # The value at a rank: counts per value are bounded like the group.
        held = F.sort_array(F.collect_list(f"_v_{c}"))
        ranks = [F.greatest(F.ceil(F.size(held) * F.lit(float(p))), F.lit(1)).cast("int") for p, _ in spots[c]]
        return F.array(*[F.get(held, r - 1) for r in ranks])

    found = values.groupBy(*keys).agg(*[of(c).alias(f"_p_{c}") for c in spots])
    named = {name: F.get(f"_p_{c}", i) for c in spots for i, (_, name) in enumerate(spots[c])}
    return found.select(*keys, *[named[name].alias(name) for _, _, name in targets])


def _ranks(n: Column, fraction: float, interpolate: bool) -> tuple[Column, Column]:
    """Ranks, from 1, of the one or two values wanted among ``n``."""
    if interpolate:
        return F.floor((n + 1) / 2), F.floor(n / 2) + 1
    rank = F.greatest(F.ceil(n * F.lit(float(fraction))), F.lit(1))
    return rank, rank


def _bracketed(values: DataFrame, brackets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row with the brackets of its group as ``_b``."""
    if not keys:
        return values.withColumn("_b", brackets.select("_b").scalar())
    # Joined on the packed key: an aggregate on the keys then needs a shuffle of its own, so
    # adaptive execution is free to split a hot key of this join.
    packed = F.struct(*keys).alias("_key")
    return values.select("*", packed).join(brackets.select(packed, "_b"), "_key").drop("_key")


def _narrowed(
    values: DataFrame,
    brackets: DataFrame,
    targets: Sequence[tuple[str, float, str]],
    keys: Sequence[str],
    accuracy: int,
    interpolate: bool,
) -> DataFrame:
    """Brackets that hold at most some four thousandths of what lay strictly inside before.

    Values at the ends are counted apart: however many rows share one, it is out of the way.
    """
    grid = [i / GRID for i in range(GRID + 1)]
    # Steps that the sketch's error, a share of ``1 / accuracy``, stays below.
    reach = -(-2 * GRID // accuracy) + 2
    counts, spots = [], []
    for i, (c, fraction, _) in enumerate(targets):
        v, b = F.col(f"_v_{c}"), F.get("_b", i)
        inside = F.when((v > b["low"]) & (v < b["high"]), v)
        counts += [
            F.count_if(v < b["low"]).alias(f"_below{i}"),
            F.count_if(v == b["low"]).alias(f"_at{i}"),
            F.count(inside).alias(f"_in{i}"),
            F.percentile_approx(inside, grid, accuracy).alias(f"_g{i}"),
            F.first(b).alias(f"_b{i}"),
        ]
        old, inside_n = F.col(f"_b{i}"), F.col(f"_in{i}")

        def end(rank: Column, way: int, i: int = i, old: Column = old, inside_n: Column = inside_n) -> Column:
            """The bracket's end for a rank: itself if it lies there, else a grid value beyond it."""
            left = rank - F.col(f"_below{i}") - F.col(f"_at{i}")
            step = F.floor(left / F.greatest(inside_n, F.lit(1)) * GRID).cast("int") + F.lit(way * reach)
            near = F.get(f"_g{i}", F.greatest(F.lit(0), F.least(F.lit(GRID), step)))
            # The outermost steps keep the old end: the sketch may miss the rank beyond them.
            near = F.when(step <= 0, old["low"]).when(step >= GRID, old["high"]).otherwise(near)
            return F.when(left < 1, old["low"]).when(left > inside_n, old["high"]).otherwise(near)

        lower, upper = _ranks(old["n"], fraction, interpolate)
        low, high = end(lower, -1), end(upper, 1)
        held = F.when(low < high, inside_n * ((2 * reach + 2) / GRID)).otherwise(0.0)
        spots.append(F.struct(old["n"].alias("n"), low.alias("low"), high.alias("high"), held.alias("held")))
    counted = _bracketed(values, brackets, keys).groupBy(*keys).agg(*counts)
    return counted.select(*keys, F.array(*spots).alias("_b"))


def _exact(
    df: DataFrame,
    targets: Sequence[tuple[str, float, str]],
    keys: Sequence[str],
    accuracy: int,
    interpolate: bool,
    small: int,
    most_inside: int,
) -> DataFrame:
    margin = 2 / accuracy
    columns = list(dict.fromkeys(c for c, _, _ in targets))
    values = df.select(*keys, *[safe_double(F.col(c)).alias(f"_v_{c}") for c in columns])
    sizes = values.groupBy(*keys).agg(F.greatest(F.lit(0), *[F.count(f"_v_{c}") for c in columns]).alias("_n"))
    if (sizes.agg(F.max("_n")).first()[0] or 0) <= small:
        return _built_in(values, targets, keys, interpolate)

    # One sketch per column serves all its fractions.
    spots = {c: [i for i, t in enumerate(targets) if t[0] == c] for c in columns}
    edges = {c: [min(max(targets[i][1] + e, 0.0), 1.0) for i in spots[c] for e in (-margin, margin)] for c in columns}
    sketch = values.groupBy(*keys).agg(
        *[F.count(f"_v_{c}").alias(f"_n_{c}") for c in columns],
        *[F.percentile_approx(f"_v_{c}", edges[c], accuracy).alias(f"_q_{c}") for c in columns],
    )
    brackets = [
        F.struct(
            F.col(f"_n_{c}").alias("n"),
            F.get(f"_q_{c}", 2 * spots[c].index(i)).alias("low"),
            F.get(f"_q_{c}", 2 * spots[c].index(i) + 1).alias("high"),
            (F.col(f"_n_{c}") * (6 / accuracy)).alias("held"),
        )
        for i, (c, _, _) in enumerate(targets)
    ]
    bracketed = staged(sketch.select(*keys, F.array(*brackets).alias("_b")))
    while bracketed.agg(F.max(F.array_max(F.transform("_b", lambda b: b["held"])))).first()[0] > most_inside:
        bracketed = staged(_narrowed(values, bracketed, targets, keys, accuracy, interpolate))
    ranged = _bracketed(values, bracketed, keys)

    # One short row per value up to its bracket; those below it merge into a count.
    value, bracket = F.col("_v"), F.col("_b")
    counted = (
        ranged.select(
            *keys,
            F.array(*[F.lit(i) for i in range(len(targets))]).alias("_t"),
            F.array(*[F.col(f"_v_{c}") for c, _, _ in targets]).alias("_v"),
            "_b",
        )
        .select(*keys, F.inline(F.arrays_zip("_t", "_v", "_b")))
        # A group without values keeps its rows, which merge into one without a pick.
        .filter((value <= bracket["high"]) | (bracket["n"] == 0))
        .groupBy(
            *keys,
            "_t",
            bracket["n"].alias("_n"),
            F.when(value >= bracket["low"], value).alias("_v"),
        )
        .agg(F.count(F.lit(1)).alias("_k"))
    )
    along = W.partitionBy(*keys, "_t").orderBy(F.asc_nulls_first("_v"))
    last = F.sum("_k").over(along.rowsBetween(W.unboundedPreceding, 0))
    placed = counted.withColumn("_last", last).withColumn("_first", F.col("_last") - F.col("_k") + 1)

    if interpolate:
        # Ranks of the one or two middle values.
        lower, upper = F.floor((F.col("_n") + 1) / 2), F.floor(F.col("_n") / 2) + 1
    else:
        fraction = F.get(F.array(*[F.lit(float(p)) for _, p, _ in targets]), F.col("_t"))
        lower = upper = F.greatest(F.ceil(F.col("_n") * fraction), F.lit(1))

    def at(rank: Column) -> Column:
        hit = value.isNotNull() & rank.between(F.col("_first"), F.col("_last"))
        return F.max(F.when(hit, value))

    picked = placed.groupBy(*keys, "_t").agg(
        ((at(lower) + at(upper)) / 2).alias("_pick"), F.max("_n").alias("_n")
    )
    # Never return a guess: a bracket that missed its rank stops the job.
    missed = F.raise_error(F.lit("a rank lies outside its bracket; raise accuracy")).cast("double")
    sure = picked.withColumn("_pick", F.when(F.col("_n") > 0, F.coalesce("_pick", missed)))
    return sure.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_t") == i, F.col("_pick"))).alias(n) for i, (_, _, n) in enumerate(targets)]
    )
