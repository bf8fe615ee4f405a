"""Mixing sources to target weights by Poisson replication.

Every document draws its number of copies from a Poisson distribution whose mean is the
repetition rate of its source. The draw is the inverse of the distribution at a number
made from the document's key and a seed, so any rerun, on any executor, repeats it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.sources.session import staged

#: Hex digits of a digest used as a uniform number; 13 of them fit a double exactly.
DIGITS = 13
#: Largest mean that is inverted at once. A larger one is the sum of equal parts drawn apart,
#: so no distribution in use has more than a hundred steps, whatever the rate.
MOST_MEAN = 16
#: Copies that one row makes at once.
COPIES = 1024
#: Sources whose rates may be sent to all tasks, and characters of their names together.
MOST_SOURCES, MOST_NAMES = 4096, 1 << 20


def hash_seeded_uniform(seed: int, key: Column) -> Column:
    """A number in [0, 1) fixed by the seed and the key; a null key counts as empty text."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") / float(16**DIGITS)


def poisson_cdf(mean: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... as far as a double can tell from 1.

    Terms are carried as logarithms, so large means do not underflow.
    """
    last = F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("int")
    start = F.struct(-mean, F.exp(-mean), F.array(F.exp(-mean)))

    def step(acc: Column, k: Column) -> Column:
        log = acc["log"] + F.log(mean / k)
        total = acc["total"] + F.exp(log)
        return F.struct(
            log.alias("log"), total.alias("total"), F.concat(acc["cdf"], F.array(total)).alias("cdf")
        )

    begin = start.cast("struct<log:double,total:double,cdf:array<double>>")
    return F.aggregate(F.sequence(F.lit(1), last), begin, step, lambda acc: acc["cdf"])


def poisson_inverse(cdf: Column, uniform: Column) -> Column:
    """The smallest k with uniform < P(X <= k)."""
    return F.size(F.filter(cdf, lambda c: c <= uniform))


def source_rates(
    docs: DataFrame,
    weights: DataFrame | None = None,
    temperature: float = 0.5,
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """One row per source: characters, target weight and mean repetition rate.

    ``weights`` (source, weight) names the targets; a source that it lacks gets none. Without it a source's weight is its size to
    the power ``temperature``. The rates keep the corpus at its size: the expected
    characters of a source are its share of the weights times all characters. Null is a
    source of its own. A source without characters has rate 0.
    """
    sizes = docs.groupBy(F.col(source).alias("mix_source")).agg(
        F.sum(F.length(F.coalesce(F.col(text), F.lit("")))).cast("double").alias("chars")
    )
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow("chars", F.lit(temperature)))
    else:
        given = weights.groupBy(F.col("source").alias("given_source")).agg(F.sum("weight").alias("weight"))
        sizes = (
            sizes.join(given, F.col("mix_source").eqNullSafe(F.col("given_source")), "left")
            .drop("given_source")
            .withColumn("weight", F.coalesce(F.col("weight").cast("double"), F.lit(0.0)))
        )
    sizes = sizes.withColumn("weight", F.when(F.col("chars") > 0, F.col("weight")).otherwise(0.0))
    total = sizes.agg(F.sum("chars").alias("c"), F.sum("weight").alias("w"))
    share = F.col("weight") / total.select("w").scalar()
    rate = F.when(F.col("weight") > 0, share * total.select("c").scalar() / F.col("chars")).otherwise(0.0)
    return sizes.withColumn("rate", rate)


def poisson_draw(parts: Column, cdf: Column, seed: int, key: Column) -> Column:
    """Copies of a document: the sum of ``parts`` inversions, each at a number of its own.

    The sum of independent Poisson numbers is one, with the sum of their means. A single part
    is drawn at the seed and the key alone.
    """
    once = poisson_inverse(cdf, hash_seeded_uniform(seed, key)).cast("long")
    text = F.coalesce(key.cast("string"), F.lit(""))

    def drawn(total: Column, i: Column) -> Column:
        return total + poisson_inverse(cdf, hash_seeded_uniform(seed, F.concat(i.cast("string"), F.lit("/"), text)))

    several = F.aggregate(F.sequence(F.lit(1).cast("long"), parts), F.lit(0).cast("long"), drawn)
    return F.when(parts == 1, once).otherwise(several)


def repeated(row: DataFrame, copies: Column) -> DataFrame:
    """Every row ``copies`` times, as ``mix_copy`` 1, 2, ...; arrays in between stay small."""
    n = F.col("mix_n")
    blocks = row.withColumn("mix_n", copies).where(n > 0)
    blocks = blocks.withColumn("mix_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / COPIES))))
    first = F.col("mix_block") * COPIES + 1
    copy = F.explode(F.sequence(first, F.least(n, first + (COPIES - 1))))
    return blocks.withColumn("mix_copy", copy).drop("mix_n", "mix_block")


def copies_in_order(
    docs: DataFrame,
    weights: DataFrame | None = None,
    temperature: float = 0.5,
    seed: int = 17,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """The copies of ``mix_sources``: columns c0, c1, ... of the document by place, mix_copy and mix_key."""
    rates = source_rates(docs, weights, temperature, source, text)
    parts = F.greatest(F.ceil(F.col("rate") / MOST_MEAN), F.lit(1)).cast("long")
    rates = rates.withColumn("mix_parts", parts)
    curves = staged(rates.select("mix_source", "mix_parts", poisson_cdf(F.col("rate") / F.col("mix_parts")).alias("mix_cdf")))
    n, names = curves.agg(F.count("*"), F.coalesce(F.sum(F.length("mix_source")), F.lit(0))).first()
    if n <= MOST_SOURCES and names <= MOST_NAMES:
        # Of checked size, so documents stay where they are; otherwise Spark deals them by source.
        curves = F.broadcast(curves)
    # Numbered names cannot clash with those in use here.
    rows = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    source_at, id_at = (F.col(f"c{docs.columns.index(c)}") for c in (source, key))
    met = rows.join(curves, source_at.eqNullSafe(F.col("mix_source")))
    copies = repeated(met, poisson_draw(F.col("mix_parts"), F.col("mix_cdf"), seed, id_at))
    mixed = F.concat_ws(":", F.lit(str(seed)), F.coalesce(id_at.cast("string"), F.lit("")), "mix_copy")
    return (
        copies.select(*rows.columns, "mix_copy", F.md5(mixed).alias("mix_key"))
        .repartitionByRange(F.col("mix_key"))
        .sortWithinPartitions("mix_key")
    )


def mix_sources(
    docs: DataFrame,
    weights: DataFrame | None = None,
    temperature: float = 0.5,
    seed: int = 17,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
) -> DataFrame:
    """Documents repeated to the target weights, in an order fixed by the seed.

    Adds ``mix_copy`` (1, 2, ...) and ``mix_key``, in the place of columns of these names, and
    orders the rows by ``mix_key``: a digest of seed, document key and copy number, which is
    the global shuffle. Documents that draw 0 copies leave. Rows with equal keys draw alike.
    Null and empty texts have no size. An empty table stays empty.

    The rates are one row per source. Documents are not moved to them: they are sent to all
    tasks after their number has been checked, and joined by source only beyond that.
    """
    copies = copies_in_order(docs, weights, temperature, seed, key, source, text)
    kept = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c not in ("mix_copy", "mix_key")]
    return copies.select(*kept, "mix_copy", "mix_key")
