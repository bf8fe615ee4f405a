"""Dense codes of a dimension's members, kept from run to run.

A key table gives every member a code when it is first seen: 0, 1, 2, ... with no gaps. Later
runs number only members that are new, behind all codes given so far, so facts that were
written earlier keep their codes. Digests (``surrogate_key``) need no table at all; dense codes
are for what needs small whole numbers, such as arrays by member.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.errors import MissingInputError
from siltbed.operators.features import ordinals
from siltbed.sources.published import publish_keys, read_published
from siltbed.sources.session import staged
from siltbed.sources.writers import WriteResult


def read_members(spark: SparkSession, path: str) -> DataFrame:
    """(member, code, batch) of all members so far; ``batch`` counts the runs that added some."""
    return read_published(spark, path)


def append_members(df: DataFrame, column: str, path: str, slices: int = 256) -> WriteResult:
    """Give codes to the values of ``column`` that the key table at ``path`` does not know.

    NULL is no member. New members are numbered in their order, in slices of it, so no task
    holds them all, and only they are written: the rows of earlier runs stay in their folders.
    A run that fails leaves the table as it was, and the same members get the same codes in
    the next one. One run at a time appends to a table.
    """
    spark = df.sparkSession
    members = df.select(F.col(column).alias("member")).dropna().distinct()
    try:
        known = read_members(spark, path)
    except MissingInputError:
        known = None
    if known is None:
        first, batch = F.lit(0), F.lit(1)
    else:
        members = members.join(known.select("member"), "member", "left_anti")
        last = known.agg(F.struct(F.max("code").alias("code"), F.max("batch").alias("batch"))).scalar()
        first, batch = F.coalesce(last["code"] + 1, F.lit(0)), F.coalesce(last["batch"] + 1, F.lit(1))
    # Numbering reads the new members several times.
    codes = ordinals(staged(members), "member", slices)
    new = codes.select(
        F.col("_v").alias("member"), (F.col("_code") + first).cast("bigint").alias("code"), batch.cast("int").alias("batch")
    )
    return publish_keys(new, path, ["batch"])


def with_member_codes(df: DataFrame, column: str, out: str, path: str) -> DataFrame:
    """``df`` with the code of its member in ``out``; -1 for NULL and for unknown members."""
    codes = read_members(df.sparkSession, path).select(F.col("member").alias("_member"), F.col("code").alias(out))
    coded = df.drop(out).join(codes, F.col(column) == F.col("_member"), "left").drop("_member")
    return coded.withColumn(out, F.coalesce(out, F.lit(-1)))
