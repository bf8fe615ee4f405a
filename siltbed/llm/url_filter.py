"""URL filters: a blocked Bloom filter of listed addresses before an exact hash join.

A list holds entries (host, path, verdict). An entry fits its host and all subdomains if
the path of the URL starts with the entry's. Every URL proposes the addresses that could be
listed; those that pass the filter are looked up by an exact join, which removes the false
positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.llm.words import let

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LANES = 8
#: The filter's size bound: blocks of 8 lanes of 64 bits; 2^15 of them are 2 MB.
MOST_BLOCKS = 1 << 15


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def address(host: Column, path: Column) -> Column:
    """The canonical text of a listed address: host, a space (no host has one), path."""
    return F.concat(host, F.lit(" "), path)


def bloom_bit(key: Column, lane: int) -> Column:
    """The one bit that a key sets in a lane of its block."""
    second = F.xxhash64(key, F.lit("lanes"))
    place = F.shiftrightunsigned(second, 8 * lane).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def block_of(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def bloom_filter(entries: DataFrame, blocks: int = MOST_BLOCKS, key: str = "address") -> DataFrame:
    """One row with the filter: an array by block of its eight lanes, null where it is empty.

    It has ``blocks`` places whatever the list's length, so the row has a proven bound; a
    list too long for it only lets more through to the exact join.
    """
    lanes = entries.groupBy(block_of(F.col(key), blocks).alias("block")).agg(
        F.array(*[F.bit_or(bloom_bit(F.col(key), lane)) for lane in range(LANES)]).alias("lanes")
    )
    places = entries.sparkSession.range(blocks).select(F.col("id").cast("int").alias("block"))
    dense = F.sort_array(F.collect_list(F.struct("block", "lanes")))
    return places.join(lanes, "block", "left").agg(F.transform(dense, lambda x: x["lanes"]).alias("filter"))


def may_be_listed(filter_array: Column, key: Column, blocks: int) -> Column:
    """True for every listed key and for few others."""
    lanes = F.get(filter_array, block_of(key, blocks))
    hit = lanes.isNotNull()
    for lane in range(LANES):
        hit = hit & (F.get(lanes, F.lit(lane)).bitwiseAND(bloom_bit(key, lane)) != 0)
    return hit


def host_suffixes(host: Column) -> Column:
    """The host and every part of it behind a dot."""
    return let(
        F.split(host, "[.]", -1),
        lambda labels: F.transform(
            labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), ".")
        ),
    )


def listed_entries(entries: DataFrame) -> DataFrame:
    """Distinct usable entries with their address; on equal addresses 'block' wins."""
    host, path = F.translate(F.col("host"), UPPER, LOWER), F.coalesce(F.col("path"), F.lit(""))
    clean = entries.where(F.col("host").isNotNull() & F.col("verdict").isin("allow", "block"))
    return (
        clean.select(host.alias("host"), path.alias("path"), "verdict", F.col("is_rule").alias("is_rule"))
        .groupBy("host", "path", "is_rule")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("address", address(F.col("host"), F.col("path")))
    )


def filter_urls(
    pages: DataFrame, entries: DataFrame, url: str = "url", key: str = "page_id", blocks: int = 4096
) -> DataFrame:
    """Judge URLs: ``host``, ``path``, ``rule`` and ``verdict`` for every row of ``pages``.

    ``entries`` (host, path, verdict, is_rule) holds explicit rules and listed addresses.
    The longest rule (host and path together, then host) decides; without one a listed
    address decides in the same way; without either the URL is allowed. Null URLs and
    those without ``://`` have an empty host and path and are allowed. Rows of ``pages`` may
    repeat: distinct URLs are judged and joined back, so a URL that makes a third of all
    rows is judged once. Columns of ``pages`` other than the key and the URL are not read.
    """
    if not 0 < blocks <= MOST_BLOCKS:
        raise ValueError(f"blocks must be 1 to {MOST_BLOCKS}")
    listed = listed_entries(entries)
    bits = bloom_filter(listed, blocks).scalar()
    lengths = listed.agg(F.sort_array(F.collect_set(F.length("path")))).scalar()
    judged = pages.select(
        F.col(key),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
    )
    # Every address (host suffix, path prefix of a listed length) of a distinct URL; only
    # possible hits go on to the join.
    prefixes = judged.select("host", "path").distinct().withColumn("n", F.explode(lengths))
    proposed = (
        prefixes.where(F.col("n") <= F.length("path"))
        .select(
            "host",
            "path",
            F.substring("path", F.lit(1), F.col("n")).alias("prefix"),
            F.explode(host_suffixes(F.col("host"))).alias("suffix"),
        )
        .select("host", "path", address(F.col("suffix"), F.col("prefix")).alias("address"))
        .where(may_be_listed(bits, F.col("address"), blocks))
    )
    exact = proposed.join(
        listed.select("address", "verdict", "is_rule", F.col("host").alias("l_host"), F.col("path").alias("l_path")),
        "address",
    )
    order = F.struct(
        F.length("l_host") + F.length("l_path"), F.length("l_host"), F.col("l_host"), F.col("l_path"), F.col("verdict")
    )
    best = exact.groupBy("host", "path").agg(
        F.max(F.when(F.col("is_rule"), order)).alias("r"), F.max(F.when(~F.col("is_rule"), order)).alias("l")
    )
    return judged.join(best, ["host", "path"], "left").select(
        key,
        "host",
        "path",
        F.concat(F.col("r")["l_host"], F.col("r")["l_path"]).alias("rule"),
        F.coalesce(F.col("r")["verdict"], F.col("l")["verdict"], F.lit("allow")).alias("verdict"),
    )
