"""Tables published by version: a failing write never harms what readers see.

Every publication writes a folder of its own. Only when all of it is there, one row naming the
folder is appended to the table's commits, and that row is what readers go by. A job that dies
before leaves the last version as it was; its folder is never read.

``<path>/data/_version=<name>/...``  the rows of one publication
``<path>/parts/<name>``              for keyed tables: each key with the folder that holds it
``<path>/commits``                   one row per version

One job at a time publishes a table; of two, the later commit is read. Folders no commit of
interest names can be deleted at any time (``unused_folders``).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from siltbed.errors import MissingInputError
from siltbed.sources.writers import WriteResult, write_table

VERSION = "_version"
COMMIT = "version bigint, name string, rows bigint, schema string, keys array<string>, committed_at timestamp"


def commits(spark: SparkSession, path: str) -> DataFrame:
    """All versions of a table; an empty table where nothing was published yet."""
    try:
        return spark.read.schema(COMMIT).parquet(f"{path}/commits")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT)


def _commit(spark: SparkSession, path: str, version: int | None = None) -> Row | None:
    known = commits(spark, path)
    if version is not None:
        known = known.filter(F.col("version") == version)
    return known.orderBy(F.desc("version"), F.desc("committed_at"), "name").first()


def _publish(df: DataFrame, path: str, name: str, last: Row | None, rows: int, keys: Sequence[str]) -> None:
    version = last.version + 1 if last else 1
    entry = df.sparkSession.range(1).select(
        F.lit(version).cast("bigint").alias("version"),
        F.lit(name).alias("name"),
        F.lit(rows).cast("bigint").alias("rows"),
        F.lit(df.schema.json()).alias("schema"),
        F.array(*[F.lit(k) for k in keys]).cast("array<string>").alias("keys"),
        F.current_timestamp().alias("committed_at"),
    )
    # One row is one file, which appears under its name when it is complete.
    entry.coalesce(1).write.mode("append").parquet(f"{path}/commits")


def publish_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), files: int | None = None
) -> WriteResult:
    """Publish a table as a whole. A drop-in for ``write_table``; read it by ``read_published``.

    The rows may come from the table's earlier versions.
    """
    spark, name = df.sparkSession, uuid.uuid4().hex
    last = _commit(spark, path)
    result = write_table(df, f"{path}/data/{VERSION}={name}", partition_by, files)
    _publish(df, path, name, last, result.rows, ())
    return result


def _folder_keys(spark: SparkSession, path: str, name: str, schema: StructType, keys: Sequence[str]) -> DataFrame:
    """The keys a folder holds; partition columns alone are read, so no data are."""
    folder = spark.read.schema(schema).parquet(f"{path}/data/{VERSION}={name}")
    return folder.select(*keys).distinct().withColumn(VERSION, F.lit(name))


def publish_keys(df: DataFrame, path: str, keys: Sequence[str]) -> WriteResult:
    """Publish the given rows in place of all rows with the same values of ``keys``.

    Only these rows are written; other keys stay in the folders that hold them. A NULL key
    is a key like any other. The columns and the keys must be those of the last version.
    """
    if not keys:
        raise ValueError("keys must name at least one column")
    spark, name = df.sparkSession, uuid.uuid4().hex
    last = _commit(spark, path)
    if last is not None:
        if list(last["keys"]) != list(keys):
            raise ValueError(f"the table at '{path}' is keyed by {list(last['keys'])}, not by {list(keys)}")
        # Compared by name and type: whether a column may hold NULL depends on the plan.
        known = {f.name: f.dataType for f in StructType.fromJson(json.loads(last.schema)).fields}
        if known != {f.name: f.dataType for f in df.schema.fields}:
            raise ValueError(f"the columns differ from those of the table at '{path}'")
    result = write_table(df, f"{path}/data/{VERSION}={name}", keys)
    parts = _folder_keys(spark, path, name, df.schema, keys) if result.rows else None
    if last is not None:
        before = spark.read.parquet(f"{path}/parts/{last.name}")
        if parts is None:
            parts = before
        else:
            same = [before[k].eqNullSafe(parts[k]) for k in keys]
            parts = before.join(parts, same, "left_anti").unionByName(parts)
    elif parts is None:
        parts = df.select(*keys).limit(0).withColumn(VERSION, F.lit(name))
    parts.write.parquet(f"{path}/parts/{name}")
    _publish(df, path, name, last, result.rows, keys)
    return result


def read_published(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The last version of a table, or the given one, with the columns in their published order.

    A keyed table is its folders joined with the table of its parts on the partition columns,
    so folders of other versions give no rows and are pruned where Spark prunes dynamically.
    """
    commit = _commit(spark, path, version)
    if commit is None:
        raise MissingInputError(f"no published table at '{path}'" + (f" in version {version}" if version else ""))
    schema = StructType.fromJson(json.loads(commit.schema))
    if not commit["keys"]:
        return spark.read.schema(schema).parquet(f"{path}/data/{VERSION}={commit.name}").select(*schema.names)
    stored = (
        spark.read.schema(StructType(schema.fields).add(VERSION, "string"))
        .option("basePath", f"{path}/data")
        .parquet(f"{path}/data")
    )
    parts = spark.read.parquet(f"{path}/parts/{commit.name}")
    same = [stored[VERSION] == parts[VERSION], *[stored[k].eqNullSafe(parts[k]) for k in commit["keys"]]]
    condition = same[0]
    for term in same[1:]:
        condition &= term
    return stored.join(parts, condition, "left_semi").select(*schema.names)


def unused_folders(spark: SparkSession, path: str, keep: int = 2) -> DataFrame:
    """Folders that none of the last ``keep`` versions reads, as ``folder``: those to be deleted."""
    last = commits(spark, path).orderBy(F.desc("version"), F.desc("committed_at")).limit(keep).collect()
    used = spark.createDataFrame([(c.name,) for c in last], "name string")
    for commit in last:
        if commit["keys"]:
            parts = spark.read.parquet(f"{path}/parts/{commit.name}")
            used = used.union(parts.select(VERSION))
    present = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{path}/data")
        .select(F.regexp_extract("path", f"/{VERSION}=([0-9a-f]+)/", 1).alias("name")).distinct()
    )
    unused = present.join(used.distinct(), "name", "left_anti")
    return unused.select(F.concat(F.lit(f"{path}/data/{VERSION}="), "name").alias("folder"))
