"""Parquet tables, versioned snapshots of them, and publishing."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.merge import new_rows
from tidemark.sources.paths import children, delete, exists
from tidemark.sources.staging import append_once

VERSION = "version="
#: Column by which the file list of a keyed table is told from rows.
KEYED = "_keyed_by"


def append_new_rows(
    incoming: DataFrame, path: str, key: str, order_by: Sequence[str]
) -> int:
    """Append the incoming rows whose key the table lacks; returns how many.

    The table is neither rewritten nor, without new rows, touched.
    """
    existing = read_table(incoming.sparkSession, path)
    return append_once(new_rows(existing, incoming, key, order_by), path, DataFrameWriter.parquet)


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet scan; a missing path is a FileNotFoundError."""
    if not exists(spark, path):
        raise FileNotFoundError(f"table not found: {path}")
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def overwrite_table(df: DataFrame, path: str) -> None:
    """Replace a table.  The job must not read the path it replaces; see publish_version."""
    df.write.mode("overwrite").parquet(path)


def publish(df: DataFrame, uri: str, partition_by: tuple[str, ...] = ()) -> str:
    """Write a finished table to any storage URI Spark can reach."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(uri)
    return uri


def sql_over_files(spark: SparkSession, statement: str, **paths: str) -> DataFrame:
    """Run SQL in which ``{name}`` stands for the Parquet table at ``paths[name]``."""
    tables = {name: read_table(spark, path) for name, path in paths.items()}
    return spark.sql(statement, **tables)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Completely written versions, ascending."""
    found = []
    for name in children(spark, root):
        if name.startswith(VERSION) and exists(spark, f"{root}/{name}/_SUCCESS"):
            found.append(int(name.removeprefix(VERSION)))
    return sorted(found)


def version_path(root: str, version: int) -> str:
    return f"{root}/{VERSION}{version:010d}"


def read_current(
    spark: SparkSession,
    root: str,
    schema: StructType | None = None,
    before: int | None = None,
) -> DataFrame | None:
    """The newest complete version, below ``before`` if given; None if there is none.

    Of a keyed table (:mod:`tidemark.sources.keyed`) the files that the version lists.
    """
    known = [v for v in versions(spark, root) if before is None or v < before]
    if not known:
        return None
    rows = read_table(spark, version_path(root, known[-1]))
    if KEYED in rows.columns:
        return _listed_files(spark, root, rows, schema)
    return rows if schema is None else read_table(spark, version_path(root, known[-1]), schema)


def read_manifest(spark: SparkSession, root: str, version: int) -> DataFrame:
    """The files of a version of a keyed table, and a row without a file about all of it."""
    return read_table(spark, version_path(root, version))


def _listed_files(spark: SparkSession, root: str, manifest: DataFrame, schema: StructType | None) -> DataFrame:
    rows = manifest.select("file", "columns").collect()
    if schema is None:
        schema = StructType.fromJson(json.loads(next(r.columns for r in rows if r.file is None)))
    files = [f"{root}/{r.file}" for r in rows if r.file is not None]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def drop_old_versions(spark: SparkSession, root: str, keep: int) -> list[int]:
    """Delete all but the newest ``keep`` complete versions; returns those deleted.

    Keep at least two: a reader may still be on the version before the newest.
    """
    if keep < 2:
        raise ValueError("at least two versions are kept")
    old = versions(spark, root)[:-keep]
    for version in old:
        delete(spark, version_path(root, version))
    return old


def publish_version(
    df: DataFrame, root: str, version: int | None = None, allow_empty: bool = True
) -> int:
    """Write a new version next to the one being read; readers switch once it is complete.

    Writing the same version number again replaces it, so a replay is harmless.
    With ``allow_empty=False`` a version without rows is withdrawn and refused; its
    rows are counted while they are written, not by another job.
    """
    spark = df.sparkSession
    if version is None:
        version = max(versions(spark, root), default=0) + 1
    path = version_path(root, version)
    rows = Observation()
    df.observe(rows, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    if not allow_empty and rows.get["n"] == 0:
        delete(spark, path)
        raise ValueError(f"no rows for {root}")
    return version
