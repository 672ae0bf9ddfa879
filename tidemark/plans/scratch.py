"""Scratch folders for written intermediates, on storage every executor sees."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.paths import delete

SETTING = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, or else the context's own.

    Unset, a local session gets a temporary folder of its own; a cluster session
    is refused, since a machine-local folder would not be visible to executors.
    """
    root = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError(f"set {SETTING} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tidemark-")
    return _local_roots[app]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder name below this application's part of the scratch root."""
    return f"{_own_root(spark)}/{label}-{uuid.uuid4().hex}"


def _own_root(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/tidemark-{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete what this application wrote; call it once its results are written."""
    delete(spark, _own_root(spark))


def materialized(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a scratch folder and read it back: a short, durable lineage."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
