"""Append-only histories: run and stage ledgers, quality metrics, alerts.

A history is never read back to be rewritten; each append only adds files, which are
written once and moved into place when they are known to be wanted.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from tidemark import schemas
from tidemark.functions.text import utc_wall_clock
from tidemark.operators.enrich import conform
from tidemark.operators.ledger import normalized_runs
from tidemark.sources.paths import children
from tidemark.sources.staging import Staged, append_once

RUN_DATE = "run_date"
#: Ids of a batch that are listed in a filter; more are joined.
LISTED_IDS = 1000


def append(df: DataFrame, path: str, schema: StructType) -> bool:
    """Append rows in the history's own layout; nothing is written for no rows."""
    return append_once(conform(df, schema), path, DataFrameWriter.parquet) > 0


def load(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A history in its own layout, with older files filled up by nulls."""
    if not _has_files(spark, path):
        raise FileNotFoundError(f"history not found: {path}")
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def _has_files(spark: SparkSession, path: str) -> bool:
    """Whether anything has been appended; a folder that a first append left empty is none."""
    return any(name[0] not in "_." for name in children(spark, path))


def load_runs(spark: SparkSession, path: str, since: date | None = None) -> DataFrame:
    """The run ledger; ``since`` reads only runs started on that day (UTC) or later."""
    if since is None:
        return load(spark, path, schemas.RUNS)
    if not _has_files(spark, path):
        raise FileNotFoundError(f"history not found: {path}")
    dated = StructType(schemas.RUNS.fields + [StructField(RUN_DATE, DateType(), True)])
    recent = spark.read.schema(dated).parquet(path).filter(F.col(RUN_DATE) >= F.lit(since))
    return recent.select(*schemas.RUNS.names)


def append_runs(runs: DataFrame, path: str) -> bool:
    """Append run records by start day; a run that is in the ledger already is refused.

    The batch is written once, aside.  Files of the ledger have a Bloom filter and the
    range of their run ids, so the ids of a batch are looked for in files only that may
    hold them: up to ``LISTED_IDS`` are listed in the filter that reaches the scan, more
    are joined within their range.
    """
    spark = runs.sparkSession
    dated = normalized_runs(runs).withColumn(RUN_DATE, F.to_date(utc_wall_clock("started_at")))
    run_id = F.col("run_id")
    staged = Staged(dated, path, _write_runs, low=F.min(run_id), high=F.max(run_id))
    try:
        if not staged.seen["n"]:
            return staged.discard() or False
        ids = spark.read.schema(dated.schema).parquet(staged.path).select("run_id")
        repeated = ids.groupBy("run_id").count().filter("count > 1").select("run_id")
        known = recorded(spark, path, ids, staged.seen)
        if known is not None:
            repeated = repeated.unionByName(known)
        for row in repeated.limit(1).collect():
            raise ValueError(f"run {row['run_id']} is already recorded")
    except Exception:
        staged.discard()
        raise
    staged.publish()
    return True


def _write_runs(writer: DataFrameWriter, path: str) -> None:
    writer.option("parquet.bloom.filter.enabled#run_id", "true").partitionBy(RUN_DATE).parquet(path)


def recorded(spark: SparkSession, path: str, ids: DataFrame, seen: Mapping) -> DataFrame | None:
    """Those of the batch's run ids that the ledger holds; None if there is no ledger yet."""
    if not _has_files(spark, path):
        return None
    known = load(spark, path, schemas.RUNS).select("run_id")
    if seen["n"] <= LISTED_IDS:
        listed = [r.run_id for r in ids.where("run_id IS NOT NULL").collect()]
        return known.where(F.col("run_id").isin(listed)) if listed else known.limit(0)
    return known.where(F.col("run_id").between(seen["low"], seen["high"])).join(ids, "run_id", "left_semi")


def append_stage_runs(stage_runs: DataFrame, path: str) -> bool:
    return append(stage_runs, path, schemas.STAGE_RUNS)


def append_quality(quality: DataFrame, path: str) -> bool:
    return append(quality, path, schemas.QUALITY)


def load_quality(spark: SparkSession, path: str) -> DataFrame:
    """Quality history; empty if nothing was recorded yet."""
    if not _has_files(spark, path):
        return spark.createDataFrame([], schemas.QUALITY)
    return load(spark, path, schemas.QUALITY)


def append_alerts(alerts: DataFrame, path: str) -> bool:
    """Append alerts as JSON lines; nothing is written for no rows."""
    return append_once(alerts.select(*schemas.ALERTS.names), path, DataFrameWriter.json) > 0


def load_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Alert history; empty if there was no alert yet."""
    if not _has_files(spark, path):
        return spark.createDataFrame([], schemas.ALERTS)
    return spark.read.schema(schemas.ALERTS).json(path)
