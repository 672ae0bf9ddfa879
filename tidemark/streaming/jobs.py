"""Streams: landed posts, micro-batch merges, live SLA violations, windowed statistics.

Every stream takes what is available and ends (``availableNow``), so a timer or a
workflow tool may start it; its checkpoint remembers what has been read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark import schemas
from tidemark.functions.numeric import exact_avg, round_even
from tidemark.operators.enrich import enrich_posts
from tidemark.operators.merge import keep_first
from tidemark.operators.sla import violations
from tidemark.operators.stages import cleaned
from tidemark.plans.scratch import materialized
from tidemark.sources.keyed import KeyedTable
from tidemark.sources.tables import versions


def landed_stream(
    spark: SparkSession, pattern: str, schema: StructType = schemas.RAW_POSTS
) -> DataFrame:
    """Landing snapshots of JSON lines matching ``pattern``, each file once."""
    return spark.readStream.schema(schema).json(pattern)


def enriched_stream(raw: DataFrame, batch_time: Column | None = None) -> DataFrame:
    """Staged posts; one processing time per micro-batch unless one is given."""
    now = F.current_timestamp() if batch_time is None else batch_time
    return enrich_posts(raw, F.col("_metadata.file_path"), now)


def append_stream(
    df: DataFrame, path: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> StreamingQuery:
    """Write rows to Parquet exactly once, as far as they are available now."""
    writer = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return (writer.partitionBy(*partition_by) if partition_by else writer).start()


def merge_stream(
    incoming: DataFrame,
    root: str,
    checkpoint: str,
    key: str,
    newest: Sequence[Column | str],
    compare: Sequence[str] | None = None,
    lineage: bool = True,
) -> StreamingQuery:
    """Upsert every micro-batch into the keyed table at ``root``.

    A batch that repeats a key contributes its first row by ``newest``; it is written once
    and merged into the files that its keys fall into.  Its version names the stream (by
    the id that its checkpoint holds) and the batch, so a replay of a merged batch is
    passed over and a new checkpoint goes on from the table as it is.  Any number of
    streams and other writers may merge into one table at a time.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream, target = _stream_id(spark, checkpoint), KeyedTable(spark, root, key)
        if not _is_merged(target, stream, batch_id):
            rows = materialized(keep_first(batch, key, newest), "micro-batch")
            target.merge(rows, compare, lineage, owner=f"{stream}.{batch_id}")

    return (
        incoming.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _is_merged(target: KeyedTable, stream: str, batch_id: int) -> bool:
    """Whether the newest version that the stream has merged is of this batch."""
    for version in reversed(versions(target.spark, target.root)):
        owner, _, number = (target.owner(version) or "").rpartition(".")
        if owner == stream:
            return int(number) >= batch_id
    return False


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint for life."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def violation_stream(
    stage_runs: DataFrame, thresholds: Mapping[str, float] = schemas.STAGE_SLA
) -> DataFrame:
    """SLA violations as they arrive: a map-side lookup and a filter, no state."""
    return violations(stage_runs, thresholds)


def windowed_stage_summary(
    stage_runs: DataFrame, at: str, window: str = "1 day", lateness: str = "1 hour"
) -> DataFrame:
    """Stage statistics per time window; a window closes ``lateness`` after its end."""
    return (
        cleaned(stage_runs)
        .filter(F.col("stage_name").isNotNull())
        .withWatermark(at, lateness)
        .groupBy(F.window(at, window), "stage_name")
        .agg(
            F.count("duration").alias("executions"),
            round_even(exact_avg("duration"), 3).alias("average_duration"),
            round_even(F.min("duration"), 3).alias("minimum_duration"),
            round_even(F.max("duration"), 3).alias("maximum_duration"),
        )
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            "stage_name",
            "executions",
            "average_duration",
            "minimum_duration",
            "maximum_duration",
        )
    )
