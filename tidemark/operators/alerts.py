"""Alerts derived from the run ledger, quality metrics, SLA violations and retries.

``at`` is the alert time: a literal batch time or an event-time column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tidemark.functions.numeric import as_column
from tidemark.functions.text import compact_timestamp, iso_timestamp, labelled, lines
from tidemark.operators.merge import union_drifted
from tidemark.operators.runs import FAILED, HEALTHY, WARNING, failed_runs
from tidemark.schemas import RETRYABLE_STAGES

# Type and severity of each kind of alert, and the heading of a text.
PIPELINE_FAILURE = ("PIPELINE_FAILURE", "CRITICAL")
DATA_QUALITY_FAILURE = ("DATA_QUALITY_FAILURE", "HIGH")
SLA_VIOLATION = ("SLA_VIOLATION", "WARNING")
RETRY_EXHAUSTED = ("RETRY_EXHAUSTED", "CRITICAL")
HEADING = "🚨 PIPELINE ALERT"


def status_alerts(runs: DataFrame) -> DataFrame:
    """FAILED gives CRITICAL, WARNING gives WARNING, HEALTHY gives no row.

    Any other status, or none, stops the job.
    """
    status = F.col("status")
    severity = (
        F.when(status == FAILED, "CRITICAL")
        .when(status == WARNING, "WARNING")
        .otherwise(
            F.raise_error(
                F.concat(
                    F.lit("Unknown pipeline status: "), F.coalesce(status, F.lit("null"))
                )
            ).cast("string")
        )
    )
    return runs.filter(~status.eqNullSafe(F.lit(HEALTHY))).select(
        severity.alias("severity"), "status", "run_id", "failed_stage", "error", "total_duration"
    )


def formatted(alerts: DataFrame) -> DataFrame:
    """Add ``text``, the readable form; empty or null optional fields are left out."""
    duration = F.concat(F.lit("Duration: "), F.col("total_duration").cast("string"), F.lit("s"))
    text = lines(
        F.lit(HEADING),
        F.lit(""),
        F.concat(F.lit("Severity: "), F.col("severity")),
        F.concat(F.lit("Status: "), F.col("status")),
        F.concat(F.lit("Run ID: "), F.coalesce(F.col("run_id"), F.lit("None"))),
        labelled("Failed Stage", F.col("failed_stage")),
        labelled("Error", F.col("error")),
        duration,
    )
    return alerts.withColumn("text", text)


def envelope(
    df: DataFrame,
    at: Column | str,
    kind: tuple[str, str],
    message: Column,
    stage: Column | None = None,
    details: dict[str, Column] | None = None,
) -> DataFrame:
    """The eight alert fields; ``details`` becomes a text map, empty when None."""
    at = as_column(at)
    alert_type, severity = kind
    if details:
        pairs = [item for k, v in details.items() for item in (F.lit(k), v.cast("string"))]
        detail_map = F.create_map(*pairs)
    else:
        detail_map = F.create_map().cast("map<string,string>")
    return df.select(
        compact_timestamp(at).alias("alert_id"),
        iso_timestamp(at).alias("timestamp"),
        F.lit(alert_type).alias("alert_type"),
        F.lit(severity).alias("severity"),
        F.col("run_id").cast("string").alias("run_id"),
        (F.lit(None).cast(StringType()) if stage is None else stage).alias("stage"),
        message.alias("message"),
        detail_map.alias("details"),
    )


def failure_alerts(runs: DataFrame, at: Column | str) -> DataFrame:
    stage = F.col("failed_stage")
    return envelope(
        failed_runs(runs),
        at,
        PIPELINE_FAILURE,
        # A run that failed after its last stage has no failed stage to name.
        F.concat(F.lit("Pipeline failed during "), F.coalesce(stage, F.lit("None"))),
        stage,
        {"error": F.coalesce(F.col("error"), F.lit("None"))},
    )


def quality_alerts(quality: DataFrame, at: Column | str) -> DataFrame:
    """For quality rows that did not pass, with their metrics as details."""
    names = ["records_checked", "null_values", "duplicate_post_ids", "quality_status"]
    return envelope(
        quality.filter(~F.col("quality_status").eqNullSafe(F.lit("PASSED"))),
        at,
        DATA_QUALITY_FAILURE,
        F.lit("Data quality validation failed"),
        details={name: F.col(name) for name in names},
    )


def sla_alerts(violations: DataFrame, at: Column | str) -> DataFrame:
    duration, limit = F.col("duration"), F.col("sla_threshold")
    return envelope(
        violations,
        at,
        SLA_VIOLATION,
        F.concat(F.col("stage_name"), F.lit(" exceeded its SLA")),
        F.col("stage_name"),
        {"duration": duration, "sla": limit, "exceeded_by": duration - limit},
    )


def retry_alerts(
    attempts: DataFrame,
    at: Column | str,
    retryable_stages: Sequence[str] = tuple(RETRYABLE_STAGES),
) -> DataFrame:
    """For retryable stages that failed all their attempts.

    ``attempts``: ``(run_id, stage_name, status, attempts, error)``.
    """
    exhausted = attempts.filter(
        ~F.col("status").eqNullSafe(F.lit("SUCCESS")) & F.col("stage_name").isin(*retryable_stages)
    )
    return envelope(
        exhausted,
        at,
        RETRY_EXHAUSTED,
        F.concat(F.lit("Retry attempts exhausted for "), F.col("stage_name")),
        F.col("stage_name"),
        {"attempts": F.col("attempts"), "error": F.coalesce(F.col("error"), F.lit("None"))},
    )


def all_alerts(*alerts: DataFrame) -> DataFrame:
    return union_drifted(*alerts)


def alert_count(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count("*").alias("alert_count"))


def alert_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("alert_type", "severity").agg(F.count("*").alias("alert_count"))
