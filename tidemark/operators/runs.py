"""Statistics over the run ledger: rates, extremes, health and eligibility."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from tidemark.functions.numeric import exact_avg, exceeds, measure, percentage
from tidemark.schemas import MAX_RETRIES, RETRYABLE_STAGES, SLOW_RUN_SECONDS

SUCCESS, FAILED, WARNING, HEALTHY = "SUCCESS", "FAILED", "WARNING", "HEALTHY"
ORDER = ("run_id",)


def _count_status(status: str):
    return F.count_if(F.col("status") == status)


def _mean_duration():
    """0.0 without runs; null if there are runs but none was measured."""
    mean = exact_avg(measure("total_duration"))
    return F.when(F.count("*") > 0, mean).otherwise(0.0).alias("average_duration")


def total_runs(runs: DataFrame) -> DataFrame:
    return runs.agg(F.count("*").alias("total_runs"))


def status_counts(runs: DataFrame) -> DataFrame:
    return runs.agg(
        _count_status(SUCCESS).alias("successful_runs"),
        _count_status(FAILED).alias("failed_runs"),
    )


def success_rate(runs: DataFrame) -> DataFrame:
    return runs.agg(percentage(_count_status(SUCCESS), F.count("*")).alias("success_rate"))


def average_duration(runs: DataFrame) -> DataFrame:
    return runs.agg(_mean_duration())


def run_summary(runs: DataFrame) -> DataFrame:
    """Counts, success rate and mean duration as one row from one scan."""
    return runs.agg(
        F.count("*").alias("total_runs"),
        _count_status(SUCCESS).alias("successful_runs"),
        _count_status(FAILED).alias("failed_runs"),
        percentage(_count_status(SUCCESS), F.count("*")).alias("success_rate"),
        _mean_duration(),
    )


def extreme_run(
    runs: DataFrame, slowest: bool, order_by: Sequence[str] = ORDER, status: str | None = None
) -> DataFrame:
    """Fastest or slowest run, whole row.  Failed runs take part unless ``status`` is given."""
    if status is not None:
        runs = runs.filter(F.col("status") == status)
    timed = runs.withColumn("total_duration", measure("total_duration"))
    duration = F.col("total_duration").desc() if slowest else F.col("total_duration").asc()
    return (
        timed.filter(F.col("total_duration").isNotNull()).orderBy(duration, *order_by).limit(1)
    )


def latest_run(runs: DataFrame, order_by: Sequence[str] = ORDER) -> DataFrame:
    return (
        runs.filter(F.col("started_at").isNotNull())
        .orderBy(F.col("started_at").desc(), *order_by)
        .limit(1)
    )


def failed_runs(runs: DataFrame) -> DataFrame:
    return runs.filter(F.col("status") == FAILED)


def slow_runs(runs: DataFrame, threshold: float = SLOW_RUN_SECONDS) -> DataFrame:
    return runs.filter(exceeds(runs, "total_duration", threshold))


def _slow(threshold: float):
    return F.count_if(measure("total_duration") > threshold)


def _health(failed, slow):
    return F.when(failed > 0, FAILED).when(slow > 0, WARNING).otherwise(HEALTHY)


def health(runs: DataFrame, threshold: float = SLOW_RUN_SECONDS) -> DataFrame:
    """FAILED if any run ever failed, else WARNING if any was slow, else HEALTHY."""
    return runs.agg(_health(_count_status(FAILED), _slow(threshold)).alias("health"))


def monitoring_report(
    runs: DataFrame, threshold: float = SLOW_RUN_SECONDS, order_by: str = "run_id"
) -> DataFrame:
    """Run, failed and slow counts, health and the latest run, as one row.

    :func:`failed_runs` and :func:`slow_runs` list the runs behind the counts.
    """
    row = F.struct("run_id", "status", "started_at", "total_duration")
    # Smallest distance from a fixed instant back to the start: latest start first,
    # and the smallest order value on a tie.
    zoned = isinstance(runs.schema["started_at"].dataType, TimestampType)
    if zoned:
        age = -F.unix_micros("started_at")
    else:
        age = F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'") - F.col("started_at")
    rank = F.when(F.col("started_at").isNotNull(), F.struct(age, F.col(order_by)))
    return runs.agg(
        F.count("*").alias("total_runs"),
        _count_status(FAILED).alias("failed_runs"),
        _slow(threshold).alias("slow_runs"),
        _health(_count_status(FAILED), _slow(threshold)).alias("health"),
        F.min_by(row, rank).alias("latest"),
    ).select(
        "total_runs",
        "failed_runs",
        "slow_runs",
        "health",
        F.col("latest.run_id").alias("latest_run_id"),
        F.col("latest.status").alias("latest_status"),
        F.col("latest.started_at").alias("latest_started_at"),
        F.col("latest.total_duration").alias("latest_total_duration"),
    )


def full_monitoring_report(
    runs: DataFrame, threshold: float = SLOW_RUN_SECONDS, order_by: str = "run_id"
) -> DataFrame:
    """The report with its lists, as rows with a section.

    ``summary`` has the counts and health, ``latest`` the latest run, and ``failed`` and
    ``slow`` a row for each such run, which stays where it is: the ledger is scanned once
    for the former and once, filtered, for the lists.
    """
    report = monitoring_report(runs, threshold, order_by)
    text, number = F.lit(None).cast("string"), F.lit(None).cast("long")
    counts = ("total_runs", "failed_runs", "slow_runs")
    started = F.lit(None).cast(runs.schema["started_at"].dataType)
    summary = F.struct(
        F.lit("summary").alias("section"), text.alias("run_id"), text.alias("status"),
        started.alias("started_at"), F.lit(None).cast("double").alias("total_duration"),
        *[F.col(c) for c in counts], F.col("health"),
    )
    latest = F.struct(
        F.lit("latest").alias("section"),
        F.col("latest_run_id").alias("run_id"),
        F.col("latest_status").alias("status"),
        F.col("latest_started_at").alias("started_at"),
        measure("latest_total_duration").alias("total_duration"),
        *[number.alias(c) for c in counts],
        text.alias("health"),
    )
    sections = F.when(F.col("latest_run_id").isNull(), F.array(summary)).otherwise(F.array(summary, latest))
    head = report.select(F.inline(sections)).withColumns({"failed_stage": text, "error": text})
    failed, slow = F.col("status") == FAILED, measure("total_duration") > threshold
    of = F.array_compact(F.array(F.when(failed, F.lit("failed")), F.when(slow, F.lit("slow"))))
    listed = runs.filter(failed | slow).select(
        F.explode(of).alias("section"), "run_id", "status", "started_at",
        measure("total_duration").alias("total_duration"),
        *[number.alias(c) for c in counts], text.alias("health"), "failed_stage", "error",
    )
    return head.unionByName(listed)


def last_state(
    runs: DataFrame, by: str | None = None, order_by: Sequence[str] = ("run_id",)
) -> DataFrame:
    """Last finished run: id, status, time, and failed stage and error if it failed.

    ``by`` names a column that separates several pipelines in one ledger.
    """
    finished = runs.filter(F.col("finished_at").isNotNull())
    newest = [F.col("finished_at").desc(), *[F.col(c).desc() for c in order_by]]
    if by is None:
        last = finished.orderBy(*newest).limit(1)
    else:
        window = Window.partitionBy(by).orderBy(*newest)
        last = finished.withColumn("_r", F.row_number().over(window)).filter("_r = 1")
    failed = F.col("status") == FAILED
    columns = [
        F.col("run_id").alias("last_run_id"),
        F.col("status").alias("last_status"),
        F.col("finished_at").alias("last_finished_at"),
        F.when(failed, F.col("failed_stage")).alias("failed_stage"),
        F.when(failed, F.col("error")).alias("error"),
        (F.col("status") == SUCCESS).alias("was_successful"),
    ]
    return last.select(*([by] if by else []), *columns)


def eligibility(
    state: DataFrame, retry_count: int | str = 0, max_retries: int = MAX_RETRIES
) -> DataFrame:
    """Skip after a success; retry after a failure while retries are left.

    ``retry_count`` is a number or the name of a column of ``state``.
    """
    used = F.col(retry_count) if isinstance(retry_count, str) else F.lit(retry_count)
    return state.withColumns(
        {
            "should_skip": F.coalesce(F.col("last_status") == SUCCESS, F.lit(False)),
            "should_retry": F.coalesce(
                (F.col("last_status") == FAILED) & (used < max_retries), F.lit(False)
            ),
        }
    )


def failure_breakdown(
    runs: DataFrame, retryable_stages: Sequence[str] = tuple(RETRYABLE_STAGES)
) -> DataFrame:
    """Failed runs by stage and by whether that stage may be retried."""
    retryable = F.coalesce(F.col("failed_stage").isin(*retryable_stages), F.lit(False))
    return (
        failed_runs(runs)
        .groupBy(
            "failed_stage",
            F.when(retryable, "RETRYABLE").otherwise("NON_RETRYABLE").alias("category"),
        )
        .agg(F.count("*").alias("failures"))
    )
