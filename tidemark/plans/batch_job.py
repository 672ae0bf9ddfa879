"""The nine stages as one Spark application: land, enrich, check, merge, join.

Stages run in order and the first failure stops the run.  Whatever happens, the
run leaves one ledger row, a row per completed stage, and alerts where due.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.text import utc_wall_clock
from tidemark.operators import alerts as alerting
from tidemark.operators import checks
from tidemark.operators.enrich import enrich_posts, prune_users
from tidemark.operators.ledger import run_records
from tidemark.operators.reports import post_user_mart
from tidemark.sources import history, landing, tables
from tidemark.sources.keyed import KeyedTable


@dataclass(frozen=True)
class Layout:
    """Folders of one pipeline below ``root``."""

    root: str

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def staged_posts(self) -> str:
        return f"{self.root}/staging/posts"

    @property
    def posts(self) -> str:
        return f"{self.root}/curated/posts"

    @property
    def users(self) -> str:
        return f"{self.root}/curated/users"

    @property
    def mart(self) -> str:
        return f"{self.root}/curated/post_user_analytics"

    @property
    def runs(self) -> str:
        return f"{self.root}/audit/runs"

    @property
    def stage_runs(self) -> str:
        return f"{self.root}/audit/stage_runs"

    @property
    def quality(self) -> str:
        return f"{self.root}/audit/quality"

    @property
    def alerts(self) -> str:
        return f"{self.root}/audit/alerts"


@dataclass
class BatchResult:
    run_id: str
    status: str = "SUCCESS"
    failed_stage: str | None = None
    error: str | None = None
    durations: dict[str, float] = field(default_factory=dict)
    changes: dict[str, int] = field(default_factory=dict)


def transform_posts(
    spark: SparkSession, raw_root: str, now: datetime, layout: str = "lines"
) -> DataFrame:
    """The latest landed posts, enriched; unknown fields are kept for the schema check."""
    path = landing.latest_snapshot(spark, raw_root, "posts")
    raw = landing.read_all_fields(spark, path, schemas.RAW_POSTS, layout)
    return enrich_posts(raw, path, F.lit(now))


def transform_users(spark: SparkSession, raw_root: str, layout: str = "lines") -> DataFrame:
    """The latest landed users, reduced to the columns in use."""
    path = landing.latest_snapshot(spark, raw_root, "users")
    return prune_users(landing.read_landed(spark, path, schemas.RAW_USERS, layout))


def check_users(users: DataFrame) -> DataFrame:
    return checks.validation_suite(
        users, key="user_id", required=schemas.USERS.names, not_null=["user_id"], lengths={}
    )


def check_staged(posts: DataFrame) -> DataFrame:
    return checks.validation_suite(
        posts, required=list(schemas.POST_TYPES), not_null=[], lengths={}
    )


def merge_posts(spark: SparkSession, staged: DataFrame, root: str) -> dict[str, int]:
    """Merge into the files of the curated posts that the batch touches; the change counts.

    They are observed after the last shuffle of the write itself, where each task reports
    once even if it is retried.
    """
    return KeyedTable(spark, root, "post_id").merge(staged).changes


def run_batch(
    spark: SparkSession,
    layout: Layout,
    now: datetime,
    land_posts: Callable[[], DataFrame] | None = None,
    land_users: Callable[[], DataFrame] | None = None,
    landing_layout: str = "lines",
    publish_to: str | None = None,
) -> BatchResult:
    """Run the nine stages once.

    ``land_posts`` and ``land_users`` supply records to land; without them the
    landing zone is filled by someone else.  ``now`` (UTC) names the run and its
    snapshots and is the processing time of its rows.
    """
    now = now.replace(tzinfo=UTC) if now.tzinfo is None else now.astimezone(UTC)
    result = BatchResult(run_id=f"{now:%Y%m%d_%H%M%S_%f}")
    raw = layout.raw

    def ingest(entity: str, schema, records: Callable[[], DataFrame] | None) -> None:
        if records is not None:
            landing.land(records(), raw, entity, now)
        path = landing.latest_snapshot(spark, raw, entity)
        checks.assert_passed(landing.landing_sanity(spark, path, schema, landing_layout))

    def staged() -> DataFrame:
        return tables.read_table(spark, layout.staged_posts)

    def users() -> DataFrame:
        return tables.read_table(spark, layout.users)

    def stage_posts() -> None:
        tables.overwrite_table(
            transform_posts(spark, raw, now, landing_layout), layout.staged_posts
        )
        checks.assert_passed(check_staged(staged()))

    def stage_users() -> None:
        tables.overwrite_table(transform_users(spark, raw, landing_layout), layout.users)
        checks.assert_passed(check_users(users()))

    def validate_posts() -> None:
        checks.assert_passed(checks.validation_suite(staged()))
        metrics = checks.quality_metrics(staged()).select(
            F.lit(result.run_id).alias("run_id"), F.lit(now).alias("recorded_at"), "*"
        )
        history.append_quality(metrics, layout.quality)

    def validate_relationship() -> None:
        checks.assert_passed(checks.relationship(staged(), users(), "user_id"))

    def load() -> None:
        result.changes = merge_posts(spark, staged(), layout.posts)

    def build_mart() -> None:
        posts = tables.read_current(spark, layout.posts)
        tables.publish_version(
            post_user_mart(posts, users()), layout.mart, allow_empty=False
        )

    actions = [
        lambda: ingest("posts", schemas.RAW_POSTS, land_posts),
        lambda: ingest("users", schemas.RAW_USERS, land_users),
        stage_posts,
        stage_users,
        validate_posts,
        validate_relationship,
        lambda: checks.assert_passed(checks.exact_schema(staged())),
        load,
        build_mart,
    ]
    try:
        for name, action in zip(schemas.STAGES, actions, strict=True):
            started = time.perf_counter()
            action()
            result.durations[name] = time.perf_counter() - started
        if publish_to is not None:
            tables.publish(tables.read_current(spark, layout.mart), publish_to)
    except Exception as error:
        done = len(result.durations)
        result.status = "FAILED"
        result.error = str(error)
        result.failed_stage = schemas.STAGES[done] if done < len(schemas.STAGES) else None
    _record(spark, layout, now, result)
    return result


def _record(spark: SparkSession, layout: Layout, now: datetime, result: BatchResult) -> None:
    """Append this run's own ledger rows and alerts: a handful of rows."""
    total = sum(result.durations.values())
    stage_rows = spark.createDataFrame(
        [(result.run_id, name, seconds) for name, seconds in result.durations.items()],
        schemas.STAGE_RUNS,
    )
    history.append_stage_runs(stage_rows, layout.stage_runs)
    facts = spark.range(1).select(
        F.lit(result.run_id).alias("run_id"),
        F.lit(now).alias("started_at"),
        (F.lit(now) + F.make_dt_interval(secs=F.lit(round(total, 6)))).alias("finished_at"),
        F.lit(result.status).alias("status"),
        F.lit(total).alias("total_duration"),
        F.lit(len(schemas.STAGES)).alias("total_stages"),
        F.lit(len(result.durations)).alias("successful_stages"),
        F.lit(result.failed_stage).cast("string").alias("failed_stage"),
        F.lit(result.error).cast("string").alias("error"),
    )
    quality = history.load_quality(spark, layout.quality).filter(
        F.col("run_id") == result.run_id
    )
    attempts = spark.createDataFrame(
        [
            (result.run_id, name, "SUCCESS" if name in result.durations else "FAILED", 1, 0)
            for name in [*result.durations, result.failed_stage]
            if name is not None
        ],
        "run_id string, stage_name string, status string, attempts long, retries long",
    ).withColumn("error", F.lit(result.error).cast("string"))
    places = F.array_position(F.array(*[F.lit(s) for s in schemas.STAGES]), F.col("stage_name"))
    history.append_runs(
        run_records(
            facts, stage_rows.withColumn("place", places), quality, attempts, order="place"
        ),
        layout.runs,
    )
    at = utc_wall_clock(F.lit(now))
    history.append_alerts(
        alerting.all_alerts(
            alerting.failure_alerts(facts, at),
            alerting.quality_alerts(quality, at),
            alerting.retry_alerts(attempts, at),
        ),
        layout.alerts,
    )
