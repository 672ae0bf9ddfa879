"""Table schemas, the stage dimension and default limits."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**columns) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in columns.items()])


_text, _int, _long, _double, _time = (
    StringType(),
    IntegerType(),
    LongType(),
    DoubleType(),
    TimestampType(),
)

RAW_POSTS = _struct(userId=_long, id=_long, title=_text, body=_text)
RAW_USERS = _struct(
    id=_long, name=_text, username=_text, email=_text, phone=_text, website=_text
)
POSTS = _struct(
    user_id=_long,
    post_id=_long,
    title=_text,
    body=_text,
    title_length=_int,
    body_length=_int,
    processed_at=_time,
    source_system=_text,
    source_file=_text,
)
USERS = _struct(
    user_id=_long, name=_text, username=_text, email=_text, phone=_text, website=_text
)
MART_COLUMNS = [
    "post_id",
    "user_id",
    "name",
    "username",
    "email",
    "title",
    "body",
    "title_length",
    "body_length",
    "processed_at",
]
RUNS = _struct(
    run_id=_text,
    started_at=_time,
    finished_at=_time,
    status=_text,
    total_duration=_double,
    total_stages=_long,
    successful_stages=_long,
    failed_stage=_text,
    error=_text,
    fastest_stage=_text,
    slowest_stage=_text,
    fastest_duration=_double,
    slowest_duration=_double,
    records_checked=_long,
    null_values=_long,
    duplicate_post_ids=_long,
    quality_status=_text,
    total_retries=_long,
    retry_information=MapType(_text, _struct(attempts=_long, retries=_long)),
)
STAGE_RUNS = _struct(run_id=_text, stage_name=_text, duration=_double)
QUALITY = _struct(
    run_id=_text,
    recorded_at=_time,
    records_checked=_long,
    null_values=_long,
    duplicate_post_ids=_long,
    quality_status=_text,
)
ALERTS = _struct(
    alert_id=_text,
    timestamp=_text,
    alert_type=_text,
    severity=_text,
    run_id=_text,
    stage=_text,
    message=_text,
    details=MapType(_text, _text),
)

# Logical type of every column of a staged post.
POST_TYPES = {
    "user_id": "int",
    "post_id": "int",
    "title": "string",
    "body": "string",
    "title_length": "int",
    "body_length": "int",
    "processed_at": "datetime",
    "source_system": "string",
    "source_file": "string",
}

# The nine stages in order, each with its SLA in seconds.
STAGE_SLA = {
    "POST INGESTION": 2.0,
    "USER INGESTION": 2.0,
    "POST TRANSFORMATION": 2.0,
    "USER TRANSFORMATION": 2.0,
    "POST VALIDATION": 2.0,
    "RELATIONSHIP VALIDATION": 2.0,
    "SCHEMA VALIDATION": 2.0,
    "INCREMENTAL LOAD": 2.0,
    "ANALYTICS DATASET": 2.0,
}
STAGES = list(STAGE_SLA)

# Stages whose failure may be retried, lineage and limits.
RETRYABLE_STAGES = ["POST INGESTION", "USER INGESTION"]
SOURCE_SYSTEM = "jsonplaceholder_api"
LEGACY_SOURCE_FILE = "legacy_incremental_load"
FRESHNESS_HOURS = 24
SLOW_RUN_SECONDS = 5.0
MAX_RETRIES = 3
