"""The composed job and its streaming forms, over landed copies of the tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tidemark import schemas
from tidemark.bindings.loads import PAIR, _merge_sql, _orders, _recomputed
from tidemark.bindings.registry import query
from tidemark.bindings.tables import (
    CLOCK,
    LIMITS,
    MEAN,
    STAGE_RUNS,
    THRESHOLDS,
    clock_sql,
    customers,
    orders,
    rounded,
    table,
)
from tidemark.functions.text import utc_instant, utc_wall_clock
from tidemark.plans.batch_job import Layout, run_batch, transform_posts, transform_users
from tidemark.plans.scratch import scratch_dir
from tidemark.sources import history, landing, tables
from tidemark.streaming import jobs as streams

FIRST, SECOND = datetime(2026, 8, 12, 9, 30), datetime(2026, 8, 12, 10, 30)


def _raw_orders(spark, sf_dir):
    posts = orders(spark, sf_dir).withColumnsRenamed({"user_id": "userId", "post_id": "id"})
    return posts.select("userId", "id", "title", "body")


def _raw_documents(spark, sf_dir):
    """Documents as posts whose authors are no users."""
    return table(spark, sf_dir, "documents").select(
        F.lit(-1).cast("long").alias("userId"),
        F.col("doc_id").alias("id"),
        F.col("source").alias("title"),
        F.col("text").alias("body"),
    )


def _raw_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        F.lit(-2).cast("long").alias("userId"),
        F.col("page_id").alias("id"),
        F.col("url").alias("title"),
        F.col("html").alias("body"),
    )


def _raw_users(spark, sf_dir):
    return customers(spark, sf_dir).withColumnRenamed("user_id", "id")


@query(
    "n1_transform_posts",
    """SELECT o_orderkey AS post_id, o_custkey AS user_id,
              CAST(length(o_orderpriority) AS BIGINT) AS title_length,
              CAST(length(concat_ws(' ', o_orderstatus, o_orderpriority)) AS BIGINT) AS body_length,
              'jsonplaceholder_api' AS source_system,
              'posts_20260812_103000.json' AS source_file FROM orders""",
)
def _(spark, sf_dir):
    raw = scratch_dir(spark, "n1")
    landing.land(_raw_documents(spark, sf_dir), raw, "posts", FIRST)
    landing.land(_raw_orders(spark, sf_dir), raw, "posts", SECOND)
    posts = transform_posts(spark, raw, SECOND)
    return posts.select(
        "post_id",
        "user_id",
        F.col("title_length").cast("long").alias("title_length"),
        F.col("body_length").cast("long").alias("body_length"),
        "source_system",
        F.element_at(F.split("source_file", "/"), -1).alias("source_file"),
    )


@query(
    "n2_transform_users",
    """SELECT c_custkey AS user_id, c_name AS name, c_mktsegment AS username,
              lower(c_name) || '@example.com' AS email FROM customer""",
)
def _(spark, sf_dir):
    raw = scratch_dir(spark, "n2")
    users = _raw_users(spark, sf_dir).withColumn("company", F.lit("dropped"))
    landing.land(users, raw, "users", FIRST)
    return transform_users(spark, raw).select("user_id", "name", "username", "email")


@query(
    "n3_batch_mart",
    """SELECT o.o_orderkey AS post_id, o.o_custkey AS user_id, c.c_name AS name,
              o.o_orderpriority AS title, '2026-08-12 09:30:00.000000' AS processed_at
       FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""",
)
def _(spark, sf_dir):
    layout = Layout(scratch_dir(spark, "n3"))
    result = run_batch(
        spark,
        layout,
        FIRST,
        lambda: _raw_orders(spark, sf_dir),
        lambda: _raw_users(spark, sf_dir),
    )
    if result.status != "SUCCESS":
        raise RuntimeError(f"{result.failed_stage}: {result.error}")
    mart = tables.read_current(spark, layout.mart)
    return mart.select(
        "post_id", "user_id", "name", "title",
        F.date_format(utc_wall_clock("processed_at"), CLOCK).alias("processed_at"),
    )


@query(
    "n3_batch_ledger",
    """SELECT '20260812_103000_000000' AS run_id, 'FAILED' AS status,
              CAST(9 AS BIGINT) AS total_stages, CAST(5 AS BIGINT) AS successful_stages,
              'RELATIONSHIP VALIDATION' AS failed_stage,
              'Posts contain user_id values with no matching user' AS error,
              count(*) AS records_checked,
              CAST(count(*) - count(DISTINCT doc_id) AS BIGINT) AS duplicate_post_ids,
              'PASSED' AS quality_status, 'PIPELINE_FAILURE' AS alert_type
       FROM documents""",
)
def _(spark, sf_dir):
    """A run whose posts have no users stops at the relationship check."""
    layout = Layout(scratch_dir(spark, "n3"))
    run_batch(
        spark,
        layout,
        SECOND,
        lambda: _raw_documents(spark, sf_dir),
        lambda: _raw_users(spark, sf_dir),
    )
    ledger_rows = history.load(spark, layout.runs, schemas.RUNS)
    alerts = history.load_alerts(spark, layout.alerts).select("run_id", "alert_type")
    return ledger_rows.join(alerts, "run_id").select(
        "run_id",
        "status",
        "total_stages",
        "successful_stages",
        "failed_stage",
        "error",
        "records_checked",
        "duplicate_post_ids",
        "quality_status",
        "alert_type",
    )


# -- streams -------------------------------------------------------------------------


@query(
    "p1_landed_stream",
    """SELECT doc_id AS post_id, CAST(length(source) AS BIGINT) AS title_length,
              CAST(length(text) AS BIGINT) AS body_length, 'posts_20260812_093000.json' AS source_file
       FROM documents
       UNION ALL SELECT page_id, CAST(length(url) AS BIGINT), CAST(length(html) AS BIGINT),
              'posts_20260812_103000.json' FROM pages""",
)
def _(spark, sf_dir):
    """Two snapshots land one after the other; the second start reads only the second."""
    root = scratch_dir(spark, "p1")
    for at, records in ((FIRST, _raw_documents), (SECOND, _raw_pages)):
        landing.land(records(spark, sf_dir), f"{root}/raw", "posts", at)
        raw = streams.landed_stream(spark, f"{root}/raw/posts_*.json")
        job = streams.append_stream(
            streams.enriched_stream(raw), f"{root}/posts", f"{root}/checkpoint"
        )
        job.awaitTermination()
    posts = spark.read.parquet(f"{root}/posts")
    return posts.select(
        "post_id",
        F.col("title_length").cast("long").alias("title_length"),
        F.col("body_length").cast("long").alias("body_length"),
        F.element_at(F.split("source_file", "/"), -2).alias("source_file"),
    )


_TOTALS = StructType(
    [
        StructField("post_id", LongType()),
        StructField("title", StringType()),
        StructField("total", DoubleType()),
    ]
)


@query(
    "p2_merge_stream",
    "WITH {pair} SELECT post_id, title, total FROM ({merge})".format(
        pair=PAIR, merge=_merge_sql("o", "r", "false")
    ),
)
def _(spark, sf_dir):
    """Orders arrive first, their recomputed totals in a later batch."""
    root = scratch_dir(spark, "p2")
    for at, records in ((FIRST, _orders), (SECOND, _recomputed)):
        rows = records(spark, sf_dir).withColumn("total", F.col("total").cast("double"))
        landing.land(rows, f"{root}/raw", "posts", at)
        incoming = streams.landed_stream(spark, f"{root}/raw/posts_*.json", _TOTALS)
        job = streams.merge_stream(
            incoming, f"{root}/posts", f"{root}/checkpoint", "post_id", ["total"], lineage=False
        )
        job.awaitTermination()
    return tables.read_current(spark, f"{root}/posts")


def _event_stream(spark, sf_dir):
    """The events table as a stream of stage executions."""
    schema = table(spark, sf_dir, "events").schema
    events = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    return events.select(
        (F.col("user_id") * 100 + F.dayofmonth("ts")).cast("string").alias("run_id"),
        F.col("event_type").alias("stage_name"),
        F.col("value").alias("duration"),
        utc_instant("ts").alias("at"),
    )


@query(
    "p3_violation_stream",
    f"""WITH {STAGE_RUNS}, {LIMITS}
        SELECT run_id, s.stage_name, duration, sla_threshold
        FROM stage_runs s JOIN limits l ON s.stage_name = l.stage_name
        WHERE duration > sla_threshold""",
)
def _(spark, sf_dir):
    root = scratch_dir(spark, "p3")
    found = streams.violation_stream(_event_stream(spark, sf_dir), THRESHOLDS)
    streams.append_stream(found, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query(
    "p4_windowed_stage_summary",
    f"""WITH {STAGE_RUNS}, days AS (SELECT *, date_trunc('day', ts) AS day FROM stage_runs),
        closed AS (SELECT * FROM days
          WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) FROM stage_runs) - INTERVAL 1 HOUR)
        SELECT {clock_sql("day::TIMESTAMP")} AS window_start, stage_name,
               count(duration) AS executions, {rounded(MEAN, 3)} AS average_duration,
               {rounded("min(duration)", 3)} AS minimum_duration,
               {rounded("max(duration)", 3)} AS maximum_duration
        FROM closed GROUP BY day, stage_name""",
)
def _(spark, sf_dir):
    root = scratch_dir(spark, "p4")
    summary = streams.windowed_stage_summary(_event_stream(spark, sf_dir), "at")
    streams.append_stream(summary, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    closed = spark.read.parquet(f"{root}/out")
    start = F.date_format(utc_wall_clock("window_start"), CLOCK)
    return closed.withColumn("window_start", start).drop("window_end")
