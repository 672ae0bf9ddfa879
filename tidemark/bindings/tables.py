"""The roles of posts, users, runs and stage executions, played by the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numeric import exact_sum
from tidemark.functions.text import utc_instant
from tidemark.operators.ledger import failed_stage

STAGES = ["view", "click", "purchase", "signup", "error"]
RETRYABLE = ["view", "click"]
THRESHOLDS = {"view": 60.0, "click": 150.0, "error": 500.0, "refund": 10.0}
TOTAL_STAGES = len(STAGES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as posts; the source is the author."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("post_id"),
        F.col("source").alias("user_id"),
        F.col("lang").alias("title"),
        F.col("text").alias("body"),
        F.length("lang").cast("long").alias("title_length"),
        F.col("n_chars").alias("body_length"),
    )


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as posts; the host is the author and the address the title."""
    return table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("post_id"),
        F.split_part("url", F.lit("/"), F.lit(3)).alias("user_id"),
        F.col("url").alias("title"),
        F.col("html").alias("body"),
        F.length("url").cast("long").alias("title_length"),
        F.length("html").cast("long").alias("body_length"),
    )


PAGES = """pages_as_posts AS (
  SELECT page_id AS post_id, split_part(url, '/', 3) AS user_id, url AS title, html AS body,
         CAST(length(url) AS BIGINT) AS title_length, CAST(length(html) AS BIGINT) AS body_length
  FROM pages)"""


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as posts of customers."""
    body = F.concat_ws(" ", "o_orderstatus", "o_orderpriority")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("post_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderpriority").alias("title"),
        body.alias("body"),
        F.length("o_orderpriority").cast("long").alias("title_length"),
        F.length(body).cast("long").alias("body_length"),
        F.col("o_orderdate").alias("processed_at"),
    )


ORDERS = """posts AS (
  SELECT o_orderkey AS post_id, o_custkey AS user_id, o_orderpriority AS title,
         concat_ws(' ', o_orderstatus, o_orderpriority) AS body,
         CAST(length(o_orderpriority) AS BIGINT) AS title_length,
         CAST(length(concat_ws(' ', o_orderstatus, o_orderpriority)) AS BIGINT) AS body_length,
         o_orderdate AS processed_at
  FROM orders)"""


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as users."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("username"),
        F.concat(F.lower("c_name"), F.lit("@example.com")).alias("email"),
        F.col("c_nationkey").cast("string").alias("phone"),
        F.col("c_acctbal").cast("string").alias("website"),
    )


CUSTOMERS = """users AS (
  SELECT c_custkey AS user_id, c_name AS name, c_mktsegment AS username,
         lower(c_name) || '@example.com' AS email
  FROM customer)"""


def stage_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as stage executions: one run per user and day of the month."""
    return table(spark, sf_dir, "events").select(
        (F.col("user_id") * 100 + F.dayofmonth("ts")).cast("string").alias("run_id"),
        F.col("event_type").alias("stage_name"),
        F.col("value").alias("duration"),
        "ts",
        "event_id",
    )


STAGE_RUNS = """stage_runs AS (
  SELECT CAST(user_id * 100 + day(ts) AS VARCHAR) AS run_id, event_type AS stage_name,
         value AS duration, ts, event_id
  FROM events)"""


def is_failure():
    """An execution that counts as a failed one."""
    return (F.col("stage_name") == "error") & (F.col("duration") > 50)


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run ledger's facts, from one aggregation over all stage executions."""
    outcome = failed_stage(
        stage_runs(spark, sf_dir),
        STAGES,
        ~is_failure(),
        started_at=F.min("ts"),
        finished_at=F.max("ts"),
        total_duration=exact_sum("duration"),
        failed=F.max(is_failure()),
    )
    stage = F.when(F.col("failed"), F.col("failed_stage"))
    return outcome.select(
        "run_id",
        utc_instant("started_at").alias("started_at"),
        utc_instant("finished_at").alias("finished_at"),
        F.when(F.col("failed"), "FAILED").otherwise("SUCCESS").alias("status"),
        "total_duration",
        F.lit(TOTAL_STAGES).cast("long").alias("total_stages"),
        "successful_stages",
        stage.alias("failed_stage"),
        F.when(
            F.col("failed"),
            F.concat(F.coalesce(stage, F.lit("None")), F.lit(" failed (exit code 1)")),
        ).alias("error"),
    )


_FAILURE = "(stage_name = 'error' AND duration > 50)"
RUNS = (
    STAGE_RUNS
    + """, run_facts AS (
  SELECT run_id, min(ts) AS started_at, max(ts) AS finished_at,
         CAST(sum(CAST(duration AS DECIMAL(18,2))) AS DOUBLE) AS total_duration,
         bool_or({failure}) AS failed,
         CAST(count(DISTINCT CASE WHEN NOT {failure} THEN stage_name END) AS BIGINT)
           AS successful_stages,
         CASE {cases} END AS open_stage
  FROM stage_runs GROUP BY run_id),
runs AS (
  SELECT run_id, started_at, finished_at,
         CASE WHEN failed THEN 'FAILED' ELSE 'SUCCESS' END AS status, total_duration,
         CAST({total} AS BIGINT) AS total_stages, successful_stages,
         CASE WHEN failed THEN open_stage END AS failed_stage,
         CASE WHEN failed THEN coalesce(open_stage, 'None') || ' failed (exit code 1)' END AS error
  FROM run_facts)""".format(
        failure=_FAILURE,
        total=TOTAL_STAGES,
        cases=" ".join(
            f"WHEN NOT coalesce(bool_or(stage_name = '{s}' AND NOT {_FAILURE}), false) THEN '{s}'"
            for s in STAGES
        ),
    )
)

LIMITS = "limits AS (SELECT * FROM (VALUES {}) AS t(stage_name, sla_threshold, ord))".format(
    ", ".join(f"('{s}', CAST({v} AS DOUBLE), {i})" for i, (s, v) in enumerate(THRESHOLDS.items()))
)
MEAN = "CAST(sum(CAST(duration AS DECIMAL(18,2))) AS DOUBLE) / count(duration)"


def rounded(expression: str, digits: int) -> str:
    scale = 10**digits
    return f"(round_even(({expression}) * {scale}.0::DOUBLE, 0) / {scale}.0::DOUBLE)"


def percent(part: str, whole: str) -> str:
    return (
        f"(CASE WHEN ({whole}) > 0 THEN "
        f"round_even(10000.0::DOUBLE * ({part}) / ({whole}), 0) / 100.0::DOUBLE "
        f"ELSE 0.0::DOUBLE END)"
    )


CLOCK = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def clock_sql(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"
