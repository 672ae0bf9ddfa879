"""Run ledger rows, quality history, alerts, last state and eligibility."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.bindings.analytics import ATTEMPTS, CONFIGURED, RUN_STAGES, _attempts
from tidemark.bindings.registry import query
from tidemark.bindings.tables import (
    CLOCK,
    RETRYABLE,
    RUNS,
    STAGE_RUNS,
    STAGES,
    THRESHOLDS,
    clock_sql,
    is_failure,
    runs,
    stage_runs,
    table,
)
from tidemark.functions.text import utc_wall_clock
from tidemark.operators import alerts, checks, ledger, merge, sla
from tidemark.operators import runs as run_stats
from tidemark.plans.scratch import scratch_dir
from tidemark.sources import history

AT = "TIMESTAMP_NTZ'2026-08-12 09:30:00.000123'"
ALERT_ID, ALERT_TIME = "20260812_093000_000123", "2026-08-12T09:30:00.000123"
WITH_RUNS = f"WITH {RUNS}"
WITH_STAGES = f"WITH {STAGE_RUNS}"


def _clocks(df, *columns):
    return df.withColumns({c: F.date_format(utc_wall_clock(c), CLOCK) for c in columns})


# -- ledger --------------------------------------------------------------------------


@query("m1_stage_rows", f"{WITH_STAGES}, {ATTEMPTS} SELECT run_id, stage_name, longest AS duration FROM attempts")
def _(spark, sf_dir):
    """Stage rows from every run's own map of durations."""
    entries = F.map_from_entries(F.collect_list(F.struct("stage_name", "longest")))
    maps = _attempts(spark, sf_dir).groupBy("run_id").agg(entries.alias("stage_durations"))
    return ledger.stage_rows(maps)


def _quality(spark, sf_dir):
    """Quality of every run: a stage that ran twice in it is a duplicate."""
    per_stage = stage_runs(spark, sf_dir).groupBy("run_id", "stage_name").agg(
        F.count("*").alias("n"), F.max("ts").alias("last")
    )
    totals = per_stage.groupBy("run_id").agg(
        F.max("last").alias("recorded_at"),
        F.sum("n").alias("records_checked"),
        F.lit(0).cast("long").alias("null_values"),
        F.sum(F.col("n") - 1).alias("duplicate_post_ids"),
    )
    failed = F.col("duplicate_post_ids") > 0
    return totals.withColumn("quality_status", F.when(failed, "FAILED").otherwise("PASSED"))


QUALITY = """quality AS (SELECT run_id, max(ts) AS recorded_at, count(*) AS records_checked,
  CAST(0 AS BIGINT) AS null_values,
  CAST(count(*) - count(DISTINCT stage_name) AS BIGINT) AS duplicate_post_ids,
  CASE WHEN count(*) > count(DISTINCT stage_name) THEN 'FAILED' ELSE 'PASSED' END
    AS quality_status FROM stage_runs GROUP BY 1)"""

RECORDS = f"""{WITH_RUNS}, {RUN_STAGES}, {QUALITY}, {ATTEMPTS},
retries AS (SELECT run_id, CAST(sum(retries) AS BIGINT) AS total_retries,
  string_agg(stage_name || '=' || attempts || '/' || retries, ',' ORDER BY stage_name)
    AS retry_information FROM attempts GROUP BY 1)
SELECT r.run_id, {clock_sql("r.started_at")} AS started_at,
  {clock_sql("r.finished_at")} AS finished_at, r.status, r.total_duration, r.total_stages,
  r.successful_stages, r.failed_stage, r.error, m.fastest_stage, m.slowest_stage,
  m.fastest_duration, m.slowest_duration, q.records_checked, q.null_values,
  q.duplicate_post_ids, q.quality_status, t.total_retries, t.retry_information
FROM runs r JOIN run_stages m ON r.run_id = m.run_id JOIN quality q ON r.run_id = q.run_id
JOIN retries t ON r.run_id = t.run_id"""


def _records(spark, sf_dir):
    return ledger.run_records(
        runs(spark, sf_dir),
        stage_runs(spark, sf_dir),
        _quality(spark, sf_dir),
        _attempts(spark, sf_dir),
    )


def _shown(records):
    """Ledger rows with times and the retry map as text."""
    pairs = F.transform(
        F.map_entries("retry_information"),
        lambda e: F.concat(
            e["key"], F.lit("="), e["value"]["attempts"].cast("string"),
            F.lit("/"), e["value"]["retries"].cast("string"),
        ),
    )
    return _clocks(records, "started_at", "finished_at").withColumn(
        "retry_information", F.concat_ws(",", pairs)
    )


@query("m2_run_records", RECORDS)
def _(spark, sf_dir):
    return _shown(_records(spark, sf_dir))


@query("m3_ledger_append", RECORDS)
def _(spark, sf_dir):
    """Failed runs are appended first, the others later, as two batches."""
    path = scratch_dir(spark, "m3")
    records = _records(spark, sf_dir)
    history.append_runs(records.filter(F.col("status") == "FAILED"), path)
    history.append_runs(records.filter(F.col("status") != "FAILED"), path)
    return _shown(history.load(spark, path, schemas.RUNS))


@query(
    "b9_canonical_ledger",
    f"""{WITH_RUNS} SELECT run_id, {clock_sql("started_at")} AS started_at, total_duration,
          total_stages, CAST(NULL AS BIGINT) AS total_retries, CAST(NULL AS VARCHAR) AS quality_status
        FROM runs""",
)
def _(spark, sf_dir):
    """Rows of an earlier layout: texts instead of times and numbers, columns absent."""
    old = runs(spark, sf_dir).select(
        "run_id",
        F.col("started_at").cast("string").alias("started_at"),
        F.col("total_duration").cast("string").alias("total_duration"),
        F.col("total_stages").cast("double").alias("total_stages"),
    )
    rows = _clocks(ledger.normalized_runs(old), "started_at")
    return rows.select(
        "run_id", "started_at", "total_duration", "total_stages", "total_retries", "quality_status"
    )


@query(
    "a7_history_append",
    f"{WITH_STAGES} SELECT run_id, stage_name, duration FROM stage_runs",
)
def _(spark, sf_dir):
    path = scratch_dir(spark, "a7")
    rows = stage_runs(spark, sf_dir)
    for stage in STAGES:
        history.append_stage_runs(rows.filter(F.col("stage_name") == stage), path)
    history.append_stage_runs(rows.filter(F.col("stage_name").isNull()), path)
    return history.load(spark, path, schemas.STAGE_RUNS)


@query(
    "a8_quality_history",
    """SELECT 'documents' AS run_id, count(*) AS records_checked,
              CAST(2 * count(*) - count(text) - count(lang) AS BIGINT) AS null_values FROM documents
       UNION ALL SELECT 'pages', count(*), CAST(2 * count(*) - count(html) - count(url) AS BIGINT)
       FROM pages""",
)
def _(spark, sf_dir):
    path = scratch_dir(spark, "a8")
    for name, key, columns in (
        ("documents", "doc_id", ["doc_id", "text", "lang"]),
        ("pages", "page_id", ["page_id", "html", "url"]),
    ):
        metrics = checks.quality_metrics(table(spark, sf_dir, name).select(*columns), key)
        row = metrics.select(
            F.lit(name).alias("run_id"), F.expr(f"CAST({AT} AS TIMESTAMP)").alias("recorded_at"), "*"
        )
        history.append_quality(row, path)
    return history.load_quality(spark, path).select("run_id", "records_checked", "null_values")


@query(
    "m4_latest_quality",
    f"""{WITH_STAGES}, {QUALITY} SELECT run_id, {clock_sql("recorded_at")} AS recorded_at,
          records_checked, null_values, duplicate_post_ids, quality_status
        FROM quality ORDER BY quality.recorded_at DESC, run_id DESC LIMIT 1""",
)
def _(spark, sf_dir):
    latest = ledger.latest_quality(_quality(spark, sf_dir))
    return latest.withColumn("recorded_at", F.date_format("recorded_at", CLOCK))


@query(
    "m13_failed_stage",
    f"""{WITH_RUNS} SELECT run_id, successful_stages, open_stage AS failed_stage FROM run_facts""",
)
def _(spark, sf_dir):
    return ledger.failed_stage(stage_runs(spark, sf_dir), STAGES, ~is_failure())


@query(
    "m13_failed_stage_of_many",
    """WITH rows_ AS (SELECT user_id AS u, 'S' || lpad(CAST(event_id % 100 AS VARCHAR), 3, '0') AS s
                       FROM events),
       all_ AS (SELECT u, s FROM (SELECT DISTINCT u FROM rows_), (SELECT DISTINCT s FROM rows_)),
       open_ AS (SELECT u, min(s) AS s FROM (SELECT * FROM all_ EXCEPT SELECT * FROM rows_) GROUP BY 1)
       SELECT CAST(r.u AS VARCHAR) AS run_id, count(DISTINCT r.s) AS successful_stages,
              any_value(o.s) AS failed_stage
       FROM rows_ r LEFT JOIN open_ o ON r.u = o.u GROUP BY 1""",
)
def _(spark, sf_dir):
    number = F.lpad((F.col("event_id") % 100).cast("string"), 3, "0")
    rows = stage_runs(spark, sf_dir).select(
        F.floor(F.col("run_id").cast("long") / 100).cast("string").alias("run_id"),
        F.concat(F.lit("S"), number).alias("stage_name"),
    )
    return ledger.failed_stage(rows, [f"S{i:03d}" for i in range(100)])


@query(
    "m14_last_state",
    f"""{WITH_RUNS}, last AS (SELECT * FROM runs
          ORDER BY finished_at DESC, run_id DESC LIMIT 1)
        SELECT run_id AS last_run_id, status AS last_status,
          {clock_sql("finished_at")} AS last_finished_at, failed_stage, error,
          status = 'SUCCESS' AS was_successful FROM last""",
)
def _(spark, sf_dir):
    return _clocks(run_stats.last_state(runs(spark, sf_dir)), "last_finished_at")


def _by_user(spark, sf_dir):
    """The ledger as one pipeline per user."""
    owner = (F.col("run_id").cast("long") / 100).cast("long")
    return runs(spark, sf_dir).withColumn("owner", owner)


STATE = f"""{WITH_RUNS}, state AS (SELECT CAST(run_id AS BIGINT) // 100 AS owner, * FROM runs
  QUALIFY row_number() OVER (PARTITION BY CAST(run_id AS BIGINT) // 100
                             ORDER BY finished_at DESC, run_id DESC) = 1)"""


@query(
    "m14_last_state_per_owner",
    f"""{STATE} SELECT owner, run_id AS last_run_id, status AS last_status,
          {clock_sql("finished_at")} AS last_finished_at, failed_stage, error,
          status = 'SUCCESS' AS was_successful FROM state""",
)
def _(spark, sf_dir):
    state = run_stats.last_state(_by_user(spark, sf_dir), by="owner")
    return _clocks(state, "last_finished_at")


@query(
    "m15_run_eligibility",
    f"""{STATE}, used AS (SELECT CAST(run_id AS BIGINT) // 100 AS owner,
          count(*) FILTER (WHERE status = 'FAILED') AS failures FROM runs GROUP BY 1)
        SELECT s.owner, s.status = 'SUCCESS' AS should_skip,
          s.status = 'FAILED' AND u.failures < 5 AS should_retry
        FROM state s JOIN used u ON s.owner = u.owner""",
)
def _(spark, sf_dir):
    """The failures of an owner's runs are the retries it has used up."""
    ledger_rows = _by_user(spark, sf_dir)
    failed = F.count_if(F.col("status") == "FAILED")
    used = ledger_rows.groupBy("owner").agg(failed.alias("used"))
    state = run_stats.last_state(ledger_rows, by="owner").join(used, "owner")
    return run_stats.eligibility(state, "used", 5).select("owner", "should_skip", "should_retry")


@query(
    "m16_failure_breakdown",
    f"""{WITH_RUNS} SELECT failed_stage,
          CASE WHEN failed_stage IN ('view', 'click') THEN 'RETRYABLE' ELSE 'NON_RETRYABLE' END
            AS category, count(*) AS failures
        FROM runs WHERE status = 'FAILED' GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    return run_stats.failure_breakdown(runs(spark, sf_dir), RETRYABLE)


# -- alerts --------------------------------------------------------------------------


def _judged(spark, sf_dir):
    """Runs with a health of their own: FAILED, else WARNING if slow, else HEALTHY."""
    failed = F.col("status") == "FAILED"
    slow = F.col("total_duration") > 200
    return runs(spark, sf_dir).withColumn(
        "status", F.when(failed, "FAILED").when(slow, "WARNING").otherwise("HEALTHY")
    )


STATUS_ALERTS = f"""{WITH_RUNS}, status_alerts AS (
  SELECT CASE WHEN status = 'FAILED' THEN 'CRITICAL' ELSE 'WARNING' END AS severity,
         CASE WHEN status = 'FAILED' THEN 'FAILED' ELSE 'WARNING' END AS status,
         run_id, failed_stage, error, total_duration
  FROM runs WHERE status = 'FAILED' OR total_duration > 200)"""


@query("m5_status_alerts", f"{STATUS_ALERTS} SELECT * FROM status_alerts")
def _(spark, sf_dir):
    return alerts.status_alerts(_judged(spark, sf_dir))


@query(
    "m6_alert_texts",
    f"""{STATUS_ALERTS} SELECT run_id, concat_ws(chr(10), '🚨 PIPELINE ALERT', '',
          'Severity: ' || severity, 'Status: ' || status, 'Run ID: ' || run_id,
          'Failed Stage: ' || failed_stage, 'Error: ' || error,
          'Duration: ' || CAST(total_duration AS VARCHAR) || 's') AS text
        FROM status_alerts""",
)
def _(spark, sf_dir):
    texts = alerts.formatted(alerts.status_alerts(_judged(spark, sf_dir)))
    return texts.select("run_id", "text")


def _alert_columns(df, *details):
    """Alert fields as plain columns, with the named details next to them."""
    return df.select(
        *[c for c in df.columns if c != "details"],
        *[F.col("details")[name].alias(f"detail_{name}") for name in details],
    )


def _alert_sql(kind, severity, stage, message, details, source):
    parts = "".join(f", {sql} AS detail_{name}" for name, sql in details.items())
    return f"""SELECT '{ALERT_ID}' AS alert_id, '{ALERT_TIME}' AS timestamp,
      '{kind}' AS alert_type, '{severity}' AS severity, run_id, {stage} AS stage,
      {message} AS message{parts} FROM {source}"""


def _failures(spark, sf_dir):
    return alerts.failure_alerts(runs(spark, sf_dir), F.expr(AT))


FAILURE_SQL = _alert_sql(
    "PIPELINE_FAILURE", "CRITICAL", "failed_stage",
    "'Pipeline failed during ' || coalesce(failed_stage, 'None')", {"error": "error"},
    "runs WHERE status = 'FAILED'",
)


@query("m7_failure_alerts", f"{WITH_RUNS} {FAILURE_SQL}")
def _(spark, sf_dir):
    return _alert_columns(_failures(spark, sf_dir), "error")


def _poor_quality(spark, sf_dir):
    return alerts.quality_alerts(_quality(spark, sf_dir), F.expr(AT))


QUALITY_SQL = _alert_sql(
    "DATA_QUALITY_FAILURE", "HIGH", "CAST(NULL AS VARCHAR)", "'Data quality validation failed'",
    {
        "records_checked": "CAST(records_checked AS VARCHAR)",
        "duplicate_post_ids": "CAST(duplicate_post_ids AS VARCHAR)",
    },
    "quality WHERE quality_status <> 'PASSED'",
)


@query("m8_quality_alerts", f"{WITH_STAGES}, {QUALITY} {QUALITY_SQL}")
def _(spark, sf_dir):
    return _alert_columns(_poor_quality(spark, sf_dir), "records_checked", "duplicate_post_ids")


def _sla_breaches(spark, sf_dir):
    return alerts.sla_alerts(sla.violations(stage_runs(spark, sf_dir), THRESHOLDS), F.expr(AT))


SLA_SQL = _alert_sql(
    "SLA_VIOLATION", "WARNING", "stage_name", "stage_name || ' exceeded its SLA'",
    {
        "duration": "CAST(duration AS VARCHAR)",
        "sla": "CAST(sla_threshold AS VARCHAR)",
        "exceeded_by": "CAST(duration - sla_threshold AS VARCHAR)",
    },
    "configured WHERE duration > sla_threshold",
)


@query("m9_sla_alerts", f"{CONFIGURED} {SLA_SQL}")
def _(spark, sf_dir):
    return _alert_columns(_sla_breaches(spark, sf_dir), "duration", "sla", "exceeded_by")


def _exhausted(spark, sf_dir):
    """A stage whose longest attempt ran over 100 failed all its attempts."""
    failed = F.col("longest") > 100
    attempts = _attempts(spark, sf_dir).select(
        "run_id",
        "stage_name",
        "attempts",
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(failed, F.concat("stage_name", F.lit(" failed (exit code 1)"))).alias("error"),
    )
    return alerts.retry_alerts(attempts, F.expr(AT), RETRYABLE)


RETRY_SQL = _alert_sql(
    "RETRY_EXHAUSTED", "CRITICAL", "stage_name", "'Retry attempts exhausted for ' || stage_name",
    {"attempts": "CAST(attempts AS VARCHAR)", "error": "stage_name || ' failed (exit code 1)'"},
    "attempts WHERE longest > 100 AND stage_name IN ('view', 'click')",
)


@query("m10_retry_alerts", f"{WITH_STAGES}, {ATTEMPTS} {RETRY_SQL}")
def _(spark, sf_dir):
    return _alert_columns(_exhausted(spark, sf_dir), "attempts", "error")


def _all_alerts(spark, sf_dir):
    return alerts.all_alerts(
        _failures(spark, sf_dir),
        _poor_quality(spark, sf_dir),
        _sla_breaches(spark, sf_dir),
        _exhausted(spark, sf_dir),
    )


ENVELOPES = " UNION ALL ".join(
    f"SELECT alert_id, timestamp, alert_type, severity, run_id, stage, message FROM ({part})"
    for part in (FAILURE_SQL, QUALITY_SQL, SLA_SQL, RETRY_SQL)
)
EVERYTHING = WITH_RUNS + f", {QUALITY}, {ATTEMPTS}, " + CONFIGURED.removeprefix(f"{WITH_STAGES}, ")


@query("m11_alert_envelope", f"{EVERYTHING} {ENVELOPES}")
def _(spark, sf_dir):
    return _all_alerts(spark, sf_dir).drop("details")


@query("m12_alert_counts", f"""{EVERYTHING} SELECT alert_type, severity, count(*) AS alert_count
        FROM ({ENVELOPES}) GROUP BY 1, 2""")
def _(spark, sf_dir):
    return alerts.alert_counts(_all_alerts(spark, sf_dir))


@query("m12_alert_count", f"{EVERYTHING} SELECT count(*) AS alert_count FROM ({ENVELOPES})")
def _(spark, sf_dir):
    return alerts.alert_count(_all_alerts(spark, sf_dir))


@query("a9_alert_history", f"{EVERYTHING} {ENVELOPES}")
def _(spark, sf_dir):
    path = scratch_dir(spark, "a9")
    for part in (_failures, _poor_quality, _sla_breaches, _exhausted):
        history.append_alerts(part(spark, sf_dir), path)
    history.append_alerts(_failures(spark, sf_dir).filter(F.col("run_id").isNull()), path)
    return history.load_alerts(spark, path).drop("details")


@query(
    "k1_stage_ledger_union",
    f"""{WITH_STAGES}, {ATTEMPTS} SELECT run_id, stage_name, duration, NULL AS attempts
        FROM stage_runs UNION ALL SELECT run_id, stage_name, NULL, attempts FROM attempts""",
)
def _(spark, sf_dir):
    rows = stage_runs(spark, sf_dir).select("run_id", "stage_name", "duration")
    tries = _attempts(spark, sf_dir).select("run_id", "stage_name", "attempts")
    return merge.union_drifted(rows, tries)
