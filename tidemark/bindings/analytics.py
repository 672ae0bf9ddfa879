"""Run and stage statistics, baselines, SLA reports and health."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.bindings.registry import query
from tidemark.bindings.tables import (
    CLOCK,
    LIMITS,
    MEAN,
    RUNS,
    STAGE_RUNS,
    THRESHOLDS,
    clock_sql,
    percent,
    rounded,
    runs,
    stage_runs,
    table,
)
from tidemark.functions.numeric import exact_avg, exact_sum
from tidemark.functions.text import utc_wall_clock
from tidemark.operators import baseline, ledger, sla, stages
from tidemark.operators import runs as run_stats

SLOW_RUN = 400.0
SLOW_STAGE = 100.0
WITH_RUNS = f"WITH {RUNS}"
WITH_STAGES = f"WITH {STAGE_RUNS}"
RUN_MEAN = "CAST(sum(CAST(total_duration AS DECIMAL(18,2))) AS DOUBLE) / count(total_duration)"


def _plain(rows):
    """Stage rows without the columns only the bindings know."""
    return rows.select("run_id", "stage_name", "duration")


# -- runs ----------------------------------------------------------------------------


@query("g1_total_runs", f"{WITH_RUNS} SELECT count(*) AS total_runs FROM runs")
def _(spark, sf_dir):
    return run_stats.total_runs(runs(spark, sf_dir))


@query("g1_stage_executions", "SELECT count(*) AS total_stage_executions FROM events")
def _(spark, sf_dir):
    return stages.total_executions(stage_runs(spark, sf_dir))


@query("g3_average_run_duration", f"{WITH_RUNS} SELECT {RUN_MEAN} AS average_duration FROM runs")
def _(spark, sf_dir):
    return run_stats.average_duration(runs(spark, sf_dir))


@query(
    "g5_status_counts",
    f"""{WITH_RUNS} SELECT count(*) FILTER (WHERE status = 'SUCCESS') AS successful_runs,
               count(*) FILTER (WHERE status = 'FAILED') AS failed_runs FROM runs""",
)
def _(spark, sf_dir):
    return run_stats.status_counts(runs(spark, sf_dir))


SUCCEEDED = "count(*) FILTER (WHERE status = 'SUCCESS')"


@query(
    "g6_success_rate",
    f"{WITH_RUNS} SELECT {percent(SUCCEEDED, 'count(*)')} AS success_rate FROM runs",
)
def _(spark, sf_dir):
    return run_stats.success_rate(runs(spark, sf_dir))


@query(
    "g7_run_summary",
    f"""{WITH_RUNS} SELECT count(*) AS total_runs, {SUCCEEDED} AS successful_runs,
               count(*) FILTER (WHERE status = 'FAILED') AS failed_runs,
               {percent(SUCCEEDED, 'count(*)')} AS success_rate,
               {RUN_MEAN} AS average_duration FROM runs""",
)
def _(spark, sf_dir):
    return run_stats.run_summary(runs(spark, sf_dir))


RUN_COLUMNS = ["run_id", "status", "total_duration"]


@query(
    "h1_extreme_runs",
    f"""{WITH_RUNS} SELECT * FROM (SELECT 'fastest' AS extreme, run_id, status, total_duration
          FROM runs ORDER BY total_duration, run_id LIMIT 1)
        UNION ALL SELECT * FROM (SELECT 'slowest', run_id, status, total_duration
          FROM runs ORDER BY total_duration DESC, run_id LIMIT 1)""",
)
def _(spark, sf_dir):
    all_runs = runs(spark, sf_dir)
    fastest = run_stats.extreme_run(all_runs, slowest=False).select(
        F.lit("fastest").alias("extreme"), *RUN_COLUMNS
    )
    slowest = run_stats.extreme_run(all_runs, slowest=True).select(
        F.lit("slowest").alias("extreme"), *RUN_COLUMNS
    )
    return fastest.unionByName(slowest)


@query(
    "h1_fastest_successful_run",
    f"""{WITH_RUNS} SELECT run_id, status, total_duration FROM runs WHERE status = 'SUCCESS'
        ORDER BY total_duration, run_id LIMIT 1""",
)
def _(spark, sf_dir):
    found = run_stats.extreme_run(runs(spark, sf_dir), slowest=False, status="SUCCESS")
    return found.select(*RUN_COLUMNS)


def _started(df):
    return df.withColumn("started_at", F.date_format(utc_wall_clock("started_at"), CLOCK))


@query(
    "h2_latest_run",
    f"""{WITH_RUNS} SELECT run_id, status, {clock_sql("started_at")} AS started_at, total_duration
        FROM runs ORDER BY runs.started_at DESC, run_id LIMIT 1""",
)
def _(spark, sf_dir):
    latest = run_stats.latest_run(runs(spark, sf_dir))
    return _started(latest.select("run_id", "status", "started_at", "total_duration"))


@query(
    "c3_failed_runs",
    f"""{WITH_RUNS} SELECT run_id, failed_stage, error FROM runs WHERE status = 'FAILED'""",
)
def _(spark, sf_dir):
    return run_stats.failed_runs(runs(spark, sf_dir)).select("run_id", "failed_stage", "error")


@query(
    "c4_slow_runs",
    f"""{WITH_RUNS} SELECT run_id, status, total_duration FROM runs
        WHERE total_duration > {SLOW_RUN}""",
)
def _(spark, sf_dir):
    return run_stats.slow_runs(runs(spark, sf_dir), SLOW_RUN).select(*RUN_COLUMNS)


HEALTH = f"""CASE WHEN count(*) FILTER (WHERE status = 'FAILED') > 0 THEN 'FAILED'
  WHEN count(*) FILTER (WHERE total_duration > {SLOW_RUN}) > 0 THEN 'WARNING'
  ELSE 'HEALTHY' END"""


@query(
    "j7_health",
    f"""{WITH_RUNS} SELECT 'all' AS scope, {HEALTH} AS health FROM runs
        UNION ALL SELECT 'successful', {HEALTH} FROM runs WHERE status = 'SUCCESS'""",
)
def _(spark, sf_dir):
    all_runs = runs(spark, sf_dir)
    good = all_runs.filter(F.col("status") == "SUCCESS")
    return (
        run_stats.health(all_runs, SLOW_RUN)
        .withColumn("scope", F.lit("all"))
        .unionByName(
            run_stats.health(good, SLOW_RUN).withColumn("scope", F.lit("successful"))
        )
    )


@query(
    "j8_monitoring_report",
    f"""{WITH_RUNS}, latest AS (SELECT * FROM runs ORDER BY started_at DESC, run_id LIMIT 1),
        totals AS (SELECT count(*) AS total_runs,
          count(*) FILTER (WHERE status = 'FAILED') AS failed_runs,
          count(*) FILTER (WHERE total_duration > {SLOW_RUN}) AS slow_runs,
          {HEALTH} AS health FROM runs)
        SELECT totals.*, run_id AS latest_run_id, status AS latest_status,
               {clock_sql("started_at")} AS latest_started_at,
               total_duration AS latest_total_duration FROM totals, latest""",
)
def _(spark, sf_dir):
    report = run_stats.monitoring_report(runs(spark, sf_dir), SLOW_RUN)
    clock = F.date_format(utc_wall_clock("latest_started_at"), CLOCK)
    return report.withColumn("latest_started_at", clock)


@query(
    "j8_full_monitoring_report",
    f"""{WITH_RUNS}, latest AS (SELECT * FROM runs ORDER BY started_at DESC, run_id LIMIT 1)
        SELECT 'summary' AS section, NULL AS run_id, NULL AS status, NULL AS started_at,
          CAST(NULL AS DOUBLE) AS total_duration, count(*) AS total_runs,
          count(*) FILTER (WHERE status = 'FAILED') AS failed_runs,
          count(*) FILTER (WHERE total_duration > {SLOW_RUN}) AS slow_runs, {HEALTH} AS health,
          NULL AS failed_stage, NULL AS error FROM runs
        UNION ALL SELECT 'latest', run_id, status, {clock_sql("started_at")}, total_duration,
          NULL, NULL, NULL, NULL, NULL, NULL FROM latest
        UNION ALL SELECT 'failed', run_id, status, {clock_sql("started_at")}, total_duration,
          NULL, NULL, NULL, NULL, failed_stage, error FROM runs WHERE status = 'FAILED'
        UNION ALL SELECT 'slow', run_id, status, {clock_sql("started_at")}, total_duration,
          NULL, NULL, NULL, NULL, failed_stage, error FROM runs WHERE total_duration > {SLOW_RUN}""",
)
def _(spark, sf_dir):
    report = run_stats.full_monitoring_report(runs(spark, sf_dir), SLOW_RUN)
    return report.withColumn("started_at", F.date_format(utc_wall_clock("started_at"), CLOCK))


# -- stages --------------------------------------------------------------------------


@query(
    "g8_average_by_stage",
    f"""{WITH_STAGES} SELECT stage_name, {rounded(MEAN, 3)} AS average_duration
        FROM stage_runs GROUP BY 1""",
)
def _(spark, sf_dir):
    return stages.average_by_stage(stage_runs(spark, sf_dir))


@query(
    "g3_mean_of_extreme_values",
    """WITH extreme AS (
         SELECT CASE event_id % 4 WHEN 0 THEN 'huge' WHEN 1 THEN 'tiny' WHEN 2 THEN 'infinite'
                  ELSE 'mixed' END AS stage_name,
                CASE event_id % 4 WHEN 0 THEN pow(2.0, 70) WHEN 1 THEN pow(2.0, -40)
                  WHEN 2 THEN 'Infinity'::DOUBLE
                  ELSE CASE WHEN event_id % 8 = 3 THEN 0.5 ELSE pow(2.0, -35) END END AS v
         FROM events)
       SELECT stage_name, sum(v) AS total, sum(v) / count(v) AS mean FROM extreme GROUP BY 1""",
)
def _(spark, sf_dir):
    kind = F.col("event_id") % 4
    mixed = F.when(F.col("event_id") % 8 == 3, 0.5).otherwise(2.0**-35)
    value = F.when(kind == 0, 2.0**70).when(kind == 1, 2.0**-40).when(kind == 2, float("inf"))
    rows = stage_runs(spark, sf_dir).select(
        F.when(kind == 0, "huge").when(kind == 1, "tiny").when(kind == 2, "infinite")
        .otherwise("mixed").alias("stage_name"),
        value.otherwise(mixed).alias("v"),
    )
    return rows.groupBy("stage_name").agg(exact_sum("v").alias("total"), exact_avg("v").alias("mean"))


@query(
    "g9_stage_summary",
    f"""{WITH_STAGES} SELECT stage_name, count(duration) AS executions,
               {rounded(MEAN, 3)} AS average_duration,
               {rounded("min(duration)", 3)} AS minimum_duration,
               {rounded("max(duration)", 3)} AS maximum_duration
        FROM stage_runs GROUP BY 1""",
)
def _(spark, sf_dir):
    return stages.stage_summary(stage_runs(spark, sf_dir))


BASELINE_SELECT = f"""SELECT stage_name, count(duration) AS executions,
       {rounded(MEAN, 3)} AS average_duration,
       {rounded("min(duration)", 3)} AS minimum_duration,
       {rounded("max(duration)", 3)} AS maximum_duration,
       {rounded("quantile_cont(duration, 0.5)", 3)} AS median_duration,
       {rounded("quantile_cont(duration, 0.95)", 3)} AS p95_duration,
       {rounded("quantile_cont(duration, 0.99)", 3)} AS p99_duration
FROM stage_runs"""
WITH_BASELINE = f"{WITH_STAGES}, baseline AS ({BASELINE_SELECT} GROUP BY 1)"


@query("g10_stage_baseline", f"{WITH_STAGES} {BASELINE_SELECT} GROUP BY 1")
def _(spark, sf_dir):
    return baseline.stage_baseline(stage_runs(spark, sf_dir))


@query("g10_stage_baseline_selection", f"{WITH_STAGES} {BASELINE_SELECT} GROUP BY 1")
def _(spark, sf_dir):
    return baseline.stage_baseline(stage_runs(spark, sf_dir), "selection")


def _many_stages(spark, sf_dir):
    """Line items as executions: half of them in one stage, the others by order."""
    large = F.col("l_quantity") > 25
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("run_id"),
        F.when(large, "hot").otherwise(F.col("l_orderkey").cast("string")).alias("stage_name"),
        F.floor("l_extendedprice").cast("double").alias("duration"),
    )


@query(
    "g10_stage_baseline_many_stages",
    f"""WITH stage_runs AS (
          SELECT CASE WHEN l_quantity > 25 THEN 'hot' ELSE CAST(l_orderkey AS VARCHAR) END AS stage_name,
                 CAST(floor(l_extendedprice) AS DOUBLE) AS duration FROM lineitem)
        {BASELINE_SELECT} GROUP BY 1""",
)
def _(spark, sf_dir):
    return baseline.stage_baseline(_many_stages(spark, sf_dir), "selection")


@query(
    "g11_baseline_of_stage",
    f"{WITH_STAGES} {BASELINE_SELECT} WHERE stage_name = 'purchase' GROUP BY 1",
)
def _(spark, sf_dir):
    return baseline.stage_baseline_for(stage_runs(spark, sf_dir), "purchase")


@query(
    "g12_average_stage_duration",
    f"""{WITH_STAGES} SELECT run_id, {MEAN} AS average_stage_duration FROM stage_runs
        GROUP BY 1""",
)
def _(spark, sf_dir):
    return stages.run_average_stage_duration(stage_runs(spark, sf_dir))


@query(
    "g13_run_duration",
    f"""{WITH_STAGES} SELECT run_id,
               CAST(sum(CAST(duration AS DECIMAL(18,2))) AS DOUBLE) AS total_duration
        FROM stage_runs GROUP BY 1""",
)
def _(spark, sf_dir):
    return stages.run_total_duration(stage_runs(spark, sf_dir))


def _attempts(spark, sf_dir):
    """Repeated executions of a stage in a run as attempts of it."""
    return (
        stage_runs(spark, sf_dir)
        .groupBy("run_id", "stage_name")
        .agg(F.count("*").alias("attempts"), F.max("duration").alias("longest"))
        .withColumn("retries", F.col("attempts") - 1)
    )


ATTEMPTS = """attempts AS (SELECT run_id, stage_name, count(*) AS attempts,
  max(duration) AS longest, count(*) - 1 AS retries FROM stage_runs GROUP BY 1, 2)"""


@query(
    "g14_total_retries",
    f"""{WITH_STAGES}, {ATTEMPTS} SELECT run_id, CAST(sum(retries) AS BIGINT) AS total_retries,
               CAST(sum(retries) AS BIGINT) AS from_map FROM attempts GROUP BY 1""",
)
def _(spark, sf_dir):
    maps = ledger.retry_maps(_attempts(spark, sf_dir))
    return maps.select("run_id", "total_retries", ledger.total_retries().alias("from_map"))


@query(
    "h3_extreme_executions",
    f"""{WITH_STAGES} SELECT * FROM (SELECT 'fastest' AS extreme, run_id, stage_name, duration
          FROM stage_runs ORDER BY duration, event_id LIMIT 1)
        UNION ALL SELECT * FROM (SELECT 'slowest', run_id, stage_name, duration
          FROM stage_runs ORDER BY duration DESC, event_id LIMIT 1)""",
)
def _(spark, sf_dir):
    rows = stage_runs(spark, sf_dir)
    parts = []
    for name, slowest in (("fastest", False), ("slowest", True)):
        found = _plain(stages.extreme_execution(rows, slowest, ["event_id"]))
        parts.append(found.withColumn("extreme", F.lit(name)))
    return parts[0].unionByName(parts[1])


@query(
    "h4_extreme_stages_by_average",
    f"""{WITH_STAGES}, means AS (SELECT stage_name, {MEAN} AS mean FROM stage_runs GROUP BY 1)
        SELECT * FROM (SELECT 'fastest' AS extreme, stage_name,
          {rounded("mean", 3)} AS average_duration FROM means ORDER BY mean, stage_name LIMIT 1)
        UNION ALL SELECT * FROM (SELECT 'slowest', stage_name, {rounded("mean", 3)}
          FROM means ORDER BY mean DESC, stage_name LIMIT 1)""",
)
def _(spark, sf_dir):
    rows = stage_runs(spark, sf_dir)
    fastest = stages.extreme_stage_by_average(rows, slowest=False)
    slowest = stages.extreme_stage_by_average(rows, slowest=True)
    return fastest.withColumn("extreme", F.lit("fastest")).unionByName(
        slowest.withColumn("extreme", F.lit("slowest"))
    )


@query(
    "h5_extreme_baseline_stages",
    f"""{WITH_BASELINE} SELECT * FROM (SELECT 'fastest' AS extreme, * FROM baseline
          ORDER BY average_duration, stage_name LIMIT 1)
        UNION ALL SELECT * FROM (SELECT 'slowest', * FROM baseline
          ORDER BY average_duration DESC, stage_name LIMIT 1)""",
)
def _(spark, sf_dir):
    found = baseline.stage_baseline(stage_runs(spark, sf_dir))
    return (
        baseline.fastest_average_stage(found)
        .withColumn("extreme", F.lit("fastest"))
        .unionByName(
            baseline.slowest_average_stage(found).withColumn("extreme", F.lit("slowest"))
        )
    )


@query(
    "h6_highest_p95_stage",
    f"{WITH_BASELINE} SELECT * FROM baseline ORDER BY p95_duration DESC, stage_name LIMIT 1",
)
def _(spark, sf_dir):
    return baseline.highest_p95_stage(baseline.stage_baseline(stage_runs(spark, sf_dir)))


RUN_STAGES = """per_stage AS (SELECT run_id, stage_name, min(duration) AS low,
  max(duration) AS high FROM stage_runs GROUP BY 1, 2),
run_stages AS (SELECT run_id, count(*) AS total_stages,
  arg_min(stage_name, (low, stage_name)) AS fastest_stage,
  arg_min(stage_name, (-high, stage_name)) AS slowest_stage,
  min(low) AS fastest_duration, max(high) AS slowest_duration FROM per_stage GROUP BY 1)"""


@query("h7_run_stage_metrics", f"{WITH_STAGES}, {RUN_STAGES} SELECT * FROM run_stages")
def _(spark, sf_dir):
    return stages.run_stage_metrics(stage_runs(spark, sf_dir))


@query(
    "c5_slow_stages",
    f"""{WITH_STAGES} SELECT run_id, stage_name, duration FROM stage_runs
        WHERE duration > {SLOW_STAGE}""",
)
def _(spark, sf_dir):
    return _plain(stages.slow_stages(stage_runs(spark, sf_dir), SLOW_STAGE))


@query(
    "c7_measured_only",
    """SELECT event_id, value AS duration FROM events
       WHERE event_type <> 'signup' AND event_type <> 'refund'""",
)
def _(spark, sf_dir):
    text = F.when(F.col("stage_name") == "signup", F.lit("NaN")).otherwise(
        F.col("duration").cast("string")
    )
    rows = stage_runs(spark, sf_dir).withColumn("duration", text)
    return (
        stages.cleaned(rows).filter(F.col("duration").isNotNull()).select("event_id", "duration")
    )


@query(
    "j9_stage_analytics",
    f"""{WITH_STAGES}, means AS (SELECT stage_name, {MEAN} AS mean, count(*) AS n
          FROM stage_runs GROUP BY 1)
        SELECT CAST(sum(n) AS BIGINT) AS total_stage_executions,
               arg_min(stage_name, (mean, stage_name)) AS fastest_stage_by_average,
               arg_min(stage_name, (-mean, stage_name)) AS slowest_stage_by_average,
               {rounded("min(mean)", 3)} AS fastest_average_duration,
               {rounded("max(mean)", 3)} AS slowest_average_duration FROM means""",
)
def _(spark, sf_dir):
    return stages.stage_analytics_summary(stage_runs(spark, sf_dir))


_EXECUTION = """UNION ALL SELECT * FROM (SELECT '{0}_execution', stage_name, run_id, NULL, duration,
          NULL, NULL, NULL FROM stage_runs ORDER BY duration {1}, event_id LIMIT 1)"""
_AVERAGE = """UNION ALL SELECT * FROM (SELECT '{0}_average', stage_name, NULL, NULL, NULL, {2}, NULL,
          NULL FROM means ORDER BY mean {1}, stage_name LIMIT 1)"""


@query(
    "j9_full_analytics",
    f"""{WITH_STAGES}, means AS (SELECT stage_name, {MEAN} AS mean FROM stage_runs GROUP BY 1)
        SELECT 'total' AS section, NULL AS stage_name, NULL AS run_id, count(*) AS executions,
          CAST(NULL AS DOUBLE) AS duration, CAST(NULL AS DOUBLE) AS average_duration,
          CAST(NULL AS DOUBLE) AS minimum_duration, CAST(NULL AS DOUBLE) AS maximum_duration
        FROM stage_runs
        UNION ALL SELECT 'stage', stage_name, NULL, count(duration), NULL, {rounded(MEAN, 3)},
          {rounded("min(duration)", 3)}, {rounded("max(duration)", 3)} FROM stage_runs GROUP BY stage_name
        {_EXECUTION.format("fastest", "ASC")} {_EXECUTION.format("slowest", "DESC")}
        {_AVERAGE.format("fastest", "ASC", rounded("mean", 3))}
        {_AVERAGE.format("slowest", "DESC", rounded("mean", 3))}""",
)
def _(spark, sf_dir):
    return stages.full_analytics(stage_runs(spark, sf_dir), ["event_id"])


@query(
    "j10_baseline_summary",
    f"""{WITH_BASELINE}
        SELECT (SELECT count(*) FROM stage_runs) AS total_stage_executions,
               count(*) AS stages_analyzed,
               arg_min(stage_name, (-average_duration, stage_name)) AS slowest_average_stage,
               arg_min(stage_name, (average_duration, stage_name)) AS fastest_average_stage,
               arg_min(stage_name, (-p95_duration, stage_name)) AS highest_p95_stage
        FROM baseline""",
)
def _(spark, sf_dir):
    return baseline.baseline_summary(stage_runs(spark, sf_dir))


# -- SLA -----------------------------------------------------------------------------

CONFIGURED = f"""{WITH_STAGES}, {LIMITS}, configured AS (
  SELECT s.*, l.sla_threshold FROM stage_runs s JOIN limits l ON s.stage_name = l.stage_name)"""


@query("c6_configured_executions", f"{CONFIGURED} SELECT event_id, stage_name FROM configured")
def _(spark, sf_dir):
    found = sla.configured_executions(stage_runs(spark, sf_dir), THRESHOLDS)
    return found.select("event_id", "stage_name")


@query(
    "e6_threshold_lookup",
    f"{CONFIGURED} SELECT event_id, stage_name, sla_threshold FROM configured",
)
def _(spark, sf_dir):
    found = sla.configured_executions(stage_runs(spark, sf_dir), THRESHOLDS)
    return found.select("event_id", "stage_name", "sla_threshold")


@query(
    "j1_sla_violations",
    f"""{CONFIGURED} SELECT run_id, stage_name, duration, sla_threshold FROM configured
        WHERE duration > sla_threshold""",
)
def _(spark, sf_dir):
    return sla.violations(stage_runs(spark, sf_dir), THRESHOLDS)


def _compliance_sql(stage: str, limit: float) -> str:
    rate = percent(f"count(*) FILTER (WHERE duration <= {limit})", "count(*)")
    return f"""SELECT '{stage}' AS stage_name, count(*) AS executions,
      {rate} AS compliance_rate, {rounded(f"100.0::DOUBLE - {rate}", 2)} AS violation_rate
      FROM stage_runs WHERE stage_name = '{stage}'"""


@query(
    "j2_stage_compliance",
    f"""{WITH_STAGES} {_compliance_sql("view", 60.0)}
        UNION ALL {_compliance_sql("refund", 10.0)}""",
)
def _(spark, sf_dir):
    rows = stage_runs(spark, sf_dir)
    return sla.compliance(rows, "view", 60.0).unionByName(sla.compliance(rows, "refund", 10.0))


REPORT = f"""{WITH_STAGES}, {LIMITS}, counted AS (
  SELECT l.stage_name, l.ord, l.sla_threshold, count(s.event_id) AS executions,
         count(*) FILTER (WHERE s.duration > l.sla_threshold) AS violations
  FROM limits l LEFT JOIN stage_runs s ON s.stage_name = l.stage_name GROUP BY 1, 2, 3),
report AS (SELECT stage_name, executions, sla_threshold, violations,
  {percent("executions - violations", "executions")} AS compliance_rate,
  {percent("violations", "executions")} AS violation_rate,
  CASE WHEN executions = 0 THEN 'NO DATA' WHEN violations = 0 THEN 'PASSED'
       ELSE 'VIOLATION' END AS sla_status, ord FROM counted)"""


@query("j3_sla_summary", f"{REPORT} SELECT * EXCLUDE (ord) FROM report")
def _(spark, sf_dir):
    return sla.stage_report(stage_runs(spark, sf_dir), THRESHOLDS)


@query(
    "e7_thresholds_with_executions",
    f"{REPORT} SELECT stage_name, executions FROM report",
)
def _(spark, sf_dir):
    report = sla.stage_report(stage_runs(spark, sf_dir), THRESHOLDS)
    return report.select("stage_name", "executions")


@query(
    "h8_worst_sla_stage",
    f"""{REPORT} SELECT * EXCLUDE (ord) FROM report WHERE executions > 0
        ORDER BY violation_rate DESC, ord LIMIT 1""",
)
def _(spark, sf_dir):
    return sla.worst_stage(stage_runs(spark, sf_dir), THRESHOLDS)


BROKEN = "(SELECT CAST(sum(violations) AS BIGINT) FROM report)"


@query(
    "j4_overall_sla_report",
    f"""{REPORT}, totals AS (SELECT count(*) AS total_executions, {BROKEN} AS total_violations
          FROM stage_runs), worst AS (SELECT stage_name, violation_rate FROM report
          WHERE executions > 0 ORDER BY violation_rate DESC, ord LIMIT 1)
        SELECT total_executions, total_violations,
          {percent("total_executions - total_violations", "total_executions")}
            AS overall_compliance_rate,
          worst.stage_name AS worst_stage, worst.violation_rate AS worst_violation_rate
        FROM totals, worst""",
)
def _(spark, sf_dir):
    return sla.overall_report(stage_runs(spark, sf_dir), THRESHOLDS)


_RATED = "compliance_rate, violation_rate, sla_status"


@query(
    "j4_full_sla_report",
    f"""{REPORT}, totals AS (SELECT count(*) AS executions, {BROKEN} AS violations FROM stage_runs)
        SELECT 'overall' AS section, 0 AS position, NULL AS stage_name, executions,
          CAST(NULL AS DOUBLE) AS sla_threshold, violations,
          {percent("executions - violations", "executions")} AS compliance_rate,
          {percent("violations", "executions")} AS violation_rate,
          CASE WHEN executions = 0 THEN 'NO DATA' WHEN violations = 0 THEN 'PASSED'
               ELSE 'VIOLATION' END AS sla_status FROM totals
        UNION ALL SELECT 'stage', ord, stage_name, executions, sla_threshold, violations, {_RATED}
        FROM report
        UNION ALL SELECT * FROM (SELECT 'worst', 0, stage_name, executions, sla_threshold, violations,
          {_RATED} FROM report WHERE executions > 0 ORDER BY violation_rate DESC, ord LIMIT 1)""",
)
def _(spark, sf_dir):
    return sla.full_report(stage_runs(spark, sf_dir), THRESHOLDS)


RECOMMENDED = f"""{WITH_BASELINE}, {LIMITS}, recommended AS (
  SELECT b.stage_name, b.executions, b.average_duration, b.p95_duration,
         l.sla_threshold AS current_sla, {rounded("b.p95_duration", 3)} AS recommended_sla,
         CASE WHEN b.p95_duration <= l.sla_threshold THEN 'KEEP' ELSE 'INVESTIGATE' END
           AS recommendation
  FROM baseline b JOIN limits l ON b.stage_name = l.stage_name)"""


def _recommended(spark, sf_dir):
    return sla.recommendations(baseline.stage_baseline(stage_runs(spark, sf_dir)), THRESHOLDS)


@query("j5_sla_recommendations", f"{RECOMMENDED} SELECT * FROM recommended")
def _(spark, sf_dir):
    return _recommended(spark, sf_dir)


@query(
    "j6_recommendation_summary",
    f"""{RECOMMENDED} SELECT count(*) AS total_stages,
          count(*) FILTER (WHERE recommendation = 'INVESTIGATE') AS stages_to_investigate
        FROM recommended""",
)
def _(spark, sf_dir):
    return sla.recommendation_summary(_recommended(spark, sf_dir))


@query(
    "j6_full_recommendation_report",
    f"""{RECOMMENDED} SELECT 'summary' AS section, NULL AS stage_name, CAST(NULL AS BIGINT) AS executions,
          CAST(NULL AS DOUBLE) AS average_duration, CAST(NULL AS DOUBLE) AS p95_duration,
          CAST(NULL AS DOUBLE) AS current_sla, CAST(NULL AS DOUBLE) AS recommended_sla,
          NULL AS recommendation, count(*) AS total_stages,
          count(*) FILTER (WHERE recommendation = 'INVESTIGATE') AS stages_to_investigate FROM recommended
        UNION ALL SELECT 'recommendation', *, NULL, NULL FROM recommended
        UNION ALL SELECT 'investigate', *, NULL, NULL FROM recommended
          WHERE recommendation = 'INVESTIGATE'""",
)
def _(spark, sf_dir):
    return sla.recommendation_report(_recommended(spark, sf_dir))


@query(
    "c8_stages_to_investigate",
    f"{RECOMMENDED} SELECT * FROM recommended WHERE recommendation = 'INVESTIGATE'",
)
def _(spark, sf_dir):
    return sla.to_investigate(_recommended(spark, sf_dir))
