"""SLA violations, compliance, reports and recommendations.

``thresholds`` is an ordered mapping of stage name to seconds, or a table
``(stage_name, sla_threshold, ord)`` with one row per stage.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.numeric import exceeds, percentage, round_even
from tidemark.operators.stages import cleaned
from tidemark.plans.sizing import MAX_DIMENSION_ROWS, dimension
from tidemark.plans.skew import keyed_join
from tidemark.schemas import STAGE_SLA

Thresholds = Mapping[str, float] | DataFrame
LISTED_STAGES = 100


def _bounded(thresholds: Thresholds) -> bool:
    return not isinstance(thresholds, DataFrame) and len(thresholds) <= MAX_DIMENSION_ROWS


def threshold_table(spark: SparkSession, thresholds: Thresholds = STAGE_SLA) -> DataFrame:
    """Lookup ``(stage_name, sla_threshold, ord)``; a mapping is of known size."""
    if isinstance(thresholds, DataFrame):
        return thresholds.select("stage_name", "sla_threshold", "ord")
    return dimension(
        spark,
        {
            "stage_name": list(thresholds),
            "sla_threshold": [float(limit) for limit in thresholds.values()],
            "ord": list(range(len(thresholds))),
        },
    )


def configured_executions(
    stage_runs: DataFrame, thresholds: Thresholds = STAGE_SLA
) -> DataFrame:
    """Executions of stages that have a threshold, with it."""
    stage_runs = _named(stage_runs, thresholds)
    table = threshold_table(stage_runs.sparkSession, thresholds).drop("ord")
    return _with_thresholds(stage_runs, table, thresholds, "inner")


def _named(stage_runs: DataFrame, thresholds: Thresholds) -> DataFrame:
    """Leave out other stages at the scan, if the configured ones are few enough to list."""
    if isinstance(thresholds, DataFrame) or not 0 < len(thresholds) <= LISTED_STAGES:
        return stage_runs
    return stage_runs.filter(F.col("stage_name").isin(*thresholds))


def _with_thresholds(
    stage_runs: DataFrame, table: DataFrame, thresholds: Thresholds, how: str
) -> DataFrame:
    """A map-side lookup; a table of unknown size is joined with hot stages spread."""
    rows = cleaned(stage_runs)
    if _bounded(thresholds):
        return rows.join(table, "stage_name", how)
    return keyed_join(rows, table, "stage_name", how)


def violations(stage_runs: DataFrame, thresholds: Thresholds = STAGE_SLA) -> DataFrame:
    """Executions above their stage's threshold; the same four columns even when none."""
    if not isinstance(thresholds, DataFrame) and thresholds:
        # No violation is at or below the lowest threshold: a bound the scan can use.
        lowest = min(float(limit) for limit in thresholds.values())
        stage_runs = stage_runs.filter(exceeds(stage_runs, "duration", lowest))
    return (
        configured_executions(stage_runs, thresholds)
        .filter(F.col("duration") > F.col("sla_threshold"))
        .select("run_id", "stage_name", "duration", "sla_threshold")
    )


def compliance(stage_runs: DataFrame, stage: str, threshold: float) -> DataFrame:
    """Compliance and violation rate of one stage.

    A null duration is not compliant here, and a stage without executions has
    compliance 0.0 and hence violation rate 100.0 (:func:`stage_report` differs
    on both).
    """
    counted = (
        cleaned(stage_runs)
        .filter(F.col("stage_name") == stage)
        .agg(
            F.count("*").alias("executions"),
            F.count_if(F.col("duration") <= threshold).alias("compliant"),
        )
    )
    rate = percentage(F.col("compliant"), F.col("executions"))
    return counted.select(
        F.lit(stage).alias("stage_name"),
        "executions",
        rate.alias("compliance_rate"),
        round_even(F.lit(100.0) - rate, 2).alias("violation_rate"),
    )


def _rates(df: DataFrame) -> DataFrame:
    executions, broken = F.col("executions"), F.col("violations")
    return df.withColumns(
        {
            "compliance_rate": percentage(executions - broken, executions),
            "violation_rate": percentage(broken, executions),
            "sla_status": F.when(executions == 0, "NO DATA")
            .when(broken == 0, "PASSED")
            .otherwise("VIOLATION"),
        }
    )


def _ordered_report(stage_runs: DataFrame, thresholds: Thresholds) -> DataFrame:
    table = threshold_table(stage_runs.sparkSession, thresholds)
    # Counting happens before the outer join, so that one sees a row per stage.
    counted = (
        configured_executions(stage_runs, thresholds)
        .groupBy("stage_name")
        .agg(
            F.count("*").alias("executions"),
            F.count_if(F.col("duration") > F.col("sla_threshold")).alias("violations"),
        )
    )
    # At most one counted row per threshold: bounded by the lookup's own size check.
    counted = F.broadcast(counted) if _bounded(thresholds) else counted
    report = table.join(counted, "stage_name", "left").fillna(0, ["executions", "violations"])
    return _rates(report)


_REPORT = [
    "stage_name",
    "executions",
    "sla_threshold",
    "violations",
    "compliance_rate",
    "violation_rate",
    "sla_status",
]


def stage_report(
    stage_runs: DataFrame, thresholds: Thresholds = STAGE_SLA
) -> DataFrame:
    """SLA performance of every configured stage, in the order of ``thresholds``."""
    report = _ordered_report(stage_runs, thresholds)
    if _bounded(thresholds):
        # One row per threshold: one task may sort them without sampling ranges.
        return report.coalesce(1).sortWithinPartitions("ord").select(*_REPORT)
    return report.orderBy("ord").select(*_REPORT)


def worst_stage(stage_runs: DataFrame, thresholds: Thresholds = STAGE_SLA) -> DataFrame:
    """The configured stage with data and the highest violation rate; first on a tie."""
    return (
        _ordered_report(stage_runs, thresholds)
        .filter(F.col("executions") > 0)
        .orderBy(F.col("violation_rate").desc(), "ord")
        .limit(1)
        .select(*_REPORT)
    )


def overall_report(
    stage_runs: DataFrame, thresholds: Thresholds = STAGE_SLA
) -> DataFrame:
    """One row over all executions, configured or not, with the worst stage.

    Together with :func:`stage_report` this is the complete report.  One scan: a
    map-side lookup, partial counts per stage, and a fold of those few rows.
    """
    table = threshold_table(stage_runs.sparkSession, thresholds)
    per_stage = (
        _with_thresholds(stage_runs, table, thresholds, "left")
        .groupBy("stage_name", "ord")
        .agg(
            F.count("*").alias("executions"),
            F.count_if(F.col("duration") > F.col("sla_threshold")).alias("violations"),
        )
    )
    rated = _rates(per_stage)
    worst = F.when(F.col("ord").isNotNull(), F.struct(-F.col("violation_rate"), F.col("ord")))
    totals = rated.agg(
        F.coalesce(F.sum("executions"), F.lit(0)).alias("total_executions"),
        F.coalesce(F.sum("violations"), F.lit(0)).alias("total_violations"),
        F.min_by("stage_name", worst).alias("worst_stage"),
        F.max(F.when(F.col("ord").isNotNull(), F.col("violation_rate"))).alias(
            "worst_violation_rate"
        ),
    )
    total, broken = F.col("total_executions"), F.col("total_violations")
    return totals.select(
        "total_executions",
        "total_violations",
        percentage(total - broken, total).alias("overall_compliance_rate"),
        "worst_stage",
        "worst_violation_rate",
    )


def full_report(stage_runs: DataFrame, thresholds: Thresholds = STAGE_SLA) -> DataFrame:
    """The complete report in rows ``(section, position, ..)``.

    ``overall`` counts all executions, configured or not; ``stage`` are the rows of
    :func:`stage_report` in order; ``worst`` is that of :func:`worst_stage`, if there is
    one.  One scan: partial counts per threshold, of which grouping sets make the totals.
    """
    table = threshold_table(stage_runs.sparkSession, thresholds)
    counted = (
        _with_thresholds(stage_runs, table, thresholds, "left")
        .groupBy("ord")
        .agg(
            F.count("*").alias("executions"),
            F.count_if(F.col("duration") > F.col("sla_threshold")).alias("violations"),
        )
    )
    # Stages without an execution are rows too.
    counted = counted.withColumns(
        {"stage_name": F.lit(None).cast("string"), "sla_threshold": F.lit(None).cast("double")}
    ).unionByName(table.withColumns({"executions": F.lit(0), "violations": F.lit(0)}))
    # Grouping sets of no row have no total; a row that counts nothing makes sure of one.
    nothing = [F.lit(0 if c in ("executions", "violations") else None).cast(t).alias(c) for c, t in counted.dtypes]
    counted = counted.unionByName(table.sparkSession.range(1).select(*nothing))
    summed = counted.groupingSets([["ord"], []], "ord").agg(
        F.grouping("ord").alias("all"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("executions", "violations")],
        *[F.max(c).alias(c) for c in ("stage_name", "sla_threshold")],
    )
    rated = _rates(summed)
    stages = rated.filter("all = 0 AND ord IS NOT NULL")
    shown = [c for c in _REPORT if c not in ("stage_name", "sla_threshold")]
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("stage_name", "string"), ("sla_threshold", "double"))]
    overall = rated.filter("all = 1").select(
        F.lit("overall").alias("section"), F.lit(0).alias("position"), *nothing, *shown
    )
    worst = stages.filter("executions > 0").orderBy(F.col("violation_rate").desc(), "ord").limit(1)
    return overall.unionByName(
        stages.select(F.lit("stage").alias("section"), F.col("ord").cast("int").alias("position"), *_REPORT)
    ).unionByName(worst.select(F.lit("worst").alias("section"), F.lit(0).alias("position"), *_REPORT))


def recommendations(
    baseline: DataFrame, thresholds: Thresholds = STAGE_SLA
) -> DataFrame:
    """KEEP or INVESTIGATE for every stage that has a baseline and a threshold."""
    table = threshold_table(baseline.sparkSession, thresholds).drop("ord")
    p95 = F.col("p95_duration")
    return baseline.join(table, "stage_name").select(
        "stage_name",
        "executions",
        "average_duration",
        "p95_duration",
        F.col("sla_threshold").alias("current_sla"),
        round_even(p95, 3).alias("recommended_sla"),
        F.when(p95 <= F.col("sla_threshold"), "KEEP")
        .otherwise("INVESTIGATE")
        .alias("recommendation"),
    )


def to_investigate(recommended: DataFrame) -> DataFrame:
    return recommended.filter(F.col("recommendation") == "INVESTIGATE")


def recommendation_report(recommended: DataFrame) -> DataFrame:
    """Totals, every recommendation, and the stages to investigate, as rows with a section.

    Grouping sets give the stages' rows and their totals, so the baseline behind them is
    computed once.
    """
    columns = recommended.columns
    investigate = F.col("recommendation") == "INVESTIGATE"
    nothing = [F.lit(None).cast(t).alias(c) for c, t in recommended.dtypes]
    recommended = recommended.unionByName(recommended.sparkSession.range(1).select(*nothing))
    rows = recommended.groupingSets([columns, []], *columns).agg(
        F.grouping("stage_name").alias("all"),
        F.count("stage_name").alias("total_stages"),
        F.count_if(investigate).alias("stages_to_investigate"),
    )
    section = (
        F.when(F.col("all") == 1, F.array(F.lit("summary")))
        .when(F.col("stages_to_investigate") > 0, F.array(F.lit("recommendation"), F.lit("investigate")))
        .otherwise(F.array(F.lit("recommendation")))
    )
    totals = [F.when(F.col("all") == 1, F.col(c)).alias(c) for c in ("total_stages", "stages_to_investigate")]
    return rows.filter("all = 1 OR stage_name IS NOT NULL").select(F.explode(section).alias("section"), *columns, *totals)


def recommendation_summary(recommended: DataFrame) -> DataFrame:
    return recommended.agg(
        F.count("*").alias("total_stages"),
        F.count_if(F.col("recommendation") == "INVESTIGATE").alias("stages_to_investigate"),
    )
