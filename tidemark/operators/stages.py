"""Statistics over stage executions ``(run_id, stage_name, duration)``.

``order_by`` names the columns that decide wherever two rows tie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import exact_avg, exact_sum, exceeds, measure, round_even

ORDER = ("run_id", "stage_name")


def cleaned(stage_runs: DataFrame) -> DataFrame:
    """Durations as doubles; unparsable text and NaN as null."""
    return stage_runs.withColumn("duration", measure("duration"))


def total_executions(stage_runs: DataFrame) -> DataFrame:
    return stage_runs.agg(F.count("*").alias("total_stage_executions"))


def _averages(stage_runs: DataFrame) -> DataFrame:
    return (
        cleaned(stage_runs)
        .filter(F.col("stage_name").isNotNull())
        .groupBy("stage_name")
        .agg(exact_avg("duration").alias("mean"))
    )


def average_by_stage(stage_runs: DataFrame) -> DataFrame:
    return _averages(stage_runs).select(
        "stage_name", round_even(F.col("mean"), 3).alias("average_duration")
    )


def stage_summary(stage_runs: DataFrame) -> DataFrame:
    """Executions, mean, min and max per named stage; null durations are not executions."""
    return (
        cleaned(stage_runs)
        .filter(F.col("stage_name").isNotNull())
        .groupBy("stage_name")
        .agg(
            F.count("duration").alias("executions"),
            round_even(exact_avg("duration"), 3).alias("average_duration"),
            round_even(F.min("duration"), 3).alias("minimum_duration"),
            round_even(F.max("duration"), 3).alias("maximum_duration"),
        )
    )


def extreme_execution(
    stage_runs: DataFrame, slowest: bool, order_by: Sequence[str] = ORDER
) -> DataFrame:
    """The single fastest or slowest execution, whole row; earliest in order on a tie."""
    duration = F.col("duration").desc() if slowest else F.col("duration").asc()
    return (
        cleaned(stage_runs)
        .filter(F.col("duration").isNotNull())
        .orderBy(duration, *order_by)
        .limit(1)
    )


def extreme_stage_by_average(stage_runs: DataFrame, slowest: bool) -> DataFrame:
    """The stage with the lowest or highest unrounded mean; alphabetical on a tie."""
    mean = F.col("mean").desc() if slowest else F.col("mean").asc()
    return (
        _averages(stage_runs)
        .filter(F.col("mean").isNotNull())
        .orderBy(mean, "stage_name")
        .limit(1)
        .select("stage_name", round_even(F.col("mean"), 3).alias("average_duration"))
    )


def full_analytics(stage_runs: DataFrame, order_by: Sequence[str] = ORDER) -> DataFrame:
    """All stage statistics as rows with a section.

    ``total`` counts every row; ``stage`` has executions, mean and extremes of each named
    stage; ``fastest_average`` and ``slowest_average`` name a stage; ``fastest_execution``
    and ``slowest_execution`` are single rows of the ledger.  One scan for the aggregates,
    whose totals are grouping sets of the stages' rows, and one bounded top-1 for each
    extreme execution.
    """
    rows = cleaned(stage_runs)
    per_stage = rows.groupBy("stage_name").agg(
        F.count("*").alias("all_rows"),
        F.count("duration").alias("executions"),
        exact_avg("duration").alias("mean"),
        F.min("duration").alias("low"),
        F.max("duration").alias("high"),
    )
    # Grouping sets of no row have no total; a row that counts nothing makes sure of one.
    nothing = [F.lit(0 if c in ("all_rows", "executions") else None).cast(t).alias(c) for c, t in per_stage.dtypes]
    per_stage = per_stage.unionByName(stage_runs.sparkSession.range(1).select(*nothing))
    both = per_stage.groupingSets([["stage_name"], []], "stage_name").agg(
        F.grouping("stage_name").alias("all"),
        F.coalesce(F.sum("all_rows"), F.lit(0)).alias("all_rows"),
        F.sum("executions").alias("executions"),
        *[F.max(c).alias(c) for c in ("mean", "low", "high")],
    )
    named = both.filter("all = 0 AND stage_name IS NOT NULL")

    def section(name: str, df: DataFrame, **values: Column) -> DataFrame:
        kinds = {
            "stage_name": "string", "run_id": "string", "executions": "long", "duration": "double",
            "average_duration": "double", "minimum_duration": "double", "maximum_duration": "double",
        }
        given = {c: values.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in kinds.items()}
        return df.select(F.lit(name).alias("section"), *given.values())

    def by_mean(name: str, order: Column) -> DataFrame:
        first = named.filter("mean IS NOT NULL").orderBy(order, "stage_name").limit(1)
        mean = round_even(F.col("mean"), 3)
        return section(name, first, stage_name=F.col("stage_name"), average_duration=mean)

    def extreme(name: str, slowest: bool) -> DataFrame:
        columns = {c: F.col(c) for c in ("run_id", "stage_name", "duration")}
        return section(name, extreme_execution(stage_runs, slowest, order_by), **columns)

    per_name = section(
        "stage",
        named,
        stage_name=F.col("stage_name"),
        executions=F.col("executions"),
        average_duration=round_even(F.col("mean"), 3),
        minimum_duration=round_even(F.col("low"), 3),
        maximum_duration=round_even(F.col("high"), 3),
    )
    out = section("total", both.filter("all = 1"), executions=F.col("all_rows")).unionByName(per_name)
    for part in (
        by_mean("fastest_average", F.col("mean").asc()),
        by_mean("slowest_average", F.col("mean").desc()),
        extreme("fastest_execution", False),
        extreme("slowest_execution", True),
    ):
        out = out.unionByName(part)
    return out


def stage_analytics_summary(stage_runs: DataFrame) -> DataFrame:
    """Total, and fastest and slowest stage by mean, as one row from one scan."""
    per_stage = (
        cleaned(stage_runs)
        .groupBy("stage_name")
        .agg(F.count("*").alias("all_rows"), exact_avg("duration").alias("mean"))
    )
    named = F.col("stage_name").isNotNull() & F.col("mean").isNotNull()

    def first_by(measured):
        return F.min_by("stage_name", F.when(named, F.struct(measured, F.col("stage_name"))))

    return per_stage.agg(
        F.coalesce(F.sum("all_rows"), F.lit(0)).alias("total_stage_executions"),
        first_by(F.col("mean")).alias("fastest_stage_by_average"),
        first_by(-F.col("mean")).alias("slowest_stage_by_average"),
        round_even(F.min(F.when(named, F.col("mean"))), 3).alias("fastest_average_duration"),
        round_even(F.max(F.when(named, F.col("mean"))), 3).alias("slowest_average_duration"),
    )


def run_stage_metrics(
    stage_runs: DataFrame, runs: DataFrame | None = None, order: str = "stage_name"
) -> DataFrame:
    """Stage count and fastest/slowest stage of every run.

    Executions are first reduced to one row per (run, stage), with fixed-width
    partial aggregates, so no run is gathered row by row.  Ties go to the stage
    with the smallest ``order`` value, a number or the stage name.  With ``runs``, runs without any stage
    appear with 0 stages and 0.0 durations.
    """
    aggregates = [F.min("duration").alias("low"), F.max("duration").alias("high")]
    if order != "stage_name":
        aggregates.append(F.min(order).alias("place"))
    per_stage = cleaned(stage_runs).groupBy("run_id", "stage_name").agg(*aggregates)
    if order == "stage_name":
        per_stage = per_stage.withColumn("place", F.col("stage_name"))

    def stage_at(measured: str, sign: int):
        rank = F.when(
            F.col(measured).isNotNull(), F.struct(sign * F.col(measured), F.col("place"))
        )
        return F.min_by("stage_name", rank)

    metrics = per_stage.groupBy("run_id").agg(
        F.count("*").alias("total_stages"),
        stage_at("low", 1).alias("fastest_stage"),
        stage_at("high", -1).alias("slowest_stage"),
        F.min("low").alias("fastest_duration"),
        F.max("high").alias("slowest_duration"),
    )
    if runs is None:
        return metrics
    return (
        runs.select("run_id")
        .join(metrics, "run_id", "left")
        .withColumns(
            {
                "total_stages": F.coalesce("total_stages", F.lit(0)),
                "fastest_duration": F.when(
                    F.col("total_stages").isNull(), 0.0
                ).otherwise(F.col("fastest_duration")),
                "slowest_duration": F.when(
                    F.col("total_stages").isNull(), 0.0
                ).otherwise(F.col("slowest_duration")),
            }
        )
    )


def run_average_stage_duration(
    stage_runs: DataFrame, runs: DataFrame | None = None
) -> DataFrame:
    """Mean stage duration of every run; 0.0 for a run without stages."""
    means = (
        cleaned(stage_runs)
        .groupBy("run_id")
        .agg(exact_avg("duration").alias("average_stage_duration"))
    )
    if runs is not None:
        means = runs.select("run_id").join(means, "run_id", "left")
    return means.withColumn(
        "average_stage_duration", F.coalesce("average_stage_duration", F.lit(0.0))
    )


def run_total_duration(stage_runs: DataFrame) -> DataFrame:
    """Run duration as the sum of its stages."""
    return (
        cleaned(stage_runs)
        .groupBy("run_id")
        .agg(F.coalesce(exact_sum("duration"), F.lit(0.0)).alias("total_duration"))
    )


def slow_stages(stage_runs: DataFrame, threshold: float) -> DataFrame:
    return cleaned(stage_runs.filter(exceeds(stage_runs, "duration", threshold)))
