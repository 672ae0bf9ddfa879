"""Historical baseline of every stage: count, mean, extremes and percentiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numeric import exact_avg, round_even
from tidemark.operators.percentiles import selected_percentiles
from tidemark.operators.stages import cleaned
from tidemark.plans.scratch import materialized
from tidemark.plans.sizing import is_small

# The percentiles of a baseline, by output column.
PERCENTILES = {"median_duration": 0.5, "p95_duration": 0.95, "p99_duration": 0.99}


def _statistics(stage_runs: DataFrame, method: str) -> DataFrame:
    """Per stage: all rows, measured rows, and the unrounded statistics."""
    if method not in ("auto", "percentile", "selection", "approximate"):
        raise ValueError(f"unknown percentile method {method!r}")
    rows = cleaned(stage_runs.select("stage_name", "duration"))
    if method == "auto":
        method = "percentile" if is_small(rows) else "selection"
    points = list(PERCENTILES.values())
    aggregates = [
        F.count("*").alias("all_rows"),
        F.count("duration").alias("executions"),
        exact_avg("duration").alias("mean"),
        F.min("duration").alias("low"),
        F.max("duration").alias("high"),
    ]
    if method == "percentile":
        aggregates.append(F.percentile("duration", points).alias("percentiles"))
    elif method == "approximate":
        aggregates.append(F.percentile_approx("duration", points, 10_000).alias("percentiles"))
    statistics = rows.groupBy("stage_name").agg(*aggregates)
    if method == "selection":
        statistics = materialized(statistics, "statistics")
        spans = statistics.select("stage_name", F.col("executions").alias("n"), "low", "high")
        chosen = selected_percentiles(rows, "stage_name", "duration", points, spans=spans)
        statistics = statistics.join(chosen, "stage_name", "left")
    return statistics


def _rounded(statistics: DataFrame) -> DataFrame:
    columns = {
        "average_duration": F.col("mean"),
        "minimum_duration": F.col("low"),
        "maximum_duration": F.col("high"),
    }
    for place, name in enumerate(PERCENTILES):
        columns[name] = F.col("percentiles")[place]
    return statistics.select(
        "stage_name",
        "all_rows",
        "executions",
        *[round_even(value, 3).alias(name) for name, value in columns.items()],
    )


def stage_baseline(stage_runs: DataFrame, method: str = "auto") -> DataFrame:
    """One row per stage that has at least one measured duration.

    ``method``: ``percentile`` is one aggregation that holds a stage's distinct
    values in a task; ``selection`` is exact at any size; ``auto`` takes the
    former only for inputs of a checked small size; ``approximate`` trades
    exactness for one bounded pass.
    """
    measured = (F.col("executions") > 0) & F.col("stage_name").isNotNull()
    return _rounded(_statistics(stage_runs, method).filter(measured)).drop("all_rows")


def stage_baseline_for(stage_runs: DataFrame, stage: str, method: str = "auto") -> DataFrame:
    """The baseline of one stage; the filter reaches the scan."""
    return stage_baseline(stage_runs.filter(F.col("stage_name") == stage), method)


def _first(baseline: DataFrame, column: str, highest: bool) -> DataFrame:
    order = F.col(column).desc() if highest else F.col(column).asc()
    return baseline.orderBy(order, "stage_name").limit(1)


def slowest_average_stage(baseline: DataFrame) -> DataFrame:
    """Highest rounded mean, as a whole baseline row; alphabetical on a tie."""
    return _first(baseline, "average_duration", True)


def fastest_average_stage(baseline: DataFrame) -> DataFrame:
    return _first(baseline, "average_duration", False)


def highest_p95_stage(baseline: DataFrame) -> DataFrame:
    return _first(baseline, "p95_duration", True)


def baseline_summary(stage_runs: DataFrame, method: str = "auto") -> DataFrame:
    """One row: totals and the slowest, fastest and highest-p95 stage.

    The baseline is computed once; total executions count every row, measured or
    not, unless no stage has a baseline.
    """
    stages = _rounded(_statistics(stage_runs, method))
    known = (F.col("executions") > 0) & F.col("stage_name").isNotNull()

    def stage_at(rank):
        return F.min_by("stage_name", F.when(known, F.struct(rank, F.col("stage_name"))))

    summary = stages.agg(
        F.coalesce(F.sum("all_rows"), F.lit(0)).alias("all_rows"),
        F.count_if(known).alias("stages_analyzed"),
        stage_at(-F.col("average_duration")).alias("slowest_average_stage"),
        stage_at(F.col("average_duration")).alias("fastest_average_stage"),
        stage_at(-F.col("p95_duration")).alias("highest_p95_stage"),
    )
    total = F.when(F.col("stages_analyzed") > 0, F.col("all_rows")).otherwise(F.lit(0))
    return summary.select(
        total.alias("total_stage_executions"),
        "stages_analyzed",
        "slowest_average_stage",
        "fastest_average_stage",
        "highest_p95_stage",
    )
