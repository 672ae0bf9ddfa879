"""Run and stage ledger rows, derived for all runs at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.enrich import conform
from tidemark.operators.stages import run_stage_metrics
from tidemark.plans.sizing import dimension

#: Stages in one word of bits; the sign bit is left out.
WORD = 63


def total_retries(attempts: Column | str = "retry_information") -> Column:
    """Retries over a map ``stage -> (attempts, retries)``; absent counts as 0."""
    values = F.map_values(F.col(attempts) if isinstance(attempts, str) else attempts)
    total = F.aggregate(
        values, F.lit(0).cast("long"), lambda acc, v: acc + F.coalesce(v["retries"], F.lit(0))
    )
    return F.coalesce(total, F.lit(0))


def retry_totals(attempts: DataFrame) -> DataFrame:
    """Retries per run from rows ``(run_id, stage_name, attempts, retries)``."""
    return attempts.groupBy("run_id").agg(
        F.coalesce(F.sum("retries"), F.lit(0)).alias("total_retries")
    )


def retry_maps(attempts: DataFrame) -> DataFrame:
    """Per run the map ``stage -> (attempts, retries)`` and its retry total.

    Rows are first reduced to one per (run, stage), so a map holds one entry per
    stage name and never the raw attempts of a run.  Attempts without a stage name
    count in the total only.
    """
    per_stage = attempts.groupBy("run_id", "stage_name").agg(
        F.sum("attempts").cast("long").alias("attempts"),
        F.coalesce(F.sum("retries"), F.lit(0)).cast("long").alias("retries"),
    )
    value = F.struct("attempts", "retries").alias("value")
    entry = F.when(F.col("stage_name").isNotNull(), F.struct("stage_name", value))
    return per_stage.groupBy("run_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("retry_information"),
        F.sum("retries").alias("total_retries"),
    )


def stage_rows(runs: DataFrame, durations: str = "stage_durations") -> DataFrame:
    """One row per entry of a run's ``stage -> seconds`` map."""
    return runs.select(
        F.col("run_id").cast("string").alias("run_id"),
        F.explode(durations).alias("stage_name", "duration"),
    ).select("run_id", "stage_name", F.col("duration").cast("double").alias("duration"))


def run_records(
    runs: DataFrame,
    stage_runs: DataFrame,
    quality: DataFrame | None = None,
    attempts: DataFrame | None = None,
    order: str = "stage_name",
) -> DataFrame:
    """The 19-column ledger row of every run.

    All inputs are grouped by run before the joins, so the joins find them
    partitioned by ``run_id`` already.  Quality metrics belong to their own run
    and stay null for a run that produced none.
    """
    metrics = run_stage_metrics(stage_runs, order=order).drop("total_stages")
    records = runs.join(metrics, "run_id", "left").fillna(
        0.0, ["fastest_duration", "slowest_duration"]
    )
    if quality is not None:
        records = records.join(
            quality.select(
                "run_id", "records_checked", "null_values", "duplicate_post_ids", "quality_status"
            ),
            "run_id",
            "left",
        )
    if attempts is not None:
        records = records.join(retry_maps(attempts), "run_id", "left")
        records = records.fillna(0, ["total_retries"])
    else:
        records = records.withColumn("total_retries", F.lit(0).cast("long"))
    return conform(records, schemas.RUNS)


def normalized_runs(runs: DataFrame) -> DataFrame:
    """Ledger columns, types and order for rows of any earlier layout."""
    return conform(runs, schemas.RUNS)


def latest_quality(quality: DataFrame, run_id: str | None = None) -> DataFrame:
    """The newest quality metrics, of one run if it is given."""
    if run_id is not None:
        quality = quality.filter(F.col("run_id") == run_id)
    return quality.orderBy(F.col("recorded_at").desc(), F.col("run_id").desc()).limit(1)


def failed_stage(
    stage_rows: DataFrame,
    stages: Sequence[str] = tuple(schemas.STAGES),
    completed: Column | None = None,
    **also: Column,
) -> DataFrame:
    """Per run, the first stage in order that did not complete; null if all did.

    ``completed`` tells which rows count as completions (all by default), and
    ``also`` adds run-level aggregates to the same pass.  Each run is folded into a
    bit per stage, ``WORD`` stages to a word: fixed-width buffers, and no run-by-stage
    product.
    """
    words = range(-(-len(stages) // WORD))
    table = dimension(
        stage_rows.sparkSession,
        {
            "stage_name": list(stages),
            "word": [i // WORD for i in range(len(stages))],
            "bit": [1 << i % WORD for i in range(len(stages))],
        },
    )
    counts = F.lit(True) if completed is None else completed
    marked = [
        F.coalesce(F.bit_or(F.when(counts & (F.col("word") == w), F.col("bit"))), F.lit(0))
        for w in words
    ]
    done = (
        stage_rows.join(table, "stage_name", "left")
        .groupBy("run_id")
        .agg(
            *[bits.alias(f"done{w}") for w, bits in enumerate(marked)],
            *[value.alias(name) for name, value in also.items()],
        )
    )
    first_open = F.coalesce(
        F.lit(None).cast("string"),
        *[
            F.when(
                F.col(f"done{i // WORD}").bitwiseAND(F.lit(1 << i % WORD)) == 0, F.lit(name)
            )
            for i, name in enumerate(stages)
        ],
    )
    successful = sum((F.bit_count(f"done{w}") for w in words), F.lit(0))
    return done.select(
        "run_id",
        successful.cast("long").alias("successful_stages"),
        first_open.alias("failed_stage"),
        *also,
    )
