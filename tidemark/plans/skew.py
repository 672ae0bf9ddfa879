"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.scratch import materialized
from tidemark.plans.sizing import estimated_bytes

#: Rows of one key that a task takes; a key with more is spread over several tasks.
ROWS_PER_TASK = 1_000_000
#: A list of hot keys up to this many rows is broadcast.
HOT_LIST_ROWS = 100_000
#: Rows with a null key match nothing and may go anywhere.
NULL_SALTS = 10_007
BROADCAST_BYTES = 10 * 1024 * 1024


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``(key, salts)`` of the keys with more rows than one task takes, counted exactly."""
    counts = (
        df.select(key).filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n"))
    )
    salts = F.ceil(F.col("n") / rows_per_task).cast("int")
    return counts.filter(F.col("n") > rows_per_task).select(key, salts.alias("_salts"))


def salted_join(
    facts: DataFrame,
    parents: DataFrame,
    key: str,
    how: str = "inner",
    rows_per_task: int = ROWS_PER_TASK,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Join on ``key`` with the rows of each hot fact key spread over as many tasks as it needs.

    The facts' keys are counted once and the hot ones written; their list grows with the
    rows (one per ``rows_per_task`` at most), so it is broadcast only after its rows are
    counted.  The salt is a hash of ``spread_by`` (all fact columns by default), so a retried
    task salts its rows the same way; name a unique column when rows are wide.
    Parents of hot keys are repeated once per salt, which adds at most one row for
    ``rows_per_task`` facts and parent.
    ``how`` may be ``inner``, ``left``, ``left_semi`` or ``left_anti``.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"cannot salt a {how} join")
    hot = materialized(hot_keys(facts, key, rows_per_task), "hot-keys")
    if hot.count() <= HOT_LIST_ROWS:
        hot = F.broadcast(hot)
    spread = F.xxhash64(*(spread_by or facts.columns))
    salts = F.when(F.col(key).isNull(), F.lit(NULL_SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    left = facts.join(hot, key, "left").withColumn("_salt", F.pmod(spread, salts).cast("int"))
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    right = parents.join(hot, key, "left").withColumn("_salt", F.explode(copies))
    return left.drop("_salts").join(right.drop("_salts"), [key, "_salt"], how).drop("_salt")


def keyed_join(
    facts: DataFrame,
    parents: DataFrame,
    key: str,
    how: str = "inner",
    strategy: str = "auto",
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Fact-to-parent join that picks its own protection against hot keys.

    ``auto`` leaves a join whose parent side is within the broadcast limit to the
    optimizer (no shuffle, so no skew) and salts a larger one; ``plain`` and
    ``salted`` force either.
    """
    if strategy not in ("auto", "plain", "salted"):
        raise ValueError(f"unknown join strategy {strategy!r}")
    size = estimated_bytes(parents)
    if strategy == "plain" or (
        strategy == "auto" and size is not None and size <= BROADCAST_BYTES
    ):
        return facts.join(parents, key, how)
    return salted_join(facts, parents, key, how, spread_by=spread_by)
