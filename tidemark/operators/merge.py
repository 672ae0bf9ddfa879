"""Incremental loads: insert-only, keyed upsert, change classes, first-of-key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.enrich import backfill_lineage
from tidemark.plans.sizing import fits, is_small

LOOKUP_BYTES = 32 * 1024 * 1024
CHANGE = "change"


def keep_first(df: DataFrame, key: str, order_by: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order.

    ``row_number() = 1`` is pruned to one row per key in every map task before
    the shuffle, so a key holding most of the rows sends one row per task.
    """
    window = Window.partitionBy(key).orderBy(*order_by)
    return (
        df.withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def new_rows(
    existing: DataFrame, incoming: DataFrame, key: str, order_by: Sequence[Column | str]
) -> DataFrame:
    """Incoming rows whose key is not in ``existing``, the first of each key.

    Next to a small batch the existing keys are looked up where they are, and only
    those the batch has are moved.
    """
    first = keep_first(incoming, key, order_by)
    known = existing.select(key)
    if fits(incoming.select(key), LOOKUP_BYTES):
        known = known.join(F.broadcast(first.select(key)), key, "left_semi")
    return first.join(known, key, "left_anti").select(*incoming.columns)


def insert_only(
    existing: DataFrame,
    incoming: DataFrame,
    key: str,
    order_by: Sequence[str],
    existing_order: Sequence[str] | None = None,
) -> DataFrame:
    """``existing`` followed by its unseen incoming rows; existing rows win.

    A repeated key within ``existing`` keeps its first row by ``existing_order``;
    without that argument the existing side is taken to be unique already.
    """
    added = new_rows(existing, incoming, key, order_by)
    if existing_order is not None:
        existing = keep_first(existing, key, existing_order)
    return existing.unionByName(added, allowMissingColumns=True)


def key_overlap(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Every key with the side it is on: BOTH, EXISTING or INCOMING; one shuffle."""
    sides = existing.select(key, F.lit(1).alias("e"), F.lit(0).alias("i")).unionAll(
        incoming.select(key, F.lit(0).alias("e"), F.lit(1).alias("i"))
    )
    return sides.groupBy(key).agg(F.max("e").alias("e"), F.max("i").alias("i")).select(
        key,
        F.when((F.col("e") == 1) & (F.col("i") == 1), "BOTH")
        .when(F.col("e") == 1, "EXISTING")
        .otherwise("INCOMING")
        .alias("side"),
    )


def assert_mergeable(existing: DataFrame | None, incoming: DataFrame, key: str) -> None:
    """Refuse null or repeated keys on either side given: one key-only job for both."""
    sides = incoming.select(key, F.lit(0).alias("e"), F.lit(1).alias("i"))
    if existing is not None:
        sides = sides.unionAll(existing.select(key, F.lit(1).alias("e"), F.lit(0).alias("i")))
    counts = sides.groupBy(key).agg(F.sum("e").alias("e"), F.sum("i").alias("i"))
    bad = counts.filter((F.col("e") > 1) | (F.col("i") > 1) | F.col(key).isNull()).limit(1)
    for row in bad.collect():
        side = "existing" if row["e"] > 1 else "incoming"
        kind = "null" if row[key] is None else "repeated"
        raise ValueError(f"{kind} {key} on the {side} side: {row[key]}")


def _wrapped(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.select(F.col(key), F.struct(*df.columns).alias(name))


def _change(
    existing: DataFrame, incoming: DataFrame, compare: Sequence[str] | None
) -> Column:
    """Change class of a joined row; a side that is absent is a null struct."""
    if compare is None:
        if set(existing.columns) != set(incoming.columns):
            # Rows with different columns are never equal.
            same = F.lit(False)
        else:
            compare = existing.columns
    if compare is not None:
        left = F.struct(*[F.col(f"_e.{c}").alias(c) for c in compare])
        right = F.struct(
            *[F.col(f"_i.{c}").cast(existing.schema[c].dataType).alias(c) for c in compare]
        )
        same = left.eqNullSafe(right)
    return (
        F.when(F.col("_e").isNull(), "INSERTED")
        .when(F.col("_i").isNull(), "KEPT")
        .when(same, "UNCHANGED")
        .otherwise("UPDATED")
    )


def _merged_columns(existing: DataFrame, incoming: DataFrame, key: str) -> list[Column]:
    columns = [F.col(key)]
    for name in existing.columns:
        if name == key:
            continue
        if name in incoming.columns:
            dtype = existing.schema[name].dataType
            value = F.coalesce(F.col(f"_i.{name}").cast(dtype), F.col(f"_e.{name}"))
        else:
            value = F.col(f"_e.{name}")
        columns.append(value.alias(name))
    for name in incoming.columns:
        if name not in existing.columns:
            # The target lacks this column: updates add none, inserts bring theirs.
            columns.append(F.when(F.col("_e").isNull(), F.col(f"_i.{name}")).alias(name))
    return columns


def _pair_full_outer(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    return _wrapped(existing, key, "_e").join(_wrapped(incoming, key, "_i"), key, "full_outer")


def _pair_lookup(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """The same pairs without moving the existing rows when incoming is small."""
    hinted = F.broadcast if fits(incoming, LOOKUP_BYTES) else (lambda df: df)
    matched = _wrapped(existing, key, "_e").join(
        hinted(_wrapped(incoming, key, "_i")), key, "left"
    )
    known = existing.select(key).join(hinted(incoming.select(key)), key, "left_semi")
    unseen = _wrapped(incoming, key, "_i").join(known, key, "left_anti")
    absent = F.lit(None).cast(matched.schema["_e"].dataType)
    return matched.unionByName(unseen.withColumn("_e", absent))


def upsert(
    existing: DataFrame,
    incoming: DataFrame,
    key: str,
    compare: Sequence[str] | None = None,
    lineage: bool = True,
    strategy: str = "auto",
    validate: str = "both",
) -> DataFrame:
    """Merge ``incoming`` into ``existing`` by unique key, with a ``change`` column.

    An incoming null never overwrites a value.  ``compare`` limits which columns
    decide UPDATED versus UNCHANGED; by default all of them do.  ``strategy``:
    ``full_outer`` shuffles both sides once; ``lookup`` suits a batch that is
    small next to the target, which then stays where it is; ``auto`` takes
    ``lookup`` when the batch is estimated within ``LOOKUP_BYTES``.  ``validate``
    names the sides whose keys are checked first: ``both``, ``incoming`` (for a
    target that only ever was written by upserts) or ``none``.
    """
    if strategy not in ("auto", "full_outer", "lookup"):
        raise ValueError(f"unknown merge strategy {strategy!r}")
    if validate not in ("both", "incoming", "none"):
        raise ValueError(f"unknown validation {validate!r}")
    if validate != "none":
        assert_mergeable(existing if validate == "both" else None, incoming, key)
    if strategy == "auto":
        strategy = "lookup" if is_small(incoming, LOOKUP_BYTES) else "full_outer"
    pair = _pair_lookup if strategy == "lookup" else _pair_full_outer
    merged = pair(existing, incoming, key).select(
        *_merged_columns(existing, incoming, key),
        _change(existing, incoming, compare).alias(CHANGE),
    )
    return backfill_lineage(merged) if lineage else merged


def change_counts(merged: DataFrame) -> DataFrame:
    """One row: inserted, updated, unchanged, kept."""
    return merged.agg(
        *[
            F.count_if(F.col(CHANGE) == name).alias(name.lower())
            for name in ("INSERTED", "UPDATED", "UNCHANGED", "KEPT")
        ]
    )


def sorted_by_key(df: DataFrame, key: str) -> DataFrame:
    """Range-partitioned and sorted: files in key order without a single-task sort."""
    return df.repartitionByRange(F.col(key)).sortWithinPartitions(key)


def union_drifted(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by name; a column absent on one side becomes null there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
