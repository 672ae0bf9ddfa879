"""Data-quality, schema, freshness and relationship checks.

A check is one row ``(position, check_name, status, violations, detail)``; rows
of several checks are unioned, and :func:`assert_passed` turns the first failure
into an exception.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

from tidemark import schemas
from tidemark.plans.skew import keyed_join

# Columns a post must have, those that may not be null, derived lengths.
REQUIRED = [
    "user_id",
    "post_id",
    "title",
    "body",
    "title_length",
    "body_length",
    "processed_at",
]
NOT_NULL = ["user_id", "post_id", "title", "body"]
LENGTHS = {"title_length": "title", "body_length": "body"}

_LOGICAL = {
    "int": (ByteType, ShortType, IntegerType, LongType),
    "datetime": (TimestampType, TimestampNTZType),
    "string": (StringType,),
}
_TYPE_NAMES = {"int": "integer", "datetime": "datetime", "string": "string"}


class CheckFailed(ValueError):
    """A data-quality check did not pass."""


def _verdict(violations: Column) -> Column:
    return F.when(violations > 0, "FAILED").otherwise("PASSED")


def _row(position: int, name: str, violations: Column, detail: Column) -> Column:
    violations = violations.cast("long")
    return F.struct(
        F.lit(position).alias("position"),
        F.lit(name).alias("check_name"),
        _verdict(violations).alias("status"),
        violations.alias("violations"),
        F.when(violations > 0, detail).otherwise("").alias("detail"),
    )


def _rows(aggregated: DataFrame, rows: Sequence[Column]) -> DataFrame:
    return aggregated.select(F.inline(F.array(*rows)))


def missing_columns(df: DataFrame, required: Sequence[str] = REQUIRED) -> list[str]:
    return sorted(set(required) - set(df.columns))


def unexpected_columns(df: DataFrame, expected: Sequence[str]) -> list[str]:
    return sorted(set(df.columns) - set(expected))


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, or NaN in a floating-point column."""
    missing = F.col(name).isNull()
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        missing = missing | F.isnan(name)
    return missing


def null_counts(df: DataFrame, columns: Sequence[str] = NOT_NULL) -> DataFrame:
    """One row ``(column_name, null_count)`` per column, from a single pass."""
    counted = df.agg(*[F.count_if(is_missing(df, c)).alias(c) for c in columns])
    pairs = [
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns
    ]
    return counted.select(F.inline(F.array(*pairs)))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their row counts; nulls equal each other."""
    return df.groupBy(key).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def key_summary(df: DataFrame, key: str) -> DataFrame:
    """One row: rows beyond the first of each key, and how many keys repeat."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"),
        F.count_if(F.col("n") > 1).alias("repeated_keys"),
    )


def length_mismatch(length: str, text: str) -> Column:
    """True where the stored length is not the text's length, or either is null."""
    return ~F.coalesce(F.col(length) == F.length(text), F.lit(False))


def quality_metrics(df: DataFrame, key: str = "post_id") -> DataFrame:
    """Record, null and duplicate counts with a verdict: one scan, one key shuffle."""
    nulls = sum((is_missing(df, c).cast("int") for c in df.columns), F.lit(0))
    if key in df.columns:
        per_key = df.groupBy(key).agg(F.count("*").alias("n"), F.sum(nulls).alias("nulls"))
        duplicates = F.sum(F.col("n") - 1)
    else:
        per_key = df.agg(F.count("*").alias("n"), F.sum(nulls).alias("nulls"))
        duplicates = F.lit(0)
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("records_checked"),
        F.coalesce(F.sum("nulls"), F.lit(0)).cast("long").alias("null_values"),
        F.coalesce(duplicates, F.lit(0)).cast("long").alias("duplicate_post_ids"),
    )
    failed = (
        (F.col("records_checked") == 0)
        | (F.col("null_values") > 0)
        | (F.col("duplicate_post_ids") > 0)
    )
    return totals.withColumn("quality_status", F.when(failed, "FAILED").otherwise("PASSED"))


def freshness(
    df: DataFrame,
    now: Column,
    max_hours: float = schemas.FRESHNESS_HOURS,
    column: str = "processed_at",
) -> DataFrame:
    """One check row; strictly older than ``max_hours`` fails, no timestamp is NO DATA."""
    zoned = isinstance(df.schema[column].dataType, TimestampType)
    latest = df.agg(F.max(column).alias("latest"))
    return _rows(latest, [_freshness_row(0, now, max_hours, zoned)])


def _freshness_row(position: int, now: Column, max_hours: float, zoned: bool) -> Column:
    """The check row of an aggregate with the ``latest`` timestamp."""
    if zoned:
        # Instants, so that a clock change in the session's zone does not count.
        age = F.unix_micros(now) - F.unix_micros("latest")
        too_old = age > F.lit(round(max_hours * 3_600_000_000))
    else:
        too_old = now - F.col("latest") > F.lit(timedelta(hours=max_hours))
    status = (
        F.when(F.col("latest").isNull(), "NO DATA")
        .when(too_old, "FAILED")
        .otherwise("PASSED")
    )
    return F.struct(
        F.lit(position).alias("position"),
        F.lit("freshness").alias("check_name"),
        status.alias("status"),
        (status != "PASSED").cast("long").alias("violations"),
        F.when(status == "NO DATA", "no timestamps")
        .when(status == "FAILED", "the newest row is too old")
        .otherwise("")
        .alias("detail"),
    )


def orphans(
    children: DataFrame,
    parents: DataFrame,
    key: str,
    strategy: str = "auto",
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Child rows without a parent; a null key has none."""
    return keyed_join(children, parents.select(key), key, "left_anti", strategy, spread_by)


def relationship(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
    """One check row with the number of orphans; :func:`orphans` lists them.

    Children are counted per key before the join, so a key with most of the rows
    moves as one row per task and only the key column is read.
    """
    per_key = children.groupBy(key).agg(F.count("*").alias("n"))
    unmatched = per_key.join(parents.select(key), key, "left_anti")
    counted = unmatched.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    detail = F.lit("Posts contain user_id values with no matching user")
    return _rows(counted, [_row(0, "relationship", F.col("n"), detail)])


def schema_differences(df: DataFrame, expected: Mapping[str, str]) -> list[tuple[str, str]]:
    """``(kind, column)`` for missing, unexpected and wrongly typed columns, in that order."""
    found = [("missing", c) for c in missing_columns(df, list(expected))]
    found += [("unexpected", c) for c in unexpected_columns(df, list(expected))]
    for name, logical in expected.items():
        if name in df.columns and not isinstance(df.schema[name].dataType, _LOGICAL[logical]):
            found.append(("type", name))
    return found


def exact_schema(df: DataFrame, expected: Mapping[str, str] = schemas.POST_TYPES) -> DataFrame:
    """One check row per expected column, plus one per unexpected column.

    A null in an integer column is a type failure as well: such a column would
    not be an integer column once it had been read back as numbers.
    """
    differences = schema_differences(df, expected)
    wrong = {(kind, name) for kind, name in differences}
    integers = [
        name
        for name, logical in expected.items()
        if logical == "int" and name in df.columns and ("type", name) not in wrong
    ]
    counted = df.agg(
        F.count("*").alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in integers],
    )
    rows = []
    for name in sorted(expected):
        absent = ("missing", name) in wrong
        rows.append(
            _row(0, f"column_present:{name}", F.lit(int(absent)), F.lit("Missing columns"))
        )
    for kind, name in differences:
        if kind == "unexpected":
            rows.append(
                _row(1, f"column_expected:{name}", F.lit(1), F.lit("Unexpected columns"))
            )
    for name, logical in expected.items():
        if name not in df.columns:
            continue
        nulls = F.col(name) if name in integers else F.lit(0)
        violations = F.lit(1) if ("type", name) in wrong else (nulls > 0).cast("int")
        detail = F.lit(f"{name} must be {_TYPE_NAMES[logical]}")
        rows.append(_row(2, f"column_type:{name}", violations, detail))
    return _rows(counted, rows)


def validation_suite(
    df: DataFrame,
    key: str = "post_id",
    required: Sequence[str] = REQUIRED,
    not_null: Sequence[str] = NOT_NULL,
    lengths: Mapping[str, str] = LENGTHS,
    now: Column | None = None,
    max_hours: float = schemas.FRESHNESS_HOURS,
    fresh: str = "processed_at",
) -> DataFrame:
    """The whole suite from one scan: a row for each key, and one row of those.

    With ``now`` the age of the newest ``fresh`` timestamp is checked as well.
    """
    absent = missing_columns(df, required)
    not_null = [c for c in not_null if c in df.columns]
    lengths = {k: v for k, v in lengths.items() if k in df.columns and v in df.columns}
    counts = {"_rows": F.count("*")}
    counts |= {f"null_{c}": F.count_if(is_missing(df, c)) for c in not_null}
    counts |= {f"bad_{k}": F.count_if(length_mismatch(k, v)) for k, v in lengths.items()}
    dated = now is not None and fresh in df.columns
    latest = [F.max(fresh).alias("latest")] if dated else []
    rows = df.groupBy(key) if key in df.columns else df.groupBy()
    per_key = rows.agg(*[c.alias(name) for name, c in counts.items()], *latest)
    counted = per_key.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in counts],
        F.coalesce(F.sum(F.col("_rows") - 1), F.lit(0)).alias("duplicates"),
        *([F.max("latest").alias("latest")] if dated else []),
    )
    nulls = sum((F.col(f"null_{c}") for c in not_null), F.lit(0))
    listed = F.concat_ws(
        ", ",
        *[
            F.when(
                F.col(f"null_{c}") > 0,
                F.concat(F.lit(f"{c}="), F.col(f"null_{c}").cast("string")),
            )
            for c in not_null
        ],
    )
    suite = [
        _row(
            1,
            "required_columns",
            F.lit(len(absent)),
            F.lit("Missing columns: " + ", ".join(absent)),
        ),
        _row(2, "not_empty", (F.col("_rows") == 0).cast("int"), F.lit("Dataset is empty")),
        _row(4, "not_null", nulls, F.concat(F.lit("Null values found: "), listed)),
    ]
    for place, name in enumerate(lengths):
        wrong = F.lit(f"{name} values are incorrect")
        suite.append(_row(5 + place, f"{name}_consistent", F.col(f"bad_{name}"), wrong))
    if key in df.columns:
        repeated = F.lit(f"Duplicate {key} values found")
        suite.append(_row(3, "unique_key", F.col("duplicates"), repeated))
    if dated:
        zoned = isinstance(df.schema[fresh].dataType, TimestampType)
        suite.append(_freshness_row(5 + len(lengths), now, max_hours, zoned))
    return _rows(counted, suite)


def assert_passed(checks: DataFrame) -> None:
    """Raise for the first check, by position, that is not PASSED."""
    failed = (
        checks.filter(F.col("status") != "PASSED").orderBy("position", "check_name").limit(1)
    ).collect()
    if failed:
        row = failed[0]
        raise CheckFailed(row["detail"] or f"{row['check_name']}: {row['status']}")
