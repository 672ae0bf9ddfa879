"""Exact percentiles per group without holding a group in one task.

Spark's ``percentile`` keeps every distinct value of a group in one task.  That
is right for small inputs; beyond them :func:`selected_percentiles` finds the
wanted order statistics in one of two ways.

Up to ``MAX_DIMENSION_ROWS`` groups it narrows intervals of values.  Each round is one
scan with a map-side lookup and at most ``buckets`` partial counts per interval
and task, so the rows themselves are never shuffled, whichever group they are in.

Beyond, a table of intervals may not be sent to every task, and rows are not keyed by
their group either: distinct values are counted, sorted into ranges of ``(group, value)``
- a group with half of the rows covers half of the ranges - and the counts of a group's
ranges tell in which of them a rank lies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.plans.scratch import materialized
from tidemark.plans.sizing import MAX_DIMENSION_ROWS

#: An interval of one value, or of no more rows than this, is not narrowed further.
FEW_ROWS = 10_000


def _magnitude(value: Column) -> Column:
    """Signed logarithmic scale: spreads a body of values apart from far outliers."""
    return F.signum(value) * F.log1p(F.least(F.abs(value), F.lit(1e300)) * F.lit(1e6))


def _linear(value: Column) -> Column:
    """The value itself, scaled so that infinities and differences stay finite."""
    return F.least(F.greatest(value, F.lit(-1.7e308)), F.lit(1.7e308)) / F.lit(4.0)


def _bucket(value: Column, low: Column, high: Column, buckets: int) -> Column:
    """Bucket of ``value`` within [low, high]; never decreases as the value grows."""
    place = F.floor(F.try_divide(value - low, high - low) * F.lit(float(buckets)))
    return F.coalesce(F.least(place, F.lit(buckets - 1)), F.lit(0)).cast("int")


def _narrowed(histogram: DataFrame, intervals: DataFrame, by: str) -> DataFrame:
    """Keep the steps of each interval that hold a target rank, with those targets."""
    window = (
        Window.partitionBy("id").orderBy(by).rowsBetween(Window.unboundedPreceding, 0)
    )
    stepped = (
        histogram.withColumn("upto", F.sum("c").over(window))
        .join(intervals.select("id", "g", "below", "targets"), "id")
        .withColumn("upto", F.col("below") + F.col("upto"))
        .withColumn("start", F.col("upto") - F.col("c"))
    )
    held = _held(F.col("start"), F.col("upto"))
    return stepped.withColumn("targets", held).filter(F.size("targets") > 0)


def _ranked(counted: DataFrame, intervals: DataFrame) -> DataFrame:
    """``(g, v, targets)`` of the values at the target ranks, however many an interval has.

    ``counted`` has ``(id, v, c)``.  Values are dealt into sorted ranges and written; the
    ranges' totals, a few rows for each id and range, say where each of them begins.
    """
    ranges = counted.repartitionByRange("id", "v").withColumn("part", F.spark_partition_id())
    placed = materialized(ranges, "ranges")
    earlier = Window.partitionBy("id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = placed.groupBy("id", "part").agg(F.sum("c").alias("c"))
    pieces = pieces.withColumn("prior", F.coalesce(F.sum("c").over(earlier), F.lit(0)))
    pieces = pieces.join(intervals.select("id", "g", "below", "targets"), "id")
    pieces = pieces.withColumn("start", F.col("below") + F.col("prior"))
    ends = _held(F.col("start"), F.col("start") + F.col("c"))
    pieces = pieces.select("id", "part", "g", "start", ends).withColumnRenamed("start", "below")
    here = Window.partitionBy("id", "part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    held = pieces.filter(F.size("targets") > 0)
    # Values are summed in order as narrow rows; a range's targets join them after the sort.
    inside = placed.join(held.select("id", "part"), ["id", "part"], "left_semi")
    inside = inside.withColumn("within", F.sum("c").over(here)).join(held, ["id", "part"])
    upto = F.col("below") + F.col("within")
    stepped = inside.withColumn("upto", upto).withColumn("start", F.col("upto") - F.col("c"))
    found = stepped.select("g", "v", _held(F.col("start"), F.col("upto")))
    return found.filter(F.size("targets") > 0)


def _held(start: Column, end: Column) -> Column:
    """The targets whose rank is in ``[start, end)``."""
    return F.filter("targets", lambda t: (t["rank"] >= start) & (t["rank"] < end)).alias("targets")


def selected_percentiles(
    df: DataFrame,
    group: str,
    value: str,
    probabilities: Sequence[float],
    rounds: int = 2,
    buckets: int = 4096,
    spans: DataFrame | None = None,
) -> DataFrame:
    """``(group, percentiles)`` by linear interpolation, null groups and values left out.

    Narrowing buckets on a logarithmic scale first, then linearly: ``rounds`` times, and on
    until every interval holds one value or few rows, or no round gets any further.  What is left is counted and ranked value by value, so the result is exact for any
    distribution, infinities included.  The intervals of each round are a small table in
    the scratch folder.  ``spans`` saves a scan for a caller that already has
    ``(group, n, low, high)`` in a written table.
    """
    rows = df.select(F.col(group).alias("g"), F.col(value).alias("v")).filter(
        F.col("g").isNotNull() & F.col("v").isNotNull()
    )
    if spans is None:
        spans = materialized(
            rows.groupBy("g").agg(
                F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
            ),
            "spans",
        )
    else:
        spans = spans.withColumnRenamed(group, "g").filter(F.col("g").isNotNull() & (F.col("n") > 0))

    def target(i: int, p: float, side) -> Column:
        position = F.lit(float(p)) * (F.col("n") - 1)
        return F.struct(
            F.lit(i).alias("i"),
            (position - F.floor(position)).alias("part"),
            side(position).cast("long").alias("rank"),
        )

    wanted = [
        target(i, p, side) for i, p in enumerate(probabilities) for side in (F.floor, F.ceil)
    ]
    whole = spans.select(
        "g", "low", "high", F.lit(0).cast("long").alias("below"), F.array(*wanted).alias("targets")
    )
    if spans.count() > MAX_DIMENSION_ROWS:
        counted = rows.groupBy(F.col("g").alias("id"), "v").agg(F.count("*").alias("c"))
        ranked = _ranked(counted, whole.withColumn("id", F.col("g")))
    else:
        ranked = _narrowed_down(rows, whole, rounds, buckets)
    return _interpolated(ranked, group, probabilities)


def _narrowed_down(rows: DataFrame, whole: DataFrame, rounds: int, buckets: int) -> DataFrame:
    """The values at the target ranks of at most ``MAX_DIMENSION_ROWS`` groups."""
    intervals = materialized(whole.withColumn("id", F.monotonically_increasing_id()), "intervals")

    def inside(intervals: DataFrame) -> DataFrame:
        # At most two intervals per percentile and group.
        lookup = F.broadcast(intervals.select("id", "g", "low", "high"))
        return rows.join(lookup, "g").filter(F.col("v").between(F.col("low"), F.col("high")))

    def counted(intervals: DataFrame) -> DataFrame:
        return inside(intervals).groupBy("id", "v").agg(F.count("*").alias("c"))

    scale, left, turn = _magnitude, None, 0
    while True:
        edges = [scale(F.col(c)) for c in ("v", "low", "high")]
        histogram = (
            inside(intervals)
            .groupBy("id", _bucket(*edges, buckets).alias("b"))
            .agg(F.count("*").alias("c"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        )
        steps = _narrowed(histogram, intervals, "b").select(
            F.monotonically_increasing_id().alias("id"),
            "g",
            F.col("lo").alias("low"),
            F.col("hi").alias("high"),
            F.col("start").alias("below"),
            "targets",
            "c",
        )
        intervals = materialized(steps, "intervals")
        scale, turn = _linear, turn + 1
        if turn < rounds:
            continue
        wide = intervals.filter((F.col("low") < F.col("high")) & (F.col("c") > FEW_ROWS))
        left, before = wide.agg(F.sum("c")).first()[0], left
        if left is None:
            return _narrowed(counted(intervals), intervals, "v").select("g", "v", "targets")
        # Values at the very ends of the range may not come apart on either scale.
        if left == before:
            return _ranked(counted(intervals), intervals)


def _interpolated(ranked: DataFrame, group: str, probabilities: Sequence[float]) -> DataFrame:
    ranked = ranked.select("g", "v", F.explode("targets").alias("t"))
    # The values at the ranks either side of each percentile's position.
    of = [F.col("t.i") == i for i in range(len(probabilities))]
    per_group = ranked.groupBy("g").agg(
        *[F.min(F.when(at, F.col("v"))).alias(f"lower{i}") for i, at in enumerate(of)],
        *[F.max(F.when(at, F.col("v"))).alias(f"upper{i}") for i, at in enumerate(of)],
        *[F.max(F.when(at, F.col("t.part"))).alias(f"part{i}") for i, at in enumerate(of)],
    )

    def interpolated(i: int) -> Column:
        # The same form as Spark's own percentile, so both agree to the last bit.
        part = F.col(f"part{i}")
        lower, upper = F.col(f"lower{i}"), F.col(f"upper{i}")
        return F.when(lower == upper, lower).otherwise(
            (F.lit(1.0) - part) * lower + part * upper
        )

    points = [interpolated(i) for i in range(len(probabilities))]
    return per_group.select(F.col("g").alias(group), F.array(*points).alias("percentiles"))
