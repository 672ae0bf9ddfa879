"""Percentile selection against sorting, on awkward distributions."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import percentiles
from tidemark.operators.percentiles import selected_percentiles

POINTS = [0.0, 0.5, 0.95, 0.99, 1.0]


def by_sorting(values, p):
    ordered = sorted(values)
    position = p * (len(ordered) - 1)
    low, high = math.floor(position), math.ceil(position)
    if ordered[low] == ordered[high]:
        return ordered[low]
    part = position - low
    return (1.0 - part) * ordered[low] + part * ordered[high]


def distributions():
    rng = random.Random(7)
    return {
        "uniform": [rng.random() * 100 for _ in range(700)],
        "hot value": [2.5] * 500 + [rng.random() for _ in range(200)],
        "outlier": [rng.random() for _ in range(300)] + [1e12],
        "negative": [rng.gauss(0, 50) for _ in range(400)],
        "tiny range": [1.0 + i * 2**-52 for i in range(300)],
        "huge range": [10.0 ** rng.uniform(-300, 300) for _ in range(300)],
        "infinite": [float("inf"), float("-inf"), 1.0, 2.0, 3.0],
        "two": [1.0, 2.0],
        "one": [4.0],
    }


@pytest.mark.parametrize("rounds, buckets", [(2, 4096), (1, 3)])
def test_selection_is_exact(spark, rounds, buckets):
    groups = distributions()
    rows = [(g, v) for g, values in groups.items() for v in values]
    rows += [(None, 1.0), ("one", None)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    found = {
        r["g"]: r["percentiles"]
        for r in selected_percentiles(df, "g", "v", POINTS, rounds, buckets).collect()
    }
    assert set(found) == set(groups)
    for name, values in groups.items():
        expected = [by_sorting(values, p) for p in POINTS]
        assert found[name] == expected, name


@pytest.mark.parametrize("limit", [0, 10_000])
def test_both_ways_agree_with_sorting(spark, monkeypatch, limit):
    """Beyond the limit ranks are looked for in sorted ranges of all values."""
    monkeypatch.setattr(percentiles, "MAX_DIMENSION_ROWS", limit)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(9)
    groups = distributions() | {f"g{i}": [rng.choice([1.0, 2.0, rng.random()])] * (i % 4 + 1) for i in range(300)}
    groups["hot"] = [rng.gauss(0, 1) for _ in range(4000)] + [0.25] * 500
    rows = [(g, v) for g, values in groups.items() for v in values] + [(None, 1.0), ("two", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    try:
        found = {r["g"]: r["percentiles"] for r in selected_percentiles(df, "g", "v", POINTS).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found == {g: [by_sorting(values, p) for p in POINTS] for g, values in groups.items()}


def test_values_that_no_scale_parts_are_ranked(spark, monkeypatch):
    """Subnormal values and values near the largest double fall into one bucket each."""
    monkeypatch.setattr(percentiles, "FEW_ROWS", 10)
    groups = {
        "subnormal": [i * 5e-324 for i in range(200)] + [1e308],
        "largest": [1.7e308 + i * 1e293 for i in range(200)] + [-1.7e308],
    }
    rows = [(g, v) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g string, v double").repartition(3)
    found = {r["g"]: r["percentiles"] for r in selected_percentiles(df, "g", "v", POINTS, 1, 3).collect()}
    assert found == {g: [by_sorting(values, p) for p in POINTS] for g, values in groups.items()}


def test_no_row_is_keyed_by_its_group(spark, monkeypatch):
    """No exchange of rows is on the group alone, in any plan that is run."""
    monkeypatch.setattr(percentiles, "MAX_DIMENSION_ROWS", 3)
    rows = [("hot" if i % 2 else f"g{i}", float(i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    written, plans = percentiles.materialized, []

    def noted(frame, label):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return written(frame, label)

    monkeypatch.setattr(percentiles, "materialized", noted)
    spans = written(df.groupBy("g").agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")), "s")
    out = selected_percentiles(df, "g", "v", POINTS, spans=spans)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert out.count() == 1001
    keys = [re.sub(r"#\d+", "", k) for plan in plans for k in re.findall(r"(?:hash|range)partitioning\(([^)]*?), \d+\)", plan)]
    rowwise = [k for k in keys if "v" in k.split(", ")[1:2] or "v ASC" in k or "part" in k]
    assert len(rowwise) >= 3
    # What is keyed by the group alone: one row for each of its ranges, and of the result.
    assert all(k in ("id", "g", "_groupingexpression") or k in rowwise for k in keys), keys


def test_ranges_are_summed_without_their_targets(spark, monkeypatch):
    """The rows that a range's running count sorts hold no targets, so a task's sort stays narrow."""
    monkeypatch.setattr(percentiles, "MAX_DIMENSION_ROWS", 3)
    rows = [("hot" if i % 2 else f"g{i % 40}", float(i % 97)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    out = selected_percentiles(df, "g", "v", POINTS)

    def windows(node):
        found = [node] if node.nodeName() == "Window" else []
        kids = node.children()
        return found + [w for i in range(kids.size()) for w in windows(kids.apply(i))]

    def names(attributes):
        return [attributes.apply(i).name() for i in range(attributes.size())]

    summed = [w for w in windows(out._jdf.queryExecution().optimizedPlan()) if "v" in names(w.child().output())]
    assert summed
    assert all("targets" not in names(w.child().output()) for w in summed)
    groups = {}
    for g, v in rows:
        groups.setdefault(g, []).append(v)
    found = {r["g"]: r["percentiles"] for r in out.collect()}
    assert found == {g: [by_sorting(values, p) for p in POINTS] for g, values in groups.items()}
