"""Skewed joins, sizes, scratch folders and the shape of plans."""

import pytest
from pyspark.sql import functions as F

from tidemark.bindings import catalog
from tidemark.bindings.tables import THRESHOLDS, stage_runs
from tidemark.functions.numeric import exact_avg, exceeds, percentage, round_even
from tidemark.functions.text import utc_instant, utc_wall_clock
from tidemark.operators import baseline, sla, stages
from tidemark.plans import scratch, session, sizing, skew


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds a third of the rows; some keys have no parent, some are null."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None)
    return spark.range(3000).select(
        F.col("id").alias("post_id"), key.otherwise(F.col("id") % 400).alias("user_id"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain(spark, rows, skewed, how):
    users = spark.range(300).select(F.col("id").alias("user_id"), (F.col("id") * 2).alias("x"))
    assert [r._salts for r in skew.hot_keys(skewed, "user_id", 300).collect()] == [4]
    salted = skew.salted_join(skewed, users, "user_id", how, rows_per_task=300)
    plain = skewed.join(users, "user_id", how)
    assert rows(salted, *plain.columns) == rows(plain)


def test_salted_join_needs_a_supported_kind(spark, skewed):
    with pytest.raises(ValueError):
        skew.salted_join(skewed, skewed, "user_id", "full_outer")
    with pytest.raises(ValueError):
        skew.keyed_join(skewed, skewed, "user_id", strategy="guess")


def test_hot_rows_are_spread(spark, skewed):
    users = spark.range(300).select(F.col("id").alias("user_id"))
    joined = skew.salted_join(skewed, users, "user_id", rows_per_task=30)
    spread = (joined.filter("user_id = 7").groupBy(F.spark_partition_id()).count())
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert spread.count() > 2
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_compressible_rows_are_measured_before_a_broadcast(spark, tmp_path):
    path = str(tmp_path / "text")
    spark.range(60).select("id", F.repeat(F.lit("abc "), 300_000).alias("body")).write.parquet(path)
    rows = spark.read.parquet(path)
    assert sizing.is_small(rows, 32 * 2**20) and not sizing.fits(rows, 32 * 2**20)
    assert sizing.fits(rows.select("id"), 32 * 2**20)


def test_sizes(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert 0 < sizing.estimated_bytes(events) < 1_000_000
    assert sizing.is_small(events) and not sizing.is_small(events, 10)
    assert sizing.estimated_bytes(events.select(F.explode(F.array("value", "value")))) is None
    few = sizing.dimension(spark, {"k": [1, 2]})
    many = sizing.dimension(spark, {"k": range(sizing.MAX_DIMENSION_ROWS + 1)})
    hinted = [d._jdf.queryExecution().logical().toString() for d in (few, many)]
    assert ["broadcast" in text.lower() for text in hinted] == [True, False]


def test_scratch_is_below_the_named_folder(spark):
    root = scratch.scratch_root(spark)
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or root == named.rstrip("/")
    assert scratch.scratch_dir(spark, "x") != scratch.scratch_dir(spark, "x")
    kept = scratch.materialized(spark.range(3), "three")
    assert sorted(r[0] for r in kept.collect()) == [0, 1, 2]
    assert all(f"{root}/tidemark-" in name.replace("file://", "") for name in kept.inputFiles())


def test_session_sizes():
    tib = 1024**4
    assert session.partitions_for(10, cores=8) == 8
    assert session.partitions_for(tib) == 8192
    assert session.partitions_for(100 * tib) == session.MAX_PARTITIONS
    assert session.split_bytes_for(tib) == session.PARTITION_BYTES
    assert session.split_bytes_for(100 * tib) == session.MAX_SPLIT_BYTES


def test_rounding(spark):
    df = spark.sql("SELECT * FROM VALUES (0.125D), (0.375D), (2.5D), (-0.125D) AS t(x)")
    assert [r[0] for r in df.select(round_even(F.col("x"), 2)).collect()] == [
        0.12, 0.38, 2.5, -0.12]
    empty = df.limit(0).agg(percentage(F.count("*"), F.count("*")), exact_avg("x")).first()
    assert tuple(empty) == (0.0, None)
    tenths = spark.range(10).select(F.lit(0.1).alias("x")).agg(exact_avg("x")).first()
    assert tenths[0] == 0.1


def test_thresholds_need_no_shuffle(spark, sf_dir):
    text = plan(sla.violations(stage_runs(spark, sf_dir), THRESHOLDS))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_thresholds_reach_the_scan(spark, sf_dir):
    text = plan(sla.violations(stage_runs(spark, sf_dir), THRESHOLDS))
    assert "GreaterThan(value,10.0)" in text and "In(event_type" in text
    text = plan(stages.slow_stages(stage_runs(spark, sf_dir), 100.0))
    assert "GreaterThan(value,100.0)" in text


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_utc_conversions_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("SELECT * FROM VALUES (TIMESTAMP_NTZ'2026-08-12 09:30:00.000123'),"
                       " (TIMESTAMP_NTZ'2026-03-08 02:30:00'), (TIMESTAMP_NTZ'1969-12-31 23:59:59.5')"
                       " AS t(w)").withColumn("i", utc_instant("w"))
        found = df.select(F.unix_micros("i"), (utc_wall_clock("i") == F.col("w"))).collect()
        assert [tuple(r) for r in found] == [
            (1786527000000123, True), (1772937000000000, True), (-500000, True)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_exceeds(spark):
    df = spark.sql("SELECT * FROM VALUES (1D, '5', 5), (CAST('NaN' AS DOUBLE), 'NaN', 1),"
                   " (9D, 'junk', NULL), (NULL, NULL, 9) AS t(d, s, i)")
    kept = [df.filter(exceeds(df, name, 2.0)).count() for name in ("d", "s", "i")]
    assert kept == [1, 1, 2]


def test_report_scans_needed_columns_once(spark, sf_dir):
    text = plan(sla.overall_report(stage_runs(spark, sf_dir), THRESHOLDS))
    assert text.count("FileScan") == 1
    assert "ReadSchema: struct<event_type:string,value:double>" in text
    text = plan(baseline.stage_baseline_for(stage_runs(spark, sf_dir), "view"))
    assert "EqualTo(event_type,view)" in text


def test_selection_never_shuffles_rows(spark, sf_dir):
    """The first exchange above the event scan sits on a partial aggregate."""
    text = plan(baseline.stage_baseline(stage_runs(spark, sf_dir), "selection"))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    lines = [(len(line) - len(line.lstrip(" :+-")), line) for line in text.splitlines()]
    checked = 0
    for place, (depth, line) in enumerate(lines):
        if "Exchange hashpartitioning" not in line:
            continue
        below = []
        for deeper, child in lines[place + 1:]:
            if deeper <= depth:
                break
            below.append(child)
        nested = any("Exchange hashpartitioning" in child for child in below)
        if not nested and any("FileScan parquet [event_type" in child for child in below):
            checked += 1
            assert "Aggregate(" in below[0] and "partial_" in below[0], below[0]
    assert checked


CARTESIAN_FREE = ["j3_sla_summary", "j4_overall_sla_report", "m13_failed_stage", "d13_validation_suite",
                  "f2_upsert_full_outer", "e1_posts_with_users_salted", "h7_run_stage_metrics"]


@pytest.mark.parametrize("name", CARTESIAN_FREE)
def test_no_cross_products(spark, sf_dir, name):
    text = plan(catalog.QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_registry(spark):
    import __spark_entry__ as driver

    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert len(driver.queries()) > 110
    assert driver.entry(spark).count() == len(THRESHOLDS)
