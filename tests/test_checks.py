"""Checks against the staged-post fixtures."""

from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import checks, enrich

POSTS = ("user_id long, post_id long, title string, body string, title_length int,"
         " body_length int, processed_at timestamp")
DAY = datetime(2026, 8, 12)


@pytest.fixture(scope="module")
def posts(spark):
    return spark.createDataFrame(
        [(1, 101, "Hello", "First post", 5, 10, DAY), (2, 102, "World", "Second post", 5, 11, DAY)],
        POSTS,
    )


def failures(df):
    return [r["detail"] for r in df.filter("status = 'FAILED'").orderBy("position").collect()]


def test_valid_posts_pass(posts):
    suite = checks.validation_suite(posts)
    assert suite.count() == 6
    checks.assert_passed(suite)


@pytest.mark.parametrize(
    "change, message",
    [
        (lambda d: d.drop("body"), "Missing columns: body"),
        (lambda d: d.withColumn("post_id", F.lit(101)), "Duplicate post_id values found"),
        (lambda d: d.withColumn("title", F.when(F.col("post_id") > 101, F.col("title"))),
         "Null values found: title=1"),
        (lambda d: d.withColumn("title_length", F.lit(999)), "title_length values are incorrect"),
        (lambda d: d.withColumn("body_length", F.lit(999)), "body_length values are incorrect"),
        (lambda d: d.limit(0), "Dataset is empty"),
    ],
)
def test_mutations_fail(posts, change, message):
    with pytest.raises(checks.CheckFailed, match=message):
        checks.assert_passed(checks.validation_suite(change(posts)))


def test_first_failure_wins(posts):
    both = posts.withColumn("post_id", F.lit(1)).withColumn("title_length", F.lit(0))
    with pytest.raises(checks.CheckFailed, match="Duplicate"):
        checks.assert_passed(checks.validation_suite(both))


def test_null_length_is_a_violation(posts):
    df = posts.withColumn("title_length", F.lit(None).cast("int"))
    assert failures(checks.validation_suite(df)) == ["title_length values are incorrect"]


def quality_frame(spark, titles, ids):
    rows = [(1, i, t, b, 1, n) for i, t, b, n in
            zip(ids, titles, ["One", "Two", "Three", "Four"], [3, 3, 5, 4], strict=True)]
    return spark.createDataFrame(
        rows, "user_id long, post_id long, title string, body string, title_length int,"
        " body_length int")


def test_quality_metrics(spark):
    good = quality_frame(spark, ["A", "B", "C", "D"], [101, 102, 103, 104])
    assert tuple(checks.quality_metrics(good).first()) == (4, 0, 0, "PASSED")
    bad = quality_frame(spark, ["A", None, "C", "D"], [101, 102, 103, 103])
    assert tuple(checks.quality_metrics(bad).first()) == (4, 1, 1, "FAILED")
    assert tuple(checks.quality_metrics(good.limit(0)).first()) == (0, 0, 0, "FAILED")
    assert tuple(checks.quality_metrics(bad.drop("post_id")).first()) == (4, 1, 0, "FAILED")


def test_null_keys_equal_each_other_and_nan_is_missing(spark):
    df = spark.createDataFrame([(None, 1.0), (None, float("nan")), (1, 2.0)],
                               "post_id long, x double")
    assert tuple(checks.quality_metrics(df).first()) == (3, 3, 1, "FAILED")
    assert [tuple(r) for r in checks.duplicate_keys(df, "post_id").collect()] == [(None, 2)]
    assert tuple(checks.key_summary(df, "post_id").first()) == (1, 1)


@pytest.mark.parametrize(
    "ages, status",
    [([1, 2], "PASSED"), ([25], "FAILED"), ([24 - 1 / 60], "PASSED"), ([24], "PASSED"),
     ([], "NO DATA")],
)
def test_freshness(spark, ages, status):
    now = datetime(2026, 8, 12, 12, tzinfo=UTC)
    df = spark.createDataFrame([(now - timedelta(hours=a),) for a in ages],
                               "processed_at timestamp")
    check = checks.freshness(df, F.lit(now))
    assert check.first()["status"] == status
    if status != "PASSED":
        with pytest.raises(checks.CheckFailed):
            checks.assert_passed(check)


def test_exact_schema(spark, posts):
    full = enrich.backfill_lineage(posts)
    assert failures(checks.exact_schema(full)) == []
    assert failures(checks.exact_schema(posts)) == ["Missing columns"] * 2
    extra = full.withColumn("note", F.lit("x"))
    assert failures(checks.exact_schema(extra)) == ["Unexpected columns"]
    wrong = full.withColumn("title_length", F.lit("5"))
    assert failures(checks.exact_schema(wrong)) == ["title_length must be integer"]
    dated = full.withColumn("processed_at", F.to_date("processed_at"))
    assert failures(checks.exact_schema(dated)) == ["processed_at must be datetime"]
    holed = full.withColumn("user_id", F.when(F.col("post_id") > 101, F.col("user_id")))
    assert failures(checks.exact_schema(holed)) == ["user_id must be integer"]
    differences = checks.schema_differences(extra.drop("body"), schemas.POST_TYPES)
    assert differences == [("missing", "body"), ("unexpected", "note")]


@pytest.mark.parametrize("strategy", ["plain", "salted"])
def test_relationship(spark, rows, strategy):
    posts = spark.createDataFrame([(i, 1) for i in range(50)] + [(90, 7), (91, None)],
                                  "post_id long, user_id long")
    users = spark.createDataFrame([(1,), (2,)], "user_id long")
    found = checks.orphans(posts, users, "user_id", strategy)
    assert rows(found, "post_id", "user_id") == [(90, 7), (91, None)]
    with pytest.raises(checks.CheckFailed, match="no matching user"):
        checks.assert_passed(checks.relationship(posts, users, "user_id"))
    assert checks.relationship(posts, users, "user_id").first()["violations"] == 2
    good = posts.filter("user_id = 1")
    checks.assert_passed(checks.relationship(good, users, "user_id"))


def test_enrichment(spark):
    raw = spark.createDataFrame(
        [(1, 101, "Test title", "Test body"), (2, 102, "Ä 🚨", None)], schemas.RAW_POSTS)
    staged = enrich.enrich_posts(raw, "posts_1.json", F.lit(DAY))
    assert staged.columns == ["user_id", "post_id", "title", "body", "title_length",
                              "body_length", "source_system", "source_file", "processed_at"]
    found = {r["post_id"]: r for r in staged.collect()}
    assert (found[101]["title_length"], found[101]["body_length"]) == (10, 9)
    assert (found[102]["title_length"], found[102]["body_length"]) == (3, None)
    assert found[101]["source_system"] == "jsonplaceholder_api"
    assert found[101]["source_file"] == "posts_1.json"


def test_conform_coerces(spark):
    old = spark.createDataFrame(
        [("r1", "2026-08-12T10:00:00+02:00", "1.5", "3", 7),
         ("r2", "junk", "junk", "3.0", 8), ("r3", None, "NaN", None, 9)],
        "run_id string, started_at string, total_duration string, total_stages string, x int")
    df = enrich.conform(old, schemas.RUNS)
    assert df.columns == schemas.RUNS.names
    picked = {r["run_id"]: r for r in df.withColumn(
        "text", F.date_format("started_at", "yyyy-MM-dd HH:mm")).collect()}
    assert picked["r1"]["text"] == "2026-08-12 08:00"
    assert picked["r2"]["text"] is None and picked["r3"]["text"] is None
    assert [picked[r]["total_duration"] for r in ("r1", "r2", "r3")] == [1.5, None, None]
    assert [picked[r]["total_stages"] for r in ("r1", "r2", "r3")] == [3, 3, None]
