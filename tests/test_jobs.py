"""Landing zone, the composed batch job, and streams."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import checks
from tidemark.plans.batch_job import Layout, run_batch
from tidemark.sources import history, landing, tables
from tidemark.streaming import jobs as streams

NOW = datetime(2026, 8, 12, 9, 30)
LATER = datetime(2026, 8, 12, 10, 30)
POSTS = [{"userId": 1, "id": 101, "title": "Test title", "body": "Test body"},
         {"userId": 2, "id": 102, "title": "Another title", "body": "Another test body"}]
USERS = [{"id": n, "name": f"N{n}", "username": f"u{n}", "email": f"{n}@x", "phone": "1",
          "website": "w", "company": {"name": "dropped"}} for n in (1, 2)]


def write_array(root, name, records):
    raw = root / "raw"
    raw.mkdir(parents=True, exist_ok=True)
    (raw / name).write_text(json.dumps(records, indent=2), encoding="utf-8")


def fill(root, stamp="20260812_093000", posts=POSTS):
    write_array(root, f"posts_{stamp}.json", posts)
    write_array(root, f"users_{stamp}.json", USERS)


def test_array_landing(spark, tmp_path):
    fill(tmp_path)
    fill(tmp_path, "20260812_103000", POSTS[:1])
    raw = str(tmp_path / "raw")
    path = landing.latest_snapshot(spark, raw, "posts")
    assert path.endswith("posts_20260812_103000.json")
    assert landing.read_landed(spark, path, schemas.RAW_POSTS, "array").count() == 1
    assert landing.landed_fields(spark, path, "array") == ["body", "id", "title", "userId"]
    checks.assert_passed(landing.landing_sanity(spark, path, schemas.RAW_POSTS, "array"))
    with pytest.raises(FileNotFoundError):
        landing.latest_snapshot(spark, raw, "comments")
    with pytest.raises(FileNotFoundError):
        landing.latest_snapshot(spark, str(tmp_path / "none"), "posts")


@pytest.mark.parametrize(
    "content, message",
    [("[]", "zero records"), ('{"id": 1}', "expected a list"), ("[{]", "unparsable")],
)
def test_bad_landing(spark, tmp_path, content, message):
    (tmp_path / "posts_1.json").write_text(content)
    check = landing.landing_sanity(
        spark, str(tmp_path / "posts_1.json"), schemas.RAW_POSTS, "array")
    with pytest.raises(checks.CheckFailed, match=message):
        checks.assert_passed(check)


def test_batch_twice(spark, rows, tmp_path):
    fill(tmp_path)
    layout = Layout(str(tmp_path))
    published = str(tmp_path / "published")
    first = run_batch(spark, layout, NOW, landing_layout="array", publish_to=published)
    assert (first.status, first.error) == ("SUCCESS", None)
    assert list(first.durations) == schemas.STAGES
    assert first.changes == {"inserted": 2, "updated": 0, "unchanged": 0, "kept": 0}
    assert tables.read_table(spark, published).columns == schemas.MART_COLUMNS
    changed = [{**POSTS[1], "title": "Changed"}, {"userId": 1, "id": 103, "title": "T", "body": "B"}]
    fill(tmp_path, "20260812_103000", changed)
    second = run_batch(spark, layout, LATER, landing_layout="array")
    assert second.changes == {"inserted": 1, "updated": 1, "unchanged": 0, "kept": 1}
    mart = tables.read_current(spark, layout.mart)
    assert rows(mart, "post_id", "name", "title") == [
        (101, "N1", "Test title"), (102, "N2", "Changed"), (103, "N1", "T")]
    ledger_rows = history.load(spark, layout.runs, schemas.RUNS).orderBy("run_id").collect()
    assert [r["status"] for r in ledger_rows] == ["SUCCESS", "SUCCESS"]
    assert [r["records_checked"] for r in ledger_rows] == [2, 2]
    assert ledger_rows[0]["fastest_stage"] in schemas.STAGES
    assert ledger_rows[0]["total_retries"] == 0
    assert set(ledger_rows[0]["retry_information"]) == set(schemas.STAGES)
    assert history.load(spark, layout.stage_runs, schemas.STAGE_RUNS).count() == 18
    assert history.load_alerts(spark, layout.alerts).count() == 0


@pytest.mark.parametrize(
    "posts, stage, message",
    [
        ([{**POSTS[0], "userId": 9}], "RELATIONSHIP VALIDATION", "no matching user"),
        ([{**POSTS[0], "extra": "x"}], "SCHEMA VALIDATION", "Unexpected columns"),
        ([POSTS[0], POSTS[0]], "POST TRANSFORMATION", "Duplicate post_id"),
        ([{**POSTS[0], "title": None}], "POST VALIDATION", "Null values found"),
    ],
)
def test_batch_stops_at_the_failing_stage(spark, tmp_path, posts, stage, message):
    fill(tmp_path, posts=posts)
    layout = Layout(str(tmp_path))
    result = run_batch(spark, layout, NOW, landing_layout="array")
    assert (result.status, result.failed_stage) == ("FAILED", stage)
    assert message in result.error
    assert tables.read_current(spark, layout.posts) is None
    row = history.load(spark, layout.runs, schemas.RUNS).first()
    assert (row["status"], row["failed_stage"]) == ("FAILED", stage)
    assert row["successful_stages"] == schemas.STAGES.index(stage)
    alert = history.load_alerts(spark, layout.alerts).first()
    assert alert["alert_type"] == "PIPELINE_FAILURE"


def test_batch_without_landing(spark, rows, tmp_path):
    result = run_batch(spark, Layout(str(tmp_path)), NOW)
    assert (result.status, result.failed_stage) == ("FAILED", "POST INGESTION")
    alerts = history.load_alerts(spark, Layout(str(tmp_path)).alerts)
    assert rows(alerts, "alert_type", "stage") == [
        ("PIPELINE_FAILURE", "POST INGESTION"), ("RETRY_EXHAUSTED", "POST INGESTION")]


def test_failure_after_the_last_stage(spark, tmp_path):
    fill(tmp_path)
    result = run_batch(spark, Layout(str(tmp_path)), NOW, landing_layout="array",
                       publish_to="nowhere://bucket/mart")
    assert (result.status, result.failed_stage) == ("FAILED", None)
    alert = history.load_alerts(spark, Layout(str(tmp_path)).alerts).first()
    assert alert["message"] == "Pipeline failed during None"
    row = history.load(spark, Layout(str(tmp_path)).runs, schemas.RUNS).first()
    assert (row["successful_stages"], row["failed_stage"]) == (9, None)


def test_merge_stream_replays(spark, rows, tmp_path):
    """Two batches, then a lost commit: the replay gives the same table."""
    schema = "k long, v string, o int"
    source, root = str(tmp_path / "in"), str(tmp_path / "out")

    def arrive(data):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").json(source)

    def run():
        stream = spark.readStream.schema(schema).json(source)
        streams.merge_stream(stream, root, str(tmp_path / "cp"), "k", [F.col("o").desc()],
                             lineage=False).awaitTermination()

    arrive([(1, "a", 0), (1, "b", 1), (2, "c", 0)])
    run()
    assert rows(tables.read_current(spark, root), "k", "v") == [(1, "b"), (2, "c")]
    arrive([(2, "d", 0), (3, "e", 0)])
    run()
    expected = [(1, "b"), (2, "d"), (3, "e")]
    assert rows(tables.read_current(spark, root), "k", "v") == expected
    for name in ("1", ".1.crc"):
        (tmp_path / "cp" / "commits" / name).unlink(missing_ok=True)
    run()
    assert rows(tables.read_current(spark, root), "k", "v") == expected
    assert tables.versions(spark, root) == [1, 2]


def test_a_new_checkpoint_goes_on_from_the_table(spark, rows, tmp_path):
    schema = "k long, v string, o long"
    root, landing = str(tmp_path / "table"), str(tmp_path / "in")

    def run(checkpoint):
        stream = spark.readStream.schema(schema).parquet(landing)
        streams.merge_stream(
            stream, root, str(tmp_path / checkpoint), "k", [F.col("o").desc()], lineage=False
        ).awaitTermination()

    spark.createDataFrame([(1, "a", 1), (2, "b", 1)], schema).write.parquet(landing)
    run("first")
    spark.createDataFrame([(2, "c", 2), (3, "d", 2)], schema).write.mode("append").parquet(landing)
    run("first")
    spark.createDataFrame([(4, "e", 3)], schema).write.mode("overwrite").parquet(landing)
    run("second")
    assert rows(tables.read_current(spark, root), "k", "v") == [(1, "a"), (2, "c"), (3, "d"), (4, "e")]


def test_half_written_snapshots_are_not_loaded(spark, tmp_path):




    done = landing.land(spark.range(2), str(tmp_path), "posts", datetime(2026, 1, 1))
    (tmp_path / "posts_20270101_000000.json").mkdir()
    assert landing.latest_snapshot(spark, str(tmp_path), "posts").endswith(done.rsplit("/", 1)[1])
