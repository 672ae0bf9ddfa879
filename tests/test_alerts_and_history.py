"""Alerts, histories and ledger appends."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import alerts, ledger, sla
from tidemark.sources import history

RUN = "run_id string, status string, failed_stage string, error string, total_duration double"


def test_status_alerts(spark):
    df = spark.createDataFrame(
        [("r1", "FAILED", "SCHEMA VALIDATION", "broken", 6.2), ("r2", "WARNING", None, "", 6.2),
         ("r3", "HEALTHY", None, None, 1.0)], RUN)
    found = {r["run_id"]: r for r in alerts.formatted(alerts.status_alerts(df)).collect()}
    assert {k: v["severity"] for k, v in found.items()} == {"r1": "CRITICAL", "r2": "WARNING"}
    assert found["r1"]["text"].split("\n") == [
        "🚨 PIPELINE ALERT", "", "Severity: CRITICAL", "Status: FAILED", "Run ID: r1",
        "Failed Stage: SCHEMA VALIDATION", "Error: broken", "Duration: 6.2s"]
    assert found["r2"]["text"].split("\n")[-1] == "Duration: 6.2s"
    assert "Error" not in found["r2"]["text"]


@pytest.mark.parametrize("status", ["PAUSED", None])
def test_unknown_status_stops(spark, status):
    df = spark.createDataFrame([("r1", status, None, None, 1.0)], RUN)
    with pytest.raises(Exception, match="Unknown pipeline status"):
        alerts.status_alerts(df).collect()


def test_alert_kinds(spark, tmp_path):
    at = F.lit(datetime(2026, 8, 12, 9, 30, 0, 123))
    run = spark.createDataFrame(
        [("r1", "FAILED", "POST VALIDATION", "bad", 1.0), ("r2", "FAILED", None, None, 1.0),
         ("r3", "SUCCESS", None, None, 1.0)], RUN)
    quality = spark.createDataFrame(
        [("r1", None, 100, 5, 0, "FAILED"), ("r2", None, 1, 0, 0, "PASSED")], schemas.QUALITY)
    stage_runs = spark.createDataFrame([("r1", "POST INGESTION", 3.5)], schemas.STAGE_RUNS)
    attempts = spark.createDataFrame(
        [("r1", "POST INGESTION", "FAILED", 3, "timeout"), ("r1", "USER INGESTION", "SUCCESS", 2, None),
         ("r1", "POST VALIDATION", "FAILED", 1, "bad")],
        "run_id string, stage_name string, status string, attempts long, error string")
    every = alerts.all_alerts(
        alerts.failure_alerts(run, at), alerts.quality_alerts(quality, at),
        alerts.sla_alerts(sla.violations(stage_runs), at), alerts.retry_alerts(attempts, at))
    path = str(tmp_path / "alerts")
    assert history.load_alerts(spark, path).count() == 0
    assert history.append_alerts(every, path)
    assert history.append_alerts(every.filter("alert_type = 'SLA_VIOLATION'"), path)
    assert not history.append_alerts(every.limit(0), path)
    stored = history.load_alerts(spark, path)
    assert alerts.alert_count(stored).first()[0] == 6
    counts = {(r[0], r[1]): r[2] for r in alerts.alert_counts(stored).collect()}
    assert counts == {
        ("PIPELINE_FAILURE", "CRITICAL"): 2, ("DATA_QUALITY_FAILURE", "HIGH"): 1,
        ("SLA_VIOLATION", "WARNING"): 2, ("RETRY_EXHAUSTED", "CRITICAL"): 1}
    kinds = {}
    for r in stored.collect():
        kinds.setdefault(r["alert_type"], []).append(r)
    sla_alert = kinds["SLA_VIOLATION"][0]
    assert sla_alert["details"] == {"duration": "3.5", "sla": "2.0", "exceeded_by": "1.5"}
    assert sla_alert["alert_id"] == "20260812_093000_000123"
    assert sla_alert["timestamp"] == "2026-08-12T09:30:00.000123"
    assert kinds["DATA_QUALITY_FAILURE"][0]["details"]["null_values"] == "5"
    assert kinds["DATA_QUALITY_FAILURE"][0]["stage"] is None
    assert kinds["RETRY_EXHAUSTED"][0]["details"] == {"attempts": "3", "error": "timeout"}
    messages = sorted(r["message"] for r in kinds["PIPELINE_FAILURE"])
    assert messages == ["Pipeline failed during None", "Pipeline failed during POST VALIDATION"]


def test_run_ledger(spark, tmp_path):
    facts = spark.createDataFrame(
        [("r1", datetime(2026, 8, 12), datetime(2026, 8, 12, 1), "SUCCESS", 1.6, 9, 2, None, None)],
        "run_id string, started_at timestamp, finished_at timestamp, status string,"
        " total_duration double, total_stages long, successful_stages long, failed_stage string,"
        " error string")
    stage_runs = spark.createDataFrame(
        [("r1", "POST VALIDATION", 0.4), ("r1", "POST INGESTION", 1.2)], schemas.STAGE_RUNS)
    quality = spark.createDataFrame([("r1", None, 102, 0, 0, "PASSED")], schemas.QUALITY)
    attempts = spark.createDataFrame(
        [("r1", "POST INGESTION", 2, 1)],
        "run_id string, stage_name string, attempts long, retries long")
    record = ledger.run_records(facts, stage_runs, quality, attempts)
    assert record.columns == schemas.RUNS.names
    row = record.first()
    assert (row["fastest_stage"], row["slowest_stage"]) == ("POST VALIDATION", "POST INGESTION")
    assert (row["fastest_duration"], row["slowest_duration"]) == (0.4, 1.2)
    assert (row["records_checked"], row["quality_status"]) == (102, "PASSED")
    assert row["total_retries"] == 1
    assert row["retry_information"]["POST INGESTION"]["attempts"] == 2
    path = str(tmp_path / "runs")
    with pytest.raises(FileNotFoundError):
        history.load(spark, path, schemas.RUNS)
    assert history.append_runs(record, path)
    with pytest.raises(ValueError, match="already recorded"):
        history.append_runs(record, path)
    old = spark.createDataFrame(
        [("r0", "2026-08-11T09:00:00+00:00", "SUCCESS", 2.0)],
        "run_id string, started_at string, status string, total_duration double")
    with pytest.raises(ValueError, match="already recorded"):
        history.append_runs(old.unionAll(old), path)
    assert history.append_runs(old, path)
    stored = history.load(spark, path, schemas.RUNS).orderBy("started_at").collect()
    assert [r["run_id"] for r in stored] == ["r0", "r1"]
    assert stored[0]["started_at"] == datetime(2026, 8, 11, 9)
    assert stored[0]["quality_status"] is None
    recent = history.load_runs(spark, path, since=date(2026, 8, 12))
    assert [r["run_id"] for r in recent.collect()] == ["r1"]
    assert recent.columns == schemas.RUNS.names
    assert history.load_runs(spark, path).count() == 2


def test_other_histories(spark, tmp_path):
    path = str(tmp_path / "stages")
    rows = spark.createDataFrame([("run-001", "POST INGESTION", 1.5)], schemas.STAGE_RUNS)
    assert not history.append_stage_runs(rows.limit(0), path)
    with pytest.raises(FileNotFoundError):
        history.load(spark, path, schemas.STAGE_RUNS)
    assert history.append_stage_runs(rows, path)
    assert history.append_stage_runs(rows.withColumn("run_id", F.lit("run-002")), path)
    assert history.load(spark, path, schemas.STAGE_RUNS).count() == 2
    quality = str(tmp_path / "quality")
    assert history.load_quality(spark, quality).count() == 0
    for hour, run in ((1, "a"), (2, "b")):
        history.append_quality(
            spark.createDataFrame([(run, datetime(2026, 8, 12, hour), 1, 0, 0, "PASSED")],
                                  schemas.QUALITY), quality)
    stored = history.load_quality(spark, quality)
    assert ledger.latest_quality(stored).first()["run_id"] == "b"
    assert ledger.latest_quality(stored, "a").first()["run_id"] == "a"
    assert ledger.latest_quality(stored, "c").first() is None


def test_old_ledger_rows_with_a_text_map_stay_readable(spark, tmp_path):
    old = spark.createDataFrame(
        [("a", '{"S": {"attempts": 2, "retries": 1}}'), ("b", "no map"), ("c", None)],
        "run_id string, retry_information string",
    )
    path = str(tmp_path / "ledger")
    assert history.append_runs(old, path)
    found = {r.run_id: r.retry_information for r in history.load_runs(spark, path).collect()}
    assert found["a"]["S"]["retries"] == 1 and not found["b"] and found["c"] is None


def _runs(spark, ids, day=12):
    data = [(i, datetime(2026, 8, day), 1.0) for i in ids]
    return spark.createDataFrame(data, "run_id string, started_at timestamp, total_duration double")


def _written(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*.parquet"))


def _rows_scanned(df):
    """Rows that come out of the scan of a query, after its row groups were pruned."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.mark.parametrize("listed", [1000, 0])
def test_a_batch_is_looked_for_in_matching_files_only(spark, tmp_path, monkeypatch, listed):
    monkeypatch.setattr(history, "LISTED_IDS", listed)
    path = str(tmp_path / "runs")
    for day in (10, 11, 12):
        assert history.append_runs(_runs(spark, [f"2026081{day % 10}_{i:03d}" for i in range(50)], day).coalesce(1), path)
    assert len(_written(tmp_path / "runs")) == 3
    batch = [f"20260813_{i:03d}" for i in range(5)]
    ids = _runs(spark, batch).select("run_id")
    found = history.recorded(spark, path, ids, {"n": 5, "low": batch[0], "high": batch[-1]})
    assert found.count() == 0
    listed_filter = spark.read.schema(schemas.RUNS).parquet(path).select("run_id").where(F.col("run_id").isin(batch))
    assert _rows_scanned(listed_filter) == 0
    # Between the ids of one day only that file's Bloom filter decides.
    absent = spark.read.schema(schemas.RUNS).parquet(path).select("run_id").where(F.col("run_id") == "20260811_0105")
    assert _rows_scanned(absent) == 0
    with pytest.raises(ValueError, match="20260811_007 is already recorded"):
        history.append_runs(_runs(spark, [*batch, "20260811_007"], 13), path)
    assert history.append_runs(_runs(spark, batch, 13), path)
    assert history.load_runs(spark, path).count() == 155
    assert not list((tmp_path / "runs").glob("_staged*"))


def test_appends_are_written_once_and_leave_nothing_for_no_rows(spark, tmp_path):
    path = str(tmp_path / "stages")
    rows = spark.createDataFrame([("r", "A", 1.5)], schemas.STAGE_RUNS).coalesce(1)
    assert not history.append_stage_runs(rows.limit(0), path)
    assert not _written(tmp_path / "stages")
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("one-append", "")
    history.append_stage_runs(rows, path)
    assert len(jobs.getJobIdsForGroup("one-append")) == 1
    spark.sparkContext.setJobGroup("other", "")
    assert len(_written(tmp_path / "stages")) == 1


def test_a_failed_append_leaves_nothing(spark, tmp_path):
    path = str(tmp_path / "stages")
    broken = spark.range(3).select(
        F.col("id").cast("string").alias("run_id"), F.lit("S").alias("stage_name"),
        F.when(F.col("id") == 2, F.raise_error(F.lit("broken"))).otherwise(1.0).alias("duration"))
    with pytest.raises(Exception, match="broken"):
        history.append_stage_runs(broken, path)
    assert not list(tmp_path.glob("stages/*"))


def test_ledger_text_has_to_be_a_number(spark):
    old = spark.createDataFrame(
        [("a", "12d", "1f"), ("b", "0x1p3", "2.0"), ("c", " 3.5 ", "7"), ("d", "NaN", "Infinity")],
        "run_id string, total_duration string, total_stages string")
    found = {r.run_id: (r.total_duration, r.total_stages) for r in ledger.normalized_runs(old).collect()}
    assert found == {"a": (None, None), "b": (None, 2), "c": (3.5, 7), "d": (None, None)}
