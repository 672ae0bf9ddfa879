"""Run and stage analytics against the hand-written fixtures."""

from datetime import datetime

import pytest

from tidemark import schemas
from tidemark.operators import baseline, ledger, runs, sla, stages

STAGE_ROWS = "run_id string, stage_name string, duration double"


@pytest.fixture(scope="module")
def three_runs(spark):
    return spark.createDataFrame(
        [("run-001", "SUCCESS", 3.0), ("run-002", "SUCCESS", 5.0), ("run-003", "FAILED", 4.0)],
        "run_id string, status string, total_duration double",
    )


@pytest.fixture(scope="module")
def sla_runs(spark):
    return spark.createDataFrame(
        [
            ("run-001", "POST INGESTION", 1.0),
            ("run-001", "USER INGESTION", 0.5),
            ("run-002", "POST INGESTION", 3.0),
            ("run-002", "USER INGESTION", 1.5),
            ("run-003", "POST INGESTION", 1.5),
        ],
        STAGE_ROWS,
    )


THRESHOLDS = {"POST INGESTION": 2.0, "USER INGESTION": 1.0}


def test_run_summary(three_runs):
    row = runs.run_summary(three_runs).first()
    assert tuple(row) == (3, 2, 1, 66.67, 4.0)
    assert runs.extreme_run(three_runs, False).first()["run_id"] == "run-001"
    assert runs.extreme_run(three_runs, True).first()["run_id"] == "run-002"
    fastest_failed = runs.extreme_run(three_runs, False, status="FAILED").first()
    assert fastest_failed["run_id"] == "run-003"


def test_four_runs_failed_takes_part(spark):
    df = spark.createDataFrame(
        [("run-001", "SUCCESS", 5.0), ("run-002", "SUCCESS", 10.0),
         ("run-003", "FAILED", 20.0), ("run-004", "SUCCESS", 15.0)],
        "run_id string, status string, total_duration double",
    )
    assert tuple(runs.run_summary(df).first()) == (4, 3, 1, 75.0, 12.5)
    assert runs.extreme_run(df, True).first()["run_id"] == "run-003"
    assert runs.success_rate(df).first()[0] == 75.0
    assert runs.average_duration(df).first()[0] == 12.5
    assert tuple(runs.status_counts(df).first()) == (3, 1)


def test_empty_runs(three_runs):
    empty = three_runs.limit(0)
    assert tuple(runs.run_summary(empty).first()) == (0, 0, 0, 0.0, 0.0)
    assert runs.extreme_run(empty, True).first() is None
    assert runs.health(empty).first()[0] == "HEALTHY"


def test_extreme_tie_and_nan(spark):
    df = spark.createDataFrame(
        [("b", "SUCCESS", 1.0), ("a", "SUCCESS", 1.0), ("c", "SUCCESS", float("nan")),
         ("d", "SUCCESS", None)],
        "run_id string, status string, total_duration double",
    )
    assert runs.extreme_run(df, False).first()["run_id"] == "a"
    assert runs.extreme_run(df, True).first()["run_id"] == "a"
    assert runs.slow_runs(df, 0.5).count() == 2


def test_monitoring(spark):
    df = spark.createDataFrame(
        [("run-001", "SUCCESS", 3.0, None, None, datetime(2026, 8, 12, 10)),
         ("run-002", "SUCCESS", 4.0, None, None, datetime(2026, 8, 12, 11)),
         ("run-003", "FAILED", 2.0, "SCHEMA VALIDATION", "Schema validation failed", None),
         ("run-004", "SUCCESS", 7.0, None, None, datetime(2026, 8, 12, 9))],
        "run_id string, status string, total_duration double, failed_stage string,"
        " error string, started_at timestamp",
    )
    assert [r["run_id"] for r in runs.failed_runs(df).collect()] == ["run-003"]
    assert [r["run_id"] for r in runs.slow_runs(df).collect()] == ["run-004"]
    assert runs.health(df).first()[0] == "FAILED"
    assert runs.latest_run(df).first()["run_id"] == "run-002"
    report = runs.monitoring_report(df).first()
    assert (report["total_runs"], report["failed_runs"], report["slow_runs"]) == (4, 1, 1)
    assert (report["health"], report["latest_run_id"]) == ("FAILED", "run-002")
    assert report["latest_started_at"] == datetime(2026, 8, 12, 11)
    one = df.filter("run_id = 'run-004'")
    assert runs.health(one).first()[0] == "WARNING"
    assert runs.health(df.filter("run_id = 'run-001'")).first()[0] == "HEALTHY"


@pytest.mark.parametrize(
    "status, used, skip, retry",
    [("SUCCESS", 0, True, False), ("FAILED", 1, False, True), ("FAILED", 3, False, False)],
)
def test_state_and_eligibility(spark, status, used, skip, retry):
    df = spark.createDataFrame(
        [("r1", "SUCCESS", datetime(2026, 8, 12, 1), None, None),
         ("r2", status, datetime(2026, 8, 12, 2), "S", "E")],
        "run_id string, status string, finished_at timestamp, failed_stage string, error string",
    )
    state = runs.last_state(df)
    row = runs.eligibility(state, used, 3).first()
    assert (row["last_run_id"], row["last_status"]) == ("r2", status)
    assert (row["should_skip"], row["should_retry"]) == (skip, retry)
    assert row["failed_stage"] == ("S" if status == "FAILED" else None)
    assert runs.eligibility(runs.last_state(df.limit(0))).count() == 0


def test_failure_breakdown(spark, rows):
    df = spark.createDataFrame(
        [("1", "FAILED", "POST INGESTION"), ("2", "FAILED", "POST INGESTION"),
         ("3", "FAILED", "SCHEMA VALIDATION"), ("4", "FAILED", None), ("5", "SUCCESS", None)],
        "run_id string, status string, failed_stage string",
    )
    assert rows(runs.failure_breakdown(df)) == [
        ("POST INGESTION", "RETRYABLE", 2),
        ("SCHEMA VALIDATION", "NON_RETRYABLE", 1),
        (None, "NON_RETRYABLE", 1),
    ]


def test_stage_metrics_of_a_run(spark):
    values = [1.2, 0.8, 2.5, 1.1, 0.6, 0.9, 0.7, 1.4, 1.8]
    df = spark.createDataFrame(
        [("r", s, v) for s, v in zip(schemas.STAGES, values, strict=True)], STAGE_ROWS
    )
    row = stages.run_stage_metrics(df).first()
    assert tuple(row) == ("r", 9, "POST VALIDATION", "POST TRANSFORMATION", 0.6, 2.5)
    mean = stages.run_average_stage_duration(df).first()[1]
    assert mean == pytest.approx(1.2222, abs=1e-4)
    assert [r["stage_name"] for r in stages.slow_stages(df, 2.0).collect()] == [
        "POST TRANSFORMATION"
    ]
    assert stages.run_total_duration(df).first()[1] == 11.0


def test_stage_metrics_without_stages(spark):
    none = spark.createDataFrame([], STAGE_ROWS)
    known = spark.createDataFrame([("r",)], "run_id string")
    assert tuple(stages.run_stage_metrics(none, known).first()) == ("r", 0, None, None, 0.0, 0.0)
    assert tuple(stages.run_average_stage_duration(none, known).first()) == ("r", 0.0)


def test_stage_analytics(spark, rows):
    df = spark.createDataFrame(
        [("run-001", "POST INGESTION", 1.0), ("run-001", "USER INGESTION", 0.5),
         ("run-002", "POST INGESTION", 2.0), ("run-002", "USER INGESTION", 0.7),
         ("run-003", "POST INGESTION", 1.5)],
        STAGE_ROWS,
    )
    found = {}
    for r in stages.full_analytics(df).collect():
        found.setdefault(r.section, []).append(r)
    assert [r.executions for r in found["total"]] == [5]
    assert sorted((r.stage_name, r.average_duration) for r in found["stage"]) == [
        ("POST INGESTION", 1.5), ("USER INGESTION", 0.6)]
    assert [(r.run_id, r.duration) for r in found["fastest_execution"]] == [("run-001", 0.5)]
    assert [(r.run_id, r.duration) for r in found["slowest_execution"]] == [("run-002", 2.0)]
    assert [r.stage_name for r in found["slowest_average"]] == ["POST INGESTION"]
    assert [r.stage_name for r in found["fastest_average"]] == ["USER INGESTION"]
    stage = next(r for r in found["stage"] if r.stage_name == "POST INGESTION")
    assert (stage.executions, stage.minimum_duration, stage.maximum_duration) == (3, 1.0, 2.0)
    assert tuple(stages.stage_analytics_summary(df).first()) == (
        5, "USER INGESTION", "POST INGESTION", 0.6, 1.5)
    empty = stages.full_analytics(df.limit(0)).collect()
    assert [(r.section, r.executions) for r in empty] == [("total", 0)]


def test_full_sla_report(spark):
    df = spark.createDataFrame(
        [("1", "A", 1.0), ("2", "A", 3.0), ("1", "B", 5.0), ("1", "other", 9.0), ("2", "B", None)], STAGE_ROWS)
    limits = {"B": 2.0, "A": 2.0, "C": 1.0}
    report = sla.full_report(df, limits)
    found = [(r.section, r.position, r.stage_name, r.executions, r.violations, r.violation_rate)
             for r in report.orderBy("section", "position").collect()]
    assert found == [
        ("overall", 0, None, 5, 2, 40.0), ("stage", 0, "B", 2, 1, 50.0), ("stage", 1, "A", 2, 1, 50.0),
        ("stage", 2, "C", 0, 0, 0.0), ("worst", 0, "B", 2, 1, 50.0)]
    empty = sla.full_report(df.limit(0), limits).collect()
    assert sorted({r.section for r in empty}) == ["overall", "stage"]
    assert [r.sla_status for r in empty if r.section == "overall"] == ["NO DATA"]


def test_full_monitoring_report(spark):
    schema = "run_id string, status string, started_at timestamp, total_duration double, failed_stage string, error string"
    data = [("1", "SUCCESS", datetime(2026, 1, 1, 10), 3.0, None, None),
            ("2", "FAILED", datetime(2026, 1, 1, 11), 9.0, "X", "broken"),
            ("3", "SUCCESS", datetime(2026, 1, 1, 9), 7.0, None, None)]
    df = spark.createDataFrame(data, schema)
    found = runs.full_monitoring_report(df, 5.0).collect()
    assert sorted((r.section, r.run_id or "") for r in found) == [
        ("failed", "2"), ("latest", "2"), ("slow", "2"), ("slow", "3"), ("summary", "")]
    summary = next(r for r in found if r.section == "summary")
    assert (summary.total_runs, summary.failed_runs, summary.slow_runs, summary.health) == (3, 1, 2, "FAILED")
    failed = next(r for r in found if r.section == "failed")
    assert (failed.failed_stage, failed.error) == ("X", "broken")
    nothing = runs.full_monitoring_report(df.limit(0), 5.0).collect()
    assert [(r.section, r.total_runs, r.health) for r in nothing] == [("summary", 0, "HEALTHY")]


def test_recommendation_report(spark):
    baseline_rows = [("A", 3, 1.0, 1.5), ("B", 2, 4.0, 5.0)]
    frame = spark.createDataFrame(
        baseline_rows, "stage_name string, executions long, average_duration double, p95_duration double")
    report = sla.recommendation_report(sla.recommendations(frame, {"A": 2.0, "B": 2.0, "C": 1.0}))
    found = sorted((r.section, r.stage_name or "", r.total_stages) for r in report.collect())
    assert found == [("investigate", "B", None), ("recommendation", "A", None),
                     ("recommendation", "B", None), ("summary", "", 2)]
    none = sla.recommendation_report(sla.recommendations(frame.limit(0), {"A": 2.0})).collect()
    assert [(r.section, r.total_stages, r.stages_to_investigate) for r in none] == [("summary", 0, 0)]


BASELINE_ROWS = [
    ("1", "POST INGESTION", 1.0), ("2", "POST INGESTION", 2.0), ("3", "POST INGESTION", 3.0),
    ("1", "USER INGESTION", 0.5), ("2", "USER INGESTION", 1.0), ("3", "USER INGESTION", 1.5),
]


@pytest.mark.parametrize("method", ["percentile", "selection"])
def test_baseline(spark, method):
    df = spark.createDataFrame(BASELINE_ROWS, STAGE_ROWS)
    found = {r["stage_name"]: tuple(r)[1:] for r in
             baseline.stage_baseline(df, method).collect()}
    assert found == {
        "POST INGESTION": (3, 2.0, 1.0, 3.0, 2.0, 2.9, 2.98),
        "USER INGESTION": (3, 1.0, 0.5, 1.5, 1.0, 1.45, 1.49),
    }
    assert tuple(baseline.baseline_summary(df, method).first()) == (
        6, 2, "POST INGESTION", "USER INGESTION", "POST INGESTION")


def test_baseline_extremes(spark):
    df = spark.createDataFrame(BASELINE_ROWS, STAGE_ROWS)
    table = baseline.stage_baseline(df, "percentile")
    assert baseline.slowest_average_stage(table).first()[0] == "POST INGESTION"
    assert baseline.fastest_average_stage(table).first()[0] == "USER INGESTION"
    assert baseline.highest_p95_stage(table).first()[0] == "POST INGESTION"
    assert baseline.stage_baseline_for(df, "NONE", "percentile").count() == 0
    assert baseline.stage_baseline_for(df, "USER INGESTION", "percentile").first()[1] == 3
    with pytest.raises(ValueError):
        baseline.stage_baseline(df, "guess")


@pytest.mark.parametrize("method", ["percentile", "selection"])
def test_baseline_ignores_unmeasured(spark, method):
    df = spark.createDataFrame(
        [("1", "A", "1.5"), ("2", "A", "junk"), ("3", "A", None), ("4", "B", "NaN"),
         ("5", None, "2.0")],
        "run_id string, stage_name string, duration string",
    )
    table = baseline.stage_baseline(df, method)
    assert [tuple(r)[:3] for r in table.collect()] == [("A", 1, 1.5)]
    assert tuple(baseline.baseline_summary(df, method).first())[:2] == (5, 1)
    empty = baseline.baseline_summary(df.filter("stage_name = 'B'"), method).first()
    assert tuple(empty) == (0, 0, None, None, None)


def test_sla(spark, rows, sla_runs):
    assert rows(sla.violations(sla_runs, THRESHOLDS)) == [
        ("run-002", "POST INGESTION", 3.0, 2.0), ("run-002", "USER INGESTION", 1.5, 1.0)]
    post = sla.compliance(sla_runs, "POST INGESTION", 2.0).first()
    assert (post["compliance_rate"], post["violation_rate"]) == (66.67, 33.33)
    report = [tuple(r) for r in sla.stage_report(sla_runs, THRESHOLDS).collect()]
    assert report == [
        ("POST INGESTION", 3, 2.0, 1, 66.67, 33.33, "VIOLATION"),
        ("USER INGESTION", 2, 1.0, 1, 50.0, 50.0, "VIOLATION"),
    ]
    assert sla.worst_stage(sla_runs, THRESHOLDS).first()["stage_name"] == "USER INGESTION"
    assert tuple(sla.overall_report(sla_runs, THRESHOLDS).first()) == (
        5, 2, 60.0, "USER INGESTION", 50.0)
    loose = {k: 5.0 for k in THRESHOLDS}
    none = sla.violations(sla_runs, loose)
    assert none.count() == 0
    assert none.columns == ["run_id", "stage_name", "duration", "sla_threshold"]


def test_sla_thresholds_from_a_table(spark, sla_runs):
    table = spark.createDataFrame(
        [("USER INGESTION", 1.0, 1), ("POST INGESTION", 2.0, 0), ("NONE", 1.0, 2)],
        "stage_name string, sla_threshold double, ord int")
    report = [tuple(r)[:4] for r in sla.stage_report(sla_runs, table).collect()]
    assert report == [("POST INGESTION", 3, 2.0, 1), ("USER INGESTION", 2, 1.0, 1),
                      ("NONE", 0, 1.0, 0)]
    assert tuple(sla.overall_report(sla_runs, table).first()) == (
        5, 2, 60.0, "USER INGESTION", 50.0)
    assert sla.violations(sla_runs, table).count() == 2


def test_sla_edges(spark, sla_runs):
    empty = sla_runs.limit(0)
    assert [r["sla_status"] for r in sla.stage_report(empty).collect()] == ["NO DATA"] * 9
    assert sla.worst_stage(empty, THRESHOLDS).count() == 0
    assert tuple(sla.overall_report(empty, THRESHOLDS).first()) == (0, 0, 0.0, None, None)
    unknown = sla.compliance(sla_runs, "NONE", 1.0).first()
    assert (unknown["compliance_rate"], unknown["violation_rate"]) == (0.0, 100.0)
    gaps = spark.createDataFrame(
        [("1", "POST INGESTION", None), ("2", "POST INGESTION", 1.0), ("3", "OTHER", 9.0)],
        STAGE_ROWS,
    )
    # A null duration is not compliant for one stage's rate, yet no violation in the report.
    assert sla.compliance(gaps, "POST INGESTION", 2.0).first()["compliance_rate"] == 50.0
    assert sla.stage_report(gaps, THRESHOLDS).first()["compliance_rate"] == 100.0
    assert sla.overall_report(gaps, THRESHOLDS).first()["total_executions"] == 3


def test_recommendations(spark, rows):
    table = spark.createDataFrame(
        [("POST TRANSFORMATION", 20, 1.8, 3.0), ("POST VALIDATION", 20, 1.2, 1.8),
         ("OTHER", 1, 1.0, 1.0)],
        "stage_name string, executions long, average_duration double, p95_duration double",
    )
    found = sla.recommendations(table)
    assert rows(found, "stage_name", "current_sla", "recommended_sla", "recommendation") == [
        ("POST TRANSFORMATION", 2.0, 3.0, "INVESTIGATE"), ("POST VALIDATION", 2.0, 1.8, "KEEP")]
    assert tuple(sla.recommendation_summary(found).first()) == (2, 1)
    assert [r[0] for r in sla.to_investigate(found).collect()] == ["POST TRANSFORMATION"]
    assert tuple(sla.recommendation_summary(found.limit(0)).first()) == (0, 0)


def test_retry_totals(spark):
    df = spark.createDataFrame(
        [("r1", "A", 3, 2), ("r1", "B", 1, 0), ("r2", "A", 1, None)],
        "run_id string, stage_name string, attempts long, retries long",
    )
    assert {r[0]: r[1] for r in ledger.retry_totals(df).collect()} == {"r1": 2, "r2": 0}
    maps = ledger.retry_maps(df)
    both = maps.select("run_id", "total_retries", ledger.total_retries().alias("again"))
    assert sorted(tuple(r) for r in both.collect()) == [("r1", 2, 2), ("r2", 0, 0)]
    none = spark.sql("SELECT CAST(NULL AS map<string,struct<attempts:bigint,retries:bigint>>) m")
    assert none.select(ledger.total_retries("m")).first()[0] == 0


def test_failed_stage(spark, rows):
    df = spark.createDataFrame(
        [("r1", "A"), ("r1", "A"), ("r1", "C"), ("r2", "A"), ("r2", "B"), ("r2", "C"),
         ("r3", "other")],
        "run_id string, stage_name string",
    )
    assert rows(ledger.failed_stage(df, ["A", "B", "C"])) == [
        ("r1", 2, "B"), ("r2", 3, None), ("r3", 0, "A")]


def test_stage_rows(spark, rows):
    df = spark.createDataFrame(
        [("run-001", {"POST INGESTION": 1.5, "USER INGESTION": 0.5}), ("run-002", {})],
        "run_id string, stage_durations map<string,double>",
    )
    assert rows(ledger.stage_rows(df)) == [
        ("run-001", "POST INGESTION", 1.5), ("run-001", "USER INGESTION", 0.5)]


def test_sums_hold_infinite_huge_and_tiny_values(spark):
    from tidemark.functions.numeric import exact_avg, exact_sum

    df = spark.createDataFrame(
        [("i", 1.0), ("i", float("inf")), ("h", 1e20), ("h", 2.0), ("t", 1e-10), ("t", 3e-10), ("n", None)],
        "g string, v double",
    )
    found = {r.g: (r.s, r.a) for r in df.groupBy("g").agg(exact_sum("v").alias("s"), exact_avg("v").alias("a")).collect()}
    assert found["i"] == (float("inf"), float("inf"))
    assert found["h"] == (1e20 + 2.0, 5e19 + 1.0)
    assert found["t"] == (pytest.approx(4e-10), pytest.approx(2e-10))
    assert found["n"] == (None, None)


def test_text_measures_are_plain_numbers(spark):
    from tidemark.functions.numeric import measure

    texts = ["12d", "1f", "0x1p3", "1.5", " 2 ", "-3e2", ".5", "inf", "nan", "", "x", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    assert [r[0] for r in df.select(measure("v")).collect()] == [
        None, None, None, 1.5, 2.0, -300.0, 0.5, float("inf"), None, None, None, None,
    ]


def test_failed_stage_beyond_one_word(spark, rows):
    stages = [f"S{i:03d}" for i in range(150)]
    df = spark.createDataFrame(
        [("all", s) for s in stages] + [("gap", s) for s in stages if s != "S130"],
        "run_id string, stage_name string",
    )
    assert rows(ledger.failed_stage(df, stages)) == [("all", 150, None), ("gap", 149, "S130")]


def test_attempts_without_a_stage_count_in_the_total(spark):
    df = spark.createDataFrame(
        [("r", "A", 2, 1), ("r", None, 3, 2)], "run_id string, stage_name string, attempts long, retries long"
    )
    row = ledger.retry_maps(df).first()
    assert row.total_retries == 3 and set(row.retry_information) == {"A"}
