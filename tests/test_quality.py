import glob

import pytest
from conftest import DAY, STAMP, event
from test_reports import row, table

from clickbasin.functions.dates import ingest_day
from clickbasin.operators import quality
from clickbasin.operators.quality import QualityRules, constraint_results, measure
from clickbasin.plans.curate import curate_day, write_curated
from clickbasin.plans.quality_run import QualityFailure, verify_day

NOW = "2024-03-05 10:00:00"


def timed(spark, rows):
    frame = table(spark, rows)
    return frame.withColumn("event_ts", quality.F.coalesce("event_ts", quality.F.lit(NOW).cast("timestamp")))


def failures(frame, rules=QualityRules()):
    results = constraint_results(measure(frame, rules), rules).collect()
    return {r["constraint"] for r in results if r["constraint_status"] != "Success"}, results


def test_all_constraints_hold(spark):
    rules = QualityRules(allowed_event_types=("search",), max_quantity=5.0)
    failed, results = failures(timed(spark, [row(1, quantity=5), row(2)]), rules)
    assert failed == set() and len(results) == 10
    assert {r["check_status"] for r in results} == {"Success"}
    assert len(failures(timed(spark, [row(1)]))[1]) == 8


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([row(1, quantity=1), row(1, quantity=1)], {"Uniqueness(event_id)"}),
        ([row(1, value=-0.1, quantity=1)], {"Compliance(value is non-negative)"}),
        ([row(1, value=None, quantity=None), row(2, quantity=1)], set()),
        ([row(1, quantity=-1), row(2, quantity=1)], {"Compliance(quantity is non-negative)"}),
        ([row(1, quantity=6)], {"Maximum(quantity)"}),
        ([row(1)], {"Maximum(quantity)"}),  # every quantity null: no maximum to judge
        ([row(1, "odd", quantity=1)], {"Compliance(event_type in allowed set)"}),
        ([row(1, user_id=None, quantity=1)], {"Completeness(user_id)"}),
    ],
)
def test_each_constraint_fails_alone(spark, rows, expected):
    rules = QualityRules(allowed_event_types=("search",), max_quantity=5.0)
    assert failures(timed(spark, rows), rules)[0] == expected


def test_null_type_passes_the_set_but_not_completeness(spark):
    rules = QualityRules(allowed_event_types=("search",))
    assert failures(timed(spark, [row(1, None)]), rules)[0] == {"Completeness(event_type)"}


def test_null_ids_are_incomplete_and_not_unique(spark):
    frame = timed(spark, [row(1), row(2)]).selectExpr(
        "IF(event_id = '2', NULL, event_id) AS event_id", "event_ts", "user_id", "value", "quantity", "event_type"
    )
    failed, results = failures(frame)
    assert failed == {"Completeness(event_id)", "Uniqueness(event_id)"}
    assert {r["constraint_message"] for r in results} == {"", "not met: 0.500000"}
    assert failures(frame, QualityRules(required_completeness=0.5))[0] == {"Uniqueness(event_id)"}
    nothing = frame.withColumn("event_id", quality.F.lit(None).cast("string"))
    assert failures(nothing)[0] == {"Completeness(event_id)", "Uniqueness(event_id)"}


def test_warnings_count_in_the_total_only(spark):
    rules = QualityRules()
    frame = timed(spark, [row(1, user_id=None)])
    summary = quality.summary(constraint_results(measure(frame, rules), rules)).first()
    assert summary.asDict() == {
        "constraints_failed": 0, "constraints_total": 8, "rows_verified": 1, "check_success": 1,
    }


def test_days_are_judged_separately_in_one_job(spark):
    rules, by = QualityRules(), ["year", "month", "day"]
    frame = timed(spark, [row(1), row(1), row(1, day="06"), row(2, day="06")])
    summary = quality.summary(constraint_results(measure(frame, rules, by), rules, by), by)
    assert {r["day"]: r["constraints_failed"] for r in summary.collect()} == {"05": 1, "06": 0}


def metrics(spark, lake):
    return {r["metric"]: r["value"] for r in spark.read.parquet(lake.metrics).collect()}


def test_results_and_metrics_are_stored_before_the_run_fails(spark, lake):
    write_curated(timed(spark, [row(1), row(1)]), lake.curated)
    with pytest.raises(QualityFailure, match="Uniqueness"):
        verify_day(spark, lake, DAY, verified_at=STAMP)
    files = glob.glob(f"{lake.quality_results}/{DAY.folder()}/*.json")
    assert len(files) == 1
    stored = spark.read.json(lake.quality_results)
    assert stored.count() == 8
    assert {r["rows_verified"] for r in stored.collect()} == {2}
    assert "verified_at" in stored.columns
    assert metrics(spark, lake) == {
        "ConstraintsFailed": 1.0, "ConstraintsTotal": 8.0, "RowsVerified": 2.0, "CheckSuccess": 0.0,
    }
    outcome = verify_day(spark, lake, DAY, verified_at=STAMP, fail_on_error=False)
    assert not outcome.success and outcome.rows_verified == 2
    assert len(glob.glob(f"{lake.quality_results}/{DAY.folder()}/*.json")) == 1  # replaced
    assert spark.read.parquet(lake.metrics).count() == 8  # appended


def test_no_data_is_a_clean_result_without_a_file(spark, lake, drop_lines):
    expected = {"ConstraintsFailed": 0.0, "ConstraintsTotal": 0.0, "RowsVerified": 0.0, "CheckSuccess": 1.0}
    assert verify_day(spark, lake, DAY, verified_at=STAMP).success
    assert metrics(spark, lake) == expected
    drop_lines(lake.raw, "search", [event("1")])
    curate_day(spark, lake, DAY)
    assert verify_day(spark, lake, ingest_day("2024-04-01"), verified_at=STAMP).rows_verified == 0
    assert not glob.glob(f"{lake.quality_results}/**/*.json", recursive=True)


def test_ids_are_summed_before_the_shuffle(spark):
    text = measure(timed(spark, [row(1)]), QualityRules())._jdf.queryExecution().executedPlan().toString()
    assert "partial_count(1)" in text and "Join" not in text and "Cartesian" not in text
