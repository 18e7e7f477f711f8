import pytest
from conftest import DAY, STAMP
from pyspark.sql import functions as F

from clickbasin.operators.alarms import Alarm, alarm_states, quality_alarms
from clickbasin.plans.quality_run import verify_day
from clickbasin.schemas import METRIC


def points(spark, values, job="job"):
    """``values``: time -> (constraints failed, check success)."""
    rows = []
    for at, (failed, success) in values.items():
        rows += [("ns", job, "ConstraintsFailed", float(failed), "Count", at),
                 ("ns", job, "CheckSuccess", float(success), "Count", at),
                 ("ns", job, "RowsVerified", 9.0, "Count", at)]
    columns = "namespace string, job_name string, metric string, value double, unit string, ts string"
    return spark.createDataFrame(rows, columns).withColumn("ts", F.col("ts").cast("timestamp"))


def states(frame, alarms, start="2024-03-01 00:00:00", end="2024-03-05 00:00:00"):
    found = {}
    for row in alarm_states(frame, alarms, start, end).orderBy("period_start").collect():
        found.setdefault(row["alarm"], []).append(row["state"])
    return found


@pytest.fixture
def gap(spark):
    """Good on the 1st, bad on the 2nd, nothing on the 3rd, good on the 4th."""
    return points(
        spark,
        {"2024-03-01 03:00:00": (0, 1), "2024-03-02 03:00:00": (2, 0), "2024-03-04 03:00:00": (0, 1)},
    )


@pytest.mark.parametrize(
    "rule, on_gap",
    [("notBreaching", "OK"), ("breaching", "ALARM"), ("missing", "INSUFFICIENT_DATA"), ("ignore", "ALARM")],
)
def test_gap_follows_the_missing_data_rule(gap, rule, on_gap):
    found = states(gap, quality_alarms(rule))
    assert found["constraints-failed"] == ["OK", "ALARM", on_gap, "OK"]
    assert found["check-failed"] == ["OK", "ALARM", on_gap, "OK"]
    assert found["stale-results"] == ["OK", "OK", "ALARM", "OK"]


def test_ignore_before_the_first_point_has_no_state_to_keep(gap):
    found = states(gap, quality_alarms("ignore"), start="2024-02-29 00:00:00", end="2024-03-02 00:00:00")
    assert found["check-failed"] == ["INSUFFICIENT_DATA", "OK"]


def test_sum_and_minimum_fold_several_runs_of_a_day(spark):
    frame = points(spark, {"2024-03-01 03:00:00": (0, 1), "2024-03-01 09:00:00": (1, 0), "2024-03-01 12:00:00": (0, 1)})
    rows = alarm_states(frame, quality_alarms(), "2024-03-01 00:00:00", "2024-03-02 00:00:00").collect()
    assert {r["alarm"]: (r["datapoints"], r["value"], r["state"]) for r in rows} == {
        "constraints-failed": (3, 1.0, "ALARM"),
        "check-failed": (3, 0.0, "ALARM"),
        "stale-results": (3, 3.0, "OK"),
    }


def test_shorter_staleness_period_and_many_jobs(spark):
    frame = points(spark, {"2024-03-01 03:00:00": (0, 1)}).union(
        points(spark, {"2024-03-01 05:30:00": (0, 1)}, "other")
    )
    rows = alarm_states(frame, quality_alarms(staleness_seconds=3600), "2024-03-01 00:00:00", "2024-03-01 06:00:00")
    stale = {
        (r["job_name"], r["period_start"].hour): r["state"] for r in rows.where("alarm = 'stale-results'").collect()
    }
    assert len(stale) == 12
    assert [k for k, v in sorted(stale.items()) if v == "OK"] == [("job", 3), ("other", 5)]


def test_job_that_never_reported_is_stale(gap):
    rows = alarm_states(gap, quality_alarms(), "2024-03-01 00:00:00", "2024-03-02 00:00:00", ["job", "silent"])
    assert {(r["job_name"], r["state"]) for r in rows.where("alarm = 'stale-results'").collect()} == {
        ("job", "OK"), ("silent", "ALARM"),
    }


def test_ignore_remembers_what_was_before_the_start(spark):
    frame = points(spark, {"2024-03-01 03:00:00": (2, 0), "2024-03-04 03:00:00": (0, 1)})
    late = alarm_states(frame, quality_alarms("ignore"), "2024-03-03 00:00:00", "2024-03-06 00:00:00")
    states = {(r["alarm"], r["period_start"].day): r["state"] for r in late.collect()}
    assert [states["check-failed", d] for d in (3, 4, 5)] == ["ALARM", "OK", "OK"]
    assert [states["constraints-failed", d] for d in (3, 4, 5)] == ["ALARM", "OK", "OK"]
    assert [states["stale-results", d] for d in (3, 4, 5)] == ["ALARM", "OK", "ALARM"]


def test_staleness_can_be_left_out_and_bounds_hold():
    assert len(quality_alarms(staleness_seconds=None)) == 2
    with pytest.raises(ValueError):
        quality_alarms(staleness_seconds=3599)
    with pytest.raises(ValueError):
        quality_alarms("sometimes")
    with pytest.raises(ValueError):
        Alarm("a", "m", "Average", "LessThanThreshold", 1.0, 60, "missing")


def test_zero_rows_leave_every_alarm_quiet(spark, lake):
    verify_day(spark, lake, DAY, verified_at=STAMP)
    stored = spark.read.parquet(lake.metrics)
    assert set(stored.columns) == set(METRIC.fieldNames())
    rows = alarm_states(stored, quality_alarms(), "2024-03-06 00:00:00", "2024-03-07 00:00:00").collect()
    assert {r["state"] for r in rows} == {"OK"} and len(rows) == 3
