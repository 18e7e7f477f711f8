import pytest
from pyspark.sql import functions as F
from test_alarms import points

from clickbasin.operators.alarms import alarm_states, quality_alarms
from clickbasin.streaming.alarm_stream import judge_new, read_history

START = "2024-03-01 00:00:00"


def run(spark, lake, frame, until, rule="ignore", jobs=("job",), since=START, staleness=86_400):
    if frame is not None:
        frame.write.mode("append").parquet(lake.metrics)
    query = judge_new(spark, lake, quality_alarms(rule, staleness), jobs, f"{lake.root}/judging", until, since)
    query.awaitTermination()
    return sum(source["numInputRows"] for progress in query.recentProgress for source in progress["sources"] if "metrics" in source["description"])


def rows(frame):
    return sorted(tuple(r) for r in frame.select("job_name", "alarm", "period_start", "datapoints", "value", "state").collect())


def at(frame, begin, end):
    moment = F.col("ts")
    return frame.where((moment >= F.lit(begin).cast("timestamp")) & (moment < F.lit(end).cast("timestamp")))


@pytest.mark.parametrize("rule", ["ignore", "missing", "breaching", "notBreaching"])
def test_runs_after_one_another_are_as_one_look_at_all_points(spark, lake, rule):
    frame = points(
        spark,
        {"2024-03-01 03:00:00": (2, 0), "2024-03-01 09:00:00": (1, 1), "2024-03-04 03:00:00": (0, 1), "2024-03-06 01:00:00": (3, 0)},
    ).union(points(spark, {"2024-03-02 05:00:00": (0, 1)}, "other"))
    days = [f"2024-03-0{n} 00:00:00" for n in (1, 3, 4, 5, 8)]
    read = []
    for begin, end in zip(days, days[1:]):
        new = at(frame, begin, end)
        read.append(run(spark, lake, new, end, rule, ("job", "other", "silent")) - new.count())
    # Every run reads the points that came since the last one, and none again.
    assert read == [0, 0, 0, 0]
    want = alarm_states(frame, quality_alarms(rule), START, days[-1], ["job", "other", "silent"])
    assert rows(read_history(spark, lake)) == rows(want)


def test_points_before_the_first_period_tell_the_state(spark, lake):
    frame = points(spark, {"2024-02-27 03:00:00": (2, 0)})
    run(spark, lake, frame, "2024-03-03 00:00:00")
    want = alarm_states(frame, quality_alarms("ignore"), START, "2024-03-03 00:00:00", ["job"])
    assert rows(read_history(spark, lake)) == rows(want)
    assert read_history(spark, lake).where("alarm = 'check-failed' AND state = 'ALARM'").count() == 2


def test_open_periods_wait_and_late_points_change_nothing(spark, lake):
    run(spark, lake, points(spark, {"2024-03-01 03:00:00": (0, 1)}), "2024-03-01 20:00:00")
    assert read_history(spark, lake).count() == 0
    run(spark, lake, points(spark, {"2024-03-01 21:00:00": (2, 0)}), "2024-03-02 00:00:00")
    first = rows(read_history(spark, lake))
    assert {(name, n, value, state) for _, name, _, n, value, state in first} == {
        ("constraints-failed", 2, 2.0, "ALARM"), ("check-failed", 2, 0.0, "ALARM"), ("stale-results", 2, 2.0, "OK"),
    }
    run(spark, lake, points(spark, {"2024-03-01 05:00:00": (9, 0)}), "2024-03-02 00:00:00")
    assert rows(read_history(spark, lake)) == first


def test_without_metrics_and_with_short_periods(spark, lake):
    run(spark, lake, None, "2024-03-01 03:00:00", staleness=3600)
    stale = read_history(spark, lake).where("alarm = 'stale-results'")
    assert [r.state for r in stale.collect()] == ["ALARM"] * 3
