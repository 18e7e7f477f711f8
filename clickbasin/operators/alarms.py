"""Alarm states over the metrics table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickbasin.functions.dates import clock
from clickbasin.operators.quality import CHECK_SUCCESS, CONSTRAINTS_FAILED
from clickbasin.session import small_frame

# States, statistics, comparisons and missing-data rules.
ALARM = "ALARM"
OK = "OK"
INSUFFICIENT = "INSUFFICIENT_DATA"
STATISTICS = ["Sum", "Minimum", "SampleCount"]
AT_LEAST = "GreaterThanOrEqualToThreshold"
BELOW = "LessThanThreshold"
MISSING_RULES = ["missing", "ignore", "breaching", "notBreaching"]
DAY_SECONDS = 86_400
MIN_STALENESS_SECONDS = 3_600


@dataclass(frozen=True)
class Alarm:
    name: str
    metric: str
    statistic: str
    comparison: str
    threshold: float
    period_seconds: int
    missing: str

    def __post_init__(self) -> None:
        if self.statistic not in STATISTICS:
            raise ValueError(f"unknown statistic {self.statistic}")
        if self.comparison not in (AT_LEAST, BELOW):
            raise ValueError(f"unknown comparison {self.comparison}")
        if self.missing not in MISSING_RULES:
            raise ValueError(f"unknown missing-data rule {self.missing}")


def quality_alarms(
    missing: str = "notBreaching", staleness_seconds: int | None = DAY_SECONDS
) -> list[Alarm]:
    """The three alarms of the quality job; ``None`` leaves the staleness alarm out."""
    alarms = [
        Alarm("constraints-failed", CONSTRAINTS_FAILED, "Sum", AT_LEAST, 1.0, DAY_SECONDS, missing),
        Alarm("check-failed", CHECK_SUCCESS, "Minimum", BELOW, 1.0, DAY_SECONDS, missing),
    ]
    if staleness_seconds is not None:
        if staleness_seconds < MIN_STALENESS_SECONDS:
            raise ValueError("the staleness period must be at least an hour")
        alarms.append(
            Alarm("stale-results", CHECK_SUCCESS, "SampleCount", BELOW, 1.0, staleness_seconds, "breaching")
        )
    return alarms


def definitions(alarms: Sequence[Alarm]) -> Column:
    """The alarms as an array of structures."""
    return F.array(
        *[
            F.struct(
                F.lit(a.name).alias("alarm"),
                F.lit(a.metric).alias("alarm_metric"),
                F.lit(a.statistic).alias("statistic"),
                F.lit(a.comparison).alias("comparison"),
                F.lit(float(a.threshold)).alias("threshold"),
                F.lit(a.period_seconds).cast("long").alias("period_seconds"),
                F.lit(a.missing).alias("missing"),
            )
            for a in alarms
        ]
    )


def alarm_states(
    points: DataFrame,
    alarms: Sequence[Alarm],
    start: datetime | str,
    end: datetime | str,
    jobs: Sequence[str] | None = None,
) -> DataFrame:
    """``job_name, alarm, period_start, datapoints, value, state`` for every period.

    Periods cover ``[start, end)`` and begin at multiples of their length since
    the epoch, so days are UTC days. ``jobs`` names the jobs to judge, also those
    that never reported; by default it is every job in ``points``. A period
    without data follows the alarm's missing-data rule; ``ignore`` keeps the
    state before it, which may come from points before ``start``.
    """
    first, last = F.unix_timestamp(clock(start)), F.unix_timestamp(clock(end))
    length = F.col("period_seconds")
    defined = definitions(alarms)

    # Every point meets the alarms on its metric, then folds to one row per period.
    longest = F.make_dt_interval(secs=F.lit(max(a.period_seconds for a in alarms)))
    recent = F.col("ts") >= clock(start) - longest
    # Only alarms that keep a state have to look further back.
    keeps = any(a.missing == "ignore" for a in alarms)
    asked = points.where(F.col("ts") < clock(end))
    observed = (
        (asked if keeps else asked.where(recent))
        .select(
            "job_name",
            "value",
            F.unix_timestamp("ts").alias("_at"),
            F.inline(
                F.filter(
                    defined,
                    lambda d: (d["alarm_metric"] == F.col("metric")) & (recent | (d["missing"] == "ignore")),
                )
            ),
        )
        .withColumn("_period", F.col("_at") - F.pmod("_at", length))
        .groupBy("job_name", "alarm", "_period", "statistic", "comparison", "threshold", "period_seconds", "missing")
        .agg(
            F.count("value").alias("datapoints"),
            F.sum("value").alias("_sum"),
            F.min("value").alias("_min"),
        )
    )
    # The spine is as long as the time range, whatever the number of points.
    named = (
        points.select("job_name").distinct()
        if jobs is None
        else small_frame(points.sparkSession, [(name,) for name in jobs], "job_name string")
    )
    spine = (
        named.select("job_name", F.inline(defined))
        .withColumn("_first", first - F.pmod(first, length))
        .where(F.col("_first") < last)
        .withColumn("_period", F.explode(F.sequence(F.col("_first"), last - 1, length)))
    )
    measured = ["job_name", "alarm", "_period", "datapoints", "_sum", "_min"]
    joined = spine.join(observed.select(*measured), ["job_name", "alarm", "_period"], "left").withColumn(
        "datapoints", F.coalesce("datapoints", F.lit(0).cast("long"))
    )
    value = (
        F.when(F.col("statistic") == "Sum", F.col("_sum"))
        .when(F.col("statistic") == "Minimum", F.col("_min"))
        .when(F.col("datapoints") > 0, F.col("datapoints").cast("double"))
    )
    breaching = F.when(F.col("comparison") == AT_LEAST, value >= F.col("threshold")).otherwise(
        value < F.col("threshold")
    )
    when_missing = (
        F.when(F.col("missing") == "breaching", ALARM)
        .when(F.col("missing") == "notBreaching", OK)
        .when(F.col("missing") == "missing", INSUFFICIENT)
    )
    # Null only under "ignore"; a partition holds one alarm's periods, not its points.
    own_state = F.when(F.col("datapoints") == 0, when_missing).when(breaching, ALARM).otherwise(OK)
    if keeps:
        # The last state of each alarm before the first period: one row per job and alarm.
        earlier = (
            observed.where((F.col("missing") == "ignore") & (F.col("_period") < first - F.pmod(first, length)))
            .groupBy("job_name", "alarm")
            .agg(F.max_by(own_state, "_period").alias("_before"))
        )
        joined = joined.join(earlier, ["job_name", "alarm"], "left")
    else:
        joined = joined.withColumn("_before", F.lit(None).cast("string"))
    history = Window.partitionBy("job_name", "alarm").orderBy("_period")
    return (
        joined.withColumn("value", value)
        .withColumn("_own", own_state)
        .withColumn(
            "state",
            F.coalesce(F.last("_own", ignorenulls=True).over(history), "_before", F.lit(INSUFFICIENT)),
        )
        .select(
            "job_name",
            "alarm",
            F.timestamp_seconds("_period").alias("period_start"),
            "datapoints",
            "value",
            "state",
        )
    )
