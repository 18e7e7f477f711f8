"""Alarm states as metrics arrive, each period judged once.

A run takes the metric files that came since the last one and judges the periods that have ended. What it has to
know of the past, the last state of each alarm and job and points of periods still open, is in the stream's
state store: earlier metrics are not read again, however long an alarm keeps its state.

Every run adds a small file that says until when to judge. It is a second source of the same stream, so that
alarms are judged also where no metric came, and a run that is repeated judges the same periods.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from clickbasin.functions.dates import clock
from clickbasin.operators.alarms import ALARM, AT_LEAST, INSUFFICIENT, OK, Alarm, definitions
from clickbasin.plans.paths import LakePaths
from clickbasin.schemas import METRIC
from clickbasin.session import pin, small_frame
from clickbasin.sources.storage import exists
from clickbasin.streaming.landing import NO_AGE_LIMIT

_CALLS = T.StructType([T.StructField("job_name", T.StringType()), T.StructField("since", T.LongType()), T.StructField("until", T.LongType())])
_FOUND = "job_name string, alarm string, period bigint, datapoints bigint, value double, state string"
_HISTORY = "job_name string, alarm string, period_start timestamp, datapoints bigint, value double, state string"
# Its state store is the one that keeps several kinds of state for a key.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _judge(alarms: Sequence[Alarm]) -> StatefulProcessor:
    """The processor of one alarm and job. Closed over plain values only: executors need not have this package."""
    kept = {a.name: (a.statistic, a.comparison == AT_LEAST, a.threshold, a.period_seconds, a.missing) for a in alarms}
    alarm_state, ok_state, unknown = ALARM, OK, INSUFFICIENT

    class Judge(StatefulProcessor):
        def init(self, handle) -> None:
            # The next period to judge, the state before it, and sums of the periods not judged yet.
            self.past = handle.getValueState("past", "next bigint, state string")
            self.open = handle.getMapState("open", "period bigint", "n bigint, total double, least double")

        def close(self) -> None:
            pass

        def handleInputRows(self, key, rows, timerValues) -> Iterator:
            import pandas as pd

            job, alarm = key
            statistic, at_least, threshold, length, missing = kept[alarm]
            past = self.past.get() if self.past.exists() else None
            first, state = past if past else (None, None)
            sums: dict[int, list] = {}
            since, until = None, None
            for part in rows:
                for start, stop in part.loc[part["until"].notna(), ["since", "until"]].itertuples(index=False):
                    since = start if since is None or pd.isna(since) else since
                    until = int(stop) if until is None else max(until, int(stop))
                points = part[part["value"].notna()]
                for period, own in points.groupby(points["at"] // length * length)["value"]:
                    total = sums.setdefault(int(period), [0, 0.0, float("inf")])
                    total[0] += len(own)
                    total[1] += float(own.sum())
                    total[2] = min(total[2], float(own.min()))
            # Points of a period that has been judged come too late.
            for period, (n, total, least) in sums.items():
                if first is None or period >= first:
                    if self.open.containsKey((period,)):
                        m, more, lowest = self.open.getValue((period,))
                        n, total, least = n + m, total + more, min(least, lowest)
                    self.open.updateValue((period,), (n, total, least))
            if until is None:
                return
            # Before the first period that is asked for, points only tell the state.
            begin = first
            if begin is None:
                begin = until // length * length if since is None or pd.isna(since) else int(since) // length * length
            waiting = {period: sums for (period,), sums in self.open.iterator()}
            spine = range(begin, until - length + 1, length)
            out = []
            for period in sorted({p for p in waiting if p + length <= until} | set(spine)):
                n, total, least = waiting.get(period, (0, None, None))
                value = {"Sum": total, "Minimum": least}.get(statistic, float(n) if n else None)
                if n:
                    breaching = value >= threshold if at_least else value < threshold
                    state = alarm_state if breaching else ok_state
                    self.open.removeKey((period,))
                elif missing != "ignore":
                    state = {"breaching": alarm_state, "notBreaching": ok_state, "missing": unknown}[missing]
                if period >= begin:
                    out.append((job, alarm, period, n, value, state or unknown))
            self.past.update((begin + len(spine) * length, state))
            yield pd.DataFrame(out, columns=["job_name", "alarm", "period", "datapoints", "value", "state"])

    return Judge()


def judge_new(
    spark: SparkSession,
    lake: LakePaths,
    alarms: Sequence[Alarm],
    jobs: Sequence[str],
    checkpoint: str,
    until: datetime | str,
    since: datetime | str | None = None,
    partitions: int = 8,
) -> StreamingQuery:
    """Judge the periods that have ended by ``until`` and append them to ``lake.alarm_history``.

    The first run of an alarm and job begins with the period of ``since``, by default with the next one to end;
    earlier points only tell the state before. Later runs go on where the last one stopped. Jobs that
    are not named are left out; so are points for a period that has been judged. One run at a time. The query
    uses ``STATE_STORE`` in ``partitions`` parts, for there is a key for each alarm and job only; the first run settles
    how many. The session's other streams keep their settings.
    """
    pin(spark)
    seconds = lambda moment: F.unix_timestamp(clock(moment))
    calls = small_frame(spark, [(job,) for job in jobs], "job_name string")
    start = F.lit(None).cast("long") if since is None else seconds(since)
    calls = calls.select("job_name", start.alias("since"), seconds(until).alias("until"))
    calls.coalesce(1).write.mode("append").json(lake.alarm_calls)
    if not exists(spark, lake.metrics):
        small_frame(spark, [], METRIC).write.parquet(lake.metrics)

    def source(schema: T.StructType):
        return spark.readStream.schema(schema).option("maxFileAge", NO_AGE_LIMIT)

    own = definitions(alarms)
    named = F.col("job_name").isin(list(jobs))
    # Every point meets the alarms on its metric, every call all of them.
    points = (
        source(METRIC)
        .parquet(lake.metrics)
        .where(named)
        .select(
            "job_name",
            "value",
            F.unix_timestamp("ts").alias("at"),
            F.explode(F.filter(own, lambda d: d["alarm_metric"] == F.col("metric"))).alias("d"),
        )
        .select("job_name", "d.alarm", "at", "value", *[F.lit(None).cast("long").alias(name) for name in ("since", "until")])
    )
    asked = (
        source(_CALLS)
        .json(lake.alarm_calls)
        .select("job_name", F.explode(own).alias("d"), "since", "until")
        .select("job_name", "d.alarm", F.lit(None).cast("long").alias("at"), F.lit(None).cast("double").alias("value"), "since", "until")
    )
    found = points.unionByName(asked).groupBy("job_name", "alarm").transformWithStateInPandas(
        _judge(alarms), T.StructType.fromDDL(_FOUND), "Append", "None"
    )
    rows = found.select("job_name", "alarm", F.timestamp_seconds("period").alias("period_start"), "datapoints", "value", "state")

    def store(batch: DataFrame, batch_id: int) -> None:
        # A folder a batch: one that is run again replaces what it wrote.
        batch.write.mode("overwrite").parquet(f"{lake.alarm_history}/batch={batch_id}")

    wanted = {"spark.sql.streaming.stateStore.providerClass": STATE_STORE, "spark.sql.shuffle.partitions": str(partitions)}
    before = {name: spark.conf.get(name) for name in wanted}
    # A stream takes the settings along with which it is started.
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        return (
            rows.writeStream.outputMode("append")
            .foreachBatch(store)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def read_history(spark: SparkSession, lake: LakePaths) -> DataFrame:
    """All periods that were judged, each once."""
    return spark.read.schema(_HISTORY).option("recursiveFileLookup", True).parquet(lake.alarm_history)
