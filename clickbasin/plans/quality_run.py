"""The daily quality job over one curated day."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from clickbasin.functions.dates import IngestDay, fixed_clock
from clickbasin.operators.quality import (
    ERROR,
    SUCCESS,
    QualityRules,
    constraint_results,
    measure,
    metrics,
    summary,
)
from clickbasin.plans.paths import LakePaths
from clickbasin.schemas import RESULT
from clickbasin.session import pin, small_frame
from clickbasin.sources.curated import read_curated_day

# Where the metrics are filed unless told otherwise.
NAMESPACE = "DataQuality"
JOB_NAME = "curated-events-quality"


@dataclass(frozen=True)
class QualityOutcome:
    constraints_failed: int
    constraints_total: int
    rows_verified: int
    failures: tuple[str, ...] = ()

    @property
    def success(self) -> bool:
        return self.constraints_failed == 0


class QualityFailure(RuntimeError):
    """Error-level constraints failed. Raised after everything is stored."""

    def __init__(self, message: str, outcome: QualityOutcome):
        super().__init__(message)
        self.outcome = outcome


def write_results(results: DataFrame, root: str, day: IngestDay) -> None:
    """At most ten rows, in one JSON file that replaces the day's earlier one."""
    results.coalesce(1).write.mode("overwrite").json(f"{root}/{day.folder()}")


def append_metrics(points: DataFrame, root: str) -> None:
    points.coalesce(1).write.mode("append").parquet(root)


def verify_day(
    spark: SparkSession,
    lake: LakePaths,
    day: IngestDay,
    rules: QualityRules = QualityRules(),
    *,
    namespace: str = NAMESPACE,
    job_name: str = JOB_NAME,
    verified_at: datetime | str | None = None,
    fail_on_error: bool = True,
) -> QualityOutcome:
    """Verify a day, store results and metrics, then raise if errors are to stop the run.

    A missing table or an empty day is a success with zero rows: it files the
    metrics but no results.
    """
    pin(spark)
    stamp = fixed_clock(verified_at)
    partition = read_curated_day(spark, lake.curated, day)
    # Eight to ten rows, judged on the executors.
    found = [] if partition is None else constraint_results(measure(partition, rules), rules).collect()
    if found and found[0]["rows_verified"] == 0:
        found = []
    unstamped = RESULT[:-1]
    results = small_frame(spark, [tuple(row[name] for name in unstamped.names) for row in found], unstamped)
    if found:
        write_results(results.withColumn("verified_at", stamp), lake.quality_results, day)
    verdict = summary(results)
    append_metrics(metrics(verdict, namespace, job_name, stamp), lake.metrics)
    row = verdict.first()
    outcome = QualityOutcome(
        row["constraints_failed"],
        row["constraints_total"],
        row["rows_verified"],
        tuple(
            f"{r['constraint']}: {r['constraint_message']}"
            for r in found
            if r["check_level"] == ERROR and r["constraint_status"] != SUCCESS
        ),
    )
    if fail_on_error and not outcome.success:
        raise QualityFailure(
            f"{outcome.constraints_failed} error-level constraint(s) failed: " + "; ".join(outcome.failures), outcome
        )
    return outcome
