"""A table of how each step of each run ended, and why.

A row is written whether the step did its work, had nothing to do, or failed; a failure is raised again
behind it. Each row is a file of its own, named by run and step, so that a step that is run again under the
same run replaces its row and concurrent runs do not meet.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickbasin.functions.dates import IngestDay, fixed_clock
from clickbasin.operators.quality import QualityRules
from clickbasin.plans.curate import CurateOutcome, curate_day
from clickbasin.plans.paths import LakePaths
from clickbasin.plans.quality_run import QualityFailure, QualityOutcome, verify_day
from clickbasin.schemas import PARTITION_FIELDS
from clickbasin.session import small_frame
from clickbasin.sources.storage import exists

# Steps, how they end, and why.
CURATE, VERIFY = "raw_to_curated", "quality_checks"
DONE, NOTHING, FAILED = "done", "nothing_to_do", "failed"
NO_INPUT, NO_VALID_ROWS, NO_DATA, GATE, ERROR = "no_input", "no_valid_rows", "no_data", "constraints_failed", "error"

OUTCOME = T.StructType(
    [
        T.StructField("run", T.StringType()),
        T.StructField("step", T.StringType()),
        *PARTITION_FIELDS[1:],
        T.StructField("status", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_out", T.LongType()),
        T.StructField("rows_rejected", T.LongType()),
        T.StructField("message", T.StringType()),
        T.StructField("at", T.TimestampType()),
    ]
)


def read_outcomes(spark: SparkSession, lake: LakePaths) -> DataFrame:
    """All rows there are; none before the first run."""
    if not exists(spark, lake.outcomes):
        return small_frame(spark, [], OUTCOME)
    # Two levels of folders, a run's and a step's, that hold one file each.
    return spark.read.schema(OUTCOME).option("recursiveFileLookup", True).json(lake.outcomes)


def _record(
    spark: SparkSession, lake: LakePaths, run: str, step: str, day: IngestDay, at: datetime | str | None, ended: tuple
) -> None:
    row = small_frame(spark, [(run, step, *day, *ended)], T.StructType(OUTCOME.fields[:-1]))
    target = f"{lake.outcomes}/run={run}/{step}-{day.iso()}"
    row.withColumn("at", fixed_clock(at)).coalesce(1).write.mode("overwrite").json(target)


def _recorded(spark, lake, run, step, day, at, work: Callable[[], object], ended: Callable[[object], tuple]):
    """The result of ``work``, its row written; what it raises is written and raised again."""
    try:
        result = work()
    except QualityFailure as failure:
        _record(spark, lake, run, step, day, at, ended(failure.outcome))
        raise
    except Exception as error:  # whatever its kind, it ends the step
        _record(spark, lake, run, step, day, at, (FAILED, ERROR, None, None, None, f"{type(error).__name__}: {error}"))
        raise
    _record(spark, lake, run, step, day, at, ended(result))
    return result


def curate_recorded(
    spark: SparkSession, lake: LakePaths, day: IngestDay, run: str, *, at: datetime | str | None = None, **options
) -> CurateOutcome:
    """``curate_day`` with a row: done, no input, or no valid rows."""

    def ended(found: CurateOutcome) -> tuple:
        reason = NO_INPUT if found.raw_rows == 0 else NO_VALID_ROWS if found.raw_rows == found.quarantined_rows else None
        counts = (found.raw_rows, found.curated_rows, found.quarantined_rows)
        return (NOTHING if reason == NO_INPUT else DONE, reason, *counts, None)

    work = lambda: curate_day(spark, lake, day, processed_at=at, **options)
    return _recorded(spark, lake, run, CURATE, day, at, work, ended)


def verify_recorded(
    spark: SparkSession,
    lake: LakePaths,
    day: IngestDay,
    run: str,
    rules: QualityRules = QualityRules(),
    *,
    at: datetime | str | None = None,
    **options,
) -> QualityOutcome:
    """``verify_day`` with a row: passed, no data, or the gate's failure, which is raised if it is to stop the run."""

    def ended(found: QualityOutcome) -> tuple:
        if found.constraints_total == 0:
            return (NOTHING, NO_DATA, 0, 0, None, None)
        rows = (found.rows_verified, found.rows_verified, None)
        if found.success:
            return (DONE, None, *rows, None)
        return (FAILED, GATE, *rows, "; ".join(found.failures))

    work = lambda: verify_day(spark, lake, day, rules, verified_at=at, **options)
    return _recorded(spark, lake, run, VERIFY, day, at, work, ended)
