"""The whole day in order: register, curate, verify, refresh the dashboard."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from clickbasin.functions.dates import IngestDay
from clickbasin.operators.quality import QualityRules
from clickbasin.plans.catalog import TABLE, register_day
from clickbasin.plans.curate import curate_day
from clickbasin.plans.dashboard import refresh_dataset
from clickbasin.plans.paths import LakePaths
from clickbasin.plans.quality_run import JOB_NAME, NAMESPACE, verify_day
from clickbasin.session import small_frame

SUCCEEDED = "SUCCEEDED"
FAILED = "FAILED"
NOT_RUN = "NOT_RUN"

_STATUS = "position int, step string, status string, rows bigint, message string"


def run_day(
    spark: SparkSession,
    lake: LakePaths,
    day: IngestDay,
    *,
    databases: dict[str, str] | None = None,
    rules: QualityRules = QualityRules(),
    namespace: str = NAMESPACE,
    job_name: str = JOB_NAME,
    fail_on_error: bool = True,
    refresh_dashboard: bool = True,
    processed_at: datetime | str | None = None,
    parquet: bool | None = None,
) -> DataFrame:
    """Run the steps and report ``position, step, status, rows, message``.

    The first failing step ends the run; later ones are ``NOT_RUN``. With
    ``databases`` the day's raw and curated partitions are registered too; without,
    that step is ``NOT_RUN`` as well. ``parquet`` is as in ``read_raw_day``: by default
    the files tell.
    ``rows``: partitions registered, rows curated, rows verified.
    """

    def register() -> int:
        return register_day(spark, f"{databases['raw']}.{TABLE}", lake.raw, day)

    def curate() -> int:
        outcome = curate_day(spark, lake, day, processed_at=processed_at, parquet=parquet)
        if databases:
            register_day(spark, f"{databases['curated']}.{TABLE}", lake.curated, day)
        return outcome.curated_rows

    def verify() -> int:
        outcome = verify_day(
            spark,
            lake,
            day,
            rules,
            namespace=namespace,
            job_name=job_name,
            verified_at=processed_at,
            fail_on_error=fail_on_error,
        )
        return outcome.rows_verified

    def refresh() -> None:
        refresh_dataset(spark, lake.curated, lake.dataset, day)

    steps: list[tuple[str, Callable[[], int | None]]] = [
        ("register_partitions", register),
        ("raw_to_curated", curate),
        ("quality_checks", verify),
    ]
    if refresh_dashboard:
        steps.append(("refresh_dashboard", refresh))

    report = []
    failed = False
    for position, (name, step) in enumerate(steps, start=1):
        if failed or step is register and not databases:
            report.append((position, name, NOT_RUN, None, None))
            continue
        try:
            report.append((position, name, SUCCEEDED, step(), None))
        except Exception as error:  # any failure ends the run, whatever its kind
            failed = True
            report.append((position, name, FAILED, None, f"{type(error).__name__}: {error}"))
    return small_frame(spark, report, _STATUS)
