"""Command line of the jobs, for ``spark-submit``.

    PYTHONPATH=/path/to/repository spark-submit clickbasin/jobs.py daily --lake s3a://my-lake

Parameters are text, as a scheduler hands them over: blank means "not set".
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickbasin.functions.dates import IngestDay, ingest_day
from clickbasin.functions.params import flag, optional_number
from clickbasin.operators.alarms import DAY_SECONDS, MISSING_RULES, alarm_states, quality_alarms
from clickbasin.operators.drift import json_drift, parquet_drift
from clickbasin.operators.governance import (
    ANALYST,
    ENGINEER,
    columns_of,
    default_assignments,
    governed,
    resolve_tags,
)
from clickbasin.operators.quality import QualityRules
from clickbasin.operators.scan_budget import check_scan
from clickbasin.plans import dashboard, reports, totals
from clickbasin.plans.catalog import TABLE, create_tables, database_names, location
from clickbasin.plans.curate import curate_day
from clickbasin.plans.daily_run import FAILED, run_day
from clickbasin.plans.dashboard import refresh_dataset
from clickbasin.plans.outcomes import curate_recorded, read_outcomes, verify_recorded
from clickbasin.plans.paths import LakePaths
from clickbasin.plans.quality_run import JOB_NAME, NAMESPACE, verify_day
from clickbasin.plans.query_results import save_result
from clickbasin.plans.totals import refresh_totals
from clickbasin.schemas import CURATED, METRIC, RAW_DATA
from clickbasin.session import pin, small_frame
from clickbasin.sources import versions
from clickbasin.sources.curated import read_curated
from clickbasin.sources.raw import PARQUET, raw_format
from clickbasin.sources.storage import day_glob
from clickbasin.streaming.alarm_stream import judge_new
from clickbasin.streaming.incremental import curate_new_days, seen_files
from clickbasin.streaming.landing import Buffering, land_buffered, line_stream, start_landing

REPORTS = {
    name: getattr(reports, name)
    for name in [
        "daily_event_counts",
        "revenue_by_date",
        "top_skus_by_quantity",
        "top_search_queries",
        "daily_active_users",
        "events_by_country",
        "hourly_event_rate",
        "partition_freshness",
    ]
} | {
    name: getattr(dashboard, name)
    for name in ["kpi_total_events", "kpi_total_value", "events_by_type", "daily_event_volume"]
}

MONTHLY = "revenue_by_type_country"
# Reports over columns that analysts do not see.
NEEDS_PERSONAL = {"daily_active_users", "events_by_country", "top_search_queries"}
AUDIENCES = {"analyst": ANALYST, "engineer": ENGINEER}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="clickbasin")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, about: str, *, dated: bool = True) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=about)
        sub.add_argument("--lake", required=True, help="root folder of the lake")
        if dated:
            sub.add_argument("--process-date", default="", help="YYYY-MM-DD; blank: yesterday, UTC")
        return sub

    def quality_options(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--fail-on-error", default="true")
        sub.add_argument("--required-completeness", default="1.0")
        sub.add_argument("--min-user-id-completeness", default="0.9")
        sub.add_argument("--allowed-event-types", default="", help="comma-separated; blank: any")
        sub.add_argument("--max-quantity", default="", help="blank: no maximum")
        sub.add_argument("--metric-namespace", default=NAMESPACE)
        sub.add_argument("--metric-job-name", default=JOB_NAME)

    def run_option(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--run", default="", help="name of the run, under which its outcome is stored; blank: not stored")

    def raw_option(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--parquet", default="", help="whether raw files are Parquet; blank: the files tell")

    land = job("land", "run the landing stream", dated=False)
    land.add_argument("--source", required=True, help="folder of JSON-lines files")
    land.add_argument("--checkpoint", required=True)
    land.add_argument("--buffer-mib", type=int, default=64)
    land.add_argument("--buffer-seconds", type=int, default=60)
    land.add_argument("--buffers", default="", help="buffers a batch fills; blank: one per core at the start")
    land.add_argument("--archive", default="", help="folder that landed source files are moved to")
    land.add_argument("--parquet", default="false")
    land.add_argument("--drain", default="false", help="take what is there and stop")
    land.add_argument("--by-size", default="false", help="also flush before its time when the buffers are full")

    curate = job("curate", "recompute one curated day")
    raw_option(curate)
    run_option(curate)

    news = job("curate-new", "recompute the days that got new raw files", dated=False)
    news.add_argument("--checkpoint", required=True)
    news.add_argument("--announced", default="false", help="go by the landing's announcements, list no raw files")
    news.add_argument("--note-files", default="false", help="keep with each row its raw file and the run that saw it first")
    raw_option(news)

    verify = job("quality", "verify one curated day")
    quality_options(verify)
    run_option(verify)

    job("refresh", "bring the dashboard dataset up to date").add_argument(
        "--full", default="false", help="rebuild all days"
    )

    job("totals", "bring the totals of a day in line with curated").add_argument("--full", default="false", help="rebuild all days")

    table = job("versions", "let the days of the curated, quarantine and dashboard tables be replaced at one moment", dated=False)
    table.add_argument("--vacuum-seconds", default="", help="instead: remove versions out of use for so long")

    judge = job("judge", "judge the alarm periods that have ended since the last call", dated=False)
    judge.add_argument("--checkpoint", required=True)
    judge.add_argument("--until", required=True, help="moment, UTC")
    judge.add_argument("--since", default="", help="where the first call begins; blank: the next period")
    judge.add_argument("--missing", default="notBreaching", choices=MISSING_RULES)
    judge.add_argument("--metric-job-name", default=JOB_NAME)

    job("outcomes", "keep how the steps of all runs ended as a result", dated=False)

    daily = job("daily", "register, curate, verify and refresh one day")
    quality_options(daily)
    daily.add_argument("--refresh-dashboard", default="true")
    raw_option(daily)
    daily.add_argument("--project", default="", help="with --environment: register tables")
    daily.add_argument("--environment", default="")

    alarms = job("alarms", "keep the alarm states over the stored metrics as a result", dated=False)
    alarms.add_argument("--start", required=True, help="first moment, UTC")
    alarms.add_argument("--end", required=True, help="moment after the last, UTC")
    alarms.add_argument("--missing", default="notBreaching", choices=MISSING_RULES)
    alarms.add_argument("--staleness-seconds", default=str(DAY_SECONDS), help="blank: no such alarm")
    alarms.add_argument("--metric-job-name", default=JOB_NAME)

    job("drift", "keep how the raw files of a day deviate from what is declared as a result")

    report = job("report", "compute a saved report and keep its result", dated=False)
    report.add_argument("--name", required=True, choices=sorted([*REPORTS, MONTHLY]))
    report.add_argument("--month", default="", help=f"YYYY-MM, for {MONTHLY}")
    report.add_argument(
        "--table", default="", help="catalogued curated table, whose pruned partitions alone are listed"
    )
    report.add_argument("--from-totals", default="false", help="read the days' totals instead of events")
    report.add_argument("--audience", default="analyst", choices=sorted(AUDIENCES))
    report.add_argument("--format", default="parquet", choices=["parquet", "csv"])
    report.add_argument("--scan-cap-bytes", default="", help="refuse to scan more; blank: no cap")
    return parser


def _rules(options: argparse.Namespace) -> QualityRules:
    return QualityRules.from_text(
        options.required_completeness,
        options.min_user_id_completeness,
        options.allowed_event_types,
        options.max_quantity,
    )


def _raw_parquet(options: argparse.Namespace) -> bool | None:
    return flag(options.parquet) if options.parquet.strip() else None


def _report_from_totals(spark: SparkSession, lake: LakePaths, options: argparse.Namespace) -> str:
    if options.audience != "engineer" and options.name in NEEDS_PERSONAL:
        raise PermissionError(f"{options.name} counts users or sessions, which analysts may not see")
    if options.name == MONTHLY:
        result = totals.revenue_by_type_country(spark, lake, *options.month.split("-"))
    elif options.name == "hourly_event_rate":
        result = totals.hourly_event_rate(spark, lake, datetime.now(timezone.utc))
    else:
        result = getattr(totals, options.name)(spark, lake)
    return save_result(result, lake, options.name, options.format)


def _report(spark: SparkSession, lake: LakePaths, options: argparse.Namespace) -> str:
    if flag(options.from_totals):
        return _report_from_totals(spark, lake, options)
    curated = spark.table(options.table) if options.table else read_curated(spark, lake.curated)
    if curated is None:
        raise FileNotFoundError(lake.curated)
    names = database_names("lake", "default")
    tags = resolve_tags(
        columns_of(spark, names["curated"], TABLE, CURATED), default_assignments(spark, names, TABLE)
    )
    view = governed(curated, tags, AUDIENCES[options.audience])
    # The partitions the report's own filters leave.
    keys = dict(reports.READ_ONLY.get(options.name, {}))
    if options.name == MONTHLY:
        year, month = options.month.split("-")
        keys |= {"year": [year], "month": [month]}
        result = reports.revenue_by_type_country(view, year, month)
    else:
        result = REPORTS[options.name](view)
    cap = optional_number(options.scan_cap_bytes)
    root = location(spark, options.table) if options.table else lake.curated
    check_scan(spark, root, None if cap is None else int(cap), keys=keys)
    return save_result(result, lake, options.name, options.format)


def _alarms(spark: SparkSession, lake: LakePaths, options: argparse.Namespace) -> DataFrame:
    staleness = optional_number(options.staleness_seconds)
    return alarm_states(
        spark.read.schema(METRIC).parquet(lake.metrics),
        quality_alarms(options.missing, None if staleness is None else int(staleness)),
        options.start,
        options.end,
        [options.metric_job_name],
    ).orderBy("alarm", "period_start")


def _drift(spark: SparkSession, lake: LakePaths, day: IngestDay) -> DataFrame:
    """Drift of a day's keys, or of its files' columns where they are Parquet; no rows for a day without files."""
    found = raw_format(spark, lake.raw, day)
    if found == PARQUET:
        return parquet_drift(spark, lake.raw, day, RAW_DATA).orderBy("column", "found_type")
    declared = T.StructType([T.StructField("event_type", T.StringType()), *RAW_DATA.fields])
    if found is None:
        return json_drift(small_frame(spark, [], "value string"), declared).where(F.lit(False))
    lines = spark.read.text(day_glob(lake.raw, day)).select("value")
    return json_drift(lines, declared).orderBy("column", "json_type")


def _keep(result: DataFrame, lake: LakePaths, name: str) -> None:
    """The whole result is stored; of it the first rows are shown."""
    path = save_result(result, lake, name)
    print(path)
    result.sparkSession.read.parquet(path).show(truncate=False)


def main(arguments: Sequence[str] | None = None) -> int:
    options = _parser().parse_args(arguments)
    spark = pin(SparkSession.builder.appName(f"clickbasin-{options.job}").getOrCreate())
    lake = LakePaths(options.lake)

    if options.job == "versions":
        for root in (lake.curated, lake.quarantine, lake.dataset):
            if options.vacuum_seconds.strip():
                print(root, versions.vacuum(spark, root, float(options.vacuum_seconds)))
            else:
                versions.start(spark, root)
        return 0
    if options.job == "judge":
        alarms, since = quality_alarms(options.missing), options.since or None
        judge_new(
            spark, lake, alarms, [options.metric_job_name], options.checkpoint, options.until, since
        ).awaitTermination()
        return 0
    if options.job == "outcomes":
        _keep(read_outcomes(spark, lake).orderBy("at", "run", "step"), lake, "outcomes")
        return 0
    if options.job == "land":
        buffering = Buffering(options.buffer_mib, options.buffer_seconds)
        if flag(options.by_size):
            end = iter([True])
            land_buffered(
                spark,
                options.source,
                lake,
                options.checkpoint,
                buffering=buffering,
                buffers=int(options.buffers) if options.buffers else None,
                archive=options.archive or None,
                parquet=flag(options.parquet),
                go_on=lambda: next(end, False) if flag(options.drain) else True,
            )
            return 0
        start_landing(
            line_stream(
                spark,
                options.source,
                buffering,
                int(options.buffers) if options.buffers else None,
                options.archive or None,
            ),
            lake,
            options.checkpoint,
            buffering=buffering,
            parquet=flag(options.parquet),
            drain=flag(options.drain),
        ).awaitTermination()
        return 0
    if options.job == "curate-new":

        note = flag(options.note_files)

        def curate(day: IngestDay) -> None:
            files = seen_files(spark, lake, day) if note else None
            print(day.iso(), curate_day(spark, lake, day, parquet=_raw_parquet(options), files=files))

        curate_new_days(
            spark, lake, options.checkpoint, curate, announced=flag(options.announced), note_files=note
        ).awaitTermination()
        return 0
    if options.job == "report":
        print(_report(spark, lake, options))
        return 0
    if options.job == "alarms":
        _keep(_alarms(spark, lake, options), lake, "alarms")
        return 0

    day = ingest_day(options.process_date)
    if options.job == "drift":
        _keep(_drift(spark, lake, day), lake, f"drift-{day.iso()}")
        return 0
    if options.job == "curate":
        parquet = _raw_parquet(options)
        if options.run:
            print(day.iso(), curate_recorded(spark, lake, day, options.run, parquet=parquet))
        else:
            print(day.iso(), curate_day(spark, lake, day, parquet=parquet))
        return 0
    if options.job == "totals":
        refresh_totals(spark, lake, None if flag(options.full) else day)
        return 0
    if options.job == "refresh":
        refresh_dataset(spark, lake.curated, lake.dataset, None if flag(options.full) else day)
        return 0
    if options.job == "quality":
        names = dict(namespace=options.metric_namespace, job_name=options.metric_job_name)
        stop = flag(options.fail_on_error)
        if options.run:
            outcome = verify_recorded(spark, lake, day, options.run, _rules(options), fail_on_error=stop, **names)
        else:
            outcome = verify_day(spark, lake, day, _rules(options), fail_on_error=stop, **names)
        print(day.iso(), outcome)
        return 0

    databases = None
    if options.project and options.environment:
        databases = database_names(options.project, options.environment)
        create_tables(spark, databases, lake, parquet=bool(_raw_parquet(options)))
    status: DataFrame = run_day(
        spark,
        lake,
        day,
        databases=databases,
        rules=_rules(options),
        namespace=options.metric_namespace,
        job_name=options.metric_job_name,
        fail_on_error=flag(options.fail_on_error),
        refresh_dashboard=flag(options.refresh_dashboard),
        parquet=_raw_parquet(options),
    )
    status.orderBy("position").show(truncate=False)
    return int(not status.where(F.col("status") == FAILED).isEmpty())


if __name__ == "__main__":
    sys.exit(main())
