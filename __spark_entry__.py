"""Contract with the driver: the registered queries and their SQL counterparts.

Every query takes ``(spark, sf_dir)`` and works on the whole ``events`` table,
brought into raw, curated or JSON-lines form by ``given_events``.
The SQL builds the same form by itself and states the expected result without
repeating the library's steps where it can (a landed line is predicted from the
fault it was given, not by parsing it).
"""

from __future__ import annotations

import importlib.util
import re
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import given_events as given
from clickbasin.functions.dates import IngestDay, ingest_day
from clickbasin.operators import quality, quality_parts
from clickbasin.operators.alarms import alarm_states, quality_alarms
from clickbasin.operators.dedup import latest_per_event
from clickbasin.operators.drift import json_drift, parquet_drift
from clickbasin.operators.governance import (
    ANALYST,
    ENGINEER,
    Grant,
    columns_of,
    default_assignments,
    governed,
    resolve_tags,
)
from clickbasin.operators.scan_budget import scan_bytes, scan_partitions
from clickbasin.operators.validate import accepted, rejected, with_verdict
from clickbasin.plans import curate, dashboard, outcomes, reports, totals
from clickbasin.plans.catalog import TABLE, create_tables, database_names, partitions, register_day, register_days
from clickbasin.plans.daily_run import run_day
from clickbasin.plans.paths import LakePaths
from clickbasin.plans.quality_run import JOB_NAME, NAMESPACE
from clickbasin.plans.query_results import save_result
from clickbasin.schemas import CURATED, CURATED_DATA, DATE_KEYS, PARTITION_KEYS, RAW_DATA, REASON_COLUMN, RESULT
from clickbasin.session import pin, scratch_path, small_frame
from clickbasin.sources import versions
from clickbasin.sources.curated import read_curated, read_curated_day, read_lineage
from clickbasin.sources.raw import read_raw_day, scan_raw_day
from clickbasin.sources.storage import ALL_DAYS, glob
from clickbasin.streaming.alarm_stream import judge_new, read_history
from clickbasin.streaming.incremental import curate_new_days, seen_files
from clickbasin.streaming.landing import (
    NOT_CONVERTED,
    Buffering,
    delivered,
    land_buffered,
    read_batches,
    undeliverable,
    with_route,
)

SMOKE_DIR = "/root/testdata/sf0.001"
AS_OF = "2024-01-31 00:00:00"
ONE_DAY = ingest_day("2024-01-15")
STRICT = quality.QualityRules(
    required_completeness=1.0,
    min_user_id_completeness=0.94,
    allowed_event_types=("page_view", "add_to_cart", "purchase", "search"),
    max_quantity=25.0,
)
RELAXED = quality.QualityRules(required_completeness=0.999)
# After the first points, and where the incremental run's second drop begins.
LATE_START = "2024-01-20 00:00:00"
SECOND_DROP = "2024-01-21 00:00:00"
# The smallest buffer there is.
FLUSH_BUFFER = Buffering(mebibytes=1)
ALARM_START, ALARM_END = "2023-12-29 00:00:00", "2024-02-04 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Raw events, validated, flattened and de-duplicated, then purchases per day."""
    raw = given.raw_shape(spark, SMOKE_DIR)
    return reports.revenue_by_date(curate.to_curated(raw, F.lit(given.PROCESSED_AT).cast("timestamp")))


def _processed_at():
    return F.lit(given.PROCESSED_AT).cast("timestamp")


def _flat_payload(rows: DataFrame) -> DataFrame:
    """Payload fields as columns of their own, for comparison with SQL."""
    fields = ["country", "session_id", "value", "query", "sku", "quantity"]
    others = [name for name in rows.columns if name != "payload"]
    return rows.select(*others, *[F.col(f"payload.{name}").alias(name) for name in fields])


def _shown(rows: DataFrame) -> DataFrame:
    """``quantity`` as double: engines hand nullable integers over in different ways."""
    return rows.withColumn("quantity", F.col("quantity").cast("double"))


def _curated(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(given.curated_shape(spark, sf_dir))


def _raw(query: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(given.raw_shape(spark, sf_dir))


def _revenue_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = reports.revenue_by_date(given.curated_shape(spark, sf_dir))
    return result.withColumn("avg_order_value", F.round("avg_order_value", 4))


# Scans -----------------------------------------------------------------------


def _raw_day_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_raw_day(pin(spark), given.raw_table(spark, sf_dir), ONE_DAY)
    return _shown(_flat_payload(rows)).drop("_malformed_line")


def _curated_day_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(read_curated_day(pin(spark), given.curated_lake(spark, sf_dir).curated, ONE_DAY))


def _raw_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = given.landed_lake(pin(spark), sf_dir)
    return _shown(_flat_payload(read_raw_day(spark, lake.raw, given.ARRIVAL))).drop("_malformed_line")


# Landing ---------------------------------------------------------------------


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_route(given.event_lines(spark, sf_dir), F.lit(given.ARRIVAL_TS).cast("timestamp"))


def _landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pin(spark).read.text(given.landed_lake(spark, sf_dir).raw)


def _landed_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pin(spark).read.text(given.landed_lake(spark, sf_dir).errors)


def _conversion_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = given.landed_lake(pin(spark), sf_dir, parquet=True)
    return spark.read.text(lake.errors).where(F.col("result") == NOT_CONVERTED)


def _ingest_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = given.landed_lake(pin(spark), sf_dir, parquet=True)
    rows = read_raw_day(spark, lake.raw, given.ARRIVAL)
    return _shown(_flat_payload(rows)).drop("_malformed_line")


# Validation and de-duplication -----------------------------------------------


def _dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = accepted(with_verdict(given.raw_shape(spark, sf_dir)), _processed_at())
    return latest_per_event(good, within=DATE_KEYS).select("event_id", "event_ts", *PARTITION_KEYS)


# Quality and alarms ----------------------------------------------------------


def _results(spark: SparkSession, sf_dir: str, rules: quality.QualityRules = STRICT) -> DataFrame:
    measures = quality.measure(given.curated_faulty(spark, sf_dir), rules, DATE_KEYS)
    return quality.constraint_results(measures, rules, DATE_KEYS)


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of a daily run at three in the morning after each day."""
    rules = quality.QualityRules(max_quantity=25.0)
    summaries = quality.summary(_results(spark, sf_dir, rules), DATE_KEYS)
    at = F.expr("to_timestamp(concat(year, '-', month, '-', day)) + INTERVAL '27' HOUR")
    return quality.metrics(summaries, NAMESPACE, JOB_NAME, at)


def _alarms(missing: str, start: str = ALARM_START) -> Query:
    return lambda spark, sf_dir: alarm_states(
        _metrics(spark, sf_dir), quality_alarms(missing), start, ALARM_END, [JOB_NAME]
    )


# Governance and catalog ------------------------------------------------------


def _governed(data: DataFrame, grant: Grant) -> DataFrame:
    spark = data.sparkSession
    names = database_names("clickbasin", "dev")
    resolved = resolve_tags(
        columns_of(spark, names["curated"], "events", CURATED), default_assignments(spark, names)
    )
    return governed(data, resolved, grant)


def _schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    declared = T.StructType([T.StructField("event_type", T.StringType()), *RAW_DATA.fields])
    return json_drift(given.event_lines(spark, sf_dir), declared)


def _kept(frame: DataFrame, label: str) -> DataFrame:
    """The rows in a scratch table, so that what they were read from can be dropped."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def _databases(spark: SparkSession, lake: LakePaths, *, parquet: bool = False) -> Iterator[dict[str, str]]:
    """The lake's catalogued tables, dropped again at the end; their data stays."""
    names = database_names("clickbasin-" + uuid.uuid4().hex, "dev")
    create_tables(spark, names, lake, parquet=parquet)
    try:
        yield names
    finally:
        for database in names.values():
            spark.sql(f"DROP DATABASE {database} CASCADE")


def _registered_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = given.curated_lake(pin(spark), sf_dir)
    days = {re.search(r"year=(\d+)/month=(\d+)/day=(\d+)", path) for path in glob(spark, f"{lake.curated}/{ALL_DAYS}")}
    with _databases(spark, lake) as names:
        table = f"{names['curated']}.{TABLE}"
        register_days(spark, table, lake.curated, sorted({IngestDay(*found.groups()) for found in days}))
        return _kept(partitions(spark, table), "partitions")


def _scan_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_bytes(pin(spark), given.curated_lake(spark, sf_dir).curated)


def _scan_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = {"event_type": reports.SALES_TYPES, "year": ["2024"], "month": ["01"]}
    return scan_partitions(pin(spark), given.curated_lake(spark, sf_dir).curated, keys)


def _raw_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = given.landed_lake(pin(spark), sf_dir)
    with _databases(spark, lake) as names:
        table = f"{names['raw']}.{TABLE}"
        register_day(spark, table, lake.raw, given.ARRIVAL)
        rows = scan_raw_day(spark.table(table), given.ARRIVAL)
        return _kept(_shown(_flat_payload(rows)).drop("_malformed_line"), "raw-table")


def _daily_run(parquet: bool) -> Query:
    """All lines arrived on one day, so the run of that day covers the whole table."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = given.landed_lake(pin(spark), sf_dir, parquet=parquet)
        with _databases(spark, lake, parquet=parquet) as names:
            report = run_day(spark, lake, given.ARRIVAL, databases=names, processed_at=given.PROCESSED_AT)
        return report.select("position", "step", "status", F.coalesce("rows", F.lit(0)).alias("rows"))

    return run


# What the jobs store --------------------------------------------------------


def _stored_lake(spark: SparkSession, sf_dir: str) -> LakePaths:
    return given.processed_lake(pin(spark), sf_dir, STRICT)


def _stored_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(read_curated(spark, _stored_lake(spark, sf_dir).curated))


def _stored_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(spark.read.parquet(_stored_lake(spark, sf_dir).dataset))


def _stored_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = rejected(with_verdict(given.raw_shape(spark, sf_dir))).schema
    rows = spark.read.schema(schema).json(_stored_lake(spark, sf_dir).quarantine)
    return _shown(_flat_payload(rows)).withColumnRenamed(REASON_COLUMN, "reject_reason")


def _stored_quality_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{_stored_lake(spark, sf_dir).quality_results}/{given.ARRIVAL.folder()}"
    return spark.read.schema(RESULT).json(folder).drop("verified_at")


def _report_through_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = _stored_lake(spark, sf_dir)
    with _databases(spark, lake) as names:
        table = f"{names['curated']}.{TABLE}"
        register_day(spark, table, lake.curated, given.ARRIVAL)
        return _kept(reports.daily_event_counts(spark.table(table)), "report")


def _incremental_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated rows after two drops, with the run that first saw the file each row came from."""
    lake = LakePaths(scratch_path(pin(spark), "lineage"))

    def curate_one(day: IngestDay) -> None:
        curate.curate_day(spark, lake, day, processed_at=given.PROCESSED_AT, files=seen_files(spark, lake, day))

    for rows in given.folded_drops(spark, sf_dir, SECOND_DROP):
        rows.write.mode("append").partitionBy(*PARTITION_KEYS).json(lake.raw)
        curate_new_days(spark, lake, f"{lake.root}/bookmark", curate_one, note_files=True).awaitTermination()
    found = read_lineage(spark, lake.curated)
    return _shown(found.withColumn("has_file", F.col("source_file").contains("event_type=")).drop("source_file"))


def _incremental_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The days that two runs find news on: files before a moment first, later ones and a few old days then."""
    lake = LakePaths(scratch_path(pin(spark), "incremental"))
    found: list[tuple] = []
    for run, rows in enumerate(given.two_drops(spark, sf_dir, SECOND_DROP), start=1):
        rows.write.mode("append").partitionBy(*PARTITION_KEYS).json(lake.raw)
        curate_new_days(
            spark, lake, f"{lake.root}/bookmark", lambda day, run=run: found.append((run, *day))
        ).awaitTermination()
    return small_frame(spark, found, "run int, year string, month string, day string")


# Totals, outcomes, alarms as metrics come -------------------------------------


def _totals(query: Callable[..., DataFrame], *options) -> Query:
    return lambda spark, sf_dir: query(spark, given.summarised_lake(pin(spark), sf_dir, ONE_DAY), *options)


def _totals_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = totals.revenue_by_date(spark, given.summarised_lake(pin(spark), sf_dir, ONE_DAY))
    return found.withColumn("avg_order_value", F.round("avg_order_value", 4))


def _outcomes(step: str, *days: IngestDay) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = outcomes.read_outcomes(spark, given.outcome_lake(pin(spark), sf_dir))
        return rows.where((F.col("step") == step) & F.col("day").isin([day.day for day in days])).drop("at")

    return query


def _parquet_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parquet_drift(spark, given.drifted_files(pin(spark), sf_dir), None, CURATED_DATA)


def _incremental_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The constraints after two drops, the second of which shares days and ids with the first."""
    root, events = scratch_path(pin(spark), "quality"), given.curated_faulty(spark, sf_dir)
    first = F.crc32(F.concat_ws("-", "session_id", "event_ts")) % 3 > 0
    for drop, part in enumerate((events.where(first), events.where(~first))):
        quality_parts.add_drop(part, root, drop, STRICT, buckets=4)
    return quality.constraint_results(quality_parts.measures(spark, root), STRICT, DATE_KEYS)


def _versioned_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose days were replaced after a first, partial write, and once more by a run that stopped half way."""
    root, rows = scratch_path(pin(spark), "versions"), given.curated_shape(spark, sf_dir)
    versions.start(spark, root)
    days = sorted(IngestDay(*row) for row in rows.select(*DATE_KEYS).distinct().collect())
    odd = F.col("event_id").cast("long") % 2 == 1
    versions.replace_days(spark, root, days, lambda path: curate.write_curated(rows.where(odd), path))
    versions.replace_days(spark, root, days, lambda path: curate.write_curated(rows, path))

    def stops(path: str) -> None:
        curate.write_curated(rows.where(~odd), path)
        raise InterruptedError

    with suppress(InterruptedError):
        versions.replace_days(spark, root, days, stops)
    return _shown(read_curated(spark, root))


def _landing_flushes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and bytes by what made their batch due, on a clock that goes half a minute a look.

    The first part is there from the start; each other one comes when the last has been landed.
    """
    lake = LakePaths(scratch_path(pin(spark), "flushes"))
    parts, looks, incoming = given.arriving_lines(spark, sf_dir), [0], f"{lake.root}/incoming"

    def look(_: float) -> None:
        if looks[0] % 3 == 0 and looks[0] // 3 + 1 < len(parts):
            parts[looks[0] // 3 + 1].write.mode("append").text(incoming)
        looks[0] += 1

    parts[0].write.text(incoming)
    land_buffered(
        spark, incoming, lake, f"{lake.root}/landing", buffering=FLUSH_BUFFER, buffers=1,
        arrival=F.lit(given.ARRIVAL_TS).cast("timestamp"), go_on=lambda: looks[0] < 3 * len(parts),
        clock=lambda: 30.0 * looks[0], sleep=look,
    )
    return read_batches(spark, lake).groupBy("cause").agg(F.sum("lines").alias("lines"), F.sum("bytes").alias("bytes"))


def _saved(how: str) -> Query:
    """A report that was stored and is read again."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = reports.events_by_country(given.curated_shape(spark, sf_dir))
        path = save_result(result, LakePaths(scratch_path(spark, "results")), "events_by_country", how)
        reader = spark.read.schema(result.schema)
        return reader.parquet(path) if how == "parquet" else reader.option("header", True).csv(path)

    return query


def _exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows behind a visual, as a file to take away."""
    result, path = dashboard.daily_event_volume(given.curated_shape(spark, sf_dir)), scratch_path(spark, "export")
    dashboard.export_csv(result, path)
    return spark.read.schema(result.schema).option("header", True).csv(path)


def _alarm_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alarms judged in two runs, of which the second gets the points since the first only."""
    lake = LakePaths(scratch_path(pin(spark), "alarms"))
    points, before = _kept(_metrics(spark, sf_dir), "metrics"), F.col("ts") < F.lit(LATE_START).cast("timestamp")
    for part, until in ((points.where(before), LATE_START), (points.where(~before), ALARM_END)):
        part.write.mode("append").parquet(lake.metrics)
        judge_new(
            spark, lake, quality_alarms("ignore"), [JOB_NAME], f"{lake.root}/judging", until, ALARM_START
        ).awaitTermination()
    return read_history(spark, lake).where(F.col("period_start") >= F.lit(LATE_START).cast("timestamp"))


def _training_data():
    """The queries for training data, where that part of the library and its pipeline are present."""
    if not importlib.util.find_spec("clickbasin.llm") or not importlib.util.find_spec("clickbasin.llm.entries"):
        return None
    from clickbasin.llm import entries

    return entries


def queries() -> dict[str, Query]:
    found = core_queries()
    if more := _training_data():
        found |= more.queries()
        if importlib.util.find_spec("corpus_pipeline") is not None:
            import corpus_pipeline

            found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    return core_oracle_sql() | (more.oracle_sql() if (more := _training_data()) else {})


def core_queries() -> dict[str, Query]:
    return {
        "raw_day_scan": _raw_day_scan,
        "raw_decode": _raw_decode,
        "curated_day_scan": _curated_day_scan,
        "ingest_route": lambda spark, sf_dir: delivered(_routed(spark, sf_dir)),
        "ingest_errors": lambda spark, sf_dir: undeliverable(_routed(spark, sf_dir)),
        "ingest_landed": _landed_lines,
        "ingest_landed_errors": _landed_errors,
        "ingest_parquet": _ingest_parquet,
        "raw_to_curated": _raw(lambda raw: _shown(curate.to_curated(raw, _processed_at()))),
        "quarantine_rows": _raw(
            lambda raw: _shown(_flat_payload(rejected(with_verdict(raw)))).withColumnRenamed(
                REASON_COLUMN, "reject_reason"
            )
        ),
        "quarantine_reason_counts": _raw(curate.quarantine_reason_counts),
        "etl_row_counts": _raw(curate.row_counts),
        "dedup_latest": _dedup_latest,
        "daily_event_counts": _curated(reports.daily_event_counts),
        "revenue_by_date": _revenue_by_date,
        "top_skus_by_quantity": _curated(reports.top_skus_by_quantity),
        "top_search_queries": _curated(reports.top_search_queries),
        "daily_active_users": _curated(reports.daily_active_users),
        "events_by_country": _curated(reports.events_by_country),
        "hourly_event_rate": _curated(lambda curated: reports.hourly_event_rate(curated, AS_OF)),
        "partition_freshness": _curated(reports.partition_freshness),
        "revenue_by_type_country": _curated(
            lambda curated: reports.revenue_by_type_country(_governed(curated, ANALYST), "2024", "01")
        ),
        "bi_dataset": _curated(lambda curated: _shown(dashboard.bi_dataset(curated))),
        "kpi_total_events": _curated(dashboard.kpi_total_events),
        "kpi_total_value": _curated(dashboard.kpi_total_value),
        "events_by_type_topn": _curated(lambda curated: dashboard.events_by_type(curated, 3)),
        "daily_event_volume": _curated(dashboard.daily_event_volume),
        "dq_constraints": _results,
        "dq_constraints_relaxed": lambda spark, sf_dir: _results(spark, sf_dir, RELAXED),
        "dq_summary": lambda spark, sf_dir: quality.summary(_results(spark, sf_dir), DATE_KEYS),
        "dq_metrics": _metrics,
        "alarm_states": _alarms("notBreaching"),
        "alarm_states_ignore": _alarms("ignore"),
        "alarm_states_ignore_late": _alarms("ignore", LATE_START),
        "schema_drift": _schema_drift,
        "governed_analyst_view": _curated(lambda curated: _shown(_governed(curated, ANALYST))),
        "governed_engineer_view": _curated(lambda curated: _shown(_governed(curated, ENGINEER))),
        "registered_partitions": _registered_partitions,
        "scan_bytes": _scan_bytes,
        "scan_partitions": _scan_partitions,
        "raw_table_scan": _raw_table_scan,
        "ingest_conversion_errors": _conversion_errors,
        "daily_run": _daily_run(parquet=False),
        "daily_run_parquet": _daily_run(parquet=True),
        "stored_curated": _stored_curated,
        "stored_dataset": _stored_dataset,
        "stored_quarantine": _stored_quarantine,
        "stored_quality_results": _stored_quality_results,
        "report_through_table": _report_through_table,
        "incremental_days": _incremental_days,
        "parquet_drift": _parquet_drift,
        "incremental_curated": _incremental_curated,
        "outcome_empty_input": _outcomes(outcomes.CURATE, given.EMPTY_DAY, given.FOLDED_DAYS[0]),
        "outcome_no_valid_rows": _outcomes(outcomes.CURATE, given.FOLDED_DAYS[1], given.FOLDED_DAYS[2]),
        "outcome_failed_gate": _outcomes(outcomes.VERIFY, given.FOLDED_DAYS[0], given.FOLDED_DAYS[2]),
        "outcome_no_data": _outcomes(outcomes.VERIFY, given.EMPTY_DAY, given.FOLDED_DAYS[1]),
        "alarm_states_stream": _alarm_history,
        "landing_flushes": _landing_flushes,
        "saved_result_parquet": _saved("parquet"),
        "saved_result_csv": _saved("csv"),
        "exported_csv": _exported,
        "top_search_queries_many": lambda spark, sf_dir: reports.top_search_queries(given.curated_with_terms(spark, sf_dir)),
        "dq_constraints_from_text": lambda spark, sf_dir: _results(
            spark,
            sf_dir,
            quality.QualityRules.from_text("1.0", " 0.94 ", "page_view,add_to_cart,,purchase,search", "25"),
        ),
        "dq_constraints_incremental": _incremental_quality,
        "versioned_curated": _versioned_curated,
        "totals_daily_event_counts": _totals(totals.daily_event_counts),
        "totals_revenue_by_date": _totals_revenue,
        "totals_top_skus_by_quantity": _totals(totals.top_skus_by_quantity),
        "totals_top_search_queries": _totals(totals.top_search_queries),
        "totals_daily_active_users": _totals(totals.daily_active_users),
        "totals_events_by_country": _totals(totals.events_by_country),
        "totals_hourly_event_rate": _totals(totals.hourly_event_rate, AS_OF),
        "totals_partition_freshness": _totals(totals.partition_freshness),
        "totals_revenue_by_type_country": _totals(totals.revenue_by_type_country, "2024", "01"),
        "totals_kpi_total_events": _totals(totals.kpi_total_events),
        "totals_kpi_total_value": _totals(totals.kpi_total_value),
        "totals_events_by_type_topn": _totals(totals.events_by_type, 3),
        "totals_daily_event_volume": _totals(totals.daily_event_volume),
    }


# SQL -------------------------------------------------------------------------

_EVENTS = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INT) AS k
  FROM events
)"""

_CURATED = (
    _EVENTS
    + """,
curated AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_ts,
    CASE WHEN k % 17 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_id,
    CASE k % 7 WHEN 0 THEN 'US' WHEN 1 THEN 'GB' WHEN 2 THEN 'IN' WHEN 3 THEN 'DE'
      WHEN 4 THEN 'BR' WHEN 5 THEN 'JP' END AS country,
    's-' || user_id || '-' || (k % 3) AS session_id,
    value,
    CASE WHEN event_type = 'error' THEN CASE k % 5 WHEN 0 THEN 'Shoes' WHEN 1 THEN 'shoes'
      WHEN 2 THEN 'laptop' WHEN 3 THEN '' END END AS query,
    CASE WHEN event_type IN ('click', 'purchase') AND k % 11 <> 0 THEN 'SKU-' || (1000 + k) END AS sku,
    CASE WHEN event_type IN ('click', 'purchase') THEN CAST(1 + k % 5 AS DOUBLE) END AS quantity,
    ts + INTERVAL 1 DAY AS processed_at,
    CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'add_to_cart'
      WHEN 'signup' THEN 'login' WHEN 'error' THEN 'search' ELSE event_type END AS event_type,
    strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
  FROM ev
)"""
)

_RAW = (
    _EVENTS
    + """,
raw AS (
  SELECT
    CASE WHEN k % 13 = 0 THEN ' ' WHEN k % 29 = 0 THEN NULL
      ELSE CAST(CASE WHEN event_id % 5 = 1 THEN event_id - 1 ELSE event_id END AS VARCHAR) END AS event_id,
    CASE WHEN k % 19 = 0 THEN 'not-a-timestamp'
      ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') END AS ts,
    CAST(user_id AS VARCHAR) AS user_id,
    CASE WHEN k % 7 <> 6 THEN 'C' || (k % 7) END AS country,
    's-' || user_id AS session_id, value,
    CASE WHEN event_type = 'error' THEN 'tent' END AS query,
    CASE WHEN event_type = 'purchase' THEN 'SKU-' || k END AS sku,
    CASE WHEN event_type = 'purchase' THEN CAST(1 + k % 5 AS DOUBLE) END AS quantity,
    event_type, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
  FROM ev
),
judged AS (
  SELECT *, TRY_CAST(ts AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS event_ts,
    CASE WHEN event_id IS NULL OR trim(event_id) = '' THEN 'missing_event_id'
      WHEN TRY_CAST(ts AS TIMESTAMPTZ) IS NULL THEN 'unparseable_ts' END AS reject_reason
  FROM raw
),
latest AS (
  SELECT * EXCLUDE (ts, reject_reason) FROM judged WHERE reject_reason IS NULL
  QUALIFY row_number() OVER (
    PARTITION BY year, month, day, event_id
    ORDER BY event_ts DESC NULLS LAST, event_type NULLS FIRST, user_id NULLS FIRST,
      session_id NULLS FIRST, country NULLS FIRST, value NULLS FIRST, query NULLS FIRST,
      sku NULLS FIRST, quantity NULLS FIRST) = 1
)"""
)

# The same with the row's own time and number, which the drops go by.
_RAW_KEYED = _RAW.replace("AS day\n  FROM ev\n),\njudged", "AS day, ev.ts AS event_at, k\n  FROM ev\n),\njudged")

# What a line holds, and where it must go, known from the fault it was given.
_LINES = (
    _EVENTS
    + """,
facts AS (
  SELECT ev.*, k % 23 = 22 AS cut, k % 47 = 46 OR k % 59 = 58 AS overfull,
    event_type = 'purchase' AND (k % 19 = 18 OR k % 13 = 12) AS lossy,
    CASE WHEN k % 31 = 30 THEN '' WHEN k % 37 = 36 THEN '"event_type":"",'
      WHEN k % 41 = 40 THEN '"event_type":null,' ELSE '"event_type":"' || event_type || '",' END AS type_part,
    k % 31 = 30 OR k % 37 = 36 OR k % 41 = 40 AS typeless,
    CAST(CASE WHEN event_id % 5 = 1 THEN event_id - 1 ELSE event_id END AS VARCHAR) AS id,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS ts_text
  FROM ev
),
lines AS (
  SELECT *, cut OR typeless OR overfull AS undeliverable,
    CASE WHEN cut THEN left(whole, 45) WHEN k % 47 = 46 THEN whole || whole
      WHEN k % 59 = 58 THEN whole || ' # end' ELSE whole END AS line
  FROM (
    SELECT *, '{' || type_part
      || CASE WHEN k % 43 = 42 THEN '"EVENT_ID":"' ELSE '"event_id":"' END || id || '",'
      || '"ts":"' || ts_text || '","user_id":"' || user_id || '","payload":{'
      || CASE WHEN k % 17 = 16 THEN '"Country":"C' ELSE '"country":"C' END || (k % 7) || '",'
      || CASE WHEN k % 53 = 52 THEN '"session_id":"none",' ELSE '' END
      || '"session_id":"s-' || user_id || '",'
      || CASE WHEN event_type = 'error' THEN '"query":"Trail tent",' ELSE '' END
      || CASE WHEN event_type = 'purchase' THEN '"sku":"SKU-' || k || '","quantity":'
           || CASE WHEN k % 19 = 18 THEN '"many"' WHEN k % 13 = 12 THEN '3000000000'
              ELSE CAST(1 + k % 5 AS VARCHAR) END || ',' ELSE '' END
      || CASE WHEN k % 29 = 28 THEN '"coupon":"WINTER",' ELSE '' END
      || '"value":' || CAST(value AS DECIMAL(18,2)) || '}}' AS whole
    FROM facts)
),
decoded AS (
  SELECT id AS event_id, ts_text AS ts, CAST(user_id AS VARCHAR) AS user_id, 'C' || (k % 7) AS country,
    's-' || user_id AS session_id, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS value,
    CASE WHEN event_type = 'error' THEN 'Trail tent' END AS query,
    CASE WHEN event_type = 'purchase' THEN 'SKU-' || k END AS sku,
    CASE WHEN event_type = 'purchase' AND NOT lossy THEN CAST(1 + k % 5 AS DOUBLE) END AS quantity,
    event_type, '2024' AS year, '02' AS month, '01' AS day, lossy
  FROM lines WHERE NOT undeliverable
)"""
)

# All raw rows as if they had arrived on one day, and what curating that day keeps.
_STORED = (
    _RAW
    + f""",
arrived AS (SELECT * REPLACE ('2024' AS year, '02' AS month, '01' AS day) FROM judged),
kept AS (
  SELECT * EXCLUDE (ts, reject_reason), TIMESTAMP '{given.PROCESSED_AT}' AS processed_at
  FROM arrived WHERE reject_reason IS NULL
  QUALIFY row_number() OVER (
    PARTITION BY event_id
    ORDER BY event_ts DESC NULLS LAST, event_type NULLS FIRST, user_id NULLS FIRST,
      session_id NULLS FIRST, country NULLS FIRST, value NULLS FIRST, query NULLS FIRST,
      sku NULLS FIRST, quantity NULLS FIRST) = 1
)"""
)

_FAULTY = (
    _CURATED
    + """,
faulty AS (
  SELECT * REPLACE (
    CASE WHEN n % 997 = 500 THEN NULL WHEN n % 499 = 1 THEN CAST(n - 1 AS VARCHAR) ELSE event_id END AS event_id,
    CASE WHEN n % 389 = 7 THEN -value - 1 ELSE value END AS value,
    CASE WHEN n % 211 = 3 AND quantity IS NOT NULL THEN 40 ELSE quantity END AS quantity)
  FROM (SELECT *, CAST(event_id AS BIGINT) AS n FROM curated)
),
copies AS (
  SELECT *, CASE WHEN event_id IS NOT NULL THEN count(*) OVER (PARTITION BY year, month, day, event_id) END AS c
  FROM faulty
),
measures AS (
  SELECT year, month, day, count(*) AS n, count(event_id) / count(*) AS id_share,
    count(event_ts) / count(*) AS ts_share, count(event_type) / count(*) AS type_share,
    count(user_id) / count(*) AS user_share, count(*) FILTER (c = 1) / count(*) AS unique_share,
    count(*) FILTER (value IS NULL OR value >= 0) / count(*) AS value_share,
    count(*) FILTER (quantity IS NULL OR quantity >= 0) / count(*) AS quantity_share,
    CAST(max(quantity) AS DOUBLE) AS top_quantity,
    count(*) FILTER (event_type IS NULL
      OR event_type IN ('page_view', 'add_to_cart', 'purchase', 'search')) / count(*) AS allowed_share
  FROM copies GROUP BY ALL
)"""
)


# The constraints' measures, over the stored rows instead of the faulty ones.
_STORED_FAULTY = _STORED + ",\nfaulty AS (SELECT * FROM kept),\n" + _FAULTY[_FAULTY.index("copies AS (") :]


def _results_sql(rules: quality.QualityRules, measured: str = _FAULTY) -> str:
    """CTEs ending in ``results``: one SELECT per constraint, united."""
    least = rules.required_completeness
    wanted = [
        ("Error", "Size", "CAST(n AS DOUBLE)", "n > 0"),
        ("Error", "Completeness(event_id)", "id_share", f"id_share >= {least}"),
        ("Error", "Completeness(event_ts)", "ts_share", f"ts_share >= {least}"),
        ("Error", "Completeness(event_type)", "type_share", f"type_share >= {least}"),
        ("Error", "Uniqueness(event_id)", "unique_share", "unique_share = 1"),
        ("Error", "Compliance(value is non-negative)", "value_share", "value_share = 1"),
        ("Error", "Compliance(quantity is non-negative)", "quantity_share", "quantity_share = 1"),
    ]
    if rules.max_quantity is not None:
        wanted.append(("Error", "Maximum(quantity)", "top_quantity", f"top_quantity <= {rules.max_quantity}"))
    if rules.allowed_event_types:
        wanted.append(
            ("Error", "Compliance(event_type in allowed set)", "allowed_share", "allowed_share = 1")
        )
    wanted.append(
        ("Warning", "Completeness(user_id)", "user_share", f"user_share >= {rules.min_user_id_completeness}")
    )
    rows = " UNION ALL ".join(
        f"SELECT year, month, day, n, '{level}' AS check_level, '{name}' AS \"constraint\","
        f" {value} AS x, coalesce({holds}, false) AS ok FROM measures"
        for level, name, value, holds in wanted
    )
    return (
        measured
        + f""",
judged_constraints AS ({rows}),
results AS (
  SELECT year, month, day,
    CASE check_level WHEN 'Error' THEN 'curated-events-quality' ELSE 'curated-events-warnings' END AS "check",
    check_level,
    CASE WHEN bool_and(ok) OVER (PARTITION BY year, month, day, check_level) THEN 'Success'
      ELSE check_level END AS check_status,
    "constraint", CASE WHEN ok THEN 'Success' ELSE 'Failure' END AS constraint_status,
    CASE WHEN ok THEN '' ELSE 'not met: ' || coalesce(CAST(CAST(x AS DECIMAL(28,6)) AS VARCHAR), 'no value') END
      AS constraint_message,
    n AS rows_verified
  FROM judged_constraints
),
summaries AS (
  SELECT year, month, day,
    count(*) FILTER (check_level = 'Error' AND constraint_status <> 'Success') AS constraints_failed,
    count(*) AS constraints_total, max(rows_verified) AS rows_verified,
    CASE WHEN count(*) FILTER (check_level = 'Error' AND constraint_status <> 'Success') > 0
      THEN 0 ELSE 1 END AS check_success
  FROM results GROUP BY year, month, day
),
points AS (
  SELECT 'DataQuality' AS namespace, 'curated-events-quality' AS job_name, metric,
    CAST(value AS DOUBLE) AS value, 'Count' AS unit,
    CAST(year || '-' || month || '-' || day AS TIMESTAMP) + INTERVAL 27 HOUR AS ts
  FROM (
    SELECT year, month, day, 'ConstraintsFailed' AS metric, constraints_failed AS value FROM summaries
    UNION ALL SELECT year, month, day, 'ConstraintsTotal', constraints_total FROM summaries
    UNION ALL SELECT year, month, day, 'RowsVerified', rows_verified FROM summaries
    UNION ALL SELECT year, month, day, 'CheckSuccess', check_success FROM summaries)
)"""
    )


def _alarm_sql(missing: str) -> str:
    when_missing = {"notBreaching": "'OK'", "ignore": "NULL"}[missing]
    return f"""WITH {_results_sql(quality.QualityRules(max_quantity=25.0))},
days AS (
  SELECT unnest(generate_series(TIMESTAMP '{ALARM_START}', TIMESTAMP '{ALARM_END}' - INTERVAL 1 DAY,
    INTERVAL 1 DAY)) AS period_start
),
daily AS (
  SELECT job_name, date_trunc('day', ts) AS period_start, metric, count(*) AS c, sum(value) AS s, min(value) AS m
  FROM points GROUP BY ALL
),
jobs AS (SELECT DISTINCT job_name FROM points),
spine AS (
  SELECT job_name, period_start, alarm, metric FROM days, jobs,
    (VALUES ('constraints-failed', 'ConstraintsFailed'), ('check-failed', 'CheckSuccess'),
            ('stale-results', 'CheckSuccess')) AS a(alarm, metric)
),
own AS (
  SELECT job_name, alarm, period_start, coalesce(c, 0) AS datapoints,
    CASE alarm WHEN 'constraints-failed' THEN s WHEN 'check-failed' THEN m
      ELSE CASE WHEN c > 0 THEN CAST(c AS DOUBLE) END END AS value,
    CASE WHEN c IS NULL THEN CASE alarm WHEN 'stale-results' THEN 'ALARM' ELSE {when_missing} END
      WHEN alarm = 'constraints-failed' THEN CASE WHEN s >= 1 THEN 'ALARM' ELSE 'OK' END
      WHEN alarm = 'check-failed' THEN CASE WHEN m < 1 THEN 'ALARM' ELSE 'OK' END
      ELSE CASE WHEN c < 1 THEN 'ALARM' ELSE 'OK' END END AS own_state
  FROM spine LEFT JOIN daily USING (job_name, period_start, metric)
)
SELECT job_name, alarm, period_start, datapoints, value,
  coalesce(last_value(own_state IGNORE NULLS) OVER (PARTITION BY job_name, alarm ORDER BY period_start),
    'INSUFFICIENT_DATA') AS state
FROM own"""


def core_oracle_sql() -> dict[str, str]:
    strict = _results_sql(STRICT)
    result_columns = (
        'year, month, day, "check", check_level, check_status, "constraint", constraint_status,'
        " constraint_message, rows_verified"
    )
    analyst = "event_id, event_ts, country, value, query, sku, quantity, processed_at, event_type, year, month, day"
    landed = f"""WITH {_LINES}
SELECT line AS value, event_type, '2024' AS year, '02' AS month, '01' AS day
FROM lines WHERE NOT undeliverable"""
    failed = f"""WITH {_LINES}
SELECT line AS value, 'processing-failed' AS result, '2024' AS year, '02' AS month, '01' AS day
FROM lines WHERE undeliverable"""
    decoded = f"WITH {_LINES} SELECT * EXCLUDE (lossy) FROM decoded"
    stored = f"WITH {_STORED}"

    def run(which: str) -> str:
        return f"""WITH {_LINES},
found AS (SELECT count(DISTINCT event_id) AS ids, count(DISTINCT event_type) AS types FROM decoded {which})
SELECT 1 AS position, 'register_partitions' AS step, 'SUCCEEDED' AS status, types AS "rows" FROM found
UNION ALL SELECT 2, 'raw_to_curated', 'SUCCEEDED', ids FROM found
UNION ALL SELECT 3, 'quality_checks', 'SUCCEEDED', ids FROM found
UNION ALL SELECT 4, 'refresh_dashboard', 'SUCCEEDED', 0"""

    def outcome(where: str, step: str) -> str:
        """How a step ended, from what was done to the rows of its day."""
        ended = {
            outcomes.CURATE: """CASE WHEN n = 0 THEN 'nothing_to_do' ELSE 'done' END AS status,
  CASE WHEN n = 0 THEN 'no_input' WHEN kept = 0 THEN 'no_valid_rows' END AS reason,
  n AS rows_in, kept AS rows_out, n - good AS rows_rejected, NULL AS message""",
            outcomes.VERIFY: """CASE WHEN kept = 0 THEN 'nothing_to_do' WHEN top > most THEN 'failed' ELSE 'done' END AS status,
  CASE WHEN kept = 0 THEN 'no_data' WHEN top > most THEN 'constraints_failed' END AS reason,
  kept AS rows_in, kept AS rows_out, NULL AS rows_rejected,
  CASE WHEN top > most THEN 'Maximum(quantity): not met: ' || CAST(CAST(top AS DECIMAL(28,6)) AS VARCHAR) END AS message""",
        }[step]
        return f"""WITH {_RAW},
dealt AS (
  SELECT *, 1 + (CAST(day AS INTEGER) - 1) // 11 AS d, reject_reason IS NULL AND 1 + (CAST(day AS INTEGER) - 1) // 11 <> 2 AS ok
  FROM judged
),
last AS (
  SELECT d, quantity FROM dealt WHERE ok QUALIFY row_number() OVER (
    PARTITION BY d, event_id
    ORDER BY event_ts DESC NULLS LAST, event_type NULLS FIRST, user_id NULLS FIRST,
      session_id NULLS FIRST, country NULLS FIRST, value NULLS FIRST, query NULLS FIRST,
      sku NULLS FIRST, quantity NULLS FIRST) = 1
),
days AS (
  SELECT w.d, (SELECT count(*) FROM dealt WHERE dealt.d = w.d) AS n, (SELECT count(*) FROM dealt WHERE dealt.d = w.d AND ok) AS good,
    (SELECT count(*) FROM last WHERE last.d = w.d) AS kept, (SELECT max(quantity) FROM last WHERE last.d = w.d) AS top,
    CASE WHEN w.d = 3 THEN 2 END AS most
  FROM (VALUES (1), (2), (3), (4)) AS w(d)
)
SELECT 'nightly' AS run, '{step}' AS step, '2024' AS year, '03' AS month, '0' || d AS day, {ended} FROM days WHERE {where}"""

    sql = {
        "raw_day_scan": f"WITH {_RAW} SELECT * FROM raw WHERE year = '2024' AND month = '01' AND day = '15'",
        "raw_decode": decoded,
        "curated_day_scan": f"""WITH {_CURATED}
SELECT * FROM curated WHERE year = '2024' AND month = '01' AND day = '15'""",
        "ingest_route": landed,
        "ingest_errors": failed,
        "ingest_landed": landed,
        "ingest_landed_errors": failed,
        "ingest_parquet": f"{decoded} WHERE NOT lossy",
        "ingest_conversion_errors": f"""WITH {_LINES}
SELECT line AS value, 'format-conversion-failed' AS result, '2024' AS year, '02' AS month, '01' AS day
FROM lines WHERE lossy AND NOT undeliverable""",
        "raw_table_scan": decoded,
        "stored_curated": f"{stored} SELECT * FROM kept",
        "stored_dataset": f"{stored} SELECT *, date_trunc('day', event_ts) AS event_date FROM kept",
        "stored_quarantine": f"""{stored}
SELECT * EXCLUDE (event_ts) FROM arrived WHERE reject_reason IS NOT NULL""",
        "stored_quality_results": f"""WITH {_results_sql(STRICT, _STORED_FAULTY)}
SELECT "check", check_level, check_status, "constraint", constraint_status, constraint_message, rows_verified
FROM results""",
        "report_through_table": f"""{stored}
SELECT year, month, day, event_type, count(*) AS events FROM kept GROUP BY ALL""",
        "incremental_days": f"""WITH {_EVENTS}
SELECT DISTINCT 1 AS run, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
FROM ev WHERE ts < TIMESTAMP '{SECOND_DROP}'
UNION ALL
SELECT DISTINCT 2, strftime(ts, '%Y'), strftime(ts, '%m'), strftime(ts, '%d')
FROM ev WHERE ts >= TIMESTAMP '{SECOND_DROP}' OR k % 10 = 0""",
        "scan_partitions": f"""WITH {_CURATED}
SELECT DISTINCT event_type, year, month, day FROM curated
WHERE event_type IN ('add_to_cart', 'purchase') AND year = '2024' AND month = '01'""",
        "alarm_states_ignore_late": f"""SELECT * FROM ({_alarm_sql("ignore")})
WHERE period_start >= TIMESTAMP '{LATE_START}'""",
        "raw_to_curated": f"""WITH {_RAW}
SELECT *, TIMESTAMP '{given.PROCESSED_AT}' AS processed_at FROM latest""",
        "quarantine_rows": f"""WITH {_RAW}
SELECT * EXCLUDE (event_ts) FROM judged WHERE reject_reason IS NOT NULL""",
        "quarantine_reason_counts": f"""WITH {_RAW}
SELECT reject_reason, count(*) AS "rows" FROM judged WHERE reject_reason IS NOT NULL GROUP BY 1""",
        "etl_row_counts": f"""WITH {_RAW}
SELECT (SELECT count(*) FROM latest) AS valid_rows,
  (SELECT count(*) FROM judged WHERE reject_reason IS NOT NULL) AS quarantined_rows""",
        "dedup_latest": f"WITH {_RAW} SELECT event_id, event_ts, event_type, year, month, day FROM latest",
        "daily_event_counts": f"""WITH {_CURATED}
SELECT year, month, day, event_type, count(*) AS events FROM curated GROUP BY ALL
ORDER BY year DESC, month DESC, day DESC, events DESC, event_type""",
        "revenue_by_date": f"""WITH {_CURATED}
SELECT year, month, day, count(*) AS purchases,
  CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
  round(CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / count(*), 4) AS avg_order_value
FROM curated WHERE event_type = 'purchase' GROUP BY year, month, day
ORDER BY year DESC, month DESC, day DESC""",
        "top_skus_by_quantity": f"""WITH {_CURATED}
SELECT sku, CAST(sum(quantity) AS BIGINT) AS units, count(*) AS line_items FROM curated
WHERE event_type IN ('add_to_cart', 'purchase') AND sku IS NOT NULL
GROUP BY sku ORDER BY units DESC NULLS LAST, sku LIMIT 50""",
        "top_search_queries": f"""WITH {_CURATED}
SELECT lower(query) AS search_term, count(*) AS searches, count(DISTINCT session_id) AS sessions
FROM curated WHERE event_type = 'search' AND query IS NOT NULL AND query <> ''
GROUP BY 1 ORDER BY searches DESC, search_term LIMIT 50""",
        "daily_active_users": f"""WITH {_CURATED}
SELECT year, month, day, count(DISTINCT user_id) AS dau, count(DISTINCT session_id) AS sessions
FROM curated WHERE user_id IS NOT NULL GROUP BY year, month, day
ORDER BY year DESC, month DESC, day DESC""",
        "events_by_country": f"""WITH {_CURATED}
SELECT country, count(*) AS events, count(DISTINCT user_id) AS users
FROM curated WHERE country IS NOT NULL GROUP BY country ORDER BY events DESC, country""",
        "hourly_event_rate": f"""WITH {_CURATED}
SELECT date_trunc('hour', event_ts) AS event_hour, event_type, count(*) AS events
FROM curated WHERE event_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY
GROUP BY 1, 2 ORDER BY event_hour DESC, events DESC, event_type""",
        "partition_freshness": f"""WITH {_CURATED}
SELECT event_type, max(year || '-' || month || '-' || day) AS latest_partition,
  max(processed_at) AS last_processed_at
FROM curated GROUP BY event_type ORDER BY event_type""",
        "revenue_by_type_country": f"""WITH {_CURATED}
SELECT event_type, country, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM curated WHERE year = '2024' AND month = '01' GROUP BY event_type, country""",
        "bi_dataset": f"WITH {_CURATED} SELECT *, date_trunc('day', event_ts) AS event_date FROM curated",
        "kpi_total_events": f"WITH {_CURATED} SELECT count(event_id) AS total_events FROM curated",
        "kpi_total_value": f"""WITH {_CURATED}
SELECT CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total_value FROM curated""",
        "events_by_type_topn": f"""WITH {_CURATED},
counts AS (SELECT event_type, count(event_id) AS events FROM curated GROUP BY event_type),
ranked AS (SELECT *, row_number() OVER (ORDER BY events DESC, event_type) AS r FROM counts)
SELECT CASE WHEN r <= 3 THEN event_type ELSE 'other' END AS event_type,
  CAST(sum(events) AS BIGINT) AS events, r > 3 AS is_other
FROM ranked GROUP BY 1, 3""",
        "daily_event_volume": f"""WITH {_CURATED}
SELECT date_trunc('day', event_ts) AS event_day, count(event_id) AS events
FROM curated GROUP BY 1 ORDER BY 1""",
        "dq_constraints": f"WITH {strict} SELECT {result_columns} FROM results",
        "dq_constraints_relaxed": f"WITH {_results_sql(RELAXED)} SELECT {result_columns} FROM results",
        "dq_summary": f"WITH {strict} SELECT * FROM summaries",
        "dq_metrics": f"WITH {_results_sql(quality.QualityRules(max_quantity=25.0))} SELECT * FROM points",
        "alarm_states": _alarm_sql("notBreaching"),
        "alarm_states_ignore": _alarm_sql("ignore"),
        "schema_drift": f"""WITH {_LINES},
objects AS (SELECT * FROM lines WHERE NOT cut AND NOT overfull),
whole_lines AS (SELECT * FROM objects WHERE k % 53 <> 52)
SELECT '(line)' AS "column", 'OBJECT' AS json_type, 'unreadable' AS change, count(*) AS "rows"
FROM objects WHERE k % 53 = 52
UNION ALL
SELECT 'payload.quantity', 'BIGINT', 'type_changed', count(*)
FROM whole_lines WHERE event_type = 'purchase' AND k % 13 = 12 AND k % 19 <> 18
UNION ALL
SELECT 'payload.coupon' AS "column", 'STRING' AS json_type, 'added' AS change, count(*) AS "rows"
FROM whole_lines WHERE k % 29 = 28
UNION ALL
SELECT 'payload.quantity', 'STRING', 'type_changed', count(*)
FROM whole_lines WHERE event_type = 'purchase' AND k % 19 = 18""",
        "governed_analyst_view": f"WITH {_CURATED} SELECT {analyst} FROM curated",
        "governed_engineer_view": f"WITH {_CURATED} SELECT {analyst}, user_id, session_id FROM curated",
        "registered_partitions": f"WITH {_CURATED} SELECT DISTINCT event_type, year, month, day FROM curated",
        "daily_run": run(""),
        "daily_run_parquet": run("WHERE NOT lossy"),
    }
    sql |= {
        "parquet_drift": f"""WITH {_CURATED},
folders AS (SELECT DISTINCT event_type, year, month, day FROM curated)
SELECT 'quantity' AS "column", 'int' AS declared_type, 'string' AS found_type, 'type_changed' AS change, count(*) AS files
FROM folders WHERE day > '10' AND day <= '20'
UNION ALL SELECT 'sku', 'string', NULL, 'missing', count(*) FROM folders WHERE day > '20'
UNION ALL SELECT 'coupon', NULL, 'string', 'added', count(*) FROM folders WHERE day > '20'""",
        "incremental_curated": f"""WITH {_RAW_KEYED},
came AS (
  SELECT *, 0 AS batch FROM judged WHERE event_at < TIMESTAMP '{SECOND_DROP}'
  UNION ALL SELECT *, 1 FROM judged WHERE event_at >= TIMESTAMP '{SECOND_DROP}' OR k % 10 = 0
),
dealt AS (SELECT * REPLACE ('2024' AS year, '03' AS month, '0' || (1 + (CAST(day AS INTEGER) - 1) // 11) AS day) FROM came)
SELECT * EXCLUDE (ts, reject_reason, event_at, k), TIMESTAMP '{given.PROCESSED_AT}' AS processed_at, true AS has_file
FROM dealt WHERE reject_reason IS NULL
QUALIFY row_number() OVER (
  PARTITION BY day, event_id
  ORDER BY event_ts DESC NULLS LAST, event_type NULLS FIRST, user_id NULLS FIRST,
    session_id NULLS FIRST, country NULLS FIRST, value NULLS FIRST, query NULLS FIRST,
    sku NULLS FIRST, quantity NULLS FIRST, batch) = 1""",
        "outcome_empty_input": outcome("d IN (1, 4)", outcomes.CURATE),
        "outcome_no_valid_rows": outcome("d IN (2, 3)", outcomes.CURATE),
        "outcome_failed_gate": outcome("d IN (1, 3)", outcomes.VERIFY),
        "outcome_no_data": outcome("d IN (2, 4)", outcomes.VERIFY),
        "alarm_states_stream": sql["alarm_states_ignore_late"],
        "landing_flushes": f"""WITH {_LINES},
parts AS (
  SELECT CASE WHEN k % 10 = 0 THEN 'first' WHEN k % 10 <= 3 THEN 'second' ELSE 'third' END AS part,
    count(*) AS lines, sum(strlen(line)) AS bytes
  FROM lines GROUP BY 1
)
SELECT CASE WHEN part = 'first' THEN 'first' WHEN bytes + lines >= {FLUSH_BUFFER.batch_bytes(1)} THEN 'size' ELSE 'time' END AS cause,
  CAST(sum(lines) AS BIGINT) AS lines, CAST(sum(bytes) AS BIGINT) AS bytes
FROM parts GROUP BY 1""",
        "saved_result_parquet": sql["events_by_country"],
        "saved_result_csv": sql["events_by_country"],
        "exported_csv": sql["daily_event_volume"],
        "top_search_queries_many": f"""WITH {_CURATED},
asked AS (
  SELECT 'item ' || (CAST(event_id AS BIGINT) % 173) AS search_term, session_id FROM curated WHERE event_type = 'search'
)
SELECT search_term, count(*) AS searches, count(DISTINCT session_id) AS sessions
FROM asked GROUP BY 1 ORDER BY searches DESC, search_term LIMIT 50""",
        "dq_constraints_from_text": sql["dq_constraints"],
        "dq_constraints_incremental": sql["dq_constraints"],
        "versioned_curated": f"WITH {_CURATED} SELECT * FROM curated",
    }
    # The same rows from the totals of days as from all events.
    return sql | {name: sql[name.removeprefix("totals_")] for name in core_queries() if name.startswith("totals_")}
