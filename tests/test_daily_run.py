from conftest import DAY, STAMP, event

from clickbasin.operators.quality import QualityRules
from clickbasin.plans.catalog import create_tables, database_names
from clickbasin.plans.daily_run import run_day
from clickbasin.schemas import RAW
from clickbasin.sources.raw import read_raw_day, scan_raw_day


def statuses(report):
    return [(r["step"], r["status"], r["rows"]) for r in report.orderBy("position").collect()]


def test_steps_run_in_order(spark, lake, drop_lines):
    drop_lines(lake.raw, "search", [event("1"), event("1"), event("2"), event(None)])
    names = database_names("run", "test")
    create_tables(spark, names, lake)
    report = run_day(spark, lake, DAY, databases=names, processed_at=STAMP)
    assert statuses(report) == [
        ("register_partitions", "SUCCEEDED", 1),
        ("raw_to_curated", "SUCCEEDED", 2),
        ("quality_checks", "SUCCEEDED", 2),
        ("refresh_dashboard", "SUCCEEDED", None),
    ]
    assert spark.table(f"{names['curated']}.events").count() == 2
    assert spark.read.parquet(lake.dataset).count() == 2
    for database in names.values():
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_failed_quality_stops_the_refresh(spark, lake, drop_lines):
    drop_lines(lake.raw, "odd", [event("1")])
    rules = QualityRules(allowed_event_types=("search",))
    report = run_day(spark, lake, DAY, rules=rules, processed_at=STAMP)
    assert [s for _, s, _ in statuses(report)] == ["NOT_RUN", "SUCCEEDED", "FAILED", "NOT_RUN"]
    message = report.where("status = 'FAILED'").first()["message"]
    assert message.startswith("QualityFailure") and "allowed set" in message
    assert spark.read.parquet(lake.metrics).count() == 4
    lenient = run_day(spark, lake, DAY, rules=rules, processed_at=STAMP, fail_on_error=False)
    assert [s for _, s, _ in statuses(lenient)] == ["NOT_RUN", "SUCCEEDED", "SUCCEEDED", "SUCCEEDED"]


def test_a_parquet_landed_day_runs_whole(spark, lake, drop_lines):
    drop_lines(f"{lake.root}/in", "search", [event("1"), event("2"), event(None)])
    rows = read_raw_day(spark, f"{lake.root}/in", DAY).select(*RAW.fieldNames())
    rows.write.partitionBy("event_type", "year", "month", "day").parquet(lake.raw)
    names = database_names("run", "parquet")
    create_tables(spark, names, lake, parquet=True)
    report = run_day(spark, lake, DAY, databases=names, processed_at=STAMP)
    assert [r for _, _, r in statuses(report)] == [1, 2, 2, None]
    assert scan_raw_day(spark.table(f"{names['raw']}.events"), DAY).count() == 3
    wrong = run_day(spark, lake, DAY, processed_at=STAMP, parquet=False)
    assert [s for _, s, _ in statuses(wrong)] == ["NOT_RUN", "FAILED", "NOT_RUN", "NOT_RUN"]
    for database in names.values():
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_day_without_data_succeeds_and_dashboard_is_optional(spark, lake):
    report = run_day(spark, lake, DAY, processed_at=STAMP, refresh_dashboard=False)
    assert statuses(report) == [
        ("register_partitions", "NOT_RUN", None),
        ("raw_to_curated", "SUCCEEDED", 0),
        ("quality_checks", "SUCCEEDED", 0),
    ]
