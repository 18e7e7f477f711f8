import json

import pytest
from conftest import DAY, event
from pyspark.errors import AnalysisException

from clickbasin.jobs import main
from clickbasin.plans.catalog import create_tables, database_names, register_day
from clickbasin.plans.curate import CurateOutcome, curate_day
from clickbasin.plans.quality_run import QualityFailure
from clickbasin.sources.curated import read_lineage
from clickbasin.sources.raw import scan_raw_day


@pytest.fixture
def run(spark, lake, capsys):
    def call(job, *options):
        code = main([job, "--lake", lake.root, *options])
        return code, capsys.readouterr().out

    return call


DATE = ["--process-date", "2024-03-05"]


def test_day_from_the_command_line(spark, lake, drop_lines, run):
    drop_lines(lake.raw, "purchase", [event("1", quantity=9, sku="k", value=2.0), event(None)])
    assert "raw_rows=2, curated_rows=1, quarantined_rows=1" in run("curate", *DATE)[1]
    assert "constraints_total=8" in run("quality", *DATE)[1]
    with pytest.raises(QualityFailure, match="Maximum"):
        run("quality", *DATE, "--max-quantity", "5")
    assert run("quality", *DATE, "--max-quantity", "5", "--fail-on-error", "off")[0] == 0
    assert run("refresh", *DATE)[0] == 0
    assert spark.read.parquet(lake.dataset).count() == 1
    code, out = run("daily", *DATE, "--allowed-event-types", "search,login")
    assert code == 1 and "NOT_RUN" in out
    code, out = run("daily", *DATE, "--refresh-dashboard", "no")
    assert code == 0 and "refresh_dashboard" not in out
    path = run("report", "--name", "revenue_by_date", "--format", "csv")[1].strip()
    assert spark.read.option("header", True).csv(path).first()["revenue"] == "2.0"
    with pytest.raises(ValueError):
        run("report", "--name", "revenue_by_date", "--scan-cap-bytes", "1")


def test_reports_alarms_and_drift(spark, lake, drop_lines, run):
    drop_lines(lake.raw, "purchase", [event("1", country="US", value=2.0, colour="red")])
    run("daily", *DATE, "--project", "job", "--environment", "report")
    counts = run("report", "--name", "daily_event_counts", "--table", "job_report_curated.events")[1].strip()
    assert spark.read.parquet(counts).first()["events"] == 1
    for layer in ("raw", "staging", "curated"):
        spark.sql(f"DROP DATABASE job_report_{layer} CASCADE")
    monthly = ["--name", "revenue_by_type_country", "--month", "2024-03", "--audience", "analyst"]
    path = run("report", *monthly)[1].strip()
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("purchase", "US", 2.0)]
    with pytest.raises(AnalysisException, match="UNRESOLVED_COLUMN"):
        run("report", "--name", "daily_active_users", "--audience", "analyst")
    assert run("report", "--name", "daily_active_users", "--audience", "engineer")[0] == 0
    with pytest.raises(AnalysisException, match="UNRESOLVED_COLUMN"):
        run("report", "--name", "daily_active_users")
    out = run("alarms", "--start", "2024-03-01 00:00:00", "--end", "2024-03-02 00:00:00")[1]
    assert "stale-results" in out and "ALARM" in out
    quiet = run(
        "alarms", "--start", "2024-03-01 00:00:00", "--end", "2024-03-02 00:00:00", "--staleness-seconds", ""
    )[1]
    assert "ALARM" not in quiet and "check-failed" in quiet
    assert "payload.colour" in run("drift", *DATE)[1]


def test_landing_and_incremental_curation(spark, lake, run, tmp_path):
    source = tmp_path / "incoming"
    source.mkdir()
    (source / "a.json").write_text(json.dumps({"event_type": "login", **event("1")}) + "\n")
    run("land", "--source", str(source), "--checkpoint", str(tmp_path / "l"), "--drain", "yes")
    assert "curated_rows=1" in run("curate-new", "--checkpoint", str(tmp_path / "c"))[1]
    assert run("curate-new", "--checkpoint", str(tmp_path / "c"))[1] == ""


def test_curating_a_day_of_a_catalogued_table(spark, lake, drop_lines):
    drop_lines(lake.raw, "search", [event("1"), "broken"])
    names = database_names("jobs", "test")
    create_tables(spark, names, lake)
    table = f"{names['raw']}.events"
    register_day(spark, table, lake.raw, DAY)
    raw = scan_raw_day(spark.table(table), DAY)
    assert curate_day(spark, lake, DAY, raw=raw) == CurateOutcome(2, 1, 1)
    for database in names.values():
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_versions_outcomes_totals_and_judging(spark, lake, drop_lines, run, tmp_path):
    assert run("versions")[0] == 0
    assert "raw_rows=0" in run("curate", *DATE, "--run", "first")[1]
    drop_lines(lake.raw, "search", [event("1", country="US", session_id="s", query="Hat"), event("2", query="hat", session_id="t")])
    run("curate", *DATE, "--run", "second")
    with pytest.raises(QualityFailure):
        run("quality", *DATE, "--run", "second", "--allowed-event-types", "login")
    rows = spark.read.parquet(run("outcomes")[1].split("\n")[0]).collect()
    assert [(r.run, r.step, r.status, r.reason) for r in rows] == [
        ("first", "raw_to_curated", "nothing_to_do", "no_input"),
        ("second", "raw_to_curated", "done", None),
        ("second", "quality_checks", "failed", "constraints_failed"),
    ]
    assert run("totals", *DATE, "--full", "yes")[0] == 0 and run("totals", *DATE)[0] == 0
    name = ["--name", "top_search_queries", "--from-totals", "yes"]
    with pytest.raises(PermissionError):
        run("report", *name)
    path = run("report", *name, "--audience", "engineer")[1].strip()
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("hat", 2, 2)]
    monthly = ["--name", "revenue_by_type_country", "--month", "2024-03", "--from-totals", "yes"]
    assert spark.read.parquet(run("report", *monthly)[1].strip()).count() == 2
    assert spark.read.parquet(run("report", "--name", "hourly_event_rate", "--from-totals", "on")[1].strip()).count() == 0
    run("refresh", *DATE)
    assert [line.split()[-1] for line in run("versions", "--vacuum-seconds", "0")[1].splitlines()] == ["0", "0", "0"]
    judged = ["--checkpoint", str(tmp_path / "j"), "--until", "2024-03-03 00:00:00", "--since", "2024-03-01 00:00:00"]
    assert run("judge", *judged)[0] == 0
    assert spark.read.option("recursiveFileLookup", True).parquet(lake.alarm_history).count() == 6


def test_landing_by_size_and_noting_files(spark, lake, run, tmp_path):
    source = tmp_path / "incoming"
    source.mkdir()
    (source / "a.json").write_text(json.dumps({"event_type": "login", **event("1")}) + "\n")
    run("land", "--source", str(source), "--checkpoint", str(tmp_path / "l"), "--drain", "yes", "--by-size", "yes")
    assert "curated_rows=1" in run("curate-new", "--checkpoint", str(tmp_path / "c"), "--note-files", "yes")[1]
    assert {r.batch for r in read_lineage(spark, lake.curated).collect()} == {0}
