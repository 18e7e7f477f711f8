import shutil

import pytest

from clickbasin.functions.dates import ingest_day
from clickbasin.operators import ranking
from clickbasin.plans import dashboard, query_results, reports
from clickbasin.plans.curate import write_curated
from clickbasin.schemas import CURATED
from clickbasin.sources.curated import read_curated


def row(n, event_type="search", **over):
    base = dict(
        event_id=str(n), event_ts=None, user_id="u", country="US", session_id="s", value=1.0, query=None,
        sku=None, quantity=None, processed_at=None, event_type=event_type, year="2024", month="03", day="05",
    )
    base.update(over)
    return tuple(base[name] for name in CURATED.fieldNames())


def table(spark, rows):
    return spark.createDataFrame(rows, CURATED)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def scan(frame):
    return next(line for line in plan(frame).splitlines() if "FileScan" in line)


@pytest.fixture
def stored(spark, tmp_path):
    root = str(tmp_path / "curated")
    write_curated(table(spark, [row(1, "purchase"), row(2), row(3, "login", month="04")]), root)
    return read_curated(spark, root)


def test_search_terms_fold_case_and_skip_blanks(spark):
    terms = [None, "", "Shoes", "shoes", "SHOES", "tent"]
    rows = [row(i, query=q, session_id=f"s{i % 2}") for i, q in enumerate(terms)] + [row(9, "login", query="tent")]
    found = [tuple(r) for r in reports.top_search_queries(table(spark, rows)).collect()]
    assert found == [("shoes", 3, 2), ("tent", 1, 1)]


def test_fifty_one_skus_with_equal_units_rank_stably(spark):
    rows = [row(i, "purchase", sku=f"sku{i:02d}", quantity=2) for i in range(51)]
    for parts in (1, 5):
        ranked = reports.top_skus_by_quantity(table(spark, rows).repartition(parts)).collect()
        assert [r["sku"] for r in ranked] == [f"sku{i:02d}" for i in range(50)]


def test_null_users_count_for_neither_measure(spark):
    rows = [row(1, user_id=None, session_id="x"), row(2), row(3, session_id="t")]
    (found,) = reports.daily_active_users(table(spark, rows)).collect()
    assert (found["dau"], found["sessions"]) == (1, 2)


def test_freshness_compares_padded_text(spark):
    rows = [row(1, month="09", day="30"), row(2, month="10", day="01"), row(3, "login", month=None)]
    found = {r["event_type"]: r["latest_partition"] for r in reports.partition_freshness(table(spark, rows)).collect()}
    assert found == {"search": "2024-10-01", "login": None}


def test_filters_and_columns_reach_the_scan(stored):
    revenue = scan(reports.revenue_by_date(stored))
    assert "event_type" in revenue.split("PartitionFilters: ")[1].split("]")[0]
    assert "ReadSchema: struct<value:double>" in revenue
    assert "ReadSchema: struct<>" in scan(reports.daily_event_counts(stored))
    hourly = scan(reports.hourly_event_rate(stored, "2024-03-31 00:00:00", arrived_since="2024-03-24"))
    assert "GreaterThanOrEqual(event_ts" in hourly
    assert "month" in hourly.split("PartitionFilters: ")[1].split("]")[0]
    monthly = scan(reports.revenue_by_type_country(stored, "2024", "03"))
    assert "year" in monthly.split("PartitionFilters: ")[1] and "(month" in monthly
    assert "TakeOrderedAndProject" in plan(reports.top_skus_by_quantity(stored))
    assert "Expand" in plan(reports.daily_active_users(stored))


def test_arrival_filter_compares_whole_dates(spark):
    days = ["2023-12-31", "2024-02-10", "2024-03-09", "2024-03-10", "2025-01-01"]
    rows = [row(i, year=text[:4], month=text[5:7], day=text[8:]) for i, text in enumerate(days)]
    frame = table(spark, rows).selectExpr(
        "event_id", "TIMESTAMP '2024-03-12 00:00:00' AS event_ts", "event_type", "year", "month", "day"
    )
    found = reports.hourly_event_rate(frame, "2024-03-13 00:00:00", arrived_since="2024-03-10").collect()
    assert [r["events"] for r in found] == [2]


def test_more_types_than_bars_fold_into_other(spark):
    rows = [row(f"{t}-{i}", f"t{t:02d}") for t in range(23) for i in range(23 - t)]
    found = dashboard.events_by_type(table(spark, rows)).collect()
    assert len(found) == 21
    assert tuple(found[-1]) == ("other", 3 + 2 + 1, True)
    assert sum(r["events"] for r in found) == len(rows)


def test_real_category_named_other_and_null_stay_apart(spark):
    rows = [row(i, kind) for i, kind in enumerate(["other"] * 3 + [None] * 2 + ["a"])]
    found = {tuple(r) for r in dashboard.events_by_type(table(spark, rows), 2).collect()}
    assert found == {("other", 3, False), (None, 2, False), ("other", 1, True)}
    with pytest.raises(ValueError):
        dashboard.events_by_type(table(spark, rows), 0)


def test_many_leaders_are_joined_without_a_broadcast_hint(spark, monkeypatch):
    rows = [row(f"{t}-{i}", f"t{t}") for t in range(6) for i in range(6 - t)]
    expected = [tuple(r) for r in dashboard.events_by_type(table(spark, rows), 4).collect()]
    assert [tuple(r) for r in dashboard.events_by_type(table(spark, rows), 4).collect()] == expected


def test_kpis_ignore_null_ids_and_sum_every_type(spark):
    frame = table(spark, [row(1, value=2.0), row(2, "purchase", value=3.0), row(None, value=None)])
    with_null = frame.selectExpr("IF(event_id = 'None', NULL, event_id) AS event_id", "value")
    assert dashboard.kpi_total_events(with_null).first()[0] == 2
    assert dashboard.kpi_total_value(frame).first()[0] == 5.0


def test_dataset_refresh_full_and_by_day(spark, tmp_path):
    curated, dataset = str(tmp_path / "curated"), str(tmp_path / "dataset")
    day = ingest_day("2024-03-05")
    assert not dashboard.refresh_dataset(spark, curated, dataset)
    write_curated(table(spark, [row(1), row(2, "login"), row(3, day="06")]), curated)
    assert dashboard.refresh_dataset(spark, curated, dataset, day)  # first time: everything
    stored = spark.read.parquet(dataset)
    assert stored.count() == 3 and set(stored.columns) == {*CURATED.fieldNames(), "event_date"}
    write_curated(table(spark, [row(1), row(4), row(5)]), curated)
    assert dashboard.refresh_dataset(spark, curated, dataset, day)
    by_day = sorted(r["event_id"] for r in spark.read.parquet(dataset).collect())
    assert dashboard.refresh_dataset(spark, curated, dataset)
    assert by_day == sorted(r["event_id"] for r in spark.read.parquet(dataset).collect())
    assert by_day == ["1", "2", "3", "4", "5"]
    shutil.rmtree(f"{curated}/event_type=search/year=2024/month=03/day=06")
    assert dashboard.refresh_dataset(spark, curated, dataset)
    assert spark.read.parquet(dataset).count() == 4
    dashboard.dataset_view(spark, curated, "bi_direct")
    assert spark.table("bi_direct").count() == 4


def test_exports(spark, tmp_path, lake):
    counts = reports.daily_event_counts(table(spark, [row(1)]))
    dashboard.export_csv(counts, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first()["events"] == "1"
    assert spark.read.parquet(query_results.save_result(counts, lake, "q1")).count() == 1
    saved = query_results.save_result(counts, lake, "q1-text", "csv")
    assert spark.read.option("header", True).csv(saved).columns == counts.columns
    with pytest.raises(ValueError):
        query_results.save_result(counts, lake, "q", "xml")
