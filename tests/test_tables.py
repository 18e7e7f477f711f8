import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import DAY, event
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_reports import row, table

from clickbasin.functions.dates import ingest_day
from clickbasin.operators import drift, governance, scan_budget
from clickbasin.plans import catalog
from clickbasin.plans.curate import curate_day, write_curated
from clickbasin.schemas import CURATED, RAW_DATA, TAG_ASSIGNMENT
from clickbasin.sources.raw import scan_raw_day
from clickbasin.sources.curated import read_curated

# Catalog ---------------------------------------------------------------------


@pytest.fixture
def names(spark, lake):
    found = catalog.database_names("my-shop", "test")
    catalog.create_tables(spark, found, lake)
    yield found
    for database in found.values():
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_database_names_use_underscores():
    assert catalog.database_names("my-shop", "dev")["raw"] == "my_shop_dev_raw"


def test_tables_see_partitions_once_registered(spark, lake, names, drop_lines):
    drop_lines(lake.raw, "search", [event("1", quantity=2), "oops"])
    drop_lines(lake.raw, "log'in", [event("2")])
    raw = f"{names['raw']}.events"
    assert spark.table(raw).count() == 0
    assert catalog.register_day(spark, raw, lake.raw, DAY) == 2
    assert catalog.register_day(spark, raw, lake.raw, DAY) == 2  # nothing new, nothing wrong
    day = scan_raw_day(spark.table(raw), DAY)
    assert day.count() == 3
    assert day.where("payload.quantity = 2").count() == 1
    other = ingest_day("2024-03-06")
    drop_lines(lake.raw, "search", [event("3")], other)
    drop_lines(lake.raw, "__HIVE_DEFAULT_PARTITION__", [event("4")], other)
    catalog.register_all(spark, raw)
    assert catalog.partitions(spark, raw).count() == 4
    assert scan_raw_day(spark.table(raw), other).count() == 2
    plan = scan_raw_day(spark.table(raw), DAY)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_curated_table_reads_what_the_job_wrote(spark, lake, names, drop_lines):
    drop_lines(lake.raw, "search", [event("1")])
    drop_lines(lake.raw, "__HIVE_DEFAULT_PARTITION__", [event("2")])
    curate_day(spark, lake, DAY)
    curated = f"{names['curated']}.events"
    assert catalog.register_day(spark, curated, lake.curated, DAY) == 2
    assert spark.table(curated).schema == CURATED
    assert spark.table(curated).count() == 2


def test_dropping_a_database_keeps_the_data(spark, lake, drop_lines):
    drop_lines(lake.raw, "search", [event("1")])
    found = catalog.database_names("dropped", "test")
    catalog.create_tables(spark, found, lake)
    curate_day(spark, lake, DAY)
    catalog.register_day(spark, f"{found['curated']}.events", lake.curated, DAY)
    for database in found.values():
        spark.sql(f"DROP DATABASE {database} CASCADE")
    assert read_curated(spark, lake.curated).count() == 1
    assert curate_day(spark, lake, DAY).raw_rows == 1


def test_partitions_that_vanished_are_unregistered(spark, lake, names, drop_lines):
    curated = f"{names['curated']}.events"
    for kind, name in (("search", "1"), ("__HIVE_DEFAULT_PARTITION__", "2"), ("a%3A'b", "3")):
        drop_lines(lake.raw, kind, [event(name)])
    curate_day(spark, lake, DAY)
    assert catalog.register_day(spark, curated, lake.curated, DAY) == 3
    assert spark.table(curated).count() == 3
    listed = catalog.partitions(spark, curated).select("event_type", "day").collect()
    assert {tuple(r) for r in listed} == {("search", "05"), (None, "05"), ("a:'b", "05")}
    drop_lines(lake.raw, "__HIVE_DEFAULT_PARTITION__", [])
    drop_lines(lake.raw, "a%3A'b", [])
    curate_day(spark, lake, DAY)
    assert catalog.register_day(spark, curated, lake.curated, DAY) == 1
    assert spark.table(curated).count() == 1
    assert catalog.partitions(spark, curated).count() == 1


# Drift -----------------------------------------------------------------------


def test_file_drift_reports_without_applying(spark, tmp_path):
    spark.range(1).selectExpr("id", "'x' AS name").write.parquet(str(tmp_path / "t"))
    spark.range(1).selectExpr("id", "1.5D AS extra").write.mode("append").parquet(str(tmp_path / "t"))
    declared = T.StructType.fromDDL("id int, name string, gone string")
    found = drift.file_schema_drift(spark, declared, drift.parquet_schema(spark, str(tmp_path / "t")))
    assert {tuple(r) for r in found.collect()} == {
        ("gone", "string", None, "missing"),
        ("extra", None, "double", "added"),
        ("id", "int", "bigint", "type_changed"),
    }
    assert drift.file_schema_drift(spark, declared, declared).count() == 0


def test_file_drift_of_a_day_with_conflicting_types(spark, tmp_path):
    root = str(tmp_path / "t")
    day = ingest_day("2024-03-05")
    folder = f"{root}/event_type=search/{day.folder()}"
    one = spark.range(1).coalesce(1)
    one.selectExpr("CAST(id AS INT) AS id", "'x' AS name").write.parquet(folder)
    one.selectExpr("'7' AS id").write.mode("append").parquet(folder)
    declared = T.StructType.fromDDL("id int, name string")
    assert {tuple(r) for r in drift.parquet_drift(spark, root, day, declared).collect()} == {
        ("id", "int", "string", "type_changed", 1),
        ("name", "string", None, "missing", 1),
    }
    assert drift.parquet_drift(spark, root, ingest_day("2024-03-06"), declared).count() == 0


def test_file_drift_reads_footers_of_any_writer_and_reports_broken_files(spark, tmp_path):
    root = tmp_path / "t" / "event_type=a b"
    root.mkdir(parents=True)
    for n in range(3):
        own = pa.table({"id": pa.array([1], pa.int32()), "at": pa.array([0], pa.timestamp("us", "UTC")), "when": pa.array([0], pa.timestamp("us"))})
        pq.write_table(own, root / f"own-{n}.parquet")
    pq.write_table(pa.table({"id": pa.array([1], pa.int32()), "at": pa.array([0], pa.timestamp("ns")), "when": pa.array([0], pa.timestamp("us"))}),
                   root / "old.parquet", use_deprecated_int96_timestamps=True)
    (root / "broken.parquet").write_bytes(b"PAR1 and no footer")
    (root / "empty.parquet").write_bytes(b"")
    declared = T.StructType.fromDDL("id bigint, at timestamp, when timestamp, gone struct<a:int>")
    want = {
        ("id", "bigint", "int", "type_changed", 4),
        ("when", "timestamp", "timestamp_ntz", "type_changed", 3),
        ("gone", "struct<a:int>", None, "missing", 4),
        ("(file)", None, None, "unreadable", 1),
    }
    where = str(tmp_path / "t")
    assert {tuple(r) for r in drift.parquet_drift(spark, where, None, declared).collect()} == want
    by_opener = drift.parquet_drift(spark, where, None, declared, lambda path: open(path.removeprefix("file:"), "rb"))
    assert {tuple(r) for r in by_opener.collect()} == want
    # As it is done for a file system that executors cannot open by themselves.
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(where).select("path", "content")
    found = files.mapInArrow(drift._deviations(declared, None), drift._DRIFT)
    assert {tuple(r) for r in found.groupBy(*found.columns).count().collect()} == want
    assert drift.parquet_drift(spark, str(tmp_path / "nowhere"), None, declared).count() == 0


def test_json_drift_sees_unreadable_objects_and_numbers_out_of_range(spark):
    lines = [
        '{"event_id":"1","ts":"t","user_id":"u","payload":{"quantity":3000000000,"value":1}}',
        '{"event_id":"1","payload":{"sku":"a","sku":"b"}}',
        '{"event_id":"1"} and more',
        '{"payload":{"country":"a","session_id":"b","query":"c","sku":"d","quantity":12345678901234567890}}',
    ]
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    assert {tuple(r) for r in drift.json_drift(frame, RAW_DATA).collect()} == {
        ("payload.quantity", "BIGINT", "type_changed", 1),
        ("payload.quantity", "DECIMAL", "type_changed", 1),
        ("(line)", "OBJECT", "unreadable", 1),
    }


def test_json_drift_counts_every_deviating_line(spark):
    lines = [
        '{"event_id":"1","ts":"t","user_id":7,"payload":{"value":1,"quantity":2.5,"colour":"red"}}',
        '{"EVENT_ID":"2","ts":"t","payload":{"value":1.25,"quantity":null,"country":"US","sku":"s"}}',
        '{"event_id":"3","ts":"t","payload":["x"],"extra":{"a":1}}',
        "not json",
    ]
    frame = spark.createDataFrame([(line,) for line in lines], "value string")
    found = {tuple(r) for r in drift.json_drift(frame, RAW_DATA).collect()}
    assert found == {
        ("user_id", "BIGINT", "type_changed", 1),
        ("payload", "ARRAY", "type_changed", 1),
        ("payload.quantity", "DECIMAL", "type_changed", 1),
        ("payload.colour", "STRING", "added", 1),
        ("extra", "OBJECT", "added", 1),
        ("payload.session_id", None, "missing", 0),
        ("payload.query", None, "missing", 0),
    }


# Governance ------------------------------------------------------------------


@pytest.fixture
def resolved(spark):
    names = catalog.database_names("shop", "dev")
    columns = governance.columns_of(spark, names["curated"], "events", CURATED)
    return governance.resolve_tags(columns, governance.default_assignments(spark, names))


def test_column_tag_beats_table_tag_beats_database_tag(spark):
    columns = governance.columns_of(spark, "db", "t", T.StructType.fromDDL("a int, b int"))
    columns = columns.union(governance.columns_of(spark, "db", "u", T.StructType.fromDDL("a int")))
    rows = [
        ("db", None, None, "layer", "curated"),
        ("db", None, None, "sensitivity", "internal"),
        ("db", "t", None, "sensitivity", "public"),
        ("db", "t", "a", "sensitivity", "confidential"),
    ]
    found = governance.resolve_tags(columns, spark.createDataFrame(rows, TAG_ASSIGNMENT))
    assert {(r["table"], r["column"]): (r["layer"], r["sensitivity"]) for r in found.collect()} == {
        ("t", "a"): ("curated", "confidential"),
        ("t", "b"): ("curated", "public"),
        ("u", "a"): ("curated", "internal"),
    }


def test_analyst_sees_no_personal_column(spark, resolved, tmp_path):
    write_curated(table(spark, [row(1)]), str(tmp_path / "c"))
    view = governance.governed(read_curated(spark, str(tmp_path / "c")), resolved, governance.ANALYST)
    assert view.columns == [c for c in CURATED.fieldNames() if c not in ("user_id", "session_id")]
    with pytest.raises(AnalysisException, match="UNRESOLVED_COLUMN"):
        view.select("user_id")
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "user_id" not in plan and "session_id" not in plan


def test_engineer_sees_all_and_raw_is_granted_to_nobody(spark, resolved):
    frame = table(spark, [row(1)])
    assert governance.governed(frame, resolved, governance.ENGINEER).columns == CURATED.fieldNames()
    names = catalog.database_names("shop", "dev")
    raw = governance.resolve_tags(
        governance.columns_of(spark, names["raw"], "events", CURATED), governance.default_assignments(spark, names)
    )
    for grant in (governance.ANALYST, governance.ENGINEER):
        with pytest.raises(PermissionError):
            governance.governed(frame, raw, grant)


def test_only_engineers_may_write(spark, resolved, tmp_path):
    frame, path = table(spark, [row(1)]), str(tmp_path / "c")
    with pytest.raises(PermissionError):
        governance.governed_append(frame, resolved, governance.ANALYST, path)
    governance.governed_append(frame, resolved, governance.ENGINEER, path)
    governance.governed_append(frame, resolved, governance.ENGINEER, path)
    assert read_curated(spark, path).count() == 2


# Scan budget -----------------------------------------------------------------


def test_scan_bytes_counts_the_files_behind_a_filter(spark, tmp_path):
    root = str(tmp_path / "c")
    write_curated(table(spark, [row(1), row(2, "login"), row(3, day="06")]), root)
    whole = scan_budget.scan_bytes(spark, root).first()
    files = list((tmp_path / "c").rglob("*.parquet"))
    assert (whole["files"], whole["bytes"]) == (len(files), sum(f.stat().st_size for f in files))
    one = scan_budget.scan_bytes(spark, root, F.col("day") == "06").first()
    assert one["files"] == 1
    assert scan_budget.scan_bytes(spark, root, F.col("day") == "07").first()["bytes"] == 0


def test_scan_cap(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "c")
    write_curated(table(spark, [row(1)]), root)
    assert scan_budget.check_scan(spark, root, None) is None
    assert scan_budget.check_scan(spark, root, scan_budget.MIN_CAP_BYTES) > 0
    with pytest.raises(ValueError):
        scan_budget.check_scan(spark, root, scan_budget.MIN_CAP_BYTES - 1)
    monkeypatch.setattr(scan_budget, "MIN_CAP_BYTES", 1)
    with pytest.raises(scan_budget.ScanTooLarge):
        scan_budget.check_scan(spark, root, 10)
