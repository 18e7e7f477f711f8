import glob

from conftest import DAY, STAMP, event

from clickbasin.functions.dates import ingest_day
from clickbasin.plans.curate import CurateOutcome, curate_day
from clickbasin.schemas import CURATED
from clickbasin.sources.curated import read_curated, read_curated_day
from clickbasin.sources.raw import read_raw


def run(spark, lake, **options):
    return curate_day(spark, lake, DAY, processed_at=STAMP, **options)


def contents(spark, root):
    return sorted(map(str, read_curated(spark, root).collect()))


def types_on_disk(root, day=DAY):
    return {path.split("event_type=")[1].split("/")[0] for path in glob.glob(f"{root}/event_type=*/{day.folder()}")}


def test_flatten_write_and_count(spark, lake, drop_lines):
    drop_lines(
        lake.raw,
        "purchase",
        [event("1", country="US", session_id="s", value=2.5, sku="k", quantity=3), event("1"), event(" "), "{"],
    )
    assert run(spark, lake) == CurateOutcome(4, 1, 2)
    table = read_curated_day(spark, lake.curated, DAY)
    assert table.schema == CURATED
    row = table.selectExpr("*", "CAST(processed_at AS STRING) AS stamp").first()
    assert (row["event_type"], row["year"], row["month"], row["day"]) == ("purchase", "2024", "03", "05")
    assert row["stamp"] == STAMP
    files = glob.glob(f"{lake.curated}/**/*.parquet", recursive=True)
    assert files and all(path.endswith(".snappy.parquet") for path in files)
    reasons = spark.read.json(lake.quarantine).select("_reject_reason", "_malformed_line").collect()
    assert set(map(tuple, reasons)) == {("missing_event_id", "{"), ("missing_event_id", None)}


def test_run_twice_gives_the_same(spark, lake, drop_lines):
    drop_lines(lake.raw, "search", [event("1"), event("2", ts="bad"), event("3")])
    first = run(spark, lake)
    before = contents(spark, lake.curated)
    assert run(spark, lake, keep_decoded=False) == first
    assert contents(spark, lake.curated) == before
    assert run(spark, lake, size_files=False) == first
    assert contents(spark, lake.curated) == before
    assert spark.read.json(lake.quarantine).count() == 1


def test_rerun_drops_partitions_that_vanished(spark, lake, drop_lines):
    next_day = ingest_day("2024-03-06")
    drop_lines(lake.raw, "search", [event("1")])
    drop_lines(lake.raw, "login", [event("2"), event("", user_id="bad")])
    drop_lines(lake.raw, "login", [event("2")], next_day)
    run(spark, lake)
    curate_day(spark, lake, next_day, processed_at=STAMP)
    drop_lines(lake.raw, "login", [])  # the file is now empty
    assert run(spark, lake) == CurateOutcome(1, 1, 0)
    assert types_on_disk(lake.curated) == {"search"}
    assert types_on_disk(lake.curated, next_day) == {"login"}
    assert types_on_disk(lake.quarantine) == set()


def test_type_that_loses_all_rows_to_deduplication_is_dropped_too(spark, lake, drop_lines):
    drop_lines(lake.raw, "login", [event("1", ts="2024-03-05T09:00:00Z")])
    run(spark, lake)
    assert types_on_disk(lake.curated) == {"login"}
    drop_lines(lake.raw, "search", [event("1", ts="2024-03-05T10:00:00Z")])
    assert run(spark, lake) == CurateOutcome(2, 1, 0)
    assert types_on_disk(lake.curated) == {"search"}


def test_only_bad_rows_leave_curated_untouched(spark, lake, drop_lines):
    drop_lines(lake.raw, "search", [event(None), event("2", ts="bad")])
    assert run(spark, lake) == CurateOutcome(2, 0, 2)
    assert read_curated(spark, lake.curated) is None
    assert types_on_disk(lake.quarantine) == {"search"}


def test_a_day_that_turns_all_invalid_loses_its_curated_rows(spark, lake, drop_lines):
    drop_lines(lake.raw, "search", [event("1"), event("2")])
    drop_lines(lake.raw, "search", [event("3")], ingest_day("2024-03-06"))
    run(spark, lake)
    curate_day(spark, lake, ingest_day("2024-03-06"), processed_at=STAMP)
    drop_lines(lake.raw, "search", [event(None)])
    assert run(spark, lake) == CurateOutcome(1, 0, 1)
    assert read_curated_day(spark, lake.curated, DAY).count() == 0
    assert types_on_disk(lake.curated) == set()
    assert [r["event_id"] for r in read_curated(spark, lake.curated).collect()] == ["3"]


def test_a_wider_raw_frame_touches_only_its_day(spark, lake, drop_lines):
    next_day = ingest_day("2024-03-06")
    for day in (DAY, next_day):
        drop_lines(lake.raw, "search", [event("1"), event(day.day)], day)
        curate_day(spark, lake, day, processed_at=STAMP)
    before = contents(spark, lake.curated)
    assert run(spark, lake, raw=read_raw(spark, lake.raw)) == CurateOutcome(2, 2, 0)
    assert contents(spark, lake.curated) == before and len(before) == 4


def test_no_rows_write_nothing(spark, lake, drop_lines):
    assert run(spark, lake) == CurateOutcome(0, 0, 0)
    drop_lines(lake.raw, "search", ["", "  "])
    assert run(spark, lake) == CurateOutcome(0, 0, 0)
    assert read_curated(spark, lake.curated) is None
    assert not glob.glob(f"{lake.quarantine}/*")


def test_null_event_type_and_odd_names_survive(spark, lake, drop_lines):
    drop_lines(lake.raw, "__HIVE_DEFAULT_PARTITION__", [event("1")])
    drop_lines(lake.raw, "a%3Ab c", [event("2")])
    run(spark, lake)
    run(spark, lake)
    rows = read_curated_day(spark, lake.curated, DAY).collect()
    assert {(row["event_id"], row["event_type"]) for row in rows} == {("1", None), ("2", "a:b c")}


def test_missing_table_and_empty_day_differ(spark, lake, drop_lines):
    assert read_curated_day(spark, lake.curated, DAY) is None
    drop_lines(lake.raw, "search", [event("1")])
    run(spark, lake)
    other = read_curated_day(spark, lake.curated, ingest_day("2024-04-01"))
    assert other is not None and other.isEmpty() and other.schema == CURATED


def test_hot_event_type_is_split_over_files(spark, lake, drop_lines):
    drop_lines(lake.raw, "search", [event(f"{n:032x}", session_id=f"{n * 7919:032x}") for n in range(6000)])
    sizes = ["advisoryPartitionSizeInBytes", "coalescePartitions.minPartitionSize"]
    for name in sizes:
        spark.conf.set(f"spark.sql.adaptive.{name}", "32k")
    try:
        assert run(spark, lake).curated_rows == 6000
    finally:
        for name in sizes:
            spark.conf.unset(f"spark.sql.adaptive.{name}")
    assert len(glob.glob(f"{lake.curated}/event_type=search/**/*.parquet", recursive=True)) > 1


def test_scattered_rejects_make_few_files(spark, lake, drop_lines):
    for part in range(12):
        drop_lines(lake.raw, "search", [event(f"{part}"), event(None)], name=f"part-{part}")
    spark.conf.set("spark.sql.files.openCostInBytes", "512m")  # a task per file
    try:
        assert run(spark, lake) == CurateOutcome(24, 12, 12)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(glob.glob(f"{lake.quarantine}/**/*.json", recursive=True)) == 1
