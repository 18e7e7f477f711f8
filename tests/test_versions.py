import glob
import os
import threading

import pytest
from conftest import DAY, STAMP, event
from pyspark.sql import functions as F
from test_reports import row, table

from clickbasin.functions.dates import ingest_day
from clickbasin.plans import catalog
from clickbasin.plans.curate import curate_day, read_quarantine, write_curated
from clickbasin.plans.dashboard import read_dataset, refresh_dataset
from clickbasin.plans.quality_run import verify_day
from clickbasin.sources import versions
from clickbasin.sources.curated import read_curated, read_curated_day
from clickbasin.sources.storage import replace_day

NEXT = ingest_day("2024-03-06")


@pytest.fixture
def versioned(spark, lake):
    for root in (lake.curated, lake.quarantine, lake.dataset):
        versions.start(spark, root)
    return lake


def ids(frame):
    return sorted(r["event_id"] for r in frame.collect())


def test_curation_writes_and_reads_versions(spark, versioned, drop_lines):
    drop_lines(versioned.raw, "search", [event("1"), event("2"), event(" ")])
    drop_lines(versioned.raw, "login", [event("3")])
    drop_lines(versioned.raw, "login", [event("4")], day=NEXT)
    assert curate_day(spark, versioned, DAY, processed_at=STAMP).curated_rows == 3
    curate_day(spark, versioned, NEXT, processed_at=STAMP)
    assert ids(read_curated(spark, versioned.curated)) == ["1", "2", "3", "4"]
    assert ids(read_curated_day(spark, versioned.curated, DAY)) == ["1", "2", "3"]
    assert ids(read_curated_day(spark, versioned.curated, ingest_day("2024-03-09"))) == []
    assert ids(read_quarantine(spark, versioned.quarantine)) == [" "]
    assert verify_day(spark, versioned, DAY, verified_at=STAMP).rows_verified == 3

    # Types and rows that are gone from raw are gone from the day, and from the quarantine, at one moment.
    for path in glob.glob(f"{versioned.raw}/event_type=login/{DAY.folder()}/*"):
        os.remove(path)
    drop_lines(versioned.raw, "search", [event("1"), event("5")])
    curate_day(spark, versioned, DAY, processed_at=STAMP)
    assert ids(read_curated(spark, versioned.curated)) == ["1", "4", "5"]
    assert ids(read_quarantine(spark, versioned.quarantine)) == []
    drop_lines(versioned.raw, "search", [event(" ")])
    assert curate_day(spark, versioned, DAY, processed_at=STAMP).curated_rows == 0
    assert ids(read_curated(spark, versioned.curated)) == ["4"]


def test_a_run_that_stops_half_way_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "t")
    versions.start(spark, root)
    replace_day(spark, root, DAY, lambda path: write_curated(table(spark, [row(1), row(2, "login")]), path))

    def stops(path):
        write_curated(table(spark, [row(9)]), path)
        raise OSError("lost")

    with pytest.raises(OSError):
        replace_day(spark, root, DAY, stops)
    assert ids(read_curated(spark, root)) == ["1", "2"]
    # It may also stop between the write and the marker.
    monkeypatch.setattr(versions, "commit", lambda *args: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        replace_day(spark, root, DAY, lambda path: write_curated(table(spark, [row(8)]), path))
    monkeypatch.undo()
    assert ids(read_curated(spark, root)) == ["1", "2"]
    replace_day(spark, root, DAY, lambda path: write_curated(table(spark, [row(7)]), path))
    assert ids(read_curated(spark, root)) == ["7"]


def test_a_reader_keeps_what_it_began_with(spark, tmp_path):
    root = str(tmp_path / "t")
    versions.start(spark, root)
    replace_day(spark, root, DAY, lambda path: write_curated(table(spark, [row(n) for n in range(50)]), path))
    begun = read_curated(spark, root)
    replace_day(spark, root, DAY, lambda path: write_curated(table(spark, [row(99)]), path))
    assert begun.count() == 50 and read_curated(spark, root).count() == 1
    # Too young to go; then what no marker names goes.
    assert versions.vacuum(spark, root) == 0
    assert versions.vacuum(spark, root, older_than_seconds=-60) == 1
    assert ids(read_curated(spark, root)) == ["99"]


def test_readers_beside_a_writer_see_whole_versions(spark, tmp_path):
    root, seen, stop = str(tmp_path / "t"), [], threading.Event()
    versions.start(spark, root)
    write = lambda n: replace_day(spark, root, DAY, lambda path: write_curated(
        table(spark, [row(i, kind, session_id=str(n)) for i in range(4) for kind in ("search", "login")]), path))
    write(0)

    def read():
        while not stop.is_set():
            rows = read_curated(spark, root).select("event_type", "session_id").collect()
            seen.append((len(rows), len({r.session_id for r in rows})))

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(1, 6):
        write(n)
    stop.set()
    reader.join()
    assert set(seen) == {(8, 1)}


def test_dashboard_and_catalog_follow(spark, versioned, drop_lines):
    for day, names in ((DAY, "12"), (NEXT, "3")):
        drop_lines(versioned.raw, "search", [event(n) for n in names], day=day)
        curate_day(spark, versioned, day, processed_at=STAMP)
    refresh_dataset(spark, versioned.curated, versioned.dataset)
    assert ids(read_dataset(spark, versioned.dataset)) == ["1", "2", "3"]
    names = catalog.database_names("versions-test", "dev")
    catalog.create_tables(spark, names, versioned)
    try:
        name = f"{names['curated']}.{catalog.TABLE}"
        assert catalog.register_day(spark, name, versioned.curated, DAY) == 1
        assert ids(spark.table(name)) == ["1", "2"]
        drop_lines(versioned.raw, "search", [event("1"), event("6")])
        curate_day(spark, versioned, DAY, processed_at=STAMP)
        refresh_dataset(spark, versioned.curated, versioned.dataset, DAY)
        assert ids(read_dataset(spark, versioned.dataset)) == ["1", "3", "6"]
        catalog.register_day(spark, name, versioned.curated, DAY)
        assert ids(spark.table(name)) == ["1", "6"]
    finally:
        for database in names.values():
            spark.sql(f"DROP DATABASE {database} CASCADE")
    refresh_dataset(spark, versioned.curated, versioned.dataset)
    assert ids(read_dataset(spark, versioned.dataset)) == ["1", "3", "6"]


def test_other_tables_are_not_taken_over(spark, tmp_path):
    root = str(tmp_path / "t")
    write_curated(table(spark, [row(1)]), root)
    with pytest.raises(ValueError):
        versions.start(spark, root)
    empty = str(tmp_path / "empty")
    versions.start(spark, empty)
    versions.start(spark, empty)
    assert read_curated(spark, empty).count() == 0
    assert read_curated(spark, empty).columns == read_curated(spark, root).columns
    assert read_curated(spark, root).where(F.col("event_id") == "1").count() == 1
