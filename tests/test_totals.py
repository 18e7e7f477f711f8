import glob
import os
import random

import pytest
from conftest import DAY
from pyspark.sql import functions as F
from test_reports import row, table

from clickbasin.functions.dates import ingest_day
from clickbasin.operators import distinct
from clickbasin.plans import dashboard, reports, totals
from clickbasin.plans.curate import write_curated
from clickbasin.sources.curated import read_curated
from clickbasin.sources.storage import replace_day

NEXT = ingest_day("2024-03-06")


def rows_of(frame):
    return [tuple(row) for row in frame.collect()]


def made(n, seed, day="05"):
    rng = random.Random(seed)
    kinds = ["search", "purchase", "add_to_cart", "login"]
    return [
        row(
            i, rng.choice(kinds), day=day, user_id=rng.choice([None, *"abcdefgh"]), session_id=rng.choice([None, *"pqrstuvwxyz"]),
            country=rng.choice([None, "US", "DE"]), value=rng.choice([None, 0.1, 0.2, 19.99]), query=rng.choice([None, "", "Shoe", "shoe", "Hat"]),
            sku=rng.choice([None, "s1", "s2"]), quantity=rng.choice([None, 1, 5]),
        )
        for i in range(n)
    ]


def all_equal(spark, lake):
    curated = read_curated(spark, lake.curated)
    for name in ("daily_event_counts", "revenue_by_date", "top_skus_by_quantity", "top_search_queries", "daily_active_users",
                 "events_by_country", "partition_freshness"):
        assert rows_of(getattr(totals, name)(spark, lake)) == rows_of(getattr(reports, name)(curated)), name
    for name in ("kpi_total_events", "kpi_total_value", "events_by_type", "daily_event_volume"):
        assert rows_of(getattr(totals, name)(spark, lake)) == rows_of(getattr(dashboard, name)(curated)), name
    month = lambda f, x: rows_of(f(*x, "2024", "03"))
    assert month(totals.revenue_by_type_country, (spark, lake)) == month(reports.revenue_by_type_country, (curated,))
    as_of = "2024-03-07 00:00:00"
    assert rows_of(totals.hourly_event_rate(spark, lake, as_of)) == rows_of(reports.hourly_event_rate(curated, as_of))


def stamped(spark, rows):
    frame = table(spark, rows)
    hour = F.expr("make_interval(0, 0, 0, 0, CAST(event_id AS INT) % 40)")
    frame = frame.withColumn("event_ts", F.lit("2024-03-05 01:10:00").cast("timestamp") + hour)
    return frame.withColumn("processed_at", F.coalesce("processed_at", F.lit("2024-03-08 00:00:00").cast("timestamp")))


def test_totals_give_what_the_events_give_also_after_reruns(spark, lake):
    write_curated(stamped(spark, made(120, 1) + made(80, 2, "06")), lake.curated)
    assert totals.refresh_totals(spark, lake)
    all_equal(spark, lake)
    # A rerun of one day, with other rows; the other day's totals are not touched.
    before = {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{lake.totals}/*/{NEXT.folder()}/*.parquet")}
    assert len(before) >= 7
    replace_day(spark, lake.curated, DAY, lambda path: write_curated(stamped(spark, made(50, 3)), path))
    assert totals.refresh_totals(spark, lake, DAY)
    assert {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{lake.totals}/*/{NEXT.folder()}/*.parquet")} == before
    all_equal(spark, lake)
    # Twice the same changes nothing; a day that is gone has no totals.
    totals.refresh_totals(spark, lake, DAY)
    all_equal(spark, lake)
    replace_day(spark, lake.curated, DAY, lambda path: None)
    totals.refresh_totals(spark, lake, DAY)
    assert not glob.glob(f"{lake.totals}/*/{DAY.folder()}")
    all_equal(spark, lake)


def test_nothing_there(spark, lake):
    assert not totals.refresh_totals(spark, lake) and not totals.refresh_totals(spark, lake, DAY)
    with pytest.raises(FileNotFoundError):
        totals.kpi_total_events(spark, lake)


def test_numbers_are_dense_and_stay(spark, tmp_path):
    root = str(tmp_path / "d")
    name = lambda n: spark.range(n).select(F.concat(F.lit("m"), "id").alias("member"))
    distinct.number_members(name(1000).union(name(10)), root)
    first = {r.member: r.number for r in distinct.read_dictionary(spark, root).collect()}
    assert len(set(first.values())) == 1000 and max(first.values()) < 2 * 1000
    distinct.number_members(name(3000).union(spark.createDataFrame([(None,)], "member string")), root)
    rows = distinct.read_dictionary(spark, root).collect()
    second = {r.member: r.number for r in rows}
    assert len(rows) == len(second) == len(set(second.values())) == 3000
    assert first.items() <= second.items()


@pytest.mark.parametrize("listed", [0, 5, 1000])
def test_sets_of_any_size_are_counted_exactly(spark, tmp_path, monkeypatch, listed):
    monkeypatch.setattr(distinct, "LISTED", listed)
    monkeypatch.setattr(distinct, "CUTS", 3)
    root = str(tmp_path / "d")
    rows = spark.range(90_000).select((F.col("id") % 5).alias("k"), (F.col("id") * F.col("id") % 70_001).cast("string").alias("m"))
    rows = rows.union(spark.range(40).selectExpr("9 AS k", "CAST(id % 7 AS STRING) AS m")).union(spark.sql("SELECT 9, CAST(NULL AS STRING)"))
    distinct.number_members(rows.select(F.col("m").alias("member")), root)
    dictionary = distinct.read_dictionary(spark, root)
    # Two days whose sets overlap.
    halves = [distinct.sets(rows.where(part), ["k"], "m", dictionary) for part in (F.col("k") < 4, F.col("k") > 1)]
    found = distinct.count_members(halves[0].unionByName(halves[1]), ["k"], "n")
    want = rows.where(F.col("m").isNotNull()).groupBy("k").agg(F.countDistinct("m").alias("n"))
    assert sorted(rows_of(found)) == sorted(rows_of(want))
    assert rows_of(distinct.count_members(halves[0].unionByName(halves[1]), [], "n")) == rows_of(rows.agg(F.countDistinct("m")))
