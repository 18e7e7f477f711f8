"""Databases, external tables and partition registration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickbasin.functions.dates import IngestDay
from clickbasin.plans.paths import LakePaths
from clickbasin.schemas import CURATED, DATE_KEYS, PARTITION_KEYS, RAW, RAW_LINES
from clickbasin.sources.storage import NULL_PARTITION, day_folders, folder_event_type
from clickbasin.sources.versions import is_versioned

TABLE = "events"


def database_names(project: str, environment: str) -> dict[str, str]:
    prefix = f"{project}_{environment}".replace("-", "_")
    return {layer: f"{prefix}_{layer}" for layer in ["raw", "staging", "curated"]}


def _create(spark: SparkSession, name: str, schema: T.StructType, how: str, path: str) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {how} "
        f"PARTITIONED BY ({', '.join(PARTITION_KEYS)}) LOCATION '{path}'"
    )


def create_tables(
    spark: SparkSession, names: dict[str, str], lake: LakePaths, *, parquet: bool = False
) -> None:
    """Declare the three databases and the raw and curated external tables.

    The raw table holds lines of text, for ``read_raw_table`` to decode with the tolerance
    that file scans have; with ``parquet``, what the converting ingest writes.

    Dropping a database deletes its folder, so the databases get folders apart
    from the data, which outlives them.
    """
    for database in names.values():
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{lake.catalog}/{database}'")
    if parquet:
        _create(spark, f"{names['raw']}.{TABLE}", RAW, "parquet", lake.raw)
    else:
        _create(spark, f"{names['raw']}.{TABLE}", RAW_LINES, "text", lake.raw)
    _create(
        spark, f"{names['curated']}.{TABLE}", CURATED, "parquet OPTIONS (compression 'snappy')", lake.curated
    )


def location(spark: SparkSession, table: str) -> str:
    """The folder of a catalogued table."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    return described.where(F.col("col_name") == "Location").first()["data_type"]


def register_all(spark: SparkSession, table: str) -> None:
    """Register every partition folder, old and new."""
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")


def register_day(spark: SparkSession, table: str, root: str, day: IngestDay) -> int:
    """``register_days`` of one day."""
    return register_days(spark, table, root, [day])


def register_days(spark: SparkSession, table: str, root: str, days: Sequence[IngestDay]) -> int:
    """Bring some days' registered partitions in line with these days' folders.

    New folders are added, partitions whose folder a rerun removed are dropped, and where days have
    versions a partition is moved to the folder of the live one; the table's columns stay as declared, whatever
    the files contain. Only these days' folders are listed. The catalog is asked once, and told once of what is new
    and once of what is gone, however many days there are. Returns the number of partitions the days have.
    """
    folders = {(folder_event_type(folder), day): folder for day in days for folder in day_folders(spark, root, day)}
    shown = f"SHOW PARTITIONS {table}" + (f" PARTITION ({_date(days[0])})" if len(days) == 1 else "")
    wanted = set(days)
    # A row a partition: names, no rows of the table.
    known = [(folder_event_type(row["partition"]), _folder_day(row["partition"])) for row in spark.sql(shown).collect()]
    registered = {found for found in known if found[1] in wanted}
    spec = lambda found: f"PARTITION (event_type = {_literal(found[0])}, {_date(found[1])})"
    added = [f"{spec(found)} LOCATION {_literal(folders[found])}" for found in folders if found not in registered]
    gone = [spec(found) for found in registered - folders.keys()]
    if added:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(added)}")
    if is_versioned(spark, root):
        for found in registered & folders.keys():
            spark.sql(f"ALTER TABLE {table} {spec(found)} SET LOCATION {_literal(folders[found])}")
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(gone)}")
    spark.catalog.refreshTable(table)
    return len(folders)


def _date(day: IngestDay) -> str:
    return f"year = '{day.year}', month = '{day.month}', day = '{day.day}'"


def _folder_day(folder: str) -> IngestDay:
    found = dict(part.split("=", 1) for part in folder.split("/") if "=" in part)
    return IngestDay(*(found[name] for name in DATE_KEYS))


def _literal(text: str | None) -> str:
    if text is None:
        return "null"
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def partitions(spark: SparkSession, table: str) -> DataFrame:
    """The registered partitions, one column per key, with their real values."""

    def value(key: str) -> Column:
        text = F.regexp_extract("partition", rf"(?:^|/){key}=([^/]*)", 1)
        # Folder names escape special characters as %XX; a plus sign is itself.
        plain = F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))
        return F.when(text != NULL_PARTITION, plain)

    spec = spark.sql(f"SHOW PARTITIONS {table}")
    return spec.select(*[value(key).alias(key) for key in PARTITION_KEYS])
