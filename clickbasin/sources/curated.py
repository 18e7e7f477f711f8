"""Scans of the curated layer: Parquet under event_type/year/month/day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickbasin.functions.dates import IngestDay
from clickbasin.schemas import CURATED, LINEAGE_FIELDS
from clickbasin.session import small_frame
from clickbasin.sources import versions
from clickbasin.sources.storage import day_glob, exists, glob


def read_curated(spark: SparkSession, root: str) -> DataFrame | None:
    """The whole curated table, or ``None`` before its first write."""
    return _read(spark, root, CURATED)


def _read(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame | None:
    if not exists(spark, root):
        return None
    if versions.is_versioned(spark, root):
        return versions.read_versions(spark, root, schema, versions.live_versions(spark, root))
    return spark.read.schema(schema).parquet(root)


def read_lineage(spark: SparkSession, root: str) -> DataFrame | None:
    """The curated table with the raw file and the batch of each row; both null where curation did not keep them."""
    return _read(spark, root, T.StructType([*CURATED.fields, *LINEAGE_FIELDS]))


def read_curated_day(spark: SparkSession, root: str, day: IngestDay) -> DataFrame | None:
    """One ingest day: ``None`` when the table is missing, empty when the day is.

    Only the folders of that day are listed.
    """
    if not exists(spark, root):
        return None
    if versions.is_versioned(spark, root):
        version = versions.live_version(spark, root, day)
        return versions.read_versions(spark, root, CURATED, {} if version is None else {day: version})
    if not glob(spark, day_glob(root, day)):
        return small_frame(spark, [], CURATED)
    return spark.read.schema(CURATED).option("basePath", root).parquet(day_glob(root, day))
