"""Tables whose days are replaced at one moment.

Rows are written to a new folder, a version, which may hold several days, and a marker, one small file a day, says
which version is the day's. Replacing the marker is what readers notice: they see all of the old rows or all of the new ones,
also when a run stops half way, and folders that markers no longer name stay until ``vacuum``.

    <root>/data/version=<number>/event_type=…/year=…/month=…/day=…/
    <root>/live/<day>

``start`` makes a table of this kind; curation, quality, dashboard and catalog notice it by the folder ``live``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from clickbasin.functions.dates import IngestDay
from clickbasin.session import small_frame

# Fixed value: what a marker says of a day without rows.
NO_ROWS = "-"


def _hadoop(spark: SparkSession):
    return spark._jvm.org.apache.hadoop.fs


def _path(spark: SparkSession, *parts: str):
    return _hadoop(spark).Path("/".join(part.rstrip("/") for part in parts))


def _system(spark: SparkSession, root: str):
    return _path(spark, root).getFileSystem(spark._jsc.hadoopConfiguration())


def start(spark: SparkSession, root: str) -> None:
    """Make ``root``, which must not hold another table, one whose days have versions."""
    system = _system(spark, root)
    if system.exists(_path(spark, root)) and not is_versioned(spark, root):
        raise ValueError(f"{root} holds a table without versions")
    system.mkdirs(_path(spark, root, "live"))


def is_versioned(spark: SparkSession, root: str) -> bool:
    return _system(spark, root).exists(_path(spark, root, "live"))


def folder(root: str, version: str) -> str:
    return f"{root.rstrip('/')}/data/version={version}"


def live_versions(spark: SparkSession, root: str) -> dict[IngestDay, str]:
    """Day to version, of the days that have rows: one short line a day."""
    rows = spark.read.schema("value string").text(f"{root.rstrip('/')}/live").select("value", "_metadata.file_name").collect()
    return {IngestDay(*row.file_name.split("-")): row.value for row in rows if row.value != NO_ROWS}


def live_version(spark: SparkSession, root: str, day: IngestDay) -> str | None:
    """The version of one day; only its marker is looked at."""
    marker = _path(spark, root, "live", day.iso())
    if not _system(spark, root).exists(marker):
        return None
    text = spark.read.text(marker.toString()).first()["value"]
    return None if text == NO_ROWS else text


def commit(spark: SparkSession, root: str, day: IngestDay, version: str | None) -> None:
    """Make ``version`` the day's, or leave the day without rows.

    The marker is written beside its place and then moved over the old one, which file systems do at once.
    """
    fs, system = _hadoop(spark), _system(spark, root)
    beside = _path(spark, root, "moving", uuid.uuid4().hex)
    out = system.create(beside, True)
    out.write(bytearray((version or NO_ROWS).encode()))
    out.close()
    options = spark._sc._gateway.new_array(fs.Options.Rename, 1)
    options[0] = fs.Options.Rename.OVERWRITE
    context = fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(beside, _path(spark, root, "live", day.iso()), options)


def day_folders(root: str, day: IngestDay, version: str) -> str:
    """A pattern of a day's partition folders in a version."""
    return f"{folder(root, version)}/event_type=*/{day.folder()}"


def replace_days(spark: SparkSession, root: str, days: Iterable[IngestDay], write: Callable[[str], None]) -> None:
    """Let ``write`` fill a new version, then make it that of each of these days; a day it has no rows of is left without."""
    version = uuid.uuid4().hex
    write(folder(root, version))
    system = _system(spark, root)
    for day in days:
        there = system.globStatus(_path(spark, day_folders(root, day, version)))
        commit(spark, root, day, version if there else None)


def read_versions(
    spark: SparkSession, root: str, schema: T.StructType, versions: dict[IngestDay, str], how: str = "parquet"
) -> DataFrame:
    """The rows of these days' versions, which nothing changes any more."""
    there = [day_folders(root, day, version) for day, version in sorted(versions.items())]
    if not there:
        return small_frame(spark, [], schema)
    reader = spark.read.schema(schema).option("basePath", f"{root.rstrip('/')}/data")
    return reader.format(how).load(there).select(*schema.fieldNames())


def vacuum(spark: SparkSession, root: str, older_than_seconds: float = 86_400) -> int:
    """Remove versions that no marker names and that are older than any reader or writer still at work; how many."""
    live, system, removed = set(live_versions(spark, root).values()), _system(spark, root), 0
    for status in system.globStatus(_path(spark, root, "data", "version=*")) or []:
        version = status.getPath().getName().removeprefix("version=")
        if version not in live and status.getModificationTime() / 1000 < time.time() - older_than_seconds:
            system.delete(status.getPath(), True)
            removed += 1
    return removed
