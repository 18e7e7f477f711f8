"""Folder handling through the Hadoop file system the session already uses.

These touch folder and file names of one ingest day, never file contents.
"""

from __future__ import annotations

from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import SparkSession

from clickbasin.functions.dates import IngestDay
from clickbasin.sources import versions

# Fixed value: the folder name Spark writes for a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _path(spark: SparkSession, text: str):
    return spark._jvm.org.apache.hadoop.fs.Path(text)


def _file_system(spark: SparkSession, text: str):
    return _path(spark, text).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def scheme(spark: SparkSession, path: str) -> str:
    """The kind of file system a path is on, such as ``file`` or ``s3a``."""
    return _file_system(spark, path).getUri().getScheme()


def glob(spark: SparkSession, pattern: str) -> list[str]:
    found = _file_system(spark, pattern).globStatus(_path(spark, pattern))
    return [status.getPath().toString() for status in found or []]


def delete(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(_path(spark, path), True)


def any_file(spark: SparkSession, folder: str) -> str | None:
    listing = _file_system(spark, folder).listFiles(_path(spark, folder), False)
    return listing.next().getPath().toString() if listing.hasNext() else None


ALL_DAYS = "event_type=*/year=*/month=*/day=*"


def day_glob(root: str, day: IngestDay) -> str:
    return f"{root.rstrip('/')}/event_type=*/{day.folder()}"


def folder_event_type(folder: str) -> str | None:
    """The event type a partition folder stands for."""
    name = next(part for part in folder.split("/") if part.startswith("event_type="))
    value = unquote(name.removeprefix("event_type="))
    return None if value == NULL_PARTITION else value


def partition_folders(spark: SparkSession, root: str) -> set[str]:
    """All partition folders below ``root``, relative to it; one listing, and none of their files."""
    depth = ALL_DAYS.count("/") + 1
    if versions.is_versioned(spark, root):
        live = versions.live_versions(spark, root).items()
        found = [path for day, version in live for path in glob(spark, versions.day_folders(root, day, version))]
    else:
        found = glob(spark, f"{root.rstrip('/')}/{ALL_DAYS}")
    return {"/".join(path.split("/")[-depth:]) for path in found}


def day_folders(spark: SparkSession, root: str, day: IngestDay) -> list[str]:
    """The partition folders that hold a day's rows now."""
    if versions.is_versioned(spark, root):
        version = versions.live_version(spark, root, day)
        return [] if version is None else glob(spark, versions.day_folders(root, day, version))
    return glob(spark, day_glob(root, day))


def replace_day(spark: SparkSession, root: str, day: IngestDay, write: Callable[[str], None]) -> None:
    """Let ``write``, a dynamic overwrite below the path it is given, say what the day's folders hold.

    A table with versions (see ``sources.versions``) changes at one moment. In another the output replaces
    files in place: dynamic overwrite leaves alone the partitions it produces no row for, and a
    partition that still has a file from before the write is such a leftover, which goes.
    Nothing is removed when the write fails.
    """
    if versions.is_versioned(spark, root):
        versions.replace_days(spark, root, [day], write)
        return
    before = {folder: any_file(spark, folder) for folder in glob(spark, day_glob(root, day))}
    write(root)
    for folder, file in before.items():
        if any_file(spark, folder) is None if file is None else exists(spark, file):
            delete(spark, folder)


def _listed(spark: SparkSession, folder: str):
    """Status by status, the files directly in a folder."""
    system, path = _file_system(spark, folder), _path(spark, folder)
    if system.exists(path):
        listing = system.listFiles(path, False)
        while listing.hasNext():
            yield listing.next()


def newest_time(spark: SparkSession, folder: str) -> float:
    """When the newest file of a folder was written, by the file system's clock; 0 without files."""
    return max((status.getModificationTime() / 1000 for status in _listed(spark, folder)), default=0.0)


def waiting_bytes(spark: SparkSession, folder: str, since: float) -> int:
    """Bytes of a folder's files that were written after a moment of the file system's clock."""
    return sum(status.getLen() for status in _listed(spark, folder) if status.getModificationTime() / 1000 > since)
