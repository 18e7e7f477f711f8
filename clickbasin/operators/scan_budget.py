"""A cap on the bytes a query may scan, checked before it runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickbasin.schemas import PARTITION_FIELDS, PARTITION_KEYS
from clickbasin.session import small_frame
from clickbasin.sources.storage import glob

# Fixed value: the smallest cap that can be set.
MIN_CAP_BYTES = 10 * 1024 * 1024

_FILES = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)
PARTITIONED_FILES = T.StructType(_FILES.fields + PARTITION_FIELDS)


class ScanTooLarge(RuntimeError):
    pass


def partition_glob(keys: dict[str, Sequence[str]]) -> str:
    """The folders of the given partition values as a pattern."""
    return "/".join(f"{name}={{{','.join(keys[name])}}}" if name in keys else f"{name}=*" for name in PARTITION_KEYS)


def scan_files(spark: SparkSession, path: str, keys: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """A row per file a scan would open, with its partition values and ``length``.

    With ``keys`` only the folders of those partitions are listed. No file is opened, as
    the content column is not asked for.
    """
    reader = spark.read.format("binaryFile").schema(PARTITIONED_FILES)
    if not keys:
        return reader.load(path)
    pattern = f"{path.rstrip('/')}/{partition_glob(keys)}"
    if not glob(spark, pattern):
        return small_frame(spark, [], PARTITIONED_FILES)
    return reader.option("basePath", path).load(pattern)


def scan_partitions(spark: SparkSession, path: str, keys: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """The partitions a filter leaves."""
    return scan_files(spark, path, keys).select(*PARTITION_KEYS).distinct()


def scan_bytes(
    spark: SparkSession, path: str, where: Column | None = None, keys: dict[str, Sequence[str]] | None = None
) -> DataFrame:
    """``files, bytes`` of the files a scan would open.

    An upper bound: whole files, whatever columns the query reads. ``keys`` are partition
    values, ``where`` may be any condition on the partition columns.
    """
    files = scan_files(spark, path, keys)
    if where is not None:
        files = files.where(where)
    return files.agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0).cast("long")).alias("bytes")
    )


def check_scan(
    spark: SparkSession,
    path: str,
    cap_bytes: int | None,
    where: Column | None = None,
    keys: dict[str, Sequence[str]] | None = None,
) -> int | None:
    """Raise when the scan is over the cap; ``None`` turns the check off."""
    if cap_bytes is None:
        return None
    if cap_bytes < MIN_CAP_BYTES:
        raise ValueError(f"a cap must be at least {MIN_CAP_BYTES} bytes")
    needed = scan_bytes(spark, path, where, keys).first()["bytes"]
    if needed > cap_bytes:
        raise ScanTooLarge(f"the query would scan up to {needed} bytes, the cap is {cap_bytes}")
    return needed
