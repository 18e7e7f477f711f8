"""Scans of the raw layer: gzip JSON lines under event_type/year/month/day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickbasin.functions.dates import IngestDay
from clickbasin.functions.json_lines import decode, decode_unread, is_blank, merge_decoded
from clickbasin.schemas import CORRUPT_COLUMN, LINEAGE, RAW, RAW_DATA, RAW_LINES
from clickbasin.sources.storage import day_glob, glob

# Formats of raw files.
LINES, PARQUET = "lines", "parquet"



def decode_lines(lines: DataFrame, *, any_case: bool = True) -> DataFrame:
    """Decode a ``value`` column of JSON text into the raw columns.

    Every non-blank line gives one row, however broken it is. Columns beside
    ``value`` (the partition columns) pass through.
    """
    others = [name for name in lines.columns if name != "value"]
    line, decoded = F.col("value"), F.col("_decoded")
    # Generating a column, rather than projecting it, keeps later expressions and
    # filters from repeating the parse behind it.
    rows = lines.where(~is_blank(line)).select(
        "value", *others, F.explode(F.array(decode(line, RAW_DATA))).alias("_decoded")
    )
    corrupt = decoded[CORRUPT_COLUMN].alias(CORRUPT_COLUMN)
    if not any_case:
        return rows.select(*[decoded[name].alias(name) for name in RAW_DATA.fieldNames()], *others, corrupt)
    again = decode_unread(line, F.col("_lowered"), decoded)
    rows = rows.withColumn("_lowered", F.lower(line)).select(
        "_decoded", *others, F.explode(F.array(again)).alias("_again")
    )
    return rows.select(*merge_decoded(decoded, F.col("_again")), *others, corrupt)


def read_raw(spark: SparkSession, root: str, *, any_case: bool = True) -> DataFrame:
    """All raw events below ``root``."""
    return decode_lines(spark.read.schema(RAW_LINES).text(root), any_case=any_case)


class UnexpectedFormat(ValueError):
    """A day's raw files are not all in the format that was expected."""


def raw_format(spark: SparkSession, root: str, day: IngestDay) -> str | None:
    """``lines`` or ``parquet``, by the names of the day's files; ``None`` when there are none."""
    names = [path.rsplit("/", 1)[-1] for path in glob(spark, f"{day_glob(root, day)}/*")]
    kinds = {PARQUET if name.endswith(".parquet") else LINES for name in names if name[0] not in "._"}
    if len(kinds) > 1:
        raise UnexpectedFormat(f"the raw files of {day.iso()} are partly Parquet and partly lines")
    return kinds.pop() if kinds else None


def _source_file() -> Column:
    """The file of a row, spelled as file listings spell it."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))).alias(LINEAGE[0])


def read_raw_day(
    spark: SparkSession,
    root: str,
    day: IngestDay,
    *,
    any_case: bool = True,
    parquet: bool | None = None,
    with_file: bool = False,
) -> DataFrame | None:
    """One ingest day, all event types; ``None`` when nothing landed that day.

    Only the folders of that day are listed, so the cost does not grow with the
    age of the lake. The files tell whether they hold lines or, from the converting
    ingest, Parquet; a day that mixes both is refused, and so is one that is not what
    ``parquet`` says. ``with_file`` adds the file of each row as ``source_file``.
    """
    found = raw_format(spark, root, day)
    if found is None:
        return None
    if parquet is not None and parquet != (found == PARQUET):
        raise UnexpectedFormat(f"the raw files of {day.iso()} are {found}")
    reader = spark.read.option("basePath", root)
    more = [_source_file()] if with_file else []
    if found == PARQUET:
        return _as_raw(reader.schema(RAW).parquet(day_glob(root, day)), *more)
    return decode_lines(reader.schema(RAW_LINES).text(day_glob(root, day)).select("*", *more), any_case=any_case)


def _as_raw(rows: DataFrame, *more: Column) -> DataFrame:
    """Rows of the converting ingest, none of which is malformed."""
    return rows.select(*RAW.fieldNames(), F.lit(None).cast("string").alias(CORRUPT_COLUMN), *more)


def read_raw_table(table: DataFrame, *, any_case: bool = True) -> DataFrame:
    """The raw columns of a catalogued raw table, whichever format it was created for.

    A table of lines is decoded as files are, with the same tolerance. Filters on the
    partition columns reach the scan.
    """
    if "value" in table.columns:
        return decode_lines(table, any_case=any_case)
    return _as_raw(table)


def scan_raw_day(table: DataFrame, day: IngestDay, *, any_case: bool = True) -> DataFrame:
    """One ingest day of a catalogued raw table, by partition pruning."""
    return read_raw_table(table.where(day.condition()), any_case=any_case)
