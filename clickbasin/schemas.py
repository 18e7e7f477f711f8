"""Declared schemas and fixed values of the lakehouse tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Partition columns, in directory order.
PARTITION_KEYS = ["event_type", "year", "month", "day"]
DATE_KEYS = ["year", "month", "day"]

# Reject reasons of the quarantine.
MISSING_EVENT_ID = "missing_event_id"
UNPARSEABLE_TS = "unparseable_ts"

# Not Spark's default name: its JSON reader blanks a column of that name on the way back.
CORRUPT_COLUMN = "_malformed_line"
REASON_COLUMN = "_reject_reason"


def _strings(names: list[str]) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


PARTITION_FIELDS = _strings(PARTITION_KEYS)

# The payload is the union of the keys of all event types; absent keys are null.
PAYLOAD = T.StructType(
    [
        T.StructField("country", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("query", T.StringType()),
        T.StructField("sku", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
    ]
)

RAW_DATA = T.StructType(_strings(["event_id", "ts", "user_id"]) + [T.StructField("payload", PAYLOAD)])
RAW = T.StructType(RAW_DATA.fields + PARTITION_FIELDS)
RAW_LINES = T.StructType(_strings(["value"]) + PARTITION_FIELDS)

CURATED_DATA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("query", T.StringType()),
        T.StructField("sku", T.StringType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("processed_at", T.TimestampType()),
    ]
)
CURATED = T.StructType(CURATED_DATA.fields + PARTITION_FIELDS)

# Where a row came from: its raw file, and the run of incremental curation that first saw that file.
LINEAGE_FIELDS = [T.StructField("source_file", T.StringType()), T.StructField("batch", T.LongType())]
LINEAGE = ["source_file", "batch"]

# One row per constraint and verified partition.
RESULT = T.StructType(
    _strings(
        ["check", "check_level", "check_status", "constraint", "constraint_status", "constraint_message"]
    )
    + [T.StructField("rows_verified", T.LongType()), T.StructField("verified_at", T.TimestampType())]
)

METRIC = T.StructType(
    [
        T.StructField("namespace", T.StringType()),
        T.StructField("job_name", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("ts", T.TimestampType()),
    ]
)

TAG_ASSIGNMENT = T.StructType(_strings(["database", "table", "column", "tag", "tag_value"]))
