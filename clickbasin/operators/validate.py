"""Row validation: a verdict per raw row, then the accepted and rejected shapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickbasin.schemas import (
    CURATED,
    MISSING_EVENT_ID,
    PARTITION_KEYS,
    PAYLOAD,
    REASON_COLUMN,
    UNPARSEABLE_TS,
)

_PARSED_TS = "_event_ts"


def with_verdict(raw: DataFrame) -> DataFrame:
    """Add the parsed time and the reject reason (null when the row is good).

    The id is looked at first, so a row with both faults counts as a missing id.
    ``try_to_timestamp`` keeps a bad text from failing the query under ANSI mode.
    """
    no_id = F.col("event_id").isNull() | (F.trim("event_id") == "")
    return raw.withColumn(_PARSED_TS, F.try_to_timestamp("ts")).withColumn(
        REASON_COLUMN,
        F.when(no_id, MISSING_EVENT_ID).when(F.col(_PARSED_TS).isNull(), UNPARSEABLE_TS),
    )


def flatten(judged: DataFrame, processed_at: Column, keep: Sequence[str] = ()) -> DataFrame:
    """The fixed curated columns, in their declared order and types, and behind them those to keep."""
    sources = {
        "event_id": F.col("event_id"),
        "event_ts": F.col(_PARSED_TS),
        "user_id": F.col("user_id"),
        "processed_at": processed_at,
        **{name: F.col("payload").getField(name) for name in PAYLOAD.fieldNames()},
        **{name: F.col(name) for name in PARTITION_KEYS},
    }
    return judged.select(
        *[sources[field.name].try_cast(field.dataType).alias(field.name) for field in CURATED.fields], *keep
    )


def accepted(judged: DataFrame, processed_at: Column, keep: Sequence[str] = ()) -> DataFrame:
    return flatten(judged.where(F.col(REASON_COLUMN).isNull()), processed_at, keep)


def rejected(judged: DataFrame) -> DataFrame:
    """Rejected rows with all their raw columns and the reason."""
    return judged.where(F.col(REASON_COLUMN).isNotNull()).drop(_PARSED_TS)
