"""The saved reports over the curated events table.

Each takes the curated frame and returns a lazy result. Filters are plain
comparisons on columns so that they reach the scan (``event_type`` and the date
parts as partition filters, the rest as Parquet filters).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickbasin.functions.dates import clock
from clickbasin.operators.money import average, total
from clickbasin.schemas import DATE_KEYS

# Event types the reports ask for, and the length of ranked lists.
PURCHASE = "purchase"
SALES_TYPES = ["add_to_cart", "purchase"]
SEARCH = "search"
LIST_LENGTH = 50

# The partitions that reports read, where it is not all of them.
READ_ONLY = {
    "revenue_by_date": {"event_type": [PURCHASE]},
    "top_skus_by_quantity": {"event_type": SALES_TYPES},
    "top_search_queries": {"event_type": [SEARCH]},
}


def _newest_days() -> list[Column]:
    return [F.desc(name) for name in DATE_KEYS]


def daily_event_counts(curated: DataFrame) -> DataFrame:
    return (
        curated.groupBy(*DATE_KEYS, "event_type")
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy(*_newest_days(), F.desc("events"), "event_type")
    )


def revenue_by_date(curated: DataFrame) -> DataFrame:
    return (
        curated.where(F.col("event_type") == PURCHASE)
        .groupBy(*DATE_KEYS)
        .agg(
            F.count(F.lit(1)).alias("purchases"),
            total("value").alias("revenue"),
            average("value").alias("avg_order_value"),
        )
        .orderBy(*_newest_days())
    )


def top_skus_by_quantity(curated: DataFrame, k: int = LIST_LENGTH) -> DataFrame:
    return (
        curated.where(F.col("event_type").isin(SALES_TYPES) & F.col("sku").isNotNull())
        .groupBy("sku")
        .agg(F.sum("quantity").alias("units"), F.count(F.lit(1)).alias("line_items"))
        .orderBy(F.desc_nulls_last("units"), "sku")
        .limit(k)
    )


def top_search_queries(curated: DataFrame, k: int = LIST_LENGTH) -> DataFrame:
    return (
        curated.where(
            (F.col("event_type") == SEARCH) & F.col("query").isNotNull() & (F.col("query") != "")
        )
        .groupBy(F.lower("query").alias("search_term"))
        .agg(F.count(F.lit(1)).alias("searches"), F.countDistinct("session_id").alias("sessions"))
        .orderBy(F.desc("searches"), "search_term")
        .limit(k)
    )


def daily_active_users(curated: DataFrame) -> DataFrame:
    return (
        curated.where(F.col("user_id").isNotNull())
        .groupBy(*DATE_KEYS)
        .agg(F.countDistinct("user_id").alias("dau"), F.countDistinct("session_id").alias("sessions"))
        .orderBy(*_newest_days())
    )


def events_by_country(curated: DataFrame) -> DataFrame:
    return (
        curated.where(F.col("country").isNotNull())
        .groupBy("country")
        .agg(F.count(F.lit(1)).alias("events"), F.countDistinct("user_id").alias("users"))
        .orderBy(F.desc("events"), "country")
    )


def hourly_event_rate(
    curated: DataFrame,
    as_of: datetime | str | Column | None = None,
    days: int = 7,
    *,
    arrived_since: str | None = None,
) -> DataFrame:
    """Events per hour and type over the ``days`` before ``as_of``.

    ``arrived_since`` (``YYYY-MM-DD``) additionally prunes ingest days before
    it. It is off by default: an event whose own clock runs ahead may have
    arrived earlier than its time says, and would vanish.
    """
    recent = curated.where(F.col("event_ts") >= clock(as_of) - F.make_dt_interval(F.lit(days)))
    if arrived_since is not None:
        year, month, day = arrived_since.split("-")
        recent = recent.where(
            (F.col("year") > year)
            | ((F.col("year") == year) & (F.col("month") > month))
            | ((F.col("year") == year) & (F.col("month") == month) & (F.col("day") >= day))
        )
    return (
        recent.groupBy(F.date_trunc("hour", "event_ts").alias("event_hour"), "event_type")
        .agg(F.count(F.lit(1)).alias("events"))
        .orderBy(F.desc("event_hour"), F.desc("events"), "event_type")
    )


def partition_freshness(curated: DataFrame) -> DataFrame:
    """Latest ingest day and processing time per type. ``concat`` skips no nulls."""
    day = F.concat("year", F.lit("-"), "month", F.lit("-"), "day")
    return (
        curated.groupBy("event_type")
        .agg(F.max(day).alias("latest_partition"), F.max("processed_at").alias("last_processed_at"))
        .orderBy("event_type")
    )


def revenue_by_type_country(curated: DataFrame, year: str, month: str) -> DataFrame:
    """Value by type and country for one month. Works on the analyst view.

    ``revenue`` sums the value of every event type, as the saved query does.
    """
    return (
        curated.where((F.col("year") == year) & (F.col("month") == month))
        .groupBy("event_type", "country")
        .agg(total("value").alias("revenue"))
        .orderBy("event_type", "country")
    )
