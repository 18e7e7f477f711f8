"""Ingest-day handling. A day is a UTC date, held as zero-padded text parts."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class IngestDay(NamedTuple):
    year: str
    month: str
    day: str

    def folder(self) -> str:
        return f"year={self.year}/month={self.month}/day={self.day}"

    def iso(self) -> str:
        return "-".join(self)

    def condition(self) -> Column:
        """Equality on the three text partition columns, prunable by the scan."""
        return (
            (F.col("year") == self.year) & (F.col("month") == self.month) & (F.col("day") == self.day)
        )


def ingest_day(text: str | None = None, *, now: datetime | None = None) -> IngestDay:
    """Parse ``YYYY-MM-DD``; blank means the day before ``now`` in UTC."""
    cleaned = (text or "").strip()
    if cleaned:
        chosen: date = datetime.strptime(cleaned, "%Y-%m-%d").date()
    else:
        moment = now or datetime.now(timezone.utc)
        chosen = moment.astimezone(timezone.utc).date() - timedelta(days=1)
    return IngestDay(f"{chosen.year:04d}", f"{chosen.month:02d}", f"{chosen.day:02d}")


def day_columns(moment: Column) -> dict[str, Column]:
    """The year, month and day partition columns of a timestamp."""
    return {
        "year": F.date_format(moment, "yyyy"),
        "month": F.date_format(moment, "MM"),
        "day": F.date_format(moment, "dd"),
    }


def clock(as_of: datetime | str | Column | None) -> Column:
    """The given instant as a timestamp column, or the query's start time."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, datetime) and as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(str(as_of)).cast("timestamp")


def fixed_clock(moment: datetime | str | None) -> Column:
    """The given instant, or now: one value for all rows and actions of a run."""
    return clock(moment if moment is not None else datetime.now(timezone.utc))
